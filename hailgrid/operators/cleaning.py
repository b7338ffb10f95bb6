"""Trip cleaning: time window, chronology, removal of reversed charges.

A reversal is found by the key of its trip. Few keys have a negative fare, so a Bloom filter of those keys parts
the trips: whatever the filter rules out is passed on without a shuffle, and only suspects are grouped and joined
exactly. What the filter lets through by mistake is found to be no reversal, so its size changes the cost and never
the result. The filter is part of the plan; nothing is counted before the plan runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailgrid.fixed import DEMAND_COLUMNS, DROPOFF, PICKUP, TRIP_KEY
from hailgrid.functions.calendar import between_moments

CHARGED_BACK = "fare_amount < 0"
#: Words of the filter, 64 bits each, and so the most rows of it that are ever broadcast: about 16 MB. Up to some
#: five million keys one in thirty others passes it.
FILTER_WORDS = 1 << 20
#: A key with more than this part of all reversed rows is removed by a broadcast join; there are fewer than 1,000.
HOT_SHARE = 1000
COMPLETE = " AND ".join(f"{name} IS NOT NULL" for name in TRIP_KEY)


def filter_time_window(trips: DataFrame, start, end) -> DataFrame:
    """Pickups in [start, end); the bounds reach the Parquet scan."""
    return between_moments(trips, PICKUP, start, end)


def filter_chronological(trips: DataFrame) -> DataFrame:
    """Trips that do not end before they start."""
    return trips.where(F.col(DROPOFF) >= F.col(PICKUP))


def demand_fields(trips: DataFrame) -> DataFrame:
    """Only the columns that demand counting reads."""
    return trips.select(*DEMAND_COLUMNS)


def _bit_place(words: int) -> tuple[Column, Column]:
    """The filter word of a key and its four bits there."""
    key = F.xxhash64(*TRIP_KEY)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(key, 40 + 6 * i) % 64).cast("int")) for i in range(4)]
    return F.pmod(key, F.lit(words)), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def key_filter(trips: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """A Bloom filter of the keys with a negative fare: one row per word in use. Tasks' filters are merged by OR."""
    word, bits = _bit_place(words)
    charged_back = trips.where(CHARGED_BACK).select(word.alias("word"), bits.alias("bits"))
    return charged_back.groupBy("word").agg(F.bit_or("bits").alias("filter_bits"))


def parted(trips: DataFrame, words: int = FILTER_WORDS) -> tuple[DataFrame, DataFrame]:
    """Trips whose key has no negative fare, and suspects: all trips with such a key, and a few others.

    With no words there is no filter, and every trip is a suspect. Empty key fields are compared as equal.
    """
    if not words:
        return trips.where(F.lit(False)), trips
    word, bits = _bit_place(words)
    known = F.broadcast(key_filter(trips, words))
    marked = trips.withColumns({"word": word, "bits": bits}).join(known, "word", "left")
    suspect = F.coalesce(F.col("filter_bits").bitwiseAND(F.col("bits")) == F.col("bits"), F.lit(False))
    return tuple(marked.where(side).select(trips.columns) for side in (~suspect, suspect))


def _groups(suspects: DataFrame) -> DataFrame:
    """Records and fare range per key; copies of a key are combined before the shuffle."""
    return suspects.groupBy(*TRIP_KEY).agg(
        F.count(F.lit(1)).alias("records"),
        F.min("fare_amount").alias("min_fare"),
        F.max("fare_amount").alias("max_fare"),
    )


REVERSED = "min_fare < 0 AND max_fare >= 0"


def correction_groups(trips: DataFrame, filter_words: int = FILTER_WORDS) -> DataFrame:
    """Trip keys charged and charged back, with record count and fare range.

    Empty key fields compare as equal here. Only suspects are grouped.
    """
    return _groups(parted(trips, filter_words)[1]).where(REVERSED)


def correction_summary(trips: DataFrame) -> DataFrame:
    """Number of correction groups and of records beyond the first of each group."""
    return correction_groups(trips).agg(
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum(F.col("records") - 1), F.lit(0)).alias("extra_records"),
    )


def drop_reversals(trips: DataFrame, filter_words: int = FILTER_WORDS) -> DataFrame:
    """Remove every record of a trip that was charged and charged back.

    A key with an empty field never matches, so such records stay. A key qualifies when it has both a negative
    and a non-negative fare. Suspects meet the reversed keys in two joins: the few keys that hold much of the
    reversed rows are broadcast, so none of them is sent to one task, and the others are joined by hash.
    """
    clear, suspects = parted(trips, filter_words)
    reversed_keys = _groups(suspects).where(f"{REVERSED} AND {COMPLETE}")
    total = reversed_keys.agg(F.sum("records")).scalar()
    hot = reversed_keys.where(F.col("records") * HOT_SHARE > total).select(*TRIP_KEY)
    cold = reversed_keys.where(F.col("records") * HOT_SHARE <= total).select(*TRIP_KEY)
    kept = suspects.join(F.broadcast(hot), TRIP_KEY, "left_anti").join(cold, TRIP_KEY, "left_anti")
    return clear.unionByName(kept)


def surviving_keys(suspects: DataFrame) -> DataFrame:
    """Keys of suspects that are no reversal, with their number of records."""
    gone = F.expr(f"{REVERSED} AND {COMPLETE}")
    return _groups(suspects).where(~F.coalesce(gone, F.lit(False)))


def clean_trips(trips: DataFrame, start, end, filter_words: int = FILTER_WORDS) -> DataFrame:
    """Window, chronology and reversal removal in this order."""
    in_time = filter_chronological(filter_time_window(trips, start, end))
    return drop_reversals(in_time, filter_words)
