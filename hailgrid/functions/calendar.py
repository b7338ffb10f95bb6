"""Calendar columns and typed time bounds.

Two weekday conventions live side by side and are never mixed: ``day_of_week`` counts from
Sunday = 1 (model features), ``weekday_number`` from Monday = 1 (reports and dimensions).
Event times stay without zone, and so does arithmetic on them: results do not depend on the time
zone of the session.
"""

from __future__ import annotations

import math
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailgrid.fixed import DAY_PARTS


def month_span(year: int, month: int) -> tuple[datetime, datetime]:
    """First instant of a month and of the month after it."""
    if month not in range(1, 13):
        raise ValueError(f"month must lie in 1..12, got {month}")
    return datetime(year, month, 1), datetime(year + month // 12, month % 12 + 1, 1)


def shift_month(year: int, month: int, by: int) -> tuple[int, int]:
    """The (year, month) that lies ``by`` months away."""
    index = year * 12 + (month - 1) + by
    return index // 12, index % 12 + 1


def moment(df: DataFrame, column: str, value: datetime | date | str) -> Column:
    """A time literal of exactly the type of ``column``.

    Comparing a zone-less column with a zoned literal would wrap the *column* in a cast, and
    the Parquet reader could then not use the predicate to skip row groups.
    """
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    zoneless = isinstance(df.schema[column].dataType, T.TimestampNTZType)
    return F.expr(f"{'TIMESTAMP_NTZ' if zoneless else 'TIMESTAMP'} '{text}'")


def between_moments(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows of the half-open interval [start, end)."""
    return df.where(
        (F.col(column) >= moment(df, column, start)) & (F.col(column) < moment(df, column, end))
    )


def zoneless_hour(column: str) -> Column:
    """The start of the hour. ``date_trunc`` would go through the time zone of the session."""
    at = F.col(column).cast("timestamp_ntz")
    return F.to_date(at).cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(at))


def _since_midnight(column: str, exact: bool) -> Column:
    at = F.col(column)
    second = F.date_part(F.lit("SECOND"), at) if exact else F.second(at)
    return F.hour(at) * 3600 + F.minute(at) * 60 + second


def seconds_between(first: str, last: str, exact: bool = False) -> Column:
    """Seconds from one zone-less time to another, whatever the session's time zone.

    Fractions of a second are left out of both times, unless the result is to be ``exact``.
    ``timestamp_diff`` and ``unix_timestamp`` would go through the time zone of the session.
    """
    days = F.datediff(F.to_date(last), F.to_date(first)).cast("bigint")
    return days * 86_400 + (_since_midnight(last, exact) - _since_midnight(first, exact))


def iso_weekday(column: str) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(column) + 1


def weekday_name(column: str) -> Column:
    return F.date_format(column, "EEEE")


def day_part(hour: Column) -> Column:
    label = F.lit(DAY_PARTS[-1][1])
    for last_hour, name in reversed(DAY_PARTS[:-1]):
        label = F.when(hour <= last_hour, name).otherwise(label)
    return label


def weekend_flag(day_of_week: str = "day_of_week") -> Column:
    """1 on Saturday and Sunday, for the Sunday = 1 convention."""
    return F.col(day_of_week).isin(1, 7).cast("int")


def cycle(prefix: str, column: str, period: int) -> dict[str, Column]:
    """Sine and cosine position of a calendar value on its circle.

    A calendar value has only ``period`` positions, so they are looked up in a constant array;
    Spark's own sin and cos would be the most expensive part of a feature row.
    """
    angles = [2 * math.pi * step / period for step in range(period)]
    step = F.col(column) % period
    return {
        f"{prefix}_{name}": F.get(F.array(*[F.lit(curve(angle)) for angle in angles]), step)
        for name, curve in (("sin", math.sin), ("cos", math.cos))
    }


def with_time_features(demand: DataFrame) -> DataFrame:
    """Calendar features of the historical model."""
    at = "pickup_hour"
    return demand.withColumns(
        {"hour": F.hour(at), "day_of_week": F.dayofweek(at), "day_of_month": F.dayofmonth(at)}
    ).withColumns(
        {"is_weekend": weekend_flag(), **cycle("hour", "hour", 24), **cycle("dow", "day_of_week", 7)}
    )


def with_cycles(slots: DataFrame) -> DataFrame:
    """Weekend flag and circle positions for rows that carry hour, day_of_week and month."""
    return slots.withColumns(
        {
            "is_weekend": weekend_flag(),
            **cycle("hour", "hour", 24),
            **cycle("dow", "day_of_week", 7),
            **cycle("month", "month", 12),
        }
    )


def with_future_calendar(demand: DataFrame) -> DataFrame:
    """Calendar features that depend on nothing but the timestamp."""
    at = "pickup_hour"
    return with_cycles(
        demand.withColumns({"hour": F.hour(at), "day_of_week": F.dayofweek(at), "month": F.month(at)})
    )
