"""Language identification by Bayesian fusion of evidence.

``P(language | everything)`` is in proportion to three factors:

* the likelihood of the text, from a naive Bayes model of hashed byte trigrams, tempered because
  neighbouring trigrams are not independent;
* the probability that a page of this language declares what the markup declares, from a table of
  declared languages against the languages of texts, counted over all rows;
* the prior of the host. Posteriors of texts alone are summed by host, by registered domain, by address
  suffix and over all; each level is smoothed with the one above it, so a host with few pages has the
  languages of its domain, a new domain those of its suffix.

Every label has a model, however rare it is. All rows are counted by label, and each label gives as many rows as
its equal part of ``SAMPLE_ROWS``, one at least: those with the smallest hashes of their ids, or of their texts
where they have no id. Rows of one id and label count as one there. Everything else covers all rows.

A row is rejected if its text is empty or blank, if trigrams drawn at random would explain it better than
any language by ``CHANCE`` (log-likelihood of a trigram) or more, or if no language has a posterior of
``CERTAIN``. Whether a text is any good is not asked.

Texts can be those of HTML pages (``page_text``): without comments, scripts, styles and tags, with entities as
characters. Columns without hosts or declarations give no such evidence: names without a dot have no domain or
suffix, and a column that is the label of training as well is no independent declaration.

Rules: null, empty and blank texts have no evidence of their own and are rejected; their language is the one that
declaration and host speak for. Null or unknown declarations and null hosts are no evidence. Hosts without
a dot have neither domain nor suffix. Repeated rows count as often as they occur; ids may be null. Extra
columns are kept if asked for. Without labelled rows there is no model and ``train`` raises ValueError,
unless the table is empty; an empty table gives no rows.
"""

from __future__ import annotations

import html as markup
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailgrid.llm.arrow import column, slices, trimmed

SAMPLE_ROWS = 4000
CODES = 1 << 16
SMOOTH = 0.1
#: Share of the log-likelihood of a trigram that counts.
TEMPER = 0.3
#: Rows of the level above that a level's own rows are mixed with.
PRIOR_ROWS = 20.0
#: Rows of agreement that the table of declarations starts with.
DECLARED_ROWS = 5.0
CERTAIN = 0.5
CHANCE = 2.0

# Suffixes under which domains are registered one label further down.
SECOND_LEVEL = ("co", "com", "org", "net", "ac", "gov", "edu")


def codes(text: str) -> np.ndarray:
    """Hashed trigrams of the UTF-8 bytes of a text, A-Z as a-z, with a blank on both sides."""
    if not text or text.isspace():
        return np.zeros(0, np.int64)
    octets = np.frombuffer(f" {text} ".encode("utf-8", "surrogatepass"), np.uint8)
    upper = (octets >= 65) & (octets <= 90)
    x = (octets + (upper.astype(np.uint8) << 5)).astype(np.uint32)
    mixed = (x[:-2] | x[1:-1] << np.uint32(8) | x[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)
    return (mixed >> np.uint32(16)).astype(np.int64)


class Model:
    """Log probabilities of trigrams by language."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table

    @staticmethod
    def train(texts: list[str], labels: list[str]) -> Model:
        languages = sorted(set(labels))
        number = {x: i for i, x in enumerate(languages)}
        counts = np.full((len(languages), CODES), SMOOTH)
        for text, label in zip(texts, labels):
            counts[number[label]] += np.bincount(codes(text), minlength=CODES)
        return Model(languages, np.ascontiguousarray(np.log(counts / counts.sum(1, keepdims=True)).T.astype(np.float32)))

    def score(self, text: str | None) -> tuple[int, float, list[float]]:
        """Number of trigrams, how far (for each) the best language is above chance, log-likelihoods."""
        found = codes(text or "")
        n = len(found)
        if not n:
            return 0, 0.0, [0.0] * len(self.languages)
        total = np.zeros(len(self.languages))
        for start in range(0, n, 1 << 18):
            total += self.table[found[start : start + (1 << 18)]].sum(0, dtype=np.float64)
        return n, float(total.max() / n + np.log(CODES)), (total - total.max()).tolist()

    def pack(self) -> tuple[str, bytes]:
        return json.dumps(self.languages), self.table.tobytes()

    @staticmethod
    def unpack(head: str, table: bytes) -> Model:
        languages = json.loads(head)
        return Model(languages, np.frombuffer(table, np.float32).reshape(CODES, len(languages)))


def train(rows: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> Model | None:
    """A model from a sample of the rows of each label; None for an empty table."""
    place = F.when(F.col(key).isNull(), F.xxhash64(F.lit(1), text)).otherwise(F.xxhash64(key))
    known = rows.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.lower(label).alias("label"), place.alias("key"), F.col(text).alias("text")
    )
    labels = known.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least")).collect()
    if not labels:
        if rows.limit(1).count():
            raise ValueError("no labelled rows to train on")
        return None
    quota = max(1, SAMPLE_ROWS // len(labels))
    # About twice as many rows of a label as wanted are below its bound, the one with its smallest hash always.
    bounds = [(x["label"], max(x["least"], min(2**63 - 1, -(2**63) + 2**65 * quota // x["n"]))) for x in labels]
    spark = rows.sparkSession
    bounded = F.broadcast(spark.createDataFrame(bounds, "label string, bound long"))
    near = known.join(bounded, "label").where("key <= bound").select("label", "key").distinct()
    rank = F.row_number().over(Window.partitionBy("label").orderBy("key"))
    picked = near.withColumn("rank", rank).where(F.col("rank") <= quota).select("label", "key").collect()
    wanted = F.broadcast(spark.createDataFrame(picked, "label string, key long"))
    sample = known.join(wanted, ["label", "key"]).groupBy("label", "key").agg(F.min("text").alias("text"))

    @trimmed
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            found += zip(*(column(batch, x) for x in ("key", "label", "text")))
        found.sort()
        if found:
            head, table = Model.train([x[2] for x in found], [x[1] for x in found]).pack()
            yield pa.RecordBatch.from_arrays([pa.array([head]), pa.array([table], pa.binary())], names=["head", "table"])

    # One task, for the sample is bounded.
    head, table = sample.repartition(1).mapInArrow(work, "head string, table binary").collect()[0]
    return Model.unpack(head, bytes(table))


def markup_language(html: str) -> Column:
    """What the ``lang`` attribute of the html element declares."""
    found = F.regexp_extract(F.col(html), r"""(?i)<html\b[^>]*\slang\s*=\s*["']?([A-Za-z-]+)""", 1)
    return F.when(found != "", found)


def url_host(url: str) -> Column:
    found = F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.I | re.S)
# Quoted values may hold >; an odd quote ends with the tag.
_TAG = re.compile(r"""<[/!?a-z](?:[^<>"']|"[^"<]*+"|'[^'<]*+')*+>|<[/!?a-z][^<>]*+>""", re.I)


def page_text(html: str | None) -> str:
    """The text of a page, with a blank for each tag."""
    return markup.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", html or "")))


def _suffix(host: str) -> Column:
    return F.when(F.col(host).contains("."), F.element_at(F.split(host, r"\."), -1))


def _domain(host: str) -> Column:
    labels = F.split(host, r"\.")
    second = F.try_element_at(labels, F.lit(-2))
    third = second.isin(*SECOND_LEVEL) & (F.length(F.element_at(labels, -1)) == 2)
    found = F.when(third, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))
    return F.when(F.col(host).contains("."), found)


def identify(
    rows: DataFrame, model: Model | None, folder: str, key: str = "doc_id", text: str = "text",
    declared: str | Column | None = "lang", host: str | Column | None = "source", keep: tuple[str, ...] = (),
    html: bool = False,
) -> DataFrame:
    """``key, language, posterior, text_language, declared, n_trigrams, accepted`` per row, and ``keep``.

    ``html``: the text column holds pages, and their text counts.
    """
    spark = rows.sparkSession
    if model is None:
        kinds = "language string, posterior double, text_language string, declared string, n_trigrams long, accepted boolean"
        none = rows.select(F.col(key).cast("long").alias(key), *keep).where(F.lit(False))
        return none.select("*", *[F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in kinds.split(", ")])
    column_of = lambda x: F.lit(None).cast("string") if x is None else F.col(x) if isinstance(x, str) else x
    told = F.lower(F.regexp_extract(column_of(declared).cast("string"), r"^\s*([A-Za-z]{2,3})\b", 1))
    given = rows.select(
        F.col(key).cast("long").alias("key"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)],
        F.col(text).cast("string").alias("text"), told.alias("declared"), F.lower(column_of(host).cast("string")).alias("host"),
    )
    languages = model.languages
    packed = spark.sparkContext.broadcast(model.pack())  # a fixed size for each language
    plain = [c for c in given.columns if c != "text"]
    schema = given.select(*plain).schema.add("n_trigrams", "long").add("above", "double").add("likelihood", T.ArrayType(T.DoubleType()))

    @trimmed
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.unpack(*packed.value)
        for batch in slices(batches):
            got = [own.score(page_text(x) if html else x) for x in column(batch, "text")]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in plain]
            arrays += [pa.array([x[i] for x in got], t) for i, t in enumerate((pa.int64(), pa.float64(), pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*plain, "n_trigrams", "above", "likelihood"])

    given.mapInArrow(work, schema).write.mode("overwrite").parquet(folder)
    scored = spark.read.schema(schema).parquet(folder)
    each = range(len(languages))
    names = F.array(*[F.lit(x) for x in languages]).cast("array<string>")
    tempered = [F.col("likelihood")[i] * TEMPER for i in each]
    # The best language has log-likelihood 0, so no sum of these is 0.
    weights = [F.exp(x) for x in tempered]
    total = sum(weights, F.lit(0.0))
    scored = scored.withColumns({
        "suffix": _suffix("host"), "domain": _domain("host"), "seen": F.col("n_trigrams") > 0,
        **{f"text_{i}": weights[i] / total for i in each},
    })
    sums = [F.sum(F.when(F.col("seen"), F.col(f"text_{i}")).otherwise(0.0)).alias(f"n_{i}") for i in each]
    again = [F.sum(f"n_{i}").alias(f"n_{i}") for i in each]

    # Soft counts by declared language and host: the one aggregation over all rows.
    counts = scored.groupBy("declared", "suffix", "domain", "host").agg(F.count(F.lit(1)).alias("rows"), *sums)
    table = {x["declared"]: [x[f"n_{i}"] for i in each] for x in counts.where(F.col("declared").isin(languages)).groupBy("declared").agg(*again).collect()}
    agreed = np.full((len(languages), len(languages)), DECLARED_ROWS / len(languages))
    for i, name in enumerate(languages):
        agreed[i, i] += DECLARED_ROWS
        agreed[i] += np.array(table.get(name, [0.0] * len(languages)))
    agreed = np.log(agreed / agreed.sum(0, keepdims=True))

    hosts = counts.where("host is not null").groupBy("suffix", "domain", "host").agg(*again)
    domains = hosts.where("domain is not null").groupBy("suffix", "domain").agg(*again)
    suffixes = domains.groupBy("suffix").agg(*again)
    whole = counts.agg(*again).first()
    n = np.array([(whole[f"n_{i}"] or 0.0) + 1.0 for i in each])
    base = (n / n.sum()).tolist()

    def smoothed(level: DataFrame, above: list[Column], prefix: str) -> DataFrame:
        seen = sum((F.col(f"n_{i}") for i in each), F.lit(0.0))
        made = {f"{prefix}_{i}": (F.col(f"n_{i}") + PRIOR_ROWS * above[i]) / (seen + PRIOR_ROWS) for i in each}
        return level.withColumns(made).drop(*[f"n_{i}" for i in each])

    suffixes = smoothed(suffixes, [F.lit(x) for x in base], "s")
    domains = domains.join(suffixes, "suffix")
    domains = smoothed(domains, [F.col(f"s_{i}") for i in each], "d").select("domain", *[f"d_{i}" for i in each])
    hosts = hosts.join(domains, "domain", "left")
    hosts = smoothed(hosts, [F.coalesce(F.col(f"d_{i}"), F.lit(base[i])) for i in each], "h")
    hosts = hosts.select("host", *[f"h_{i}" for i in each])

    fused = scored.join(hosts, "host", "left")
    said = []
    for i in each:
        one = F.lit(0.0)
        for j, name in enumerate(languages):
            one = F.when(F.col("declared") == name, F.lit(float(agreed[j, i]))).otherwise(one)
        said.append(one)
    logs = F.array(*[tempered[i] + said[i] + F.log(F.coalesce(F.col(f"h_{i}"), F.lit(base[i]))) for i in each]).cast("array<double>")
    fused = fused.withColumn("logs", logs).withColumn("most", F.array_max("logs"))
    odds = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("most")))
    best = F.element_at(names, F.array_position("logs", F.col("most")).cast("int"))
    spoken = F.element_at(names, F.array_position("likelihood", F.array_max("likelihood")).cast("int"))
    posterior = F.round(F.lit(1.0) / odds, 6)
    return fused.select(
        F.col("key").alias(key), *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)],
        best.alias("language"), posterior.alias("posterior"),
        F.when(F.col("seen"), spoken).alias("text_language"), "declared", "n_trigrams",
        (F.col("seen") & (F.col("above") > -CHANCE) & (posterior >= CERTAIN)).alias("accepted"),
    )
