"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailgrid.functions.storage import new_folder
from hailgrid.llm import (
    alignment, anchors, bitplane, bpe, hilbert, language, line_chunks, merkle, merkle_sql, mixing, mixing_sql, mtree, ngram_join, syncmers, warc,
)

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def importable(spark: SparkSession) -> None:
    """Let local Python workers import this package; on a cluster it is installed or sent with --py-files."""
    context = spark.sparkContext
    if context.master.startswith("local"):
        known = context.environment.get("PYTHONPATH", "").split(os.pathsep)
        if ROOT not in known:
            context.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_bitplane_ids")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, write shard files of byte planes, and read the files back."""
    folder = new_folder(spark, "bitplane")
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = bitplane.write_ids(table(spark, sf_dir, "documents"), folder, path, end_id=2)
    return bitplane.digests(bitplane.read_ids(spark, folder), manifest)


@query("op6_backtracking_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(bpe.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), path))


@query(
    "op10_zstd_warc",
    """
    WITH held AS (
        SELECT page_id, coalesce(html, '') AS payload FROM pages
    ), sized AS (
        SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
            max(page_id) OVER (PARTITION BY payload) AS last_id FROM held
    )
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
    FROM sized
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages to archives and read the archives back."""
    pages, folder = table(spark, sf_dir, "pages"), new_folder(spark, "warc")
    manifest = warc.write_archives(warc.identified(pages), folder, warc.train(pages))
    return warc.digests(warc.read_archives(spark, folder, payloads=False), manifest)


# A mixture of production shape: four domains of sources, languages below them, sources below those.
DOMAIN = "concat('d', try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 4)"
DOMAIN_SQL = "'d' || try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 4"
WEIGHTS = {"d0": 40, "d1": 30, "d2": 20, "d3": 10, "en": 50, "de": 20, "fr": 20, "es": 10, "d3/en": 25}
TOKENS, TOKENS_SQL = "(octet_length(text) + 3) div 4", "(strlen(text) + 3) // 4"
MIX_SEED = 17


@query(
    "op8_hierarchical_mix",
    mixing_sql.choose_sql(
        "documents", [("domain", DOMAIN_SQL), ("lang", "lang"), ("source", "source")], TOKENS_SQL, WEIGHTS,
        fraction=(6, 10), max_epochs=3, seed=MIX_SEED,
        out="doc_id, k_domain AS domain, k_lang AS lang, k_source AS source, t_::BIGINT AS tokens, copies",
    ),
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights; one row per document taken, with its number of epochs."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.expr(DOMAIN).alias("domain"), "lang", "source", F.expr(TOKENS).cast("long").alias("tokens")
    )
    keys = ["domain", "lang", "source"]
    chosen = mixing.choose(rows, keys, F.col("tokens"), WEIGHTS, (6, 10), max_epochs=3, seed=MIX_SEED)
    return chosen.withColumns({k: mixing.name_of(k) for k in keys})


@query("op5_closed_syncmers")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and their likeness to both."""
    return syncmers.digests(syncmers.compare_neighbours(table(spark, sf_dir, "documents")))


@query("op3_fixed_block_anchors")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages that an earlier document has."""
    return anchors.digests(anchors.repeats(table(spark, sf_dir, "documents")))


@query("op7_ngram_jaccard_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component of their near copies."""
    return ngram_join.join(table(spark, sf_dir, "documents"), new_folder(spark, "ngram_join"))


@query("op9_line_chunks")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without runs of lines that occur before."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_chunks.digests(line_chunks.remove(rows, new_folder(spark, "line_chunks"), whole=True))


@query("op2_language_evidence")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents and all pages.

    For documents the source is the host, and ``lang``, which trains the model too, what it declares. Pages have
    hosts with domains and suffixes, and declare their language in the markup.
    """
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model = language.train(rows)
    found = language.identify(rows, model, new_folder(spark, "language"))
    pages = language.identify(
        table(spark, sf_dir, "pages"), model, new_folder(spark, "language-pages"), key="page_id", text="html",
        declared=language.markup_language("html"), host=language.url_host("url"), html=True,
    )
    both = found.withColumn("origin", F.lit("documents")).unionByName(pages.withColumn("origin", F.lit("pages")), allowMissingColumns=True)
    return both.select("origin", "doc_id", "page_id", *[c for c in found.columns if c != "doc_id"])


@query(
    "op4_mtree_top5",
    """
    WITH held AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
        WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x::DOUBLE[], c.x::DOUBLE[]) AS BIGINT) AS score
        FROM held q JOIN held c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every fiftieth vector."""
    rows = table(spark, sf_dir, "embeddings")
    return mtree.top(rows, new_folder(spark, "mtree"), F.col("vec_id") % 50 == 0)


@query("op12_hilbert_shards")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards along a curve through source, language and length, read back from the files."""
    folder = new_folder(spark, "hilbert")
    hilbert.write_shards(table(spark, sf_dir, "documents"), folder, ["source", "lang", "n_chars"], shards=16)
    return hilbert.digests(hilbert.read_shards(spark, folder))


@query("op13_merkle_levels", merkle_sql.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their proofs, and what tampered copies lead to."""
    return merkle.verified(table(spark, sf_dir, "documents"), new_folder(spark, "merkle"))


@query("op11_interval_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in two tokenizers, and how common the pairs of ids are that their tokens link."""
    a_path, b_path = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    chunks = alignment.store(table(spark, sf_dir, "documents"), new_folder(spark, "alignment"), a_path, b_path)
    return alignment.documents(chunks, b_path)
