"""Merkle manifest of a dataset: trees of hashes per group, kept as strings of whole levels.

Every row is a leaf: the hash of its fields. The leaves of a group, in ascending order of the key, are hashed
in runs of three, and so on until one node is left, the group's subroot. The subroots, in order of the groups,
make one more such tree, whose top is the root.

``WIDTH`` consecutive nodes that start at a multiple of ``WIDTH`` form a block. A block keeps each of its levels
as one string of hexadecimal digests, 64 bytes each; the level above it hashes fixed-width substrings of 192
bytes. What stands left and right of a node within its run is its segment of a proof. The tops of blocks are the
nodes of the next round, which is done in the same way, so a tree over n leaves takes log n / log WIDTH rounds,
and no task ever holds more than a block, however many leaves a group has.

Rules: a null field is written as ``-``, any other as its size in UTF-8, a colon and its value, so fields cannot
run into each other. Rows without a key come first in their group; rows without a group make the first group.
Rows of one key are ordered by their leaves; full copies are leaves of their own with equal digests but
positions, and proofs, of their own. A group of one row has that row's leaf as its subroot. Empty and long texts
are hashed like any other. Other columns take no part. An empty table has no leaves, no root and no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hailgrid.llm.ranges import numbered

#: Nodes that are hashed together.
FAN = 3
#: Levels of a block, and the nodes at its bottom.
LEVELS = 5
WIDTH = FAN**LEVELS
#: Bytes of a digest.
DIGEST = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left:string,right:string>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    """The hash of a row's fields; integers are written in decimals."""
    texts = [field.cast("string") for field in fields]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return digest(F.concat(*[F.coalesce(t, F.lit("-")) for t in sized]))


def fold(start: Column, proof: Column) -> Column:
    """The top that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda node, step: digest(F.concat(step["left"], node, step["right"])))


def segments(proof: Column) -> Column:
    """All siblings of a proof as one text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def _above(level: Column) -> Column:
    """The level over a level: substrings of three digests, hashed."""
    size = FAN * DIGEST
    last = F.floor((F.octet_length(level) - 1) / size).cast("int")
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(F.substring(level, i * size + 1, F.lit(size)), 256))
    return F.array_join(runs, "").cast("binary")


def _heights() -> Column:
    """How many levels are built over a block's first: all, unless the block is its whole, smaller tree."""
    exact = F.lit(LEVELS)
    for height in range(LEVELS - 1, -1, -1):
        exact = F.when(F.col("count") <= FAN**height, F.lit(height)).otherwise(exact)
    return F.when(F.col("block") == 0, exact).otherwise(F.lit(LEVELS))


def _blocks(nodes: DataFrame, items: list[str]) -> DataFrame:
    """Blocks of nodes (group, position, node): their levels, and the items of their members in order."""
    member = F.struct("position", *items, "node")
    found = nodes.groupBy("group", F.floor(F.col("position") / WIDTH).alias("block")).agg(
        F.sort_array(F.collect_list(member)).alias("held")
    )
    bottom = F.array_join(F.transform("held", lambda m: m["node"]), "").cast("binary")
    found = found.select(
        "group", "block", F.size("held").alias("count"), bottom.alias("bottom"),
        F.transform("held", lambda m: F.struct(*[m[i].alias(i) for i in ("position", *items)])).alias("members"),
    ).withColumn("height", _heights())
    grown = F.aggregate(
        F.sequence(F.lit(1), F.col("height")), F.array("bottom"),
        lambda levels, _: F.concat(levels, F.array(_above(F.element_at(levels, -1)))),
    )
    levels = F.when(F.col("height") > 0, grown).otherwise(F.array("bottom"))
    return found.select("group", "block", "height", "members", levels.alias("levels"))


def _step(levels: Column, level: Column, index: Column) -> Column:
    """What stands left and right of the node over member ``index`` in its run."""
    powers = F.array(*[F.lit(FAN**i) for i in range(LEVELS)])
    node = F.floor(index / F.element_at(powers, level + 1)).cast("int")
    within = node % FAN
    text = F.element_at(levels, level + 1)
    left = F.substring(text, (node - within) * DIGEST + 1, within * DIGEST)
    right = F.substring(text, (node + 1) * DIGEST + 1, (F.lit(FAN - 1) - within) * DIGEST)
    return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))


def _members(blocks: DataFrame, items: list[str], above: DataFrame) -> DataFrame:
    """Every member of every block with its node and proof; ``above`` has those of the blocks' tops."""
    carried = [c for c in above.columns if c not in ("group", "position", "proof", "node")]
    top = above.select(
        F.col("group").alias("top_group"), F.col("position").alias("top_position"), F.col("proof").alias("top_proof"), *carried
    )
    joined = blocks.join(top, blocks["group"].eqNullSafe(top["top_group"]) & (blocks["block"] == top["top_position"]))
    own = F.when(F.col("height") > 0, F.sequence(F.lit(0), F.col("height") - 1)).otherwise(F.lit([]).cast("array<int>"))

    def placed(member: Column, index: Column) -> Column:
        steps = F.transform(own, lambda level: _step(F.col("levels"), level, index))
        node = F.substring(F.col("levels")[0], index * DIGEST + 1, F.lit(DIGEST)).cast("string")
        return F.struct(*[member[i].alias(i) for i in ("position", *items)], node.alias("node"), steps.alias("steps"))

    each = joined.select("group", "top_proof", *carried, F.explode(F.transform("members", placed)).alias("m"))
    return each.select(
        "group", *[F.col(f"m.{i}").alias(i) for i in ("position", *items)], F.col("m.node").alias("node"),
        F.concat("m.steps", "top_proof").alias("proof"), *carried,
    )


@dataclass(frozen=True)
class Manifest:
    """Stored block tables of a dataset: ``rounds`` of them over its rows, and others over its subroots."""

    spark: SparkSession
    folder: str
    rounds: int
    root_rounds: int
    items: tuple[str, ...]

    def table(self, tree: str, round_: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{tree}-{round_}")

    def roots(self) -> DataFrame:
        """The root, in one row; none for an empty table."""
        last = self.table("roots", self.root_rounds - 1)
        return last.select(F.element_at("levels", -1).cast("string").alias("root"))

    def subroots(self) -> DataFrame:
        """Each group with its subroot, its proof up to the root, and the root."""
        start = self.table("roots", self.root_rounds - 1).select(
            "group", F.lit(0).cast("long").alias("position"), F.lit([]).cast(f"array<{STEP}>").alias("proof"),
            F.element_at("levels", -1).cast("string").alias("root"),
        )
        found = self._down("roots", self.root_rounds, ["name"], start)
        return found.select(F.col("name").alias("group"), F.col("node").alias("subroot"), "proof", "root")

    def proofs(self) -> DataFrame:
        """Each row's items with its leaf, its group's subroot, the root, and its proof up to the root."""
        start = self.subroots().withColumn("position", F.lit(0).cast("long"))
        found = self._down("rows", self.rounds, list(self.items), start)
        return found.select(*self.items, "group", F.col("node").alias("leaf"), "subroot", "root", "proof")

    def _down(self, tree: str, rounds: int, items: list[str], above: DataFrame) -> DataFrame:
        for round_ in range(rounds - 1, -1, -1):
            above = _members(self.table(tree, round_), items if round_ == 0 else [], above)
        return above


def _grow(nodes: DataFrame, items: list[str], folder: str, tree: str) -> int:
    """Store the block tables over nodes; how many rounds that took."""
    spark = nodes.sparkSession
    longest = nodes.agg(F.max("position")).first()[0] or 0
    rounds = 0
    while True:
        _blocks(nodes, items if rounds == 0 else []).write.parquet(f"{folder}/{tree}-{rounds}")
        rounds += 1
        if longest < WIDTH:
            return rounds
        longest //= WIDTH
        nodes = spark.read.parquet(f"{folder}/{tree}-{rounds - 1}").select(
            "group", F.col("block").alias("position"), F.element_at("levels", -1).cast("string").alias("node")
        )


def build(
    rows: DataFrame, folder: str, fields: tuple[str, ...] = FIELDS, group: str = "source", key: str = "doc_id",
    items: dict[str, Column] | None = None,
) -> Manifest:
    """Hash all rows and store the manifest in ``folder``. ``items`` are further values that go with a row."""
    spark, extra = rows.sparkSession, items or {}
    names = ["key", *extra]
    leaves = rows.select(
        F.col(group).cast("string").alias("group"), F.col(key).alias("key"), leaf([F.col(f) for f in fields]).alias("node"),
        *[value.alias(name) for name, value in extra.items()],
    )
    # Texts are read once; ranges are found in the few bytes that are left of a row.
    leaves.write.parquet(f"{folder}/leaves")
    placed = numbered(spark.read.parquet(f"{folder}/leaves"), ["group"], ["key", "node"], f"{folder}/order")
    rounds = _grow(placed, names, folder, "rows")
    tops = spark.read.parquet(f"{folder}/rows-{rounds - 1}").select(
        F.col("group").alias("name"), F.element_at("levels", -1).cast("string").alias("node")
    )
    ordered = numbered(tops, [], ["name"], f"{folder}/root-order").withColumn("group", F.lit(""))
    return Manifest(spark, folder, rounds, _grow(ordered, ["name"], folder, "roots"), tuple(names))


def tampered_leaf() -> Column:
    """The leaf without the text's line ends, where the CRC-32 of the key is even; the true one elsewhere."""
    chosen = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    others = [F.col(f) for f in FIELDS[:-1]]
    return F.when(chosen, leaf([*others, F.replace("text", F.lit("\n"), F.lit(""))]))


def verified(docs: DataFrame, folder: str) -> DataFrame:
    """All documents with proofs, and what tampered copies of them lead to."""
    manifest = build(docs, folder, items={"changed": tampered_leaf()})
    found = manifest.proofs()
    found = found.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("proof")))
    return found.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", digest(segments(F.col("proof"))).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
