"""Exact top-k by inner product with M-trees of pages.

Vectors are whole numbers under the Euclidean metric. They are divided among trees by the nearest of a few
pivots, and a large share is divided further, so that a tree has about ``TREE`` vectors. A tree consists of
pages of up to ``PAGE`` entries. A routing entry has its object ``o``, the covering radius ``r`` of the
subtree and the distance to the object ``p`` of the page above; a leaf entry has a vector and that
distance. With ``q.p`` known from above, the triangle inequality gives bounds without any computation on
the entry: a vector of the subtree scores at most ``q.p + |q| (d(o, p) + r)``. Only entries that this bound
leaves possible are computed, and only subtrees with ``q.o + |q| r`` above the k-th score are queued.
Pages are visited best first, so the search ends when the best bound is below the k-th score.

Trees are stored as rows. Each query goes to the trees whose root bound reaches its k-th score within a
bounded sample, and meets them in blocks of queries; the best ``k`` of all trees are the answer. Scores are
exact integers; bounds have a margin for rounding, and bounds that equal the k-th score are followed,
unless all ids of the subtree are larger than that of the k-th, so ties go to the smaller id.

Rules: a vector that is null, or has null or non-finite components, takes no part, nor does one without an
id; only vectors of one length are compared with each other. A query is not compared with rows of its own
id. Rows with one id are candidates each; as queries each has its own ranks, equal rows too. Fewer than ``k`` candidates
give fewer rows. Components must stay below 2**31 after scaling. Extra columns take no part. Empty tables
give no rows.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hailgrid.llm.arrow import column, slices
from hailgrid.llm.sampling import sampled_keys

PAGE, FAN = 512, 16
PIVOTS, TREE = 32, 8192
#: Rows whose scores give the first bound of each query, and from which pivots are chosen.
SAMPLE = 2048
#: Queries of a block.
BLOCK = 2048
_MARGIN = 1e-9

_FOUND = "query_id long, mark long, vec_id long, score long"
_FOUND_SCHEMA = pa.schema([("query_id", pa.int64()), ("mark", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def scaled(vector: str, scale: int) -> Column:
    """``floor(scale * x)`` of every component as double; null unless all are finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(wide, lambda x: F.floor(x * F.lit(float(scale)))))


def _matrix(batch, name: str) -> np.ndarray:
    rows = column(batch, name)
    return np.array(rows, np.int64).reshape(len(rows), -1)


def spread(vectors: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` distinct rows, each the farthest from those before it."""
    if not len(vectors):
        return vectors
    points = vectors.astype(float)
    chosen = [0]
    far = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < count and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
    return vectors[chosen]


def nearest(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each vector, and the distance."""
    x, p = vectors.astype(float), pivots.astype(float)
    squares = (x * x).sum(1)[:, None] - 2 * x @ p.T + (p * p).sum(1)
    best = squares.argmin(1)
    return best, np.sqrt(((x - p[best]) ** 2).sum(1))


class Tree:
    """Pages of a metric tree. ``pages[i]`` is a tuple of arrays; routing pages have a list of children."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, fan: int = FAN):
        self.pages: list[tuple] = []
        self.page, self.fan = page, fan
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        # Products stay exact as doubles below 2**53.
        top = float((vectors.astype(float) ** 2).sum(1).max()) if len(ids) else 0.0
        self.exact = top < 2**50
        self.vectors = vectors.astype(float) if self.exact else vectors
        self.ids = ids
        self.centre = self.vectors[0]
        distance = self._distances(np.arange(len(ids)), self.centre)
        self.radius = float(distance.max())
        self.root = self._grow(np.arange(len(ids)), self.centre, distance)

    def _distances(self, rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.vectors[rows].astype(float) - centre.astype(float)) ** 2).sum(1))

    def _grow(self, rows: np.ndarray, centre: np.ndarray, distance: np.ndarray) -> int:
        """Pages of ``rows`` below a routing object; ``distance`` is from each row to it."""
        if len(rows) <= self.page:
            self.pages.append((True, rows, self.vectors[rows], distance))
            return len(self.pages) - 1
        # Enough routing objects for half-full pages; they are taken at equal steps.
        count = min(self.fan, max(2, -(-2 * len(rows) // self.page)))
        pivots = np.unique(self.vectors[rows[:: len(rows) // count][:count]], axis=0)
        if len(pivots) > 1:
            owner, own = nearest(self.vectors[rows], pivots)
            groups = [(pivots[g], np.flatnonzero(owner == g)) for g in range(len(pivots))]
        else:  # mostly copies of one vector: divided in the order of ids
            own = self._distances(rows, pivots[0])
            size = -(-len(rows) // self.fan)
            groups = [(pivots[0], np.arange(s, min(s + size, len(rows)))) for s in range(0, len(rows), size)]
        objects, radii, above, children, least = [], [], [], [], []
        for pivot, at in groups:
            if not len(at):
                continue
            if len(at) == len(rows):  # nothing was divided
                half = len(at) // 2
                parts = [at[:half], at[half:]]
            else:
                parts = [at]
            for part in parts:
                objects.append(pivot)
                radii.append(float(own[part].max()))
                above.append(float(np.sqrt(((pivot.astype(float) - centre.astype(float)) ** 2).sum())))
                least.append(int(self.ids[rows[part]].min()))
                children.append(self._grow(rows[part], pivot, own[part]))
        self.pages.append((False, np.array(objects), np.array(radii), np.array(above), children, np.array(least)))
        return len(self.pages) - 1

    def search(self, query: np.ndarray, own_id: int, k: int, least: float = -np.inf) -> list[tuple[int, int]]:
        """Up to ``k`` pairs of score and id, none below ``least``, among ids other than ``own_id``."""
        if self.exact and float(np.abs(query).max(initial=0)) < 2**25:
            q = query.astype(float)
        else:
            q = query.astype(np.int64)
        vectors_of = (lambda x: x) if q.dtype == float else (lambda x: x.astype(np.int64))
        norm = float(np.sqrt((query.astype(float) ** 2).sum()))
        slack = _MARGIN * norm * (float(np.sqrt((self.centre.astype(float) ** 2).sum())) + 3 * self.radius + 1)
        best: list[tuple[int, int]] = []  # a heap of (score, -id)

        def floor() -> float:
            return max(least, best[0][0]) if len(best) == k else least

        def reaches(bounds: np.ndarray, first_ids: np.ndarray | None) -> np.ndarray:
            limit = floor()
            ok = bounds + slack >= limit
            if first_ids is not None and len(best) == k and best[0][0] >= least:
                # At equal scores an id above that of the k-th cannot come in.
                ok &= (bounds + slack >= limit + 1) | (first_ids < -best[0][1])
            return ok

        start = float(vectors_of(self.centre) @ q)
        queue = [(-(start + norm * self.radius), self.root, start)]
        while queue:
            bound, number, above = heapq.heappop(queue)
            if -bound + slack < floor():
                break
            page = self.pages[number]
            if page[0]:
                _, rows, vectors, distance = page
                ids = self.ids[rows]
                at = np.flatnonzero(reaches(above + norm * distance, ids) & (ids != own_id))
                if not len(at):
                    continue
                # Most of a page is computed as a whole, which is cheaper than picking its rows.
                scores = (vectors_of(vectors) @ q)[at] if 2 * len(at) > len(rows) else vectors_of(vectors[at]) @ q
                if len(at) > 4 * k:
                    best_of = np.partition(scores, len(at) - k)[len(at) - k]
                    at, scores = at[scores >= best_of], scores[scores >= best_of]
                for i in np.lexsort((ids[at], -scores))[:k]:
                    entry = (int(scores[i]), -int(ids[at[i]]))
                    if entry[0] < least:
                        break
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            else:
                _, objects, radii, distance, children, first_ids = page
                at = np.flatnonzero(reaches(above + norm * (distance + radii), first_ids))
                if not len(at):
                    continue
                own = vectors_of(objects[at]) @ q
                bounds = own + norm * radii[at]
                for i in np.flatnonzero(reaches(bounds, first_ids[at])):
                    heapq.heappush(queue, (-float(bounds[i]), children[at[i]], float(own[i])))
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))


def _seeds(queries: np.ndarray, ids: list[int], sample: np.ndarray, sample_ids: np.ndarray, k: int) -> np.ndarray:
    """For each query a score that ``k`` rows of the sample reach."""
    if len(sample) <= k:
        return np.full(len(queries), -np.inf)
    scores = queries.astype(float) @ sample.astype(float).T
    scores[np.array(ids)[:, None] == sample_ids[None, :]] = -np.inf
    seeds = np.partition(scores, len(sample) - k, axis=1)[:, len(sample) - k]
    return seeds - 1e-6 * np.abs(seeds)


def top(
    rows: DataFrame, folder: str, is_query: Column, k: int = 5, scale: int = 256, key: str = "vec_id",
    vector: str = "embedding", tree: int = TREE, pivots: int = PIVOTS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the best ``k`` rows for each row that ``is_query``."""
    spark = rows.sparkSession
    held = rows.select(
        F.col(key).cast("long").alias("vec_id"), scaled(vector, scale).alias("x"), is_query.alias("asks"),
        F.xxhash64(key, vector).alias("mark"),
    ).where("vec_id is not null and x is not null and size(x) > 0")
    picked = sampled_keys(held, "mark", SAMPLE)
    sample = held.where(F.col("mark").isin(picked)).select("vec_id", "x").limit(2 * SAMPLE).collect()
    by_size: dict[int, tuple] = {}
    for size in {len(r["x"]) for r in sample}:
        some = sorted((r["vec_id"], r["x"]) for r in sample if len(r["x"]) == size)
        vectors = np.array([x for _, x in some], np.int64)
        by_size[size] = (np.array([i for i, _ in some]), vectors, spread(vectors, pivots))

    def pivots_of(size: int) -> np.ndarray:
        return by_size[size][2] if size in by_size else np.zeros((1, size), np.int64)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["vec_id", "x", "share", "far"]
        for batch in slices(batches):
            ids, xs = column(batch, "vec_id"), column(batch, "x")
            shares, far = [], []
            for x in xs:
                pivot, distance = nearest(np.array([x], np.int64), pivots_of(len(x)))
                shares.append(f"{len(x)}-{int(pivot[0])}")
                far.append(float(distance[0]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(xs, pa.list_(pa.int64())), pa.array(shares), pa.array(far)], names=names
            )

    shared = held.select("vec_id", "x").mapInArrow(assign, "vec_id long, x array<long>, share string, far double")
    shared.write.mode("overwrite").parquet(f"{folder}/shares")
    shared = spark.read.parquet(f"{folder}/shares")
    # As many rows as pivots for each length of vectors.
    sizes = {r["share"]: (r["n"], r["far"]) for r in shared.groupBy("share").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
    parts = {s: -(-n // tree) for s, (n, _) in sizes.items()}
    known = F.create_map(*[F.lit(x) for s, n in parts.items() for x in (s, n)]) if parts else F.create_map(F.lit(""), F.lit(1))
    part = F.pmod(F.xxhash64("vec_id"), known[F.col("share")])
    named = shared.select(F.concat_ws("-", "share", part.cast("string")).alias("tree"), "vec_id", "x")

    def build(table: pa.Table) -> pa.Table:
        one = Tree(np.array(column(table, "vec_id"), np.int64), _matrix(table, "x"))
        data = pickle.dumps(one, protocol=5)
        return pa.table({"tree": [column(table, "tree")[0]], "pages": pa.array([data], pa.binary())})

    named.groupBy("tree").applyInArrow(build, "tree string, pages binary").write.mode("overwrite").parquet(f"{folder}/trees")
    trees = spark.read.schema("tree string, pages binary").parquet(f"{folder}/trees")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query_id", "mark", "x", "least", "tree"]
        for batch in slices(batches, 1 << 18):
            ids, marks, xs = (column(batch, c) for c in ("vec_id", "mark", "x"))
            out = []
            for size in {len(x) for x in xs}:
                at = [i for i, x in enumerate(xs) if len(x) == size]
                queries = np.array([xs[i] for i in at], np.int64)
                sample_ids, sample_of, _ = by_size.get(size, (np.zeros(0), np.zeros((0, size)), None))
                seeds = _seeds(queries, [ids[i] for i in at], sample_of, sample_ids, k)
                norms = np.sqrt((queries.astype(float) ** 2).sum(1))
                pivot_scores = queries.astype(float) @ pivots_of(size).astype(float).T
                for j, i in enumerate(at):
                    for number in range(pivot_scores.shape[1]):
                        share = f"{size}-{number}"
                        if share not in sizes:
                            continue
                        most = pivot_scores[j, number] + norms[j] * sizes[share][1]
                        if most + 1e-6 * abs(most) + 1 >= seeds[j]:
                            out += [(ids[i], marks[i], xs[i], float(seeds[j]), f"{share}-{p}") for p in range(parts[share])]
            types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(types)], names=names)

    # Equal query rows are searched for once, and answered once each.
    queries = held.where("asks").groupBy("vec_id", "mark", "x").agg(F.count(F.lit(1)).alias("copies"))
    copies = queries.where("copies > 1").select(F.col("vec_id").alias("query_id"), "mark", "copies")
    queries = queries.select("vec_id", "mark", "x")
    blocks = max(1, -(-queries.count() // BLOCK))
    routed = queries.mapInArrow(route, "query_id long, mark long, x array<long>, least double, tree string")
    routed = routed.withColumn("block", F.pmod(F.xxhash64("mark"), F.lit(blocks)).cast("int"))
    spread_trees = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(asked: pa.Table, held_tree: pa.Table) -> pa.Table:
        out = []
        if asked.num_rows and held_tree.num_rows:
            one: Tree = pickle.loads(held_tree.column("pages")[0].as_py())
            xs = _matrix(asked, "x")
            for own, mark, x, least in zip(column(asked, "query_id"), column(asked, "mark"), xs, column(asked, "least")):
                out += [(own, mark, i, s) for s, i in one.search(x, own, k, least)]
        return pa.Table.from_arrays([pa.array([r[c] for r in out], f.type) for c, f in enumerate(_FOUND_SCHEMA)], schema=_FOUND_SCHEMA)

    pairs = routed.groupBy("tree", "block").cogroup(spread_trees.groupBy("tree", "block"))
    found = pairs.applyInArrow(search, _FOUND)
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    times = F.array_repeat(F.lit(0), F.coalesce("copies", F.lit(1)).cast("int"))
    answers = ranked.join(copies, ["query_id", "mark"], "left").withColumn("copy", F.explode(times))
    return answers.select("query_id", "rank", "vec_id", "score")
