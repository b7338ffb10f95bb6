"""Repeated passages, line chunks and near copies against brute force."""

import hashlib
import json
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import pytest

from hailgrid.llm import anchors, line_chunks, ngram_join
from hailgrid.llm.components import components
from hailgrid.llm.queries import QUERIES, ROOT
from tests.llm.samples import corpus

FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def removed_by_brute_force(rows, window=13):
    """(id, text, n_words, n_removed, kept) of each row."""
    first = {}
    split = [(i, t, (t or "").encode().split()) for i, t, *_ in rows]
    for i, _, w in split:
        if i is not None:
            for s in range(len(w) - window + 1):
                key = tuple(w[s : s + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, _, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s : s + window])] < i:
                gone[s : s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        out.append((i, len(w), sum(gone), kept))
    return out


def order(rows):
    return sorted(rows, key=lambda x: tuple((v is not None, v) for v in x))


@pytest.mark.parametrize("window", [13, 5])
def test_repeated_windows_go(spark, documents, window):
    rows = corpus()
    got = anchors.repeats(documents(rows), window=window)
    assert order(tuple(r) for r in got.collect()) == order(removed_by_brute_force(rows, window))
    digests = {r.doc_id: r.kept_sha256 for r in anchors.digests(got).where("doc_id = 5004").collect()}
    assert digests == {5004: hashlib.sha256(b"word").hexdigest()}


def test_a_passage_in_every_document(spark, documents):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"own{i} {passage} end{i}", "en", "s") for i in range(300)]
    got = anchors.repeats(documents(rows)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(0, 0)] + [(i, 30) for i in range(1, 300)]
    spans = anchors.repeats(documents(rows), spans=True).collect()
    assert sorted(map(tuple, spans)) == [(i, 1, 30) for i in range(1, 300)]


@pytest.mark.parametrize("shared", [None, 7])
def test_rows_under_no_id_or_one_id_spread_over_chunks(spark, documents, shared):
    rows = [(shared if i % 2 else 100 + i, f"text {i} " + f"a b{i % 3} c " * 8, "en", "s") for i in range(400)]
    chunks = anchors.dealt(documents(rows).select("doc_id", "text"), 8).groupBy("chunk").count().collect()
    assert len(chunks) == 8 and max(r["count"] for r in chunks) < 100
    got = anchors.repeats(documents(rows))
    assert order(tuple(r) for r in got.collect()) == order(removed_by_brute_force(rows))


def test_line_chunks_go_after_their_first_occurrence(documents, folder):
    rows = corpus()
    given = documents(rows)
    got = line_chunks.remove(given, folder)
    assert got.columns == [*given.columns, "n_lines", "n_removed"]
    # Of the two texts under one id one has a single line, so their order doesn't matter.
    unique = sorted({r[:2] for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, expected = set(), defaultdict(set)
    for i, text in unique:
        kept = []
        for piece in line_chunks.chunks(text) if text is not None else []:
            if "\n" not in piece or piece not in seen:
                kept.append(piece)
            seen.add(piece)
        expected[i].add(None if text is None else "\n".join(kept))
    found = defaultdict(set)
    for row in got.collect():
        found[row.doc_id].add(row.text)
        lost = row.n_lines - (0 if row.text in (None, "") else row.text.count("\n") + 1)
        assert row.text in (None, "") or lost == row.n_removed
    assert expected == found
    assert got.agg({"n_removed": "sum"}).first()[0] > 20


def without_repeated_runs(rows):
    """{id: texts}: lines go that are in a run of two or more lines which stands before, all pairs of places compared."""
    unique = sorted({r[:2] for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    held, expected = [], defaultdict(set)
    for i, text in unique:
        lines = [] if text is None else text.split("\n")
        gone = set()
        for before in [*held, lines]:
            for a in range(len(lines) - 1):
                for b in range(len(before) - 1):
                    if (before is not lines or b < a - 1) and before[b : b + 2] == lines[a : a + 2]:
                        gone |= {a, a + 1}
        held.append(lines)
        expected[i].add((None if text is None else "\n".join(x for j, x in enumerate(lines) if j not in gone), len(gone)))
    return expected


def test_whole_runs_of_lines_go(documents, folder):
    own = lambda i: f"own {i}"
    rows = corpus() + [
        (7000, "\n".join(map(str, range(40))), "en", "s"),
        *[(7001 + i, "\n".join([own(i), *map(str, range(i, i + 2 + i % 3)), own(-i - 1)]), "en", "s") for i in range(30)],
        (7100, "r\nr\nr", "en", "s"), (7101, "q\nq\nq\nq\nq", "en", "s"), (7102, "u\nv\nw\nu\nv", "en", "s"),
        (7103, "end\nu\nv", "en", "s"), (7104, "v\nu", "en", "s"), (7105, "0\nnew\n2\n3\n4\n5", "en", "s"),
    ]
    given = documents(rows)
    got = line_chunks.remove(given, folder, whole=True)
    assert got.columns == [*given.columns, "n_lines", "n_removed"]
    found = defaultdict(set)
    for row in got.collect():
        found[row.doc_id].add((row.text, row.n_removed))
    assert found == without_repeated_runs(rows)
    assert all(found[7001 + i] == {(f"own {i}\nown {-i - 1}", 2 + i % 3)} for i in range(30))
    assert found[7100] == {("r\nr\nr", 0)} and found[7101] == {("q\nq", 3)} and found[7102] == {("u\nv\nw", 2)}


def test_the_query_takes_whole_runs(spark, folder):
    lines = [f"line {i * i}" for i in range(40)]
    rows = [(0, "\n".join(lines))] + [(i, "\n".join([f"a{i}", *lines[i : i + 2], f"b{i}"])) for i in range(1, 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op9_line_chunks"](spark, folder).collect()
    assert {r.doc_id: r.n_removed for r in got} == {0: 0} | {i: 2 for i in range(1, 30)}


def test_chunks_are_lossless_and_resist_shifts():
    lines = [f"line {i * i}" for i in range(200)]
    text = "\n".join(lines)
    assert "\n".join(line_chunks.chunks(text)) == text
    shifted = line_chunks.chunks("\n".join(["new", "lines", *lines]))
    assert len(set(line_chunks.chunks(text)) & set(shifted)) >= len(shifted) - 4
    for odd in ("", "\n", "\n\n\n", "a", "a\n" * 500):
        assert "\n".join(line_chunks.chunks(odd)) == odd


def test_a_shifted_passage_keeps_its_borders():
    passage = [f"line {i * i}" for i in range(100)]
    inner = set(line_chunks.chunks("\n".join(passage))[1:-1])
    for before, after in ((1, 0), (0, 3), (7, 7)):
        lines = [*[f"b{i}" for i in range(before)], *passage, *[f"a{i}" for i in range(after)]]
        found = line_chunks.chunks("\n".join(lines))
        assert inner <= set(found)
        assert all("\n" in piece for piece in found[:-1])  # only what the end of a text cuts may be one line


def _no_pairs():
    def work(batches):
        yield from ()

    return work


def test_the_query_finds_chunks_and_widens_them(spark, folder, monkeypatch):
    lines = [f"line {i * i}" for i in range(60)]
    rows = [(0, "\n".join(lines))] + [(i, "\n".join([f"a{i}", *lines, f"b{i}"])) for i in range(1, 5)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")

    def removed():
        return {r.doc_id: r.n_removed for r in QUERIES["op9_line_chunks"](spark, folder).collect()}

    assert removed() == {0: 0, 1: 60, 2: 60, 3: 60, 4: 60}
    # Without the widening the chunks alone still go, all but what stands at the edges.
    monkeypatch.setattr(line_chunks, "_pairs", _no_pairs())
    alone = removed()
    assert alone.pop(0) == 0 and all(50 <= n < 60 for n in alone.values())


def test_covered_pairs_are_not_looked_up():
    import pyarrow as pa

    text = "\n".join(f"line {i}" for i in range(50))
    ends = [0, *line_chunks.borders(text.split("\n"))]
    flags = [{"kind": 0, "place": i, "hash": 1, "is_first": False} for i in range(len(ends) - 1)]
    batch = pa.RecordBatch.from_pylist([{"doc_id": 1, "mark": 2, "text": text, "flags": flags}])
    (found,) = line_chunks._pairs(iter([batch]))
    assert found.column(2).to_pylist() == [end - 1 for end in ends[1:-1]]  # only pairs across borders


def test_columns_with_the_operators_names(spark, folder):
    rows = [(1, "a\nb", "m", "g", "__m"), (2, "c\na\nb", "n", "h", "__n")]
    given = spark.createDataFrame(rows, "doc_id long, text string, mark string, gone string, __mark string")
    got = sorted(map(tuple, line_chunks.remove(given, folder, whole=True).collect()))
    assert got == [(1, "a\nb", "m", "g", "__m", 2, 0), (2, "c", "n", "h", "__n", 3, 2)]


def test_equal_hashes_of_other_bytes_stay(documents, folder, monkeypatch):
    # Through the function that workers get by value, every chunk has one hash.
    monkeypatch.setattr(line_chunks, "_multi_line", _one_hash(line_chunks.chunks, line_chunks._FOUND_SCHEMA))
    rows = [(1, "a\nb", "en", "s"), (2, "c\nd", "en", "s"), (3, "a\nb", "en", "s")]
    got = line_chunks.remove(documents(rows), folder).collect()
    assert {r.doc_id: r.text for r in got} == {1: "a\nb", 2: "c\nd", 3: ""}


def _one_hash(chunks, schema):
    def work(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [(i, m, 0, 7) for i, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], f.type) for c, f in enumerate(schema)], schema=schema)

    return work


def shingles(text):
    words = (text or "").encode().translate(FOLD).split()
    return {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()


def components_by_brute_force(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    above = {i: i for i, _ in sets}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = top(i), top(j)
                above[max(p, q)] = min(p, q)
    return sorted((i, len(x), top(i)) for i, x in sets)


def unique_ids(rows):
    return list({r[0]: r for r in rows if r[0] is not None}.values())


@pytest.mark.parametrize("group,hubs", [(128, 4), (4, 1), (4, 3)])
def test_near_copies_form_components(documents, folder, group, hubs):
    words = [f"w{i}" for i in range(60)]
    cluster = []
    for i in range(40):
        own = list(words)
        own[i % 55] = f"x{i}"
        if i % 4 == 0:
            own[(i * 7) % 50] = f"y{i}"
        cluster.append((9000 + i, " ".join(own), "en", "s"))
    chain = [(9100 + i, " ".join(f"c{j}" for j in range(3 * i, 3 * i + 60)), "en", "s") for i in range(30)]
    rows = unique_ids(corpus()) + cluster + chain
    got = ngram_join.join(documents(rows), folder, group=group, hubs=hubs).collect()
    assert sorted(map(tuple, got)) == components_by_brute_force(rows)


def test_similarity_on_the_border(documents, folder):
    # 20 shingles in common of 25 in all link; 20 of 26 don't
    a = [f"a{i}" for i in range(26)]
    rows = [(1, " ".join(a), "en", "s"), (2, " ".join(a[:24] + ["z"] * 0), "en", "s"), (3, " ".join(a[3:]), "en", "s"), (4, " ".join(a[5:] + ["q", "r"]), "en", "s")]
    got = ngram_join.join(documents(rows), folder).collect()
    assert sorted(map(tuple, got)) == components_by_brute_force(rows)


def test_rows_without_id_or_with_one_id(documents, folder):
    rows = corpus()
    got = ngram_join.join(documents(rows), folder).collect()
    assert len(got) == len(rows)
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_divide_skip_finds_what_counting_finds():
    import random

    import numpy as np

    r = random.Random(5)
    sets = [np.array(sorted(r.sample(range(60), r.randint(1, 50))), np.int64) for _ in range(60)]
    sets += [np.array(sorted(set(s.tolist()) ^ {r.randrange(60)}), np.int64) for s in sets if len(s) > 2]
    index = ngram_join.Index(sets)
    for q in sets:
        expected = sorted(
            (i, len(set(q.tolist()) & set(s.tolist()))) for i, s in enumerate(sets)
            if 100 * len(set(q.tolist()) & set(s.tolist())) >= 80 * len(set(q.tolist()) | set(s.tolist()))
        )
        assert sorted(index.search(q, lambda i: False)) == expected


def test_components_of_chains_and_stars(spark, folder):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 3), (None, 4), (5, 1), (1, 5)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(6)
    found = {r.node: r.component for r in components(frame, folder).collect()}
    found |= {c: c for c in found.values()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]} | {1: 1, 5: 1}


@pytest.mark.parametrize("held,rounds", [(1_000_000, 0), (100, 2)])
def test_edges_that_one_task_can_hold_need_no_rounds(spark, folder, monkeypatch, held, rounds):
    """A round costs the driver a dozen stages; edges of more nodes than a task may hold still take rounds."""
    monkeypatch.setattr(sys.modules[components.__module__], "HELD", held)
    edges = [(i, i + 1) for i in range(100, 200)] + [(7, i) for i in range(300, 360)] + [(5, 1), (1, 5), (1, 5)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(6)
    found = [tuple(r) for r in components(frame, folder).collect()]
    assert sorted(found) == [(5, 1)] + [(i, 100) for i in range(101, 201)] + [(i, 7) for i in range(300, 360)]
    written = [p.name for p in Path(folder.removeprefix("file:")).iterdir()]
    assert sum(name.startswith("round-") for name in written) >= rounds and ("whole" in written) == (not rounds)


def test_empty_tables(documents, folder):
    empty = documents([])
    assert anchors.repeats(empty).count() == 0
    assert line_chunks.remove(empty, f"{folder}/a").count() == 0
    assert ngram_join.join(empty, f"{folder}/b").count() == 0
    blank = documents([(1, None, None, None), (2, "", None, None), (3, " \n ", None, None)])
    assert sorted(map(tuple, ngram_join.join(blank, f"{folder}/c").collect())) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert sorted(map(tuple, anchors.repeats(blank).collect())) == [(1, 0, 0, ""), (2, 0, 0, ""), (3, 0, 0, "")]


def _only_lines(work):
    def watched(batches):
        def seen():
            for batch in batches:
                assert all("\n" in text for text in batch.column(batch.schema.get_field_index("text")).to_pylist())
                yield batch

        yield from work(seen())

    return watched


def test_texts_of_one_line_are_not_dealt_out(spark, folder, monkeypatch):
    """They hold no run; only the last join sends them on, unchanged."""
    rows = [(1, "a\nb"), (2, "x\na\nb"), (3, "alone"), (4, "alone"), (5, ""), (6, None), (7, "\n"), (8, "z\n\n")]
    data = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(line_chunks, "_pairs", _only_lines(line_chunks._pairs))
    got = line_chunks.remove(data, f"{folder}/pieces", whole=True).collect()
    expected = {1: ("a\nb", 2, 0), 2: ("x", 3, 2), 3: ("alone", 1, 0), 4: ("alone", 1, 0), 5: ("", 1, 0), 6: (None, 0, 0)}
    expected |= {7: ("\n", 2, 0), 8: ("z", 3, 2)}
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in got} == expected


_SHUFFLED = """
import os, random, sys
from pyspark.sql import SparkSession
root, folder = sys.argv[1:]
sys.path.insert(0, root)
spark = (
    SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{folder}/events")
    .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
    .config("spark.sql.autoBroadcastJoinThreshold", "-1").getOrCreate()
)
from hailgrid.llm import line_chunks
from hailgrid.llm.queries import importable
importable(spark)
r = random.Random(5)
line = lambda: "".join(chr(r.randrange(33, 0x2000)) for _ in range(300))
shared = [line() for _ in range(4)]
rows = [(i, "\\n".join([line() for _ in range(8)] + (shared if i % 20 == 0 else [])), i % 7) for i in range(400)]
spark.createDataFrame(rows, ["doc_id", "text", "n"]).write.parquet(f"{folder}/given")
line_chunks.remove(spark.read.parquet(f"{folder}/given"), f"{folder}/flags", whole=True).write.parquet(f"{folder}/out")
assert spark.read.parquet(f"{folder}/out").agg({"n_removed": "sum"}).first()[0] == 4 * 19
with open(f"{folder}/bytes", "w") as f:
    f.write(str(sum(len(x[1].encode()) for x in rows)))
spark.stop()
"""


def test_texts_are_dealt_out_once(tmp_path):
    (tmp_path / "events").mkdir()
    subprocess.run([sys.executable, "-c", _SHUFFLED, ROOT, str(tmp_path)], check=True, timeout=300, capture_output=True)
    written = 0
    for path in (tmp_path / "events").iterdir():
        ends = [e for e in map(json.loads, path.read_text().splitlines()) if e["Event"] == "SparkListenerTaskEnd"]
        written += sum(e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] for e in ends)
    size = int((tmp_path / "bytes").read_text())
    assert 0.5 * size < written < 1.5 * size  # twice the size and more if a second exchange moves them
