"""Syncmer fingerprints and M-tree search against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hailgrid.llm import mtree, syncmers
from hailgrid.llm.rolling import mixed, runs, smallest, words
from tests.llm.samples import corpus


def test_rolling_runs_and_minima():
    x = np.random.default_rng(1).integers(0, 2**63, 50, dtype=np.uint64)
    for n in (1, 2, 3, 5, 8, 13, 24):
        got = runs(x, n)
        assert len(got) == 51 - n
        assert got[0] == runs(x[:n], n)[0] and got[-1] == runs(x[-n:], n)[0]
        assert smallest(x, n).tolist() == [min(x[i : i + n].tolist()) for i in range(51 - n)]


def test_words_are_those_between_blanks():
    import pyarrow as pa

    texts = ["a b\ta\n", None, "", "é\x1cz \x0b\x0c\r a", "A a", "x" * 3_000_000 + " a " + "y " * 900_000]
    hashes, counts = words(pa.array(texts))
    split = [(t or "").encode().split() for t in texts]
    assert counts.tolist() == [len(w) for w in split]
    by_word = {}
    for word, value in zip([w for s in split for w in s], hashes.tolist()):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)
    folded, _ = words(pa.array(["ABC abc"]), fold=True)
    assert folded[0] == folded[1]


@pytest.mark.parametrize("k,s", [(24, 8), (6, 2)])
def test_anchors_are_closed_syncmers(k, s):
    text = "the quick brown fox é jumps over 😀 the lazy dog " * 3 + "and a tail without repeats 0123456789"
    letters = np.array([ord(c) + 1 for c in text], np.uint64)
    inner = mixed(runs(letters, s)).tolist()
    expected = [
        p for p in range(len(text) - k + 1)
        if min(inner[p : p + k - s + 1]) in (inner[p], inner[p + k - s])
    ]
    assert [int(p) for at, _ in syncmers.anchors(text, k, s) for p in at] == expected
    # context-free: the same k-mers wherever the passage stands
    inside = [int(p) - 5 for at, _ in syncmers.anchors("12345" + text, k, s) for p in at]
    assert [p for p in inside if p >= 0] == expected


def test_pieces_give_the_anchors_of_the_whole(monkeypatch):
    text = " ".join(f"word{i * i}" for i in range(400))
    whole = [x.tolist() for x in map(np.concatenate, zip(*syncmers.anchors(text)))]
    monkeypatch.setattr(syncmers, "PIECE", 97)
    assert [x.tolist() for x in map(np.concatenate, zip(*syncmers.anchors(text)))] == whole


def test_neighbours_in_order(documents):
    rows = corpus()
    rows = list({r[0]: r for r in rows}.values())
    got = {r.doc_id: r for r in syncmers.digests(syncmers.compare_neighbours(documents(rows))).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(rows)
    for (i, text, *_), (_, following, *_) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        n = len(text) // 4
        changed = text[: len(text) - n] + following[:n]
        row = got[i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        prints = [syncmers.fingerprint(t) for t in (text, changed, following)]
        assert (row.fingerprint, row.edited_fingerprint) == (prints[0].hex(), prints[1].hex())
        assert row.near_edited == syncmers.likeness(prints[0], prints[1])
        assert row.near_next == syncmers.likeness(prints[0], prints[2])
    long_ones = [r for r in got.values() if 300 < r.n_chars < 10_000]
    assert np.mean([r.near_edited for r in long_ones]) > 0.4 > 0.2 > np.mean([r.near_next for r in long_ones])


def test_short_texts_are_near_their_edits():
    r = np.random.default_rng(6)
    texts = ["".join(r.choice(list("abcdefghijklmnopqrstuvwxyz  éß日"), n)) for n in range(4, 300) for _ in range(4)]
    near, far = [], []
    for text, following in zip(texts, texts[4:] + texts[:4]):
        a, b, c = (syncmers.fingerprint(t) for t in (text, syncmers.edited(text, following), following))
        near.append(syncmers.likeness(a, b))
        far.append(syncmers.likeness(a, c))
        # an edit without a replacement is shorter, and may be of another size
        assert syncmers.likeness(a, syncmers.fingerprint(syncmers.edited(text, ""))) > 0
    short = [x for x, t in zip(near, texts) if 8 <= len(t) <= 64]
    assert min(near) > 0 and np.mean(short) > 0.4 and np.mean(near) > 0.4 > 0.1 > np.mean(far)


def test_likeness_of_empty_and_equal():
    a, b = syncmers.fingerprint("some text of a few words"), syncmers.fingerprint("")
    assert b == b"" and syncmers.likeness(b, b) == 1.0 and syncmers.likeness(a, b) == 0.0
    assert syncmers.likeness(a, a) == 1.0
    assert syncmers.fingerprint("a") != syncmers.fingerprint("b")


def test_repeated_rows_and_empty_tables(documents):
    # 160 code points, of which 40 are replaced: a whole number of words, so the edited text is the text.
    rows = [(1, "same " * 32, "en", "s")] * 3
    got = syncmers.compare_neighbours(documents(rows)).collect()
    assert [(r.doc_id, r.near_edited, r.near_next) for r in got] == [(1, 1.0, 1.0)] * 3
    assert syncmers.compare_neighbours(documents([])).count() == 0
    assert syncmers.anchor_rows(documents(rows)).columns == ["doc_id", "position", "hash"]


def ranked(vectors, every, k):
    scaled = [
        (i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, q in scaled:
        if i % every == 0:
            scores = [(-sum(a * b for a, b in zip(q, x)), j) for j, x in scaled if j != i and len(x) == len(q)]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_equal_query_rows_are_answered_each(spark, folder):
    vectors = [(0, [1.0, 0.0])] * 3 + [(0, [0.0, 1.0])] + [(i, [1.0 / i, float(i % 3)]) for i in range(1, 12)] + [(4, [0.25, 1.0])]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = mtree.top(rows, folder, F.col("vec_id") % 4 == 0)
    assert sorted(map(tuple, got.collect())) == ranked(vectors, 4, 5)


@pytest.mark.parametrize("tree,pivots", [(8192, 32), (40, 3)])
def test_top_k_is_exact(spark, folder, tree, pivots):
    r = np.random.default_rng(3)
    centres = r.normal(size=(5, 12))
    rows = [(i, (centres[i % 5] + 0.3 * r.normal(size=12)).tolist()) for i in range(400)]
    rows += [(1000 + i, [0.5] * 12) for i in range(300)]  # many equal vectors, ties
    rows += [(2000, None), (2010, [None] * 12), (2020, [float("nan")] * 12), (2030, [float("inf")] * 12), (None, [1.0] * 12)]
    rows += [(2040, []), (2050, [1.0, 2.0, 3.0]), (2060, [2.0, 1.0, 3.0]), (2070, [0.0] * 12), (2080, [1e6] * 12)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, label int, score int")
    got = mtree.top(frame, folder, F.col("vec_id") % 10 == 0, tree=tree, pivots=pivots)
    f32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == ranked(f32, 10, 5)


def test_bounds_save_computations():
    r = np.random.default_rng(4)
    vectors = (r.normal(size=(6, 16))[np.arange(3000) % 6] * 900 + r.normal(size=(3000, 16)) * 60).astype(np.int64)
    tree = mtree.Tree(np.arange(3000), vectors)
    visited = []
    pages = tree.pages

    class Counted(list):
        def __getitem__(self, i):
            visited.append(i)
            return pages[i]

    tree.pages = Counted(pages)
    for q in range(0, 3000, 300):
        scores = vectors @ vectors[q]
        expected = sorted((-int(s), j) for j, s in enumerate(scores.tolist()) if j != q)[:5]
        assert tree.search(vectors[q], q, 5) == [(-s, j) for s, j in expected]
    assert len(visited) < 10 * len(pages) / 2


def test_no_vectors(spark, folder):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert mtree.top(empty, f"{folder}/a", F.col("vec_id") % 10 == 0).count() == 0
    single = spark.createDataFrame([(0, [1.0]), (0, [2.0])], "vec_id long, embedding array<float>")
    assert mtree.top(single, f"{folder}/b", F.col("vec_id") % 10 == 0).count() == 0
