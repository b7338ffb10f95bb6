"""Alignment of tokenizers, curve-ordered shards and Merkle manifests against brute force."""

import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hailgrid.llm import alignment, hilbert, merkle
from hailgrid.llm.ranges import numbered
from tests.llm.samples import corpus

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")


# Alignment

LIBRARY = Tokenizer.from_file(A_PATH)
LIBRARY.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def library_tokens(text):
    """(id, bytes) of both libraries; nothing if one of them doesn't spell the text."""
    library, pieces = LIBRARY, PIECES
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {chr(b): b for b in printable}
    letters.update((chr(256 + i), b) for i, b in enumerate(b for b in range(256) if b not in printable))
    a = [(i, bytes(letters[c] for c in library.id_to_token(i))) for i in library.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in pieces.encode(text):
        piece = pieces.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    spelled = all(b"".join(raw for _, raw in side) == whole for side in (a, b))
    return (a, b) if text and spelled else ([], [])


def brute_groups(text):
    a, b = library_tokens(text or "")
    ends = [np.cumsum([len(raw) for _, raw in side]).tolist() for side in (a, b)]
    groups, begin = [], [0, 0]
    for cut in sorted(set(ends[0]) & set(ends[1])):
        group = []
        for side, tokens in enumerate((a, b)):
            stop = ends[side].index(cut) + 1
            group.append([i for i, _ in tokens[begin[side] : stop]])
            begin[side] = stop
        groups.append(group)
    return groups


ODD = ["▁ x▁y", "ﬁne ½ Ⅷ", "  many   blanks  \n\n\t tabs", "<|endoftext|> <s> </s> <unk> <0x41>", "日本語テキスト 😀😀", "\x00 nul", "0000000 1234567890"]


def test_documents_agree_with_brute_force(spark, documents, folder):
    rows = [r for r in corpus() if len(r[1] or "") < 20_000] + [(7000 + i, t, "en", "s") for i, t in enumerate(ODD)]
    # The words of one document are in two thirds of all.
    rows += [(8000 + i, "the same few words " * (1 + i % 3), None, None) for i in range(150)]
    groups = [brute_groups(text) for _, text, _, _ in rows]
    links = [[(x, y) for a, b in found for x in a for y in b] for found in groups]
    count = collections.Counter(p for found in links for p in set(found))
    best = collections.defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    expected = []
    for (key, _, _, _), found, pairs in zip(rows, groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)
        expected.append((
            key, sum(len(a) for a, _ in found), sum(len(b) for _, b in found), len(found), len(pairs),
            sum(count[p] == best[p[0]] for p in pairs), sum(count[p] for p in pairs),
            hashlib.sha256(text.encode()).hexdigest() if found else "",
        ))
    assert sum(not found for found in groups) >= 3  # null, empty, and texts that B changes
    given = documents(rows).repartition(5)
    chunks = alignment.store(given, folder, A_PATH, B_PATH)
    got = [tuple(r) for r in alignment.documents(chunks, B_PATH).collect()]
    order = lambda row: str(row)
    assert sorted(got, key=order) == sorted(expected, key=order)
    counted = {(r.a, r.b): (r.documents, r.best) for r in alignment.pair_counts(chunks, B_PATH).collect()}
    assert counted == {p: (n, n == best[p[0]]) for p, n in count.items()}


def test_pairs_are_reduced_before_they_are_shuffled(spark, documents, folder):
    given = documents([(i, "one text that all documents share", "en", "s") for i in range(3000)]).repartition(4)
    chunks = alignment.store(given, folder, A_PATH, B_PATH)
    pairs = len({(x, y) for a, b in brute_groups("one text that all documents share") for x in a for y in b})
    assert chunks.count() == 4 and chunks.select(F.explode("keys")).count() == 4 * pairs
    assert {r.count_sum for r in alignment.documents(chunks, B_PATH).collect()} == {3000 * pairs}


def test_large_groups_and_small_slices_give_the_same(monkeypatch):
    tools = alignment.pair(A_PATH, B_PATH)
    texts = [t for _, t, _, _ in corpus()[:30]] + ODD
    plain = alignment.Aligned(tools, texts).links()
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1)
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", 3)
    for a, b in zip(plain, alignment.Aligned(tools, texts).links()):
        assert a.tolist() == b.tolist()


def test_intervals_are_coalesced():
    starts, ends = np.array([0, 3, 5, 0, 2, 5]), np.array([3, 5, 9, 2, 5, 9])
    order, group = alignment.coalesce(starts, ends)
    assert sorted(zip(group.tolist(), order.tolist())) == [(0, 0), (0, 1), (0, 3), (0, 4), (1, 2), (1, 5)]


def test_long_runs_are_encoded_like_the_library():
    for text in ("a" * 200_000, " " * 200_000 + "x", "\n" * 50_000, "x y " * 50_000):
        ids = alignment.pair(A_PATH, B_PATH).encode([text])[0][0]
        assert ids.tolist() == LIBRARY.encode(" " + text, add_special_tokens=False).ids


def test_alignments_give_ids_and_groups(spark, documents):
    rows = [r for r in corpus() if len(r[1] or "") < 20_000][:20] + [(1, None, None, None)]
    for row in alignment.alignments(documents(rows), A_PATH, B_PATH).collect():
        found = brute_groups(next(t for k, t, _, _ in rows if k == row.doc_id))
        assert row.a_ids == [x for a, _ in found for x in a] and row.b_ids == [x for _, b in found for x in b]
        assert row.a_in == [len(a) for a, _ in found] and row.b_in == [len(b) for _, b in found]


# Shards


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (5, 2)])
def test_the_curve_visits_neighbours(dims, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1)
    place = hilbert.curve_index(points, bits)
    assert sorted(place) == list(range(1 << dims * bits))
    steps = np.abs(np.diff(points[:, np.argsort(place)], axis=1)).sum(0)
    assert (steps == 1).all()


def test_shards_hold_all_rows_evenly(spark, documents, folder):
    rows = corpus() + [(9000, "one row many times", "en", "src0")] * 100
    hilbert.write_shards(documents(rows), folder, ["source", "lang", "n_chars"], shards=16, file_rows=7)
    back = hilbert.read_shards(spark, folder)
    assert {"ids", "hash", "chunk"} <= set(back.columns)
    got = back.collect()
    assert sorted(((r.doc_id, r.text, r.lang, r.source) for r in got), key=str) == sorted(rows, key=str)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    sizes = [len(x) for x in slots.values()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    for row in hilbert.digests(back).collect():
        text = next(r.text for r in got if (r.shard, r.slot) == (row.shard, row.slot))
        assert row.text_crc32 == zlib.crc32((text or "").encode()) and row["size"] == len((text or "").encode()) + 1
        assert (row.law, row.grown_shard) == ("rows", None)


def test_order_is_that_of_brute_force(spark, folder):
    """Cells by ranks in plain Python, the curve by its definition, then shard and slot."""
    rows = [(i, f"s{i * i % 7}", (i * 37) % 50) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, n_chars long").repartition(6)
    hilbert.write_shards(frame, folder, ["source", "n_chars"], shards=3, bits=4)
    cells = []
    for column in (1, 2):
        values = [r[column] for r in rows]
        cells.append([sum(v < x for v in values) * 16 // len(values) for x in values])

    def place(x, y, side=16):
        total, half = 0, side // 2
        while half:
            a, b = int((x & half) > 0), int((y & half) > 0)
            total += half * half * ((3 * a) ^ b)
            if b == 0:
                if a:
                    x, y = side - 1 - x, side - 1 - y
                x, y = y, x
            half //= 2
        return total

    def ordered(turned):
        points = zip(cells[1], cells[0]) if turned else zip(*cells)
        ranked = sorted(range(400), key=lambda i: (places[i], i)) if (places := [place(*p) for p in points]) else []
        return {i: (n * 3 // 400, n - -(-(n * 3 // 400) * 400 // 3)) for n, i in enumerate(ranked)}

    got = {r.doc_id: (r.shard, r.slot) for r in hilbert.read_shards(spark, folder).collect()}
    assert got in (ordered(False), ordered(True))


def test_filters_leave_few_files(spark, folder):
    rows = spark.range(20_000).selectExpr(
        "id as doc_id", "concat('h', id * 7919 % 64) as source", "(id * 104729) % 1000 as n_chars", "'x' as text"
    )
    manifest = hilbert.write_shards(rows, folder, ["source", "n_chars"], shards=16, file_rows=200)
    files = manifest.count()
    for ranges in ({"source": ("h10", "h12")}, {"n_chars": (100, 140)}):
        kept = hilbert.files_for(manifest, ranges).count()
        assert 0 < kept < files * 0.4
        (name, (low, high)), = ranges.items()
        assert hilbert.read_ranges(spark, folder, ranges).count() == rows.where(F.col(name).between(low, high)).count() > 0
    assert hilbert.read_ranges(spark, folder, {"n_chars": (5000, None)}).count() == 0


def test_values_without_order_have_cells(spark, folder):
    rows = [(1, float("nan")), (2, None), (3, -1.5), (4, 2.0), (None, 2.0)]
    hilbert.write_shards(spark.createDataFrame(rows, "doc_id long, x double"), folder, ["x"], shards=2)
    assert [r.doc_id for r in hilbert.read_shards(spark, folder).orderBy("shard", "slot").collect()] == [2, 3, None, 4, 1]


# Merkle manifests


def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([hashed("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, index):
    out = []
    for level in tree[:-1]:
        run = index // 3 * 3
        out.append(("".join(level[run:index]), "".join(level[index + 1 : run + 3])))
        index //= 3
    return out


def brute_leaf(key, source, lang, n, text):
    texts = [None if x is None else str(x) for x in (key, source, lang, n, text)]
    return hashed("".join("-" if x is None else f"{len(x.encode())}:{x}" for x in texts))


def brute_manifest(rows):
    groups = collections.defaultdict(list)
    for key, text, lang, source in rows:
        groups[source].append((key, brute_leaf(key, source, lang, len(text or ""), text), text, lang))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {name: levels([r[1] for r in groups[name]]) for name in names}
    upper = levels([trees[name][-1][0] for name in names])
    root, out = upper[-1][0], []
    for k, name in enumerate(names):
        for i, (key, leaf, text, lang) in enumerate(groups[name]):
            proof = siblings(trees[name], i) + siblings(upper, k)
            node = leaf
            if key is not None and text is not None and zlib.crc32(str(key).encode()) % 2 == 0:
                node = brute_leaf(key, name, lang, len(text), text.replace("\n", ""))
            for left, right in proof:
                node = hashed(left + node + right)
            out.append((key, leaf, trees[name][-1][0], root, hashed("".join(a + b for a, b in proof)), node, node == root))
    return out


def same(frame, rows):
    assert sorted(map(str, map(tuple, frame.collect()))) == sorted(map(str, brute_manifest(rows)))


def test_proofs_agree_with_brute_force(spark, documents, folder):
    rows = corpus() + [(9000, "one row many\ntimes", "en", "src0")] * 20
    same(merkle.verified(documents(rows), folder), rows)


@pytest.mark.parametrize("sizes", [(1,), (2, 1), (3, 4), (243, 244), (730, 1, 9)])
def test_sizes_around_blocks(spark, documents, folder, sizes):
    rows = [(i, f"text\n{i}", "en", f"s{s}") for s, n in enumerate(sizes) for i in range(1000 * s, 1000 * s + n)]
    same(merkle.verified(documents(rows).repartition(7), folder), rows)


def test_many_groups_make_blocks_of_subroots(spark, documents, folder):
    rows = [(i, f"t{i}", None, f"host{i % 300}") for i in range(600)]
    same(merkle.verified(documents(rows), folder), rows)


def test_changes_are_found(spark, documents, folder):
    rows = corpus()
    manifest = merkle.build(documents(rows), folder)
    root = manifest.roots().first().root
    proofs = manifest.proofs()
    assert proofs.where(merkle.fold(F.col("leaf"), F.col("proof")) != root).count() == 0
    assert proofs.where(merkle.fold(F.sha2(F.col("leaf"), 256), F.col("proof")) == root).count() == 0
    # one leaf never takes more than a block, whatever its group holds
    assert manifest.table("rows", 0).select(F.max(F.size("members"))).first()[0] <= merkle.WIDTH


def test_a_group_with_most_rows_is_spread(spark, folder):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # 20,000 small rows would be one task
    rows = spark.range(20_000).selectExpr("id as k", "if(id % 10 = 0, 'cold', 'hot') as g")
    try:
        placed = numbered(rows.repartition(8), ["g"], ["k"], folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert placed.where("position <> if(g = 'cold', k div 10, k - k div 10 - 1)").count() == 0
    tasks = spark.read.parquet(folder).where("g = 'hot'").select(F.shiftrightunsigned("place", 33)).distinct().count()
    assert tasks > 1


def test_empty_tables(spark, documents, folder):
    none = documents([])
    assert merkle.verified(none, f"{folder}/m").collect() == []
    hilbert.write_shards(none, f"{folder}/h", ["source", "lang"], shards=16)
    assert hilbert.digests(hilbert.read_shards(spark, f"{folder}/h")).collect() == []
    chunks = alignment.store(none, f"{folder}/a", A_PATH, B_PATH)
    assert alignment.documents(chunks, B_PATH).collect() == []
