"""BPE coding and shard files against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hailgrid.llm import bitplane, bpe
from tests.llm.samples import corpus

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTE_LIBRARY, WORD_LIBRARY = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)


def library_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def unpacked(ids):
    return np.frombuffer(ids, "<u4").tolist()


def test_coder_gives_library_ids_and_texts(documents):
    rows = corpus()
    got = bpe.encode_and_decode(documents(rows), BYTES).collect()
    assert len(got) == len(rows)
    assert got[0].asDict().keys() >= {"doc_id", "lang", "hash", "chunk", "ids", "decoded"}
    for row in got:
        expected = library_ids(BYTE_LIBRARY, row.text)
        assert unpacked(row.ids) == expected
        assert row.decoded == BYTE_LIBRARY.decode(expected, skip_special_tokens=False) == (row.text or "")


def test_columns_with_the_names_of_the_coder(spark):
    rows = spark.createDataFrame([(1, "some text", "a", "b")], "doc_id long, text string, source string, __source string")
    (row,) = bpe.encode_and_decode(rows, BYTES).collect()
    assert (row.source, row["__source"], row.decoded) == ("a", "b", "some text")


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError):
        bitplane.Words(BYTES)
    with pytest.raises(ValueError):
        bpe.Bpe(WORDS)


def test_decode_alone_and_of_incomplete_bytes(spark):
    ids = library_ids(BYTE_LIBRARY, "😀")[:1]
    packed = np.array(ids, "<u4").tobytes()
    rows = spark.createDataFrame([(1, packed), (2, None), (3, b"")], "k int, ids binary")
    texts = {r.k: r.decoded for r in bpe.decode(rows, BYTES).collect()}
    assert texts == {1: BYTE_LIBRARY.decode(ids), 2: "", 3: ""}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abEs' \n\t'dl.,-é"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text_is_coded_like_the_library(text):
    assert unpacked(bpe.load(BYTES).encode(text)) == library_ids(BYTE_LIBRARY, text)
    assert unpacked(bitplane.words(WORDS).encode([text])[0]) == library_ids(WORD_LIBRARY, text)


def test_one_long_piece_takes_linear_time():
    assert unpacked(bpe.load(BYTES).encode("ab" * 100_000)) == library_ids(BYTE_LIBRARY, "ab" * 100_000)


@pytest.mark.parametrize("kind", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 65, 1000])
def test_planes_are_undone(kind, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32) >> np.uint32(n % 20)
    assert bitplane.unpack(bitplane.pack(ids, kind), n, kind).tolist() == ids.tolist()


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_shards_hold_all_documents_in_order(spark, documents, folder, kind):
    rows = corpus()
    manifest = bitplane.write_ids(documents(rows), folder, WORDS, end_id=2, kind=kind, block=100, file_ids=3000)
    assert manifest.count() > 3
    got = bitplane.digests(bitplane.read_ids(spark, folder), manifest).orderBy("start").collect()
    keys = [r.doc_id for r in got]
    assert keys == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    at = 0
    expected = sorted((r[0] if r[0] is not None else -1, *_digest(r[1])) for r in rows)
    assert expected == sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_crc32) for r in got)
    for row in got:
        assert row.start == at
        at += row.n_tokens
    # any span of a file, without the rest
    one = bitplane.read_ids(spark, folder).where("octet_length(ids) > 1000").first()
    whole = np.frombuffer(one.ids, "<u4")
    assert bitplane.read_span(folder, one.name, one.first + 90, 130).tolist() == whole[90:220].tolist()
    with pytest.raises(ValueError):
        bitplane.read_span(folder, one.name, 0, 10**9)


def _digest(text):
    ids = library_ids(WORD_LIBRARY, text) + [2]
    return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())


def test_left_over_files_are_not_read(spark, documents, folder):
    manifest = bitplane.write_ids(documents(corpus(n=6)), folder, WORDS, end_id=2)
    before = bitplane.digests(bitplane.read_ids(spark, folder), manifest).count()
    bitplane.write_file(folder, "ids-000000-0000-lost.idp", bitplane.shard([1], [b"\0" * 8]))
    assert bitplane.digests(bitplane.read_ids(spark, folder), manifest).count() == before


def test_cut_shard_is_refused():
    data = bitplane.shard([1], [b"\0" * 80])[:-1]
    with pytest.raises(ValueError):
        bitplane.Shard(lambda at, n: data[at:][:n])


def test_empty_tables(spark, documents, folder):
    empty = documents([])
    manifest = bitplane.write_ids(empty, folder, WORDS, end_id=2)
    assert bitplane.digests(bitplane.read_ids(spark, folder), manifest).count() == 0
    assert bpe.digests(bpe.encode_and_decode(empty, BYTES)).count() == 0
