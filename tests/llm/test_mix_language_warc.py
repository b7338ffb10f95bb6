"""Mixing, language identification and archives."""

import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import pytest
import zstandard
from pyspark.sql import functions as F

from hailgrid.llm import language, mixing, warc
from hailgrid.llm.queries import QUERIES
from tests.llm.samples import corpus

KEYS = ["domain", "lang", "source"]


def water(given, children):
    """Shares of [(name, weight, most)] by filling step by step with exact fractions."""
    share, left, open_ = {}, given, sorted(children)
    while open_:
        total = sum(w for _, w, _ in open_)
        full = [c for c in open_ if c[1] and c[2] * total <= left * c[1]]
        if not full:
            break
        # the fullest first, as limits over weights go
        first = min(full, key=lambda c: (Fraction(c[2], c[1]), c[0]))
        share[first[0]] = first[2]
        left -= first[2]
        open_.remove(first)
    total = sum(w for _, w, _ in open_)
    for name, w, _ in open_:
        share[name] = left * w // total if total else 0
    rest = given - sum(share.values())
    for name, w, _ in sorted(open_):
        if w and rest > 0:
            share[name] += 1
            rest -= 1
    return share


def chosen_by_brute_force(rows, weights, fraction, max_epochs, seed):
    """{id: copies} for rows (id, domain, lang, source, tokens)."""
    leaves = defaultdict(list)
    for r in rows:
        leaves[tuple("(none)" if x is None else x for x in r[1:4])].append((r[0], max(r[4] or 0, 0)))
    held = {leaf: sum(t for _, t in docs) for leaf, docs in leaves.items()}
    budgets = {(): sum(held.values()) * fraction[0] // fraction[1]}
    for depth in range(3):
        below = {}
        for path, given in budgets.items():
            names = sorted({leaf[depth] for leaf in held if leaf[:depth] == path})
            children = []
            for name in names:
                own = path + (name,)
                most = max_epochs * sum(n for leaf, n in held.items() if leaf[: depth + 1] == own)
                children.append((name, weights.get("/".join(own), weights.get(name, 1)), most))
            below |= {path + (n,): s for n, s in water(given, children).items()}
        budgets = below
    copies = {}
    for leaf, docs in leaves.items():
        take, has = budgets[leaf], held[leaf]
        whole, rest = divmod(take, has) if has else (0, 0)
        ordered = sorted(docs, key=lambda d: (hashlib.md5(f"{seed}|{whole + 1}|{d[0]}".encode()).hexdigest(), d[0]))
        run = 0
        for i, tokens in ordered:
            run += tokens
            n = whole + (rest > 0 and run <= rest)
            if n:
                copies[i] = n
    return copies


@pytest.mark.parametrize("fraction,epochs", [((6, 10), 1), ((3, 2), 3), ((5, 1), 2), ((0, 1), 1)])
def test_mixture_is_that_of_step_by_step_filling(spark, fraction, epochs):
    r = random.Random(7)
    rows = [
        (i, r.choice(["d0", "d1", None]), r.choice(["en", "de", "fr"]), r.choice(["s1", "s2", "s2", "s2", None]), r.choice([0, 5, 40, 700, None, -3]))
        for i in range(500)
    ]
    weights = {"d0": 1, "d1": 9, "en": 5, "de": 0, "d1/en": 7, "s1": 3}
    frame = spark.createDataFrame([(*x, 9) for x in rows], "doc_id long, domain string, lang string, source string, tokens long, __x int")
    got = mixing.choose(frame, KEYS, F.col("tokens"), weights, fraction, epochs, seed=4)
    assert {x.doc_id: x.copies for x in got.collect()} == chosen_by_brute_force(rows, weights, fraction, epochs, 4)
    assert mixing.epochs(got).count() == sum(x.copies for x in got.collect())


def test_shortage_goes_to_siblings_first(spark):
    rows = [("a", "x", "1", 10), ("a", "x", "2", 1000), ("a", "y", "3", 1000), ("b", "x", "4", 5000)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, available long")
    takes = mixing.budget(leaves, KEYS, {"a": 1, "b": 1}, (800, 7010), 1)
    # a has 400: x and y have 200 each; source 1 holds 10 only, so its sibling 2 takes 190
    assert {(*x[:3],): x["take"] for x in takes.select(*KEYS, "take").collect()} == {
        ("a", "x", "1"): 10, ("a", "x", "2"): 190, ("a", "y", "3"): 200, ("b", "x", "4"): 400,
    }


def test_mixture_plan_is_native(spark):
    rows = spark.createDataFrame([(1, "d", "en", "s", 5)], "doc_id long, domain string, lang string, source string, tokens long")
    plan = mixing.choose(rows.where("doc_id > 0"), KEYS, F.col("tokens"), {}, (1, 1))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_mixture_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, domain string, lang string, source string, tokens long")
    assert mixing.choose(empty, KEYS, F.col("tokens"), {}, (1, 2)).count() == 0


SYLLABLES = {"aa": "the and of ing er", "bb": "der die und ung sch", "cc": "les est que eau oi"}


def labelled(n, seed=2):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lang = "aabbcc"[2 * (i % 3) :][:2]
        parts = SYLLABLES[lang].split()
        text = " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(r.randint(2, 30)))
        out.append((i, text, lang, f"host{i % 3}.{lang}" if i % 2 else None))
    return out


def test_held_out_languages_are_found(spark, documents, folder):
    rows = labelled(600)
    model = language.train(documents(rows[:300]))
    held = rows[300:]
    got = {r.doc_id: r for r in language.identify(documents(held), model, folder, declared=None, host=None).collect()}
    assert sum(got[i].language == lang for i, _, lang, _ in held) >= 0.98 * len(held)
    assert sum(got[i].accepted for i, *_ in held) >= 0.98 * len(held)


def test_evidence_is_fused(spark, documents, folder):
    rows = labelled(300)
    model = language.train(documents(rows))
    # texts of one ambiguous syllable, whose host or declaration speaks
    more = rows + [(900, "a", None, "host1.bb"), (901, "a", "cc", None), (902, None, "bb", None), (903, "", None, None), (904, " \n", None, "new.aa"), (905, "\x01\x02\x03\x04\x05" * 9, None, None), (None, "the and of", "zz", "x"), rows[0]]
    found = language.identify(documents(more), model, folder, keep=("n_chars", "hash"))
    assert found.columns == ["doc_id", "n_chars", "hash", "language", "posterior", "text_language", "declared", "n_trigrams", "accepted"]
    got = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(more)
    assert got[900].language == "bb" and got[901].language == "cc"
    assert got[902].language == "bb" and not got[902].accepted and got[902].text_language is None
    assert not got[903].accepted and not got[904].accepted and not got[905].accepted
    assert got[904].language == "aa" and got[None].accepted


def test_priors_come_from_the_levels_above(spark, documents, folder):
    rows = [(i, t, la, f"h{i}.site{i % 2}.co.xx" if la == "aa" else f"h{i}.other.yy") for i, t, la, _ in labelled(300)]
    model = language.train(documents(rows))
    unseen = [(1000, None, None, "new.site0.co.xx"), (1001, None, None, "fresh.co.xx"), (1002, None, None, "new.other.yy")]
    got = {r.doc_id: r for r in language.identify(documents(rows + unseen), model, folder, declared=None).collect()}
    assert got[1000].language == got[1001].language == "aa" and got[1002].language != "aa"
    assert got[1000].posterior > 0.9 > got[1002].posterior


def test_markup_and_addresses(spark):
    pages = spark.createDataFrame([('<!DOCTYPE html><HTML class="x" lang="de-AT">', "https://u@Blog.Example.co.uk:80/a?b"), ("<p>", "nothing"), (None, None)], "html string, url string")
    got = pages.select(language.markup_language("html").alias("m"), language.url_host("url").alias("host")).collect()
    assert [tuple(r) for r in got] == [("de-AT", "blog.example.co.uk"), (None, None), (None, None)]
    hosts = spark.createDataFrame([("blog.example.co.uk",), ("a.b.de",), ("plain",), (None,)], "host string")
    parts = hosts.select(language._domain("host"), language._suffix("host")).collect()
    assert [tuple(r) for r in parts] == [("example.co.uk", "uk"), ("b.de", "de"), (None, None), (None, None)]


def test_every_label_has_a_model(documents, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_ROWS", 40)
    rows = labelled(600)
    # rare labels: one row, rows without ids, and one id many times
    rare = [(1000, "zq xj zq", "dd", None), *[(None, f"w{i} ww", "ee", None) for i in range(3)], *[(1001, "vv", "ff", None)] * 300]
    model = language.train(documents(rows + rare))
    assert model.languages == ["aa", "bb", "cc", "dd", "ee", "ff"]
    for text, lang in (("zq xj", "dd"), ("w1 ww", "ee"), ("vv", "ff"), ("the and of", "aa")):
        assert model.languages[model.score(text)[2].index(0.0)] == lang


def test_text_of_pages():
    page = """<!DOCTYPE html><html lang="de"><style>p{}</style><SCRIPT>var t="</p>";</SCRIPT ><!-- no <p> --><p title="a>b">1 &lt; 2 &amp; <b>x</b> < y</p><i don't>z</i>"""
    assert language.page_text(page).split() == ["1", "<", "2", "&", "x", "<", "y", "z"]
    assert language.page_text(None) == "" and language.page_text("a<script>b").split() == ["a"]


def test_query_uses_markup_and_addresses_of_pages(spark, folder):
    docs = [(i, t, la, "src0") for i, t, la, _ in labelled(300)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    html = lambda text, lang="": f"<!DOCTYPE html><html{lang and f' lang={lang}'}><script>the and the and</script><p>{text}</p></html>"
    held = [(i, html(t, f'"{la}-XX"'), f"https://h{i}.site{i % 9}.{la}/x") for i, t, la, _ in labelled(200, seed=8)]
    odd = [
        (900, html("q"), "http://h1.site1.bb:80/"), (901, html("q"), "http://new.site1.bb/"), (902, html("q"), "http://new.other.cc/"),
        (903, html("q", "cc"), None), (904, None, None), (None, html("the and of"), "nothing"),
    ]
    spark.createDataFrame(held + odd, "page_id long, html string, url string").write.parquet(f"{folder}/pages.parquet")
    rows = QUERIES["op2_language_evidence"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows if r.origin == "documents") == list(range(300))
    got = {r.page_id: r for r in rows if r.origin == "pages"}
    assert len(rows) == 300 + len(held) + len(odd) and len(got) == len(held) + len(odd)
    lang = {i: la for i, _, la, _ in labelled(200, seed=8)}
    assert sum(got[i].language == lang[i] == got[i].declared for i in lang) >= 0.98 * len(held)
    assert [got[i].language for i in (900, 901, 902, 903)] == ["bb", "bb", "cc", "cc"]
    assert got[None].language == "aa" and not got[904].accepted


def test_language_of_nothing(documents, folder):
    empty = documents([])
    assert language.identify(empty, language.train(empty), folder).count() == 0
    with pytest.raises(ValueError):
        language.train(documents([(1, "text", None, None)]))


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, digest string, payload string")


def test_archives_give_pages_back(spark, folder):
    big = "<p>" + "é" * 600
    rows = [(i, f"http://a.b/{i}", t or "") for i, t, *_ in corpus() if i is not None]
    rows += [(100_000 + i, None if i % 2 else "http://x y\r\nz", big) for i in range(40)] + [(7, "http://n", None), (8, "u", "small"), (9, "u", "small")]
    rows = list({r[0]: r for r in rows}.values())
    frame = pages(spark, rows)
    dictionary = warc.train(frame)
    assert dictionary
    manifest = warc.write_archives(warc.identified(frame), folder, dictionary, archive_bytes=20_000)
    assert manifest.count() > 1
    records = warc.read_archives(spark, folder)
    last = {}
    for i, _, html in rows:
        last[html or ""] = max(i, last.get(html or "", i))
    expected = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and last[html or ""] != i
        expected.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", last[html] if revisit else None))
    assert sorted(map(tuple, warc.digests(records, manifest).collect())) == sorted(expected)
    payloads = {r.record_id: bytes(r.payload) for r in records.where("record_type = 'response'").collect()}
    assert payloads["<urn:page:100039>"] == big.encode()


def test_pages_without_ids_or_with_equal_ones(spark, folder):
    big = "x" * 1500
    rows = [(None, "u", big), (None, "v", big), (5, "u", big), (5, "u", big), (4, None, big), (None, "w", "y" * 2000), (None, "w", "y" * 2000)]
    manifest = warc.write_archives(warc.identified(pages(spark, rows)), folder, b"")
    got = warc.digests(warc.read_archives(spark, folder), manifest).collect()
    assert sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in got) == [
        (0, 1500, "revisit", 5), (0, 1500, "revisit", 5), (0, 2000, "response", 0), (0, 2000, "response", 0),
        (4, 1500, "revisit", 5), (5, 1500, "response", 0), (5, 1500, "response", 0),
    ]


def test_no_pages(spark, folder):
    empty = pages(spark, [])
    manifest = warc.write_archives(warc.identified(empty), folder, warc.train(empty))
    assert warc.digests(warc.read_archives(spark, folder), manifest).count() == 0


GOOD = warc.record(1, "http://a", b"payload", hashlib.sha1(b"payload").hexdigest(), None)


@pytest.mark.parametrize("bad", [
    GOOD[:-1], GOOD.replace(b"WARC/1.1", b"WARC/9"), GOOD.replace(b"WARC-Date", b"X"), GOOD.replace(b"payload\r\n\r\n", b"paylaod\r\n\r\n"),
    GOOD.replace(b"Content-Length: 7\r", b"Content-Length: 8\r"), GOOD + b"x", b"", GOOD.replace(b"WARC-Type: r", b"WARC-Type r"),
    GOOD.replace(b"WARC-Type: response", b"WARC-Type: revisit"),
])
def test_broken_records_are_refused(bad):
    assert warc.parse(GOOD)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(bad)


def test_dictionary_frames():
    texts = [f"<html><p>{i} shared words of all pages {i * 7}</p></html>".encode() * 4 for i in range(400)]
    known = zstandard.train_dictionary(4096, texts)
    press = zstandard.ZstdCompressor(dict_data=known)
    for held in (known.as_bytes(), zstandard.ZstdCompressor().compress(known.as_bytes())):
        lead = warc.struct.pack("<II", warc.DICTIONARY_FRAME, len(held)) + held
        data = lead + b"".join(press.compress(t) for t in texts)
        assert [x[2] for x in warc.frames(data)] == texts
        with pytest.raises(ValueError):
            list(warc.frames(data[:-3]))


def test_columns_with_the_names_of_the_mixture(spark):
    rows = [(i, f"d{i % 2}", 10, f"own {i}", i, f"t{i}") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, domain string, tokens int, __id string, __order int, __tokens string")
    got = mixing.choose(frame, ["domain"], F.col("tokens"), {}, (1, 2))
    assert got.columns == [*frame.columns, "copies"] and got.count() == 10
    assert all((r["__id"], r["__order"], r["__tokens"]) == (f"own {r.doc_id}", r.doc_id, f"t{r.doc_id}") for r in got.collect())
