"""Language identification, token counts, HTML text, quality and personal data."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers import docs
from hypothesis import given, settings
from hypothesis import strategies as st

from pitchline.llm import quality
from pitchline.llm.common import held_out
from pitchline.llm.html_text import Page, main_text, template
from pitchline.llm.language_id import Lookup, PpmModel, accepted, grams, identify, reduced, train
from pitchline.llm.pii import find_pii
from pitchline.llm.token_counts import TokenCounter, token_counts

SYLLABLES = {"aa": "ka ko ki ma mo mi".split(), "bb": "str ung ach ein lich ver".split(), "cc": "eau oux éle ion què ment".split()}


def sentence(lang: str, seed: int, n: int = 40) -> str:
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randrange(1, 4))) for _ in range(n))


def test_languages_are_told_apart(spark):
    rows = [(k, sentence(lang, k), lang, "s") for k, lang in enumerate(list(SYLLABLES) * 60)]
    table = docs(spark, rows)
    model = train(table, ~held_out())
    assert model.languages == sorted(SYLLABLES)
    odd = [(1000, None), (1001, ""), (1002, "12 !? 34"), (1003, "Ka ko MAMO"), (1004, "\u4e2d\u6587"), (1005, sentence("bb", 7, 40_000)), (1005, sentence("bb", 7, 40_000))]
    found = identify(docs(spark, rows + odd), model).select("doc_id", "language.*").collect()
    by_id = {r.doc_id: r for r in found}
    out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert len(out) > 20 and all(by_id[r[0]].lang_pred == r[2] for r in out)
    assert [by_id[k].lang_pred for k in (1000, 1001, 1002)] == ["und"] * 3 and by_id[1000].score == 0
    assert by_id[1003].lang_pred == "aa" and by_id[1004].lang_pred in SYLLABLES and by_id[1005].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in found) and len(found) == len(rows) + len(odd)
    kept = identify(table, model)
    assert kept.where(accepted(kept.language)).count() == len(rows) and kept.drop("language").columns == table.columns
    assert identify(docs(spark, []), model).collect() == []
    assert {r.language.lang_pred for r in identify(table, train(docs(spark, []), ~held_out())).collect()} == {"und"}


def test_counts_of_languages_reach_the_driver_as_arrow(spark, monkeypatch):
    table = docs(spark, [(k, sentence(lang, k), lang, "s") for k, lang in enumerate(list(SYLLABLES) * 8)] + [(99, "no lang")])

    def refused(self, *args, **kwargs):
        raise AssertionError("rows are pickled for the driver")

    monkeypatch.setattr(type(table), "toPandas", refused)
    model = train(table, ~held_out())
    assert model.languages == sorted(SYLLABLES)
    text = sentence("cc", 500).encode()
    bits, coded = model.code_lengths([text])
    assert int(bits[0].argmin()) == 2 and coded[0] > 0


def test_code_lengths_follow_the_definition():
    order, texts = 2, [b"abab abc", b"ba"]
    data, _ = reduced(texts, order)
    keys, n = np.unique(grams(data[: order + 8], order), return_counts=True)
    model = PpmModel(["x"], np.array([1.0]), keys, n[:, None].astype(float), order)
    seen = b"  " + texts[0]
    counts: dict = {}
    for k in range(order + 1):
        for at in range(order, len(seen)):
            c, s = seen[at - k : at], seen[at]
            counts.setdefault(c, {}).setdefault(s, 0)
            counts[c][s] += 1

    def bits(context: bytes, symbol: int) -> float:
        if context in counts:
            of = counts[context]
            n, d = sum(of.values()), len(of)
            if symbol in of:
                return -np.log2(of[symbol] / (n + d))
            escape = -np.log2(d / (n + d))
        else:
            escape = 0.0
        return escape + (bits(context[1:], symbol) if context else 8.0)

    text = b"abcab zab"
    told = b"  " + text
    expected = sum(bits(told[at - 2 : at], told[at]) for at in range(2, len(told)))
    found, coded = model.code_lengths([text, b"", text])
    assert found[:, 0] == pytest.approx([expected, 0, expected], rel=1e-5) and coded.tolist() == [9, 0, 9]


def test_lookup_finds_all_and_no_other_keys():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 62, 5000).astype(np.uint64))
    table = Lookup(keys)
    assert (table.rows(keys) == np.arange(len(keys))).all()
    assert (table.rows(keys + np.uint64(1 << 63)) == -1).all()
    assert (Lookup(keys[:0]).rows(keys) == -1).all()


@pytest.fixture(scope="module")
def tokenizer_file():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_token_counts_equal_the_library(spark, tokenizer_file):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file)
    texts = [None, "", " ", "a<|endoftext|>b <|endoftext|>", "don't I'LL  \n\n x ", "½²٣ 漢字 🙂 é", "word " * 3000, "A" * 20_000, "same", "same"]
    found = {r.doc_id: r for r in token_counts(docs(spark, list(enumerate(texts))), tokenizer_file, table_size=2).collect()}
    for k, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (found[k].n_bytes, found[k].n_tokens, found[k].over_limit) == (len((t or "").encode()), n, n > 1024)
    assert token_counts(docs(spark, []), tokenizer_file).collect() == []


def test_pre_tokens_add_up(tokenizer_file):
    from tokenizers import Tokenizer

    library, counter = Tokenizer.from_file(tokenizer_file), TokenCounter(tokenizer_file, {})

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.one_of(st.sampled_from(" \t\n\r'<|>endoftxsv0\xa0\u3000\u200b"), st.characters(exclude_categories=["Cs"])), max_size=30))
    def check(text):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)

    check()


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><header>Site</header>
<div class="cookie-notice">We use cookies</div><nav><ul><li><a href="/x>y">x</a></ul></nav><main><article><h1>Title &amp; more</h1>
<p>One<b>two</b> three<br>four &lt;x&gt; 5 < 6<aside>side</aside><p>un<i>closed <!-- <p>gone</p> --><ul><li>a<li>b</ul><form>f</form>
<table><tr><td>c<td>d</table></article><div id="user-comments"><article>reader</article></div></main><footer>&copy; f</footer>"""


def test_article_text(spark):
    want = "Title & more Onetwo three four <x> 5 < 6 unclosed a b c d"
    rows = [(1, "http://a.example.com/x", PAGE), (2, "http://a.example.com/y", PAGE), (2, "http://a.example.com/y", PAGE), (3, None, PAGE), (4, "http://b.example.com", None), (5, "no scheme", "")]
    rows += [(6, "http://c.example.com/", "<article>" + "<p>word &eacute;</p>" * 20_000), (7, "http://c.example.com/2", "<<<a<b> plain & text")]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, chunk int")
    found = {r.page_id: r for r in main_text(table).collect()}
    assert {found[k].text for k in (1, 2, 3)} == {want}
    assert found[4].text == found[5].text == "" and found[6].text == " ".join(["word é"] * 20_000)
    assert found[6].n_chars == len(found[6].text) and main_text(table).count() == len(rows)
    assert main_text(table.limit(0)).collect() == []


def test_template_of_pages_without_article():
    def source(k):
        return f"<html><body><div><span>Welcome to the site</span></div><div><p>Story {k * 7} of {k}</p><p>{'x' * k} text</p></div><div>All rights reserved here</div></body></html>"

    pages = [Page(source(k)) for k in range(1, 9)]
    assert [p.text(template(pages)) for p in pages[:2]] == ["Story 7 of 1 x text", "Story 14 of 2 xx text"]
    assert pages[0].text(template(pages[:2])) == "Welcome to the site Story 7 of 1 x text All rights reserved here"


def test_chunks_of_a_hot_host(spark):
    rows = [(k, "http://hot.example.com/", f"<nav>n</nav><article><p>text {k}</p></article>") for k in range(90)]
    found = main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), chunk_pages=20).collect()
    assert sorted((r.page_id, r.text) for r in found) == [(k, f"text {k}") for k in range(90)]


def test_quality_is_learned(spark):
    good = [(k, sentence("aa", k).capitalize() + ".") for k in range(300)]
    bad = [(k, (sentence("aa", k, 3) + " ") * 12 if k % 2 else sentence("aa", k).upper().replace(" ", "!! ")) for k in range(300, 500)]
    odd = [(900, None), (901, ""), (902, " "), (903, "x" * 200_000), (904, sentence("aa", 1)), (904, sentence("aa", 1))]
    found = quality.features(docs(spark, good + bad + odd))
    labels = spark.createDataFrame([(k, int(k < 300)) for k in range(500) if k % 3], "doc_id long, y int")
    model = quality.train(found.join(labels, "doc_id"))
    scored = quality.scores(found, model).collect()
    assert len(scored) == 506 and all(0 <= r.score <= 1 for r in scored)
    right = [(r.score >= 0.7) == (r.doc_id < 300) for r in scored if r.doc_id < 500 and r.doc_id % 3 == 0]
    assert np.mean(right) > 0.97
    untrained = quality.train(found.join(labels.limit(0), "doc_id"))
    assert {r.score for r in quality.scores(found, untrained).collect()} == {0.5}
    assert quality.scores(quality.features(docs(spark, [])), model).collect() == []


def test_isotonic_is_the_least_squares_fit():
    rng = np.random.default_rng(5)
    x, n = np.arange(30.0), rng.integers(1, 9, 30).astype(float)
    y = rng.binomial(n.astype(int), np.linspace(0.2, 0.8, 30)).astype(float)
    knots, levels = quality.isotonic(x, n, y)
    assert (np.diff(levels) > 0).all() and (np.diff(knots) > 0).all()
    # max-min formula
    for k in range(30):
        best = max(min(y[a : b + 1].sum() / n[a : b + 1].sum() for b in range(k, 30)) for a in range(k + 1))
        assert np.isclose(levels, best).any()


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_personal_data(spark):
    r = random.Random(8)
    alphabet = list("0123456789" * 3 + "abé🙂@@@...--++  ()_%\n")
    texts = ["".join(r.choices(alphabet, k=r.randrange(80))) for _ in range(1500)]
    texts += [None, "", "x@y", "a@b.com_x@y.org", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "001.02.3.255 1.2.3.256", "+1 (988) 555-2485", "4041894974608795", "4041-8949 7460 8795 1"]
    texts += ["same a@b.co", "same a@b.co"]
    # The plain expressions are quadratic in such texts, so their spans are stated.
    long_texts = {
        "a" * 200_000 + "@": [],
        "1" * 200_000: [],
        "1." * 50_000: [("ip", 8 * k, 8 * k + 7) for k in range(12_500)],
        "a@b.co " * 3000: [("email", 7 * k, 7 * k + 6) for k in range(3000)],
    }
    expected = [(text, plain_spans(text)) for text in texts] + list(long_texts.items())
    found = {row.doc_id: row for row in find_pii(docs(spark, [(k, text) for k, (text, _) in enumerate(expected)])).collect()}
    assert len(found) == len(expected)
    for k, (text, spans) in enumerate(expected):
        told = ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)
        assert found[k].base_sha256 == hashlib.sha256(told.encode()).hexdigest(), text
        assert [found[k][f"n_{kind}"] for kind in PLAIN] == [sum(kind == s[0] for s in spans) for kind in PLAIN]
        assert set(told.split(",")) - {""} <= set(found[k].spans.split(","))
    assert find_pii(docs(spark, [])).collect() == []


def test_contexts_discover_unseen_identifiers(spark):
    r = random.Random(3)
    rows = [(k, f"text here call +{r.randrange(10**9, 10**10)} and more") for k in range(40)]
    rows += [(100, "again call +12345 now"), (101, "the year +12345 now"), (102, "plain 77 text")]
    found = {row.doc_id: row for row in find_pii(docs(spark, rows)).collect()}
    assert found[100].spans == "phone:11:17" and found[100].n_phone == 0
    assert found[101].spans == found[102].spans == ""


def luhn_fails(n):
    double = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(str(n)))]
    return sum(d - 9 * (d > 9) for d in double) % 10 != 0


def cards(valid, start=4_000_000_000_000_000):
    return (n for n in range(start, start + 10**9, 7) if luhn_fails(n) != valid)


def test_patterns_count_all_their_instances(spark):
    good, bad = cards(True), cards(False)
    rows = [(k, f"pay card {next(good)} for w{k}") for k in range(70)]
    shared = [next(bad) for _ in range(6)]
    rows += [(100 + k, f"pay card {n} for v{k}") for k, n in enumerate(shared)] + [(200 + k, f"in order {n} of u{k}") for k, n in enumerate(shared)]
    rows += [(300 + k, f"in order {next(bad)} of t{k}") for k in range(100)]
    found = {row.doc_id: row.spans for row in find_pii(docs(spark, rows)).collect()}
    assert {found[k] for k in range(100, 106)} == {"card:9:25"}
    assert {found[k] for k in range(200, 206)} | {found[k] for k in range(300, 400)} == {""}


def test_words_of_a_seed_teach_no_context_of_their_own(spark):
    r, good, bad = random.Random(5), cards(True), cards(False)
    rows = [(k, f"ring +1 (826) 555-{r.randrange(1000, 10000)} today") for k in range(40)]
    rows += [(50 + k, f"pay {n[:4]} {n[4:8]} {n[8:12]} {n[12:]} now") for k, n in enumerate(str(next(good)) for _ in range(40))]
    rows += [(100, "room 12 555-4081 here"), (101, f"{next(bad)} is a count"), (102, f"room 7 {next(bad)} here")]
    found = {row.doc_id: row for row in find_pii(docs(spark, rows)).collect()}
    assert {found[k].n_phone for k in range(40)} == {found[50 + k].n_card for k in range(40)} == {1}
    assert {found[k].spans for k in (100, 101, 102)} == {""}


def test_contexts_discover_shapes_that_no_seed_has(spark):
    r = random.Random(6)
    rows = [(k, f"text w{k % 7}x call +{r.randrange(10**9, 10**10)} and more") for k in range(40)]
    rows += [(50 + k, f"text mail name{'abcdefghij'[k % 10]}{'klmno'[k % 5]}x{'y' * k}@example.org or") for k in range(40)]
    rows += [(100, "again call 020-7946-0958 now"), (101, "Call: (555) 123-4567 now"), (102, "and call 555 123 4567 now"), (103, "they mail jane@localhost now"), (104, "to mail @jane_doe now")]
    rows += [(200, "year 020-7946-0958 now"), (201, "see (555) 123-4567 now"), (202, "at jane@localhost now"), (203, "call 5 now")]
    found = {row.doc_id: row.spans for row in find_pii(docs(spark, rows)).collect()}
    assert [found[k] for k in range(100, 105)] == ["phone:11:24", "phone:6:20", "phone:9:21", "email:10:24", "email:8:17"]
    assert {found[k] for k in range(200, 204)} == {""}


def test_wrappers_with_telling_names_keep_the_article():
    inner = '<article><p>The story</p><div class="ad">buy</div></article><div class="related"><article>a longer other story</article></div>'
    for start in ('<div class="layout has-sidebar">', '<div id="page" class="comments-open">', '<form id="aspnetForm">', '<div class="social">', '<form><div class="search">'):
        assert Page(f"<html><body><nav>n</nav>{start}{inner.split('<div class=\"related')[0]}</body></html>").text(frozenset()) == "The story"
    for start in ('<div class="layout has-sidebar">', '<div id="page" class="comments-open">'):
        assert Page(f"<html><body>{start}{inner}</body></html>").text(frozenset()) == "The story"
    assert Page("<body><form id='f'><nav>n</nav><p>All of it</p></form>").text(frozenset()) == "All of it"
    assert Page("<body><p>A text of its own</p><div class='comments'><article>reader</article></div>").text(frozenset()) == "A text of its own"
    assert Page("<body><article>Text</article><div class='comments'><article>reader</article></div>").text(frozenset()) == "Text"


def test_template_inside_articles(spark):
    def source(k):
        notice = "<p>Send us your own story today</p>" if k % 4 else ""
        return f"<body><nav>n</nav><article><h1>Head {k * 7}</h1><p>Share this with all friends</p><p>The story of day {k} is told at some length, so that there is more of it than of notices.</p>{notice}</article></body>"

    rows = [(k, "http://a.example.com/", source(k)) for k in range(24)] + [(100 + k, "http://b.example.com/", source(k)) for k in range(5)]
    rows += [(200 + k, "http://c.example.com/", f"<article><p>One text on many pages of a host</p><p>{k}</p></article>") for k in range(12)]
    found = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[k] == f"Head {k * 7} The story of day {k} is told at some length, so that there is more of it than of notices." for k in range(24))
    assert all("Share this with all friends The story" in found[100 + k] for k in range(5))
    assert all(found[200 + k] == f"One text on many pages of a host {k}" for k in range(12))


def test_held_out(spark):
    ids = [None, *range(60)]
    found = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", held_out().alias("out")).collect()
    assert {r.doc_id: r.out for r in found} == {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in ids}
