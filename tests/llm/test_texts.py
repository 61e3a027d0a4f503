"""BPE round trips, decontamination against brute force, main text of pages, and the pipeline."""

import hashlib
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from kestrel.llm import bpe, decontaminate, html_text
from kestrel.llm.queries import bpe_files, op2_decontamination, op6_bpe
from test_near_dups import brute as brute_groups
from test_pii import brute as brute_spans


@pytest.fixture(scope="module")
def enc():
    return bpe.encoding(*bpe_files())


PARTS = st.one_of(st.sampled_from(["don't", " it's", "'re", "'", "12", " 3", "\n\n", "  ", "\t", "é", "ñandú", "日本", "!!", " —", "a" * 9, " ", "\r\n"]), st.text(max_size=5))


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=30).map("".join), st.integers(1, 12))
def test_pieces_encode_like_the_whole(enc, text, limit):
    text = text.encode("utf-8", "replace").decode()
    pieces = bpe.safe_pieces(text, limit)
    assert "".join(pieces) == text
    assert [i for p in pieces for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_encode_and_decode(spark, enc):
    texts = [None, "", "plain", "é😀\n" * 50, "word " * 40000, "x" * 70000, "<|endoftext|>", "plain"]
    df = spark.createDataFrame([(i, t, b"z") for i, t in enumerate(texts)], "doc_id long, text string, token_ids binary")
    for r in bpe.decode(bpe.encode(df, *bpe_files()), *bpe_files()).collect():
        text = texts[r.doc_id] or ""
        assert list(struct.unpack(f"<{len(r.token_ids) // 4}I", r.token_ids)) == enc.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()
    assert bpe.encode(df.limit(0), *bpe_files()).collect() == []


def test_bpe_query(spark, small_dir, enc):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    for r in op6_bpe(spark, small_dir).collect():
        ids = enc.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def least_edits(item, text):
    """Least edit distance between the item and any stretch of the text, by the plain recurrence."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        before, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != d)))
    return min(row)


def contaminated(docs, items, rate=decontaminate.ERROR_RATE):
    out = set()
    for doc_id, text in docs:
        for item_id, item in items:
            item = decontaminate.normalise(item or "")
            if len(item) >= decontaminate.MIN_CHARS:
                k = max(0, min(int(rate * len(item)), len(item) // decontaminate.MIN_PIECE - 1))
                edits = least_edits(item, decontaminate.normalise(text or ""))
                if edits <= k:
                    out.add((doc_id, item_id, edits))
    return out


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(n))
    items = [(i, prose(18)) for i in range(6)] + [(6, None), (7, ""), (8, "too short"), (9, prose(6))]
    items.append((10, items[0][1].upper()))
    docs = [(100, None), (101, ""), (102, prose(40))]
    for n in range(24):
        item = list(rng.choice(items[:6])[1])
        for _ in range(n % 9):
            at = rng.randrange(len(item))
            item[at:at + 1] = rng.choice([[], ["z"], [item[at], "q"]])
        docs.append((n, prose(12) + "\n " + "".join(item).replace(" ", "  \n") + " " + prose(9)))
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.edits) for r in decontaminate.matches(d, b).collect()}
    assert got == contaminated(docs, items)
    left = decontaminate.without_items(d, b)
    assert left.columns == d.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in docs} - {x[0] for x in got}


def test_decontamination_in_blocks_and_empty_tables(spark, monkeypatch):
    items = [(i, f"item number {i} with a text that is long enough") for i in range(8)]
    b = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame([(i, f"before {t} after") for i, t in items] * 2, "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 60)
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.matches(d, b).where("edits = 0").collect()) == sorted((i, i) for i, _ in items * 2)
    assert decontaminate.matches(d, b.limit(0)).collect() == [] and decontaminate.matches(d.limit(0), b).collect() == []
    assert decontaminate.without_items(d, b.limit(0)).count() == 16


def test_short_items_and_items_without_an_id(spark):
    items = [(1, "Who wrote Emma?"), (2, "中国的首都是哪里"), (3, "Paris"), (None, "an item that has no id at all but a long text"), (4, "in the art")]
    docs = [(1, "Quiz: who  wrote\nEmma? Jane Austen."), (2, "你好。中国的首都是哪里？北京"), (3, "Name it.\n\n paris \nEnd."), (4, "Paris is a city. She starred in the arts, who wrote emma"),
            (5, "so here is an item that has no id at all but a long text, as said")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(tuple(r) for r in decontaminate.matches(d, b).collect()) == [(1, 1, 0, 21), (2, 2, 0, 11), (3, 3, 0, 14)]
    assert [r.doc_id for r in decontaminate.without_items(d, b).collect()] == [4]


def test_decontamination_query_finds_exact_items(spark, small_dir):
    docs, items = (spark.read.parquet(f"{small_dir}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    exact = {(d.doc_id, i.item_id) for d in docs for i in items if decontaminate.normalise(i.text) in decontaminate.normalise(d.text)}
    got = op2_decontamination(spark, small_dir).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.edits == 0} == exact


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><div id="header"><h1>Site</h1></div>
<ul class="menu"><li><a href=x>Home</a><li><a href=y>News</a></ul><div class="wrap"><div class="post"><h2>Title &amp; more</h2>
<p>First paragraph with <a href=y>a link</a> and text that runs on for a good while, so that it is dense.<p>Second&nbsp;one &mdash; with
some   more words,<br>and more <b>of</b> them still.</p><ul><li>One thing<li>Another thing</ul><blockquote>Quote me.</blockquote>
<script>var a = "<p>no</p>";</script></div><div class="sidebar"><p>Related stuff here</p></div><div class="comments"><p>A reader says
something long that is not part of the text at all, however long it may get.</p></div></div><div class="cookie-notice">We use cookies,
please accept all of them now, thank you.</div><form><p>Search</p><input></form><footer>&copy; 2020</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE).split("\n") == [
        "Title & more", "First paragraph with a link and text that runs on for a good while, so that it is dense.",
        "Second one — with some more words, and more of them still.", "One thing", "Another thing", "Quote me."]


LONG = "A sentence of the article that runs on for a while, so that it is dense. " * 4


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-sidebar", "layout with-sidebar", "content-sidebar-wrap", "post comments-closed", "comments-open",
                                  "sharing-enabled", "related-work", "legal-analysis", "sidebar", "widget"])
def test_names_do_not_drop_the_article(name):
    for page in (f"<div class='{name}'><article><p>{LONG}</p><p>{LONG}</p></article></div>", f"<div class='{name}'><p>{LONG}</p><p>{LONG}</p></div><p>x</p>",
                 f"<article class='{name}'><p>{LONG}</p><p>{LONG}</p></article>"):
        assert html_text.main_text(page).split("\n")[:2] == [LONG.strip()] * 2
    if "-" in name:
        assert html_text.main_text(f"<article><p>{LONG}</p><p>{LONG}</p><section id='{name.split()[-1]}'><p>Another part.</p></section></article>").endswith("Another part.")


def test_bare_text_beside_the_selected_node():
    bare = ("Some words of the article without an element. " * 40).strip()
    ps = [f"Paragraph {i} of the article with so many words that it is about a hundred code points long, or so." for i in range(20)]
    inner = "<div>" + "".join(f"<p>{p}</p>" for p in ps) + "</div>"
    link = bare.replace("words", "<b>words</b>", 1)
    for page, want in ((f"<div id=content>{bare}{inner}</div>", [bare, *ps]), (f"<div id=content>{inner}{bare}</div>", [*ps, bare]),
                       (f"<div id=content>{link}<script>x()</script>{inner}</div>", [bare, *ps]), (f"{bare}<div>{inner}{bare}</div>{bare}", [bare, *ps, bare, bare]),
                       (f"<div id=content>Home <a href=x>News</a> | 2020{inner}</div>", ps)):
        assert html_text.main_text(page).split("\n") == want


@pytest.mark.parametrize("name", ["ad", "site-footer", "x cookie-notice", "nav_menu", "side-bar", "comments", "comment-list", "Related", "advert_" * 40])
def test_whole_names_of_noise_are_dropped(name):
    assert html_text.main_text(f"<article><p>{LONG}</p><div class='{name}'><p>Something else.</p></div></article><div id='comments'><article class='comment-body'>{LONG * 9}</article></div>") == LONG.strip()


@pytest.mark.parametrize("page", ["", "<", "<p", "no markup at all", "<p>open<div>never closed", "<![bad]><p>x</p>", "</p></div></b>", "<a><a><a>x", "&#0;&bad; &amp;lt;"])
def test_odd_markup_does_not_fail(page):
    assert isinstance(html_text.main_text(page), str)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<ul><li>", "<td>", "<!--", "-->", "<script>", "</script>", "word ", "&lt;", "<br>", "<!x", "<a href='"]), max_size=25).map("".join))
def test_any_markup(page):
    assert "<p>" not in html_text.main_text(page) or "<!" in page


def test_extract_edge_cases(spark):
    df = spark.createDataFrame([(1, "u", None, 1), (2, None, "", 1), (3, "u", "<p>" + "word " * 60000, 1), (3, "u", "<i>x</i>", 1)], "page_id long, url string, html string, text int")
    assert [(r.page_id, r.url, len(r.text)) for r in html_text.extract(df).collect()] == [(1, "u", 0), (2, None, 0), (3, "u", 299999), (3, "u", 1)]
    assert html_text.extract(df.limit(0)).collect() == []


def test_articles_of_the_test_pages(spark, small_dir):
    import html
    import re

    for r in html_text.extract(spark.read.parquet(f"{small_dir}/pages.parquet")).join(spark.read.parquet(f"{small_dir}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inside = re.search("<article>(.*)</article>", r.html, re.S)[1]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", x)))).strip() for x in re.split("</?(?:p|h1)>", inside))
        assert r.text == "\n".join(b for b in blocks if b)


def test_pipeline_matches_brute_force(spark, small_dir, enc):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    groups = brute_groups([d for d in docs if any(c.isalpha() for c in d[1])])
    kept = [(i, t) for i, t in docs if groups.get(i) == i]
    bad = {(r.doc_id) for r in op2_decontamination(spark, small_dir).collect()}
    exact = {i for i, t in kept for _, x in items if decontaminate.normalise(x) in decontaminate.normalise(t)}
    assert exact <= bad
    want = {}
    for i, text in kept:
        if i not in bad:
            out, at = [], 0
            for start, _, kind, end in brute_spans(text):
                if start >= at:
                    out += [text[at:start], f"[{kind.upper()}]"]
                at = max(at, end)
            ids = enc.encode_ordinary("".join(out) + text[at:])
            want[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, small_dir).collect()} == want


def test_pipeline_stages_on_odd_rows(spark, small_dir):
    rows = [(1, "one two three four five six seven", "en", None, 33, "x"), (1, "one two three four five six seven", "en", None, 33, "x"), (None, "some words here", None, "s", None, "y"),
            (2, None, "en", "s", 0, None), (3, "", "en", "s", 0, "z"), (4, "123", None, "s", 3, "z"), (5, "ONE two three four five six seven", "en", "s", 33, "w")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    for rows_, want in ((rows, [None, 1]), ([], [])):
        docs = spark.createDataFrame(rows_, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, small_dir)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
        assert sorted((r.doc_id for r in docs.collect()), key=lambda x: (x is not None, x)) == want


def test_pipeline_keeps_different_texts_of_one_id(spark, small_dir):
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six seven eight", "red green blue black white grey pink")
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "y"), (2, b.upper(), "x"), (2, c, "x"), (3, c + "!", "x"), (4, a + " " + b, "x"), (None, a, "x"), (5, None, "x"), (5, a, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.near_duplicates(spark, docs, small_dir)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, a, "x"), (1, b, "x"), (2, c, "x"), (3, c + "!", "x"), (4, a + " " + b, "x"), (None, a, "x"), (5, None, "x")], key=str)


def test_pipeline_without_a_labelled_row(spark, small_dir):
    rows = [(1, "some words here", None), (2, "123", None), (3, None, None), (4, "", None), (5, "más palabras", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.language(spark, docs, small_dir).collect()) == [1, 5]
