"""Lexical search, collocations and HTML text: plain versions, awkward tables, every way of running."""

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), ROOT]

import brute  # noqa: E402

from waybill.llm import collocations, html_text, lexical_search  # noqa: E402

CLASH = "rank score term terms tfs n m hash class_id first item place words phrase a l r lang2 start rest deal text2 html2".split()


def phrases(rng, n, vocabulary=40):
    marks = ["", "", "", "", ",", ".", "\n", "\t", " ;"]
    return " ".join(f"W{rng.randrange(vocabulary)}{rng.choice(marks)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = [(k, phrases(rng, rng.randrange(60)), rng.choice(["en", "fr", None])) for k in range(60)]
    out += [(100 + k, "Copy of one text, copy of W1 W2 W3.", "en") for k in range(30)]
    out += [(500, None, "en"), (501, "", "en"), (502, " .,;\t\n ", "fr"), (None, "W1 W2 nobody", "en"), (None, "W1 W2 nobody", "en")]
    out += [(7, "W1 W2 W3", "en"), (7, "W1 W2 W3", "en"), (600, "long é É " * 20_000, "de")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit("x") for c in CLASH})


ITEMS = [(1, "w1 W2 w3, copy"), (2, "é nobody"), (3, None), (4, ""), (5, "unheard"), (1, "w9"), (None, "w4 text")]


@pytest.mark.parametrize(("vocabulary", "cells"), [(1 << 18, 1 << 22), (1 << 18, 3), (2, 1 << 22)])
def test_lexical_search(spark, docs, rows, vocabulary, cells):
    items = spark.createDataFrame(ITEMS, "item_id int, text string").withColumns({c: F.lit("y") for c in CLASH})
    found = lexical_search.lexical_search(docs, items, vocabulary=vocabulary, cells=cells)
    got = sorted([tuple(r) for r in found.collect()], key=repr)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert got == sorted(brute.lexical([r[:2] for r in rows], ITEMS), key=repr)
    assert sum(r[0] == 1 for r in got) == 10


def test_copies_are_one_class_and_open_by_id(spark):
    rows = [(1000 - k, "same words here") for k in range(400)] + [(k, f"other {k}") for k in range(5000, 5040)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, "words")], "item_id long, text string")
    got = [tuple(r) for r in lexical_search.lexical_search(docs, items, top=12).orderBy("rank").collect()]
    assert [r[2] for r in got] == list(range(601, 613)) and len({r[3] for r in got}) == 1
    bagged = lexical_search.bags(docs, spark.createDataFrame([("words",)], "term string"), "doc_id", "text")
    classes = lexical_search._classes(bagged, 440, 1280)
    assert classes.select("hash", "m", "terms", "tfs").distinct().count() == 1


def test_vectors_of_one_hash_stay_two_classes(spark, monkeypatch):
    """With a hash that never differs, grouping by the vectors still tells them apart."""
    rows = [(k, "apple " * (1 + k % 3) + "pear") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, "apple"), (2, "pear")], "item_id long, text string")
    monkeypatch.setattr(lexical_search.F, "xxhash64", lambda *c: F.lit(5).cast("long"))
    got = [tuple(r) for r in lexical_search.lexical_search(docs, items).collect()]
    assert sorted(got) == sorted(brute.lexical(rows, [(1, "apple"), (2, "pear")]))


def test_search_of_empty_tables(spark, docs):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert lexical_search.lexical_search(nothing, items).count() == 0
    assert lexical_search.lexical_search(docs, items.limit(0)).count() == 0


def found_phrases(df):
    return {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize(("longest", "least", "chunk"), [(3, 10, 1 << 22), (3, 2, 50), (2, 3, 200), (4, 2, 300)])
def test_collocations(spark, docs, rows, longest, least, chunk):
    got = collocations.collocations(docs, longest=longest, least=least, chunk=chunk)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found_phrases(got) == brute.collocations([r[1:] for r in rows], longest, least)


def test_collocations_with_hot_starts_and_more_words_than_bits(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(collocations, "SAMPLE", 1.0)
    monkeypatch.setattr(collocations, "HOT_ROWS", 3)
    hot = collocations._hot_starts(docs, "text", "lang", 3, 10)
    assert hot and len(hot) <= collocations.MANY
    got = collocations.collocations(docs, least=2, chunk=10)
    assert found_phrases(got) == brute.collocations([r[1:] for r in rows], 3, 2)
    # Nine words a window leave 7 bits a word: chunks of more words are counted a stretch at a time.
    rng = random.Random(1)
    texts = [(" ".join(f"v{rng.randrange(400)}" for _ in range(900)), "en")] * 3
    got = collocations.collocations(spark.createDataFrame(texts, "text string, lang string"), longest=9, least=3)
    assert found_phrases(got) == brute.collocations(texts, 9, 3)


def test_cuts_ties_and_phrases_inside_longer_ones(spark):
    texts = [("a b c", "en")] * 10 + [("a b", "en")] * 5 + [("x y", "en")] * 30 + [("Ä B", None)] * 10
    df = spark.createDataFrame(texts, "text string, lang string")
    got = found_phrases(collocations.collocations(df, top=2))
    assert got == brute.collocations(texts, top=2)
    assert got["en", 1][0] == "x y" and got["en", 2][0] == "a b c" and got["und", 1][0] == "Ä b"


def test_collocations_of_nothing(spark):
    nothing = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(nothing).count() == 0


PAGES = {
    "plain": (
        "<html><head><title>no</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li><a href=/>no</a></ul></nav>"
        "<div class=ad>no, no, no, and no again, as often as you like</div><article><h1>Head &amp; line</h1><p>One  long\n paragraph,"
        " with commas,<br>and a break.<p>Two: unclosed, but <b>bold and long enough.</article><footer>no &copy;</footer>",
        "Head & line\n\nOne long paragraph, with commas, and a break.\n\nTwo: unclosed, but bold and long enough.",
    ),
    "no article": (
        "<body><div id=header>no</div><div id=wrap><div class='sidebar-left'><p>no, no, no, this is a very long sidebar, very long indeed.</p></div>"
        "<div class=text><h2>Title</h2><p>First paragraph of the text, long enough, to count.</p><ul><li>short</li></ul>"
        "<p>Second one with a <a href=x>link</a> in it, also long.</p></div><div class=comments><article class=comment><p>I like this, "
        "no, I love it, and so does everyone, really.</p></article></div></div>",
        "Title\n\nFirst paragraph of the text, long enough, to count.\n\nshort\n\nSecond one with a link in it, also long.",
    ),
    "sections": (
        "<main><article><header><h1>T</h1><p>by someone, somewhere, on some day</p></header><section><p>One paragraph, long enough for points.</p>"
        "</section><section><p>Two paragraph, long enough for points.</p><form>no<input value=no></form></section><aside>no</aside></article></main>",
        "T\n\nOne paragraph, long enough for points.\n\nTwo paragraph, long enough for points.",
    ),
    "form around all": (
        "<form id=f><div class=menu>no</div><article><div class='entry-header'><h1>T</h1><span>no</span></div><p>yes</p>"
        "<form><label>no</label></form></article></form>",
        "T\n\nyes",
    ),
    "siblings": (
        "<body><div><div class=a><p>This is the best part, with commas, many, of them, and long, long text.</p><p>More of it, as long, and as good.</p></div>"
        "<div class=b><p>A sibling that goes on with it, also long, also with commas.</p></div><div class=c><a href=x>Only, a, list, of, links, "
        "that, go, to, other, pages</a></div></div>",
        "This is the best part, with commas, many, of them, and long, long text.\n\nMore of it, as long, and as good.\n\n"
        "A sibling that goes on with it, also long, also with commas.",
    ),
    "short": ("<article><p>Hi</p></article>", "Hi"),
    "cells": ("<article><table><tr><td>a&nbsp;b<td>c<tr><td>d</table></article>", "a b\n\nc\n\nd"),
    "hidden": ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p><!-- no --><div role=dialog>no</div></article>", "yes"),
    "text only": ("just text &lt;here&gt;", "just text <here>"),
    "broken": ("<article><p>text </b></div> goes on <unknown x='", "text goes on"),
    "empty": ("", ""),
    "markup only": ("<html><body><script>no</script></body></html>", ""),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_main_text(name):
    html, want = PAGES[name]
    assert html_text.main_text(html) == want


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "deep text, long enough for a point or two" + "</div>" * 20_000
    assert html_text.main_text(deep) == "deep text, long enough for a point or two"
    many = "".join(f"<p>Paragraph {k}, of a long page.</p>" for k in range(20_000))
    assert html_text.main_text(f"<article>{many}</article>").count("\n\n") == 19_999


def test_html_text(spark):
    rows = [(k, f"http://x/{n}", PAGES[n][0]) for k, n in enumerate(sorted(PAGES))] + [(1, None, None), (1, None, None), (None, "u", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in [*CLASH, "text", "n_chars"]})
    found = html_text.html_text(df)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    want = [(k, u, html_text.main_text(h)) for k, u, h in rows]
    assert sorted([tuple(r) for r in found.collect()], key=repr) == sorted([(*w, len(w[2])) for w in want], key=repr)
    assert html_text.html_text(df.limit(0)).count() == 0


def test_a_worker_keeps_what_one_operator_knows():
    """Ids of words go when another operator's task comes to the worker."""
    import pyarrow as pa

    from waybill.llm import packing, quality_model, shared
    from waybill.llm.queries import tokenizer_path

    known = packing._shared_ids(tokenizer_path())
    known("some words")
    assert packing._shared_ids(tokenizer_path()) is known
    quality_model._features.func(pa.array(["text", None]))
    assert not shared._KEPT and packing._shared_ids(tokenizer_path()) is not known
    assert list(shared.strings(pa.array([str(i) for i in range(1300)]))) == [str(i) for i in range(1300)]
