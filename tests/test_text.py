import hashlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from feedlens.functions import text as TX
from feedlens.plans import oracle as O

from . import pyref

CLEANED = {
    "&lt;b&gt;bold&lt;/b&gt;": "<b>bold</b>", "&amp;lt;": "&lt;", "it&#39;s": "it's", "a&nbsp;b": "a b", "<p>a</p><p>b</p>": "ab",
    "x &copy; y &middot; z &quot;q&quot;": "x \u00a9 y \u00b7 z \"q\"", "&ampx and &amp": "&x and &", "tab\there nbsp  end ": "tab here nbsp end",
    "  Lead <i>tag</i>  ": "Lead tag", "": "", " em\u3000space": "em space", "a &unknown; b": "a &unknown; b", "&#x27;hex&#x27;": "'hex'",
}


def _eval(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_content_cases(spark):
    assert _eval(spark, list(CLEANED), TX.clean_content) == list(CLEANED.values())


# url: (normalized, domain)
URLS = {
    "https://A.com/x/?q=1#f": ("https://a.com/x", "a.com"), "https://a.com/x//": ("https://a.com/x", "a.com"),
    "http://a.com/x#frag?x": ("http://a.com/x", "a.com"), "": (None, ""), None: (None, None),
    "HTTP://User@Host:8080/p": ("http://user@host:8080/p", "user@host:8080"), "www.no-scheme.com/a": ("www.no-scheme.com/a", ""),
    "//host/path": ("//host/path", "host"), "https://[::1/x": ("https://[::1/x", "unknown"), "https://h.com/a b": ("https://h.com/a b", "h.com"),
    "mailto:x@y.z": ("mailto:x@y.z", ""),
}


def test_url_functions(spark):
    assert _eval(spark, list(URLS), TX.normalize_url) == [n for n, _ in URLS.values()]
    assert _eval(spark, list(URLS), TX.extract_domain) == [d for _, d in URLS.values()]


TITLES = {
    "BREAKING: Big news": " big news", "breaking news: x": " x", " Exclusive: A ": " a", "x": "x", "  ": None, "": None,
    "breaking: breaking:": " ", "Title with nbsp\u00a0": "title with nbsp", "EXCLUSIVE NEWS: y": " y",
}


def test_normalize_title_and_hash(spark):
    assert _eval(spark, list(TITLES), TX.normalize_title) == list(TITLES.values())
    same = _eval(spark, ["One  two", "one two ", "ONE\ttwo", "", None], TX.content_hash)
    assert same == [hashlib.md5(b"one two").hexdigest()] * 3 + [None, None]


_pieces = st.sampled_from(list("ab .!?,\u00a0\tAndhowevr") + [" and ", ". ", " though ", "w" * 60])
text_st = st.lists(_pieces, max_size=60).map("".join)


@settings(max_examples=30, deadline=None)
@given(st.lists(text_st, min_size=1, max_size=40))
def test_summaries_property(spark, values):
    assert _eval(spark, values, TX.summary_detailed) == pyref.scalar(O.summary_detailed, values)
    assert _eval(spark, values, TX.summary_brief) == pyref.scalar(O.summary_brief, values)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.sampled_from(list("aB<>&;#x1 \t\u00a0/?p") + ["&amp;", "&lt;", "&#39;"]),
                        max_size=30).map("".join), min_size=1, max_size=30))
def test_clean_and_keys_property(spark, values):
    assert _eval(spark, values, TX.clean_content) == pyref.scalar(O.clean_content, values)
    assert _eval(spark, values, TX.normalize_title) == pyref.scalar(O.normalize_title, values)
    assert _eval(spark, values, TX.content_hash) == pyref.scalar(O.content_hash, values)
    assert _eval(spark, values, TX.normalize_url) == pyref.scalar(O.normalize_url, values)


def test_summary_edge_cases(spark):
    long1 = "w" * 201
    words = ("word " * 40).strip()
    cases = {  # text: (brief, detailed)
        "": (".", ""), "One.": ("One.", "One."), "One. Two": ("One.", "One."), "One. Two. Three": ("One.", "One. Two."),
        "A. B. ": ("A.", "A. B."), long1 + ". " + "s" * 200: ("s" * 200 + ".", long1 + "."),
        long1 + " and " + "z" * 10: (None, long1[:200] + "..."), words: (words + ".", words[:200] + "..." if len(words) > 200 else words),
        "Question? Next. More": ("Question? Next.", "Question? Next."), "Wow! Yes. No": ("Wow! Yes.", "Wow! Yes."), "abc def": ("abc def.", "abc def"),
    }
    brief, detailed = _eval(spark, list(cases), TX.summary_brief), _eval(spark, list(cases), TX.summary_detailed)
    for (text, want), b, d in zip(cases.items(), brief, detailed):
        assert d == want[1], text
        assert want[0] is None or b == want[0], text


@pytest.mark.parametrize("n,expect", [(0, ""), (300, "x" * 300), (501, "x" * 500 + "...")])
def test_preview(spark, n, expect):
    assert _eval(spark, ["x" * n], lambda c: TX.preview(c, 500)) == [expect]


def test_whitespace_set_matches_python(spark):
    cps = [c for c in range(0x3100) if not 0xD800 <= c <= 0xDFFF]
    values = ["a" + chr(c) + "b" for c in cps]
    got = _eval(spark, values, TX.collapse_ws)
    assert got == [" ".join(v.split()) for v in values]
    got = _eval(spark, [chr(c) + "x" + chr(c) for c in cps], TX.strip_ws)
    assert got == [(chr(c) + "x" + chr(c)).strip() for c in cps]


def test_unescape_equals_the_standard_library(spark):
    """Every name of HTML 5 with and without its end, numbers of all kinds, and random mixtures."""
    import html
    import random
    from html.entities import html5

    from feedlens.functions.text import unescape_html

    rng = random.Random(1)
    codes = [*range(300), 0xD7FF, 0xD800, 0xDFFF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFEFF, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x10FFFF, 0x110000, 10 ** 12, 10 ** 30]
    values = [f"&{n}" for n in html5] + [f"&{n[:-1]}x;" for n in html5] + [f"a&#{k};b&#x{k:x} &#X{k:X}" for k in codes]
    parts = ["&", "#", "x", "amp", ";", "lt", "notit", "39", "0", " ", "<", "é", "&&", "&#", "&#x", "copy", "\n", "&amp;lt;", "😀", "&#00000000000000039;", "&not", "in;"]
    values += ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", unescape_html("v").alias("u"))
    assert [(values[r.i], r.u) for r in df.collect() if r.u != html.unescape(values[r.i])] == []


def test_cleaning_stays_on_the_jvm(spark):
    from feedlens.sources.adapters import documents_articles

    from .conftest import SF001
    assert "Python" not in documents_articles(spark, SF001)._jdf.queryExecution().executedPlan().toString()
