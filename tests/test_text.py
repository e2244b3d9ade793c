from __future__ import annotations

import hashlib
import html
import re
from html.entities import html5

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from toneflow.functions import text as X
from toneflow.functions.html import unescape

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def apply(spark, values, expression):
    """Values of ``expression(column v)`` in input order."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.o for r in df.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]


# Dirty and clean text, step by step and together.
CLEANED = [
    ("a &lt; b &amp; c&#33;", "a < b & c!"), ("<div class='x'>Bank</div><br/>rate", "Bank rate"), ("&lt;i&gt;up&lt;/i&gt;", "up"),
    ("‘one’ “two”", "'one' \"two\""), ("(REUTERS)- Oil falls", "Oil falls"), ("Steel (Bloomberg) -- rises", "Steel rises"),
    ("  tab\tand\u00a0line\n\x1cend ", "tab and line end"), ("<b> </b>", ""), ("3 < 4", "3 < 4"), ("", ""),
    ("<h1>(Reuters) -   Miner&rsquo;s&nbsp;&nbsp;“deal”</h1>\n", "Miner's \"deal\""),
]


def test_clean_pairs(spark):
    assert apply(spark, [dirty for dirty, _ in CLEANED], X.clean_text) == [clean for _, clean in CLEANED]


def test_every_entity_name(spark):
    cases = [f"a&{name}b" for name in html5] + [f"&{name}" for name in html5]
    assert apply(spark, cases, unescape) == [html.unescape(c) for c in cases]


def test_numeric_and_odd_references(spark):
    cases = ["&amp;lt;", "&lt;p&gt;", "&copyfoo", "&notit;", "&#65;", "&#x41", "&#0;", "&#128;", "&#x81;",
             "&#xD800;", "&#1114112;", "&#99999999999999;", "&#xFFFFFFFFFF;", "&", "&&amp;", "&#", "&#x",
             "&#xg", "&#11;", "&#xFFFE;", "&#x1FFFF;", "&#13;", "&#000065;", "&nosuch;", "&ampamp;", "a&b;c",
             "&#x1F600;", "&#xFDD0;", "&#127;", "", "&#65&#66"]
    assert apply(spark, cases, unescape) == [html.unescape(c) for c in cases]


def test_entities_are_decoded_before_tags_go(spark):
    assert apply(spark, ["&lt;b&gt;x", "&amp;lt;b&amp;gt;x"], X.clean_text) == ["x", "&lt;b&gt;x"]


def test_single_steps(spark):
    assert apply(spark, ["a<b\n>c", "<>x", None], X.strip_tags) == ["a c", "<>x", None]
    assert apply(spark, ["’‘“”x"], X.straighten_quotes) == ["''\"\"x"]
    assert apply(spark, ["(REUTERS)-a (Bloomberg) --b (x)"], X.drop_wire_prefixes) == ["a b (x)"]
    assert apply(spark, [" a \x1cb\x85 \n"], X.collapse_space) == ["a b"]


PIECES = st.lists(st.sampled_from(
    ["<p>", "</p>", "<", ">", "&lt;", "&amp;", "&nbsp;", "(Reuters) - ", "(bloomberg) --", "(", ")", "’", "“",
     " ", "\x1c", " ", "\n", " ", "word", "É", "&copy", "&#8217;", "ſ", "᠎"]), max_size=14).map("".join)


@FEW
@given(st.lists(PIECES, min_size=40, max_size=60))
def test_clean_leaves_nothing_to_clean(spark, values):
    cleaned = apply(spark, values, X.clean_text)
    for text in cleaned:
        assert text == " ".join(text.split()) and not set(text) & set("’‘“”")
        assert not re.search(r"\((?:Reuters|Bloomberg)\) ?-", re.sub("&[^;]*;", "", text), re.IGNORECASE) or "(" in text


def test_keys_match_hashlib(spark):
    rows = [("  Ärger İm Büro  ", "ΑΣ", "2024-01-05T10:00:00Z"), (None, None, None), ("", "Unknown", "x")]
    df = spark.createDataFrame(rows, "t string, s string, p string")
    got = [r.h for r in df.select(X.article_key(F.col("t"), F.col("s"), F.col("p")).alias("h")).collect()]
    want = [hashlib.sha256(f"{(t or '').lower().strip()}|{(s or 'unknown').lower()}|{(p or '')[:10]}".encode())
            .hexdigest() for t, s, p in rows]
    assert got == want


def test_joined_fields(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, ""), ("", "b")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    rows = df.select(X.join_fields(a, b), X.labelling_text(a, b), X.scoring_text(a, b)).collect()
    assert [tuple(r) for r in rows] == [("a b", "a. b", "a b"), ("a", "a.", "a"), ("", ".", ""), ("b", ". b", "b")]


def test_tags(spark):
    symbols = ["AAPL", "A", "IT"]
    texts = ["aapl rose", "It said", "nothing of note", "xyz", None]
    assert apply(spark, texts, lambda c: X.tag_tickers(c, symbols)) == [["AAPL", "A"], ["A", "IT"], [], [], []]
    assert apply(spark, texts, lambda c: X.tag_tickers(c, symbols, words_only=True)) == [["AAPL"], ["IT"], [], [], []]


def test_tokens_and_shortening(spark):
    assert apply(spark, ["Don't stop-Now 3x"], X.tokens) == [["don't", "stop", "now", "x"]]
    assert apply(spark, ["x" * 100, "y" * 101], X.shorten) == ["x" * 100, "y" * 100 + "..."]


def test_query_terms():
    assert X.query_terms("Apple Inc", "AAPL", [" iphone ", "", "AAPL"]) == ["Apple Inc", "AAPL", "iphone"]
