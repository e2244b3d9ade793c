from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from toneflow.operators import articles, terms


def by_hand(texts, wanted):
    low = {t.lower() for t in wanted if t}
    return sorted((i, t) for i, text in enumerate(texts) for t in low if text and t in text.lower())


def run(spark, texts, wanted):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string").withColumn("gram", F.lit("x"))
    watch = spark.createDataFrame([(w,) for w in wanted], "term string")
    return terms.find_terms(df, "id", F.col("body"), watch)


@pytest.mark.parametrize("block", [1 << 24, 60])
def test_terms_of_all_lengths(spark, monkeypatch, block):
    """Also with an index that is broadcast in several blocks."""
    monkeypatch.setattr(terms, "BLOCK_CHARS", block)
    rng = random.Random(3)
    signs = "aaabbcé. 😀ß"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(80)] + [None, "", "AAAA", "x" * 100_000 + "abc\nab"]
    wanted = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 7))) for _ in range(60)]
    wanted += ["", None, "a", "A", "aaaa", "aaaaa", "aaaaaa", "c\na", "😀", "zzzz"]
    assert sorted(map(tuple, run(spark, texts, wanted).collect())) == by_hand(texts, wanted)


def test_no_terms_and_no_texts(spark):
    assert run(spark, ["abc"], []).collect() == [] and run(spark, [], ["abc"]).collect() == []
    assert run(spark, ["abc"], ["", None]).collect() == []


def test_a_term_is_entered_where_fewest_are(spark):
    watch = spark.createDataFrame([("abcx",), ("abcy",), ("abc",), ("ABC",)], "term string")
    got = {r.gram: r.terms for r in terms.term_index(watch).collect()}
    assert got == {"abcx": ["abcx"], "abcy": ["abcy"], "ab": ["abc"]}
    watch = spark.createDataFrame([("abcxyzwv1",), ("abcxyzwv2",), ("abcxyzwv",)], "term string")
    got = {r.gram: r.terms for r in terms.term_index(watch).collect()}
    assert got == {"bcxyzwv1": ["abcxyzwv1"], "bcxyzwv2": ["abcxyzwv2"], "abcxyzwv": ["abcxyzwv"]}


def test_texts_are_not_shuffled(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = [f"{a}{b}{c}{d}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyzabcd" for d in "efghijklmn"]
    assert len(words) == 10_000
    found = terms.find_terms(df, "doc_id", F.col("text"), spark.createDataFrame([(w,) for w in words], "term string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    texts = {r.doc_id: r.text.lower() for r in df.collect()}
    assert {tuple(r) for r in found.collect()} == {(k, w) for k, t in texts.items() for w in words if w in t}


def test_few_terms_are_searched_for_directly(spark):
    """No text is taken apart for them, and rows that share a key stay rows."""
    df = spark.createDataFrame([(1, "The theme"), (1, "the"), (None, "HE "), (2, None), (3, "other")], "id int, body string")
    wanted = ["THE", "he", "He", "h", " ", "", None]
    found = terms.find_terms(df, "id", F.col("body"), spark.createDataFrame([(w,) for w in wanted], "term string"))
    assert "regexp_extract_all" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(i, t) for i, b in df.collect() if b for t in ("the", "he", "h", " ") if t in b.lower()], key=str)


def test_texts_are_looked_up_by_words(spark):
    """Long lists: words of texts are looked up, not runs of signs; a term in several words of a row comes once."""
    texts = ["the over-other others", "over New York, newyork", "anew yorks x9 é", "", "😀 9x9 OTHER other", "new york"]
    wanted = [f"{a}{b}" for a in "tonex9é" for b in "hvterwx9 -é"] + ["new york", "w y", ", n", "9", "other o", "😀 9", "York,"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts) for _ in range(2)], "id int, body string")
    found = terms.find_terms(df, "id", F.col("body"), spark.createDataFrame([(w,) for w in wanted], "term string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "(.{" not in plan and "Exchange hashpartitioning" not in plan
    assert sorted(map(tuple, found.collect())) == sorted(by_hand(texts, wanted) * 2)


@pytest.mark.parametrize("block, passes", [(1 << 24, 6), (1 << 24, 0), (60, 6)])
def test_many_words_are_shuffled(spark, monkeypatch, block, passes):
    """One pass however many words have a piece; rows that share a key stay rows, a term in two words counts once."""
    monkeypatch.setattr(terms, "NEAR_CHARS", 0)
    monkeypatch.setattr(terms, "BLOCK_CHARS", block)
    monkeypatch.setattr(terms, "WORD_BLOCKS", passes)
    monkeypatch.setattr(terms, "_dense", lambda words, found: False)
    texts = ["the over-other others", "over New York, newyork", "anew yorks x9 é", "", "😀 9x9 OTHER other", "new york", None]
    single, longer = [f"{a}{b}" for a in "tonex9é" for b in "hvterwx9é"] + ["newyork"], ["new york", "w y", "other o", "York,"]
    df = spark.createDataFrame([(i % 4 or None, t) for i, t in enumerate(texts) for _ in range(2)], "id int, body string")

    def of(wanted):
        return terms.find_terms(df, "id", F.col("body"), spark.createDataFrame([(w,) for w in wanted], "term string"))

    for wanted in (single, single + longer):
        want = sorted([(i % 4 or None, t) for i, t in by_hand(texts, wanted)] * 2, key=str)
        assert sorted(map(tuple, of(wanted).collect()), key=str) == want
    plan = of(single)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "regexp_extract_all" not in plan


def test_short_terms_stay_with_their_texts(spark, monkeypatch):
    """Where every word has several terms, words are not shuffled."""
    monkeypatch.setattr(terms, "NEAR_CHARS", 0)
    texts, wanted = ["abab baba abba", "aab", None, "b bb"], [a + b + c for a in "ab" for b in "abc " for c in ["", "a", "b", "ab", "ba"]]
    found = run(spark, texts, wanted)
    assert "Deduplicate" not in found._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, found.collect())) == by_hand(texts, wanted)


def test_tickers_anywhere(spark):
    df = spark.createDataFrame([(1, "The theme"), (2, "other"), (3, "HE")], "id int, body string")
    watch = spark.createDataFrame([("THE",), ("he",), ("He",)], "ticker string")
    got = sorted(map(tuple, articles.mentions(df, "id", F.col("body"), watch, words_only=False).collect()))
    assert got == [(1, "He"), (1, "THE"), (1, "he"), (2, "He"), (2, "THE"), (2, "he"), (3, "He"), (3, "he")]
