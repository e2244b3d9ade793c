from __future__ import annotations

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from toneflow.functions import labels as L
from toneflow.operators.lexicon import score_by_table
from toneflow.plans.labelling import build_dataset, label_missing, weak_label

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]


def py_score(t, lexicon=L.FINANCE):
    words = [w.lower() for w in re.findall(r"[A-Za-z']+", t)]
    p, n = sum(w in lexicon.positive for w in words), sum(w in lexicon.negative for w in words)
    return (p - n) / (p + n) if p + n else 0.0


def test_two_sentences(spark):
    scores = column(spark, ["record profit growth and upgrade", "loss decline lawsuit and probe"], "string",
                    L.score_lexicon)
    assert scores == [1.0, -1.0]
    assert column(spark, scores, "double", L.label_from_score) == ["positive", "negative"]


def test_no_tokens_no_hits_null(spark):
    assert column(spark, ["", "123", "plain words", None, "profits lossy 'beat"], "string", L.score_lexicon) == [0.0] * 5


WORDS = st.lists(st.sampled_from([*L.FINANCE.positive, *L.FINANCE.negative, "profits", "Beat", "LOSS", "it's", "'",
                                  " ", "-", "é", "K", "ſurge", "mıss"]), max_size=12).map(" ".join)


@FEW
@given(st.lists(st.one_of(WORDS, WORDS.map(lambda t: t.replace(" ", ""))), min_size=40, max_size=60))
def test_score_matches_python(spark, texts):
    assert column(spark, texts, "string", L.score_lexicon) == [py_score(t) for t in texts]


def test_long_list_scores_alike(spark):
    filler = tuple(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))
    long = L.Lexicon(L.FINANCE.positive + filler, L.FINANCE.negative)
    texts = ["profit loss loss wordab", "nothing", "Growth, growth; decline"]
    assert column(spark, texts, "string", lambda c: L.score_lexicon(c, long)) == \
        [py_score(t, long) for t in texts]
    table = spark.createDataFrame([(w, 1) for w in L.FINANCE.positive] + [(w, -1) for w in L.FINANCE.negative],
                                  "word string, polarity int")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    rows = score_by_table(df, "id", "body", table).orderBy("id").collect()
    assert [r.lex_score for r in rows] == [py_score(t) for t in texts]


def test_lexicon_table_shuffles_no_texts(spark):
    """Keys, words and polarities cross the network, whether the lexicon is broadcast or not."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    table = spark.createDataFrame([("the", 1), ("of", -1)], "word string, polarity int")
    for limit, joins in (("10m", "BroadcastHashJoin"), ("-1", "SortMergeJoin")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            plan = score_by_table(df, "doc_id", "text", table)._jdf.queryExecution().executedPlan()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert joins in plan.toString()
        below = re.findall(r"Exchange hashpartitioning.*\n[^\n]*", plan.toString())
        assert below and not any("text#" in x for x in below)


def test_cut_is_strict(spark):
    assert column(spark, [0.2, 0.2000001, -0.2, -0.2000001, 0.0], "double", L.label_from_score) == \
        ["neutral", "positive", "neutral", "negative", "neutral"]


def test_combination(spark):
    rows = [("negative", {"negative": 0.6}, "positive"), ("negative", {"negative": 0.59}, "positive"),
            (None, {"negative": 0.9}, "positive"), ("negative", None, "positive"), ("negative", {}, "positive"),
            ("", {"negative": 0.9}, "neutral")]
    df = spark.createDataFrame(rows, "m string, p map<string,double>, l string")
    got = [r[0] for r in df.select(L.combine_labels(F.col("m"), F.col("p"), F.col("l"))).collect()]
    assert got == ["negative", "positive", "positive", "positive", "positive", "neutral"]


def test_scores_of_labels_and_probabilities(spark):
    assert column(spark, ["negative", "neutral", "positive", "Positive", "love", None], "string",
                  L.label_to_score) == [-1.0, 0.0, 1.0, 0.0, 0.0, 0.0]
    probs = [{"positive": 0.7, "negative": 0.1}, {"negative": 0.25}, {}]
    assert column(spark, probs, "map<string,double>", L.prob_score) == [0.7 - 0.1, -0.25, 0.0]


def test_decay(spark):
    assert column(spark, [0, 50, 100], "int", L.decay_weight) == [1.0, 0.5, 0.25]
    assert column(spark, [3], "int", lambda c: L.decay_weight(c, 0)) == [0.125]


def test_vocabularies(spark):
    names = ["LABEL_0", "label_1", "Label_2", "Joy", "sadness", "POSITIVE", "love", "Anger", "disgust", None]
    assert column(spark, names, "string", L.normalise_label) == [
        "negative", "neutral", "positive", "positive", "negative", "positive", "love", "anger", "disgust", None]
    assert column(spark, names[3:], "string", L.emotion_tone) == [
        "positive", "negative", "positive", "love", "neutral", "neutral", None]
    assert column(spark, ["negative", "neutral", "positive", "x"], "string", L.label_to_id) == [0, 1, 2, None]
    assert column(spark, [2, 0, 7], "int", L.id_to_label) == ["positive", "negative", None]


def test_decision_takes_first_maximum(spark):
    best = column(spark, [[1.0, 1.0, 0.0], [0.0, 800.0, 1.0]], "array<double>",
                  lambda c: L.decide(L.softmax(c)))
    assert best[0].label == "negative" and best[1].label == "neutral"
    top = math.exp(0) / (2 * math.exp(0) + math.exp(-1))
    assert abs(best[0].confidence - top) < 1e-12 and abs(sum(best[0].probs.values()) - 1) < 1e-12


def test_one_result_per_text(spark):
    df = spark.createDataFrame([(1, "profit"), (2, "loss"), (3, None)], "id int, body string")
    rows = weak_label(df, "body").orderBy("id").collect()
    assert [(r.weak_label, r.lex_label, r.lex_score, r.model_label) for r in rows] == [
        ("positive", "positive", 1.0, None), ("negative", "negative", -1.0, None), ("neutral", "neutral", 0.0, None)]


ARTICLES = "hash string, title string, description string"


def test_dataset_keeps_rows_and_samples_exactly(spark):
    rows = [(str(i), "profit" if i % 2 else None, None) for i in range(50)]
    df = spark.createDataFrame(rows, ARTICLES)
    assert build_dataset(df).count() == 50
    sampled = build_dataset(df, sample=7)
    assert sampled.count() == 7 and build_dataset(df, sample=70).count() == 50
    assert sorted(r.hash for r in sampled.collect()) == sorted(r.hash for r in build_dataset(
        df.repartition(9), sample=7).collect())


def test_label_only_what_is_missing(spark):
    df = spark.createDataFrame([("a", "profit", None), ("b", None, None)], ARTICLES)
    assert [r.weak_label for r in label_missing(df).orderBy("hash").collect()] == ["positive", "neutral"]
    partly = df.withColumn("weak_label", F.when(F.col("hash") == "a", "negative"))
    assert [r.weak_label for r in label_missing(partly).orderBy("hash").collect()] == ["negative", "neutral"]
