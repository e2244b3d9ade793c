"""Word-list scores and label rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from toneflow import fixtures
from toneflow.catalog import query, sql
from toneflow.functions import labels as L
from toneflow.functions.text import tokens
from toneflow.operators import articles
from toneflow.operators.daily import decayed_tone, prepare_articles, recency_index
from toneflow.operators.lexicon import score_by_table
from toneflow.plans.labelling import weak_label

# The test documents are invented prose: frequent words stand in for a lexicon.
COMMON = L.Lexicon(positive=("the", "and", "for"), negative=("of", "to", "with"))
SCORE = sql.lexicon_score("text", COMMON.positive, COMMON.negative)


@query("lab1_lexicon_score", f"SELECT doc_id, round_even({SCORE}, 6) + 0.0 AS score FROM documents")
def lab1(spark, d):
    return fixtures.documents(spark, d).select(
        "doc_id", sql.r6(L.score_lexicon(F.col("text"), COMMON)).alias("score"))


@query("lab1_default_words",
       f"SELECT doc_id, {sql.lexicon_score('text', L.FINANCE.positive, L.FINANCE.negative)} AS score FROM documents")
def lab1_default(spark, d):
    return fixtures.documents(spark, d).select("doc_id", L.score_lexicon(F.col("text")).alias("score"))


_TABLE = """lexicon AS (
  SELECT word, CASE WHEN length(word) % 2 = 1 THEN 1 ELSE -1 END AS polarity FROM (
    SELECT DISTINCT lower(w) AS word FROM (
      SELECT unnest(regexp_extract_all(text, '[A-Za-z'']+')) AS w FROM benchmark)))"""


@query("lab2_lexicon_table", f"""WITH {_TABLE}, tokens AS (
  SELECT doc_id, lower(unnest(regexp_extract_all(text, '[A-Za-z'']+'))) AS word FROM documents),
scored AS (SELECT doc_id, sum(polarity) / CAST(count(*) AS DOUBLE) AS score
  FROM tokens JOIN lexicon USING (word) GROUP BY 1)
SELECT doc_id, round_even(coalesce(score, 0.0), 6) + 0.0 AS score FROM documents LEFT JOIN scored USING (doc_id)""")
def lab2(spark, d):
    words = fixtures.table(spark, d, "benchmark").select(F.explode(tokens(F.col("text"))).alias("word"))
    lexicon = words.distinct().withColumn(
        "polarity", F.when(F.length("word") % 2 == 1, 1).otherwise(-1))
    scored = score_by_table(fixtures.documents(spark, d), "doc_id", "text", lexicon)
    return scored.select("doc_id", sql.r6("lex_score").alias("score"))


@query("lab3_label_from_score", f"SELECT doc_id, {sql.label_of(SCORE)} AS label FROM documents")
def lab3(spark, d):
    return fixtures.documents(spark, d).select(
        "doc_id", L.label_from_score(L.score_lexicon(F.col("text"), COMMON)).alias("label"))


@query("lab4_lexicon_label",
       f"SELECT doc_id, {sql.label_of(SCORE)} AS label, round_even({SCORE}, 6) + 0.0 AS score FROM documents")
def lab4(spark, d):
    found = fixtures.documents(spark, d).select(
        "doc_id", L.lexicon_label(F.col("text"), COMMON).alias("x"))
    return found.select("doc_id", "x.label", sql.r6("x.score").alias("score"))


# Model output made up from the row key: missing, empty, unsure, just sure and sure.
_MODEL_SQL = """CASE WHEN {0} % 4 <> 0 THEN 'negative' END AS model_label,
  CASE WHEN {0} % 4 = 1 THEN NULL ELSE ({0} % 11) / 10.0 END AS top"""


def _with_model(df, key):
    n = F.col(key)
    top = (n % 11) / 10.0
    probs = F.when(n % 4 != 1, F.create_map(F.lit("negative"), top, F.lit("neutral"), F.lit(0.05)))
    return df.withColumns({"model_label": F.when(n % 4 != 0, "negative"), "model_probs": probs})


_COMBINED = "CASE WHEN model_label IS NOT NULL AND greatest(top, 0.05) >= 0.6 THEN model_label ELSE {0} END"


@query("lab5_combine_labels", f"""WITH {sql.EVENTS}, m AS (
  SELECT hash, weak_label, {_MODEL_SQL.format('CAST(hash AS BIGINT)')} FROM ev)
SELECT hash, CASE WHEN top IS NULL THEN weak_label ELSE {_COMBINED.format('weak_label')} END AS label FROM m""")
def lab5(spark, d):
    df = fixtures.events_as_articles(spark, d).withColumn("_n", F.col("hash").cast("bigint"))
    return _with_model(df, "_n").select("hash", L.combine_labels(
        F.col("model_label"), F.col("model_probs"), F.col("weak_label")).alias("label"))


@query("lab6_weak_labels", f"""WITH m AS (
  SELECT doc_id, {sql.label_of(SCORE)} AS lex_label, {SCORE} AS lex_score, {_MODEL_SQL.format('doc_id')}
  FROM documents)
SELECT doc_id, lex_label, round_even(lex_score, 6) + 0.0 AS lex_score, model_label,
  CASE WHEN top IS NULL THEN lex_label ELSE {_COMBINED.format('lex_label')} END AS weak_label FROM m""")
def lab6(spark, d):
    df = _with_model(fixtures.documents(spark, d), "doc_id")
    return weak_label(df, "text", COMMON).select(
        "doc_id", "lex_label", sql.r6("lex_score").alias("lex_score"), "model_label", "weak_label")


@query("lab7_label_score", f"""WITH {sql.EVENTS}
SELECT hash, CASE WHEN k % 10 = 0 THEN 0.0 ELSE {sql.SCORE} END AS tone_score FROM ev""")
def lab7(spark, d):
    label = F.when(F.col("k") % 20 == 0, "Positive").when(F.col("k") % 10 != 0, F.col("weak_label"))
    df = fixtures.events_as_articles(spark, d).withColumn("weak_label", label)
    return prepare_articles(df).select("hash", "tone_score")


@query("lab8_prob_score", f"""WITH {sql.EVENTS}
SELECT hash, round_even(CASE WHEN k % 3 = 0 THEN -(1 - k / 100.0) WHEN k % 3 = 1 THEN k / 100.0
  ELSE k / 100.0 - (1 - k / 100.0) END, 6) + 0.0 AS score FROM ev""")
def lab8(spark, d):
    p = F.col("k") / 100.0
    entries = F.filter(F.array(
        F.struct(F.lit("positive").alias("key"), F.when(F.col("k") % 3 != 0, p).alias("value")),
        F.struct(F.lit("negative").alias("key"), F.when(F.col("k") % 3 != 1, 1 - p).alias("value"))),
        lambda e: e["value"].isNotNull())
    return fixtures.events_as_articles(spark, d).select(
        "hash", sql.r6(L.prob_score(F.map_from_entries(entries))).alias("score"))


_INDEX = "row_number() OVER (PARTITION BY ticker ORDER BY published_at DESC, hash) - 1"


@query("lab9_decay_weight", f"""WITH {sql.EVENTS}, i AS (SELECT hash, ticker, {_INDEX} AS index FROM ev)
SELECT hash, ticker, index, round_even(pow(0.5, index / 50.0), 6) + 0.0 AS weight FROM i""")
def lab9(spark, d):
    df = recency_index(articles.per_ticker(fixtures.events_as_articles(spark, d)))
    return df.select("hash", "ticker", "index", sql.r6(L.decay_weight(F.col("index"))).alias("weight"))


@query("lab9_decayed_tone", f"""WITH {sql.ORDERS}, i AS (
  SELECT ticker, pow(0.5, ({_INDEX}) / 50.0) AS w, {sql.SCORE} AS s FROM ev)
SELECT ticker, round_even(sum(w * s) / sum(w), 6) + 0.0 AS decayed_score, count(*) AS n FROM i GROUP BY 1""")
def lab9_tone(spark, d):
    df = articles.per_ticker(prepare_articles(fixtures.orders_as_articles(spark, d)))
    return decayed_tone(df).select("ticker", sql.r6("decayed_score").alias("decayed_score"), "n")


_NAMES = ("LABEL_0", "label_1", "LABEL_2", "Joy", "sadness", "Positive", "love", "ANGER", "fear")
_NAME_SQL = f"list_extract([{sql.quoted(_NAMES)}], k % {len(_NAMES)} + 1)"


def _names(spark, d):
    name = F.element_at(F.array(*[F.lit(n) for n in _NAMES]), F.col("k") % len(_NAMES) + 1)
    return fixtures.events_as_articles(spark, d).select("hash", name.alias("raw_label"))


@query("lab10_normalise_label", f"""WITH {sql.EVENTS}, n AS (SELECT hash, {_NAME_SQL} AS raw_label FROM ev)
SELECT hash, raw_label, CASE lower(raw_label) WHEN 'label_0' THEN 'negative' WHEN 'label_1' THEN 'neutral'
  WHEN 'label_2' THEN 'positive' WHEN 'joy' THEN 'positive' WHEN 'sadness' THEN 'negative'
  ELSE lower(raw_label) END AS label FROM n""")
def lab10(spark, d):
    return _names(spark, d).withColumn("label", L.normalise_label(F.col("raw_label")))


@query("lab11_emotion_tone", f"""WITH {sql.EVENTS}, n AS (SELECT hash, {_NAME_SQL} AS raw_label FROM ev)
SELECT hash, raw_label, CASE lower(raw_label) WHEN 'joy' THEN 'positive' WHEN 'sadness' THEN 'negative'
  WHEN 'anger' THEN 'neutral' WHEN 'fear' THEN 'neutral' WHEN 'surprise' THEN 'neutral'
  WHEN 'disgust' THEN 'neutral' ELSE lower(raw_label) END AS label FROM n""")
def lab11(spark, d):
    return _names(spark, d).withColumn("label", L.emotion_tone(F.col("raw_label")))


@query("lab12_decide", f"""WITH {sql.EVENTS}, l AS (
  SELECT hash, k / 20.0 AS a, value / 10.0 AS b, CAST(1.5 AS DOUBLE) AS c FROM ev), e AS (
  SELECT hash, exp(a - greatest(a, b, c)) AS x, exp(b - greatest(a, b, c)) AS y,
         exp(c - greatest(a, b, c)) AS z FROM l)
SELECT hash, CASE WHEN x >= y AND x >= z THEN 'negative' WHEN y >= z THEN 'neutral' ELSE 'positive' END AS label,
  round_even(greatest(x, y, z) / (x + y + z), 6) AS confidence, round_even(z / (x + y + z), 6) AS p_positive FROM e""")
def lab12(spark, d):
    logits = F.array(F.col("k") / 20.0, F.col("value") / 10.0, F.lit(1.5))
    best = fixtures.events_as_articles(spark, d).select("hash", L.decide(L.softmax(logits)).alias("x"))
    return best.select("hash", "x.label", F.bround("x.confidence", 6).alias("confidence"),
                       F.bround(F.col("x.probs")["positive"], 6).alias("p_positive"))


@query("lab13_label_ids", f"""WITH {sql.EVENTS}
SELECT hash, CASE weak_label WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 ELSE 2 END AS label_id,
  weak_label AS label FROM ev""")
def lab13(spark, d):
    number = L.label_to_id(F.col("weak_label"))
    return fixtures.events_as_articles(spark, d).select(
        "hash", number.alias("label_id"), L.id_to_label(number).alias("label"))


@query("lab14_correctness", f"""WITH {sql.WIDE}
SELECT row_id, b_prediction = true_label AS correct, round_even(b_confidence, 2) AS confidence FROM wide""")
def lab14(spark, d):
    return fixtures.wide_predictions(spark, d).select(
        "row_id", L.is_correct(F.col("b_prediction"), F.col("true_label")).alias("correct"),
        L.round_confidence(F.col("b_confidence"), 2).alias("confidence"))
