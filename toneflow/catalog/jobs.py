"""Whole jobs: ingestion, labelling, training and the streaming forms."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from toneflow import fixtures
from toneflow.catalog import query, sql
from toneflow.catalog.labels import COMMON
from toneflow.catalog.metrics import TREND, shown
from toneflow.catalog.samples import _RANKED
from toneflow.catalog.sources import _ACCEPTED, _SMALL, feed, profile
from toneflow.operators import model as M
from toneflow.operators.evaluate import counts
from toneflow.plans.evaluation import compare_models
from toneflow.plans.ingest import ingest, ingest_request
from toneflow.plans.labelling import build_dataset, label_once
from toneflow.plans.report import build_reports, daily_report
from toneflow.plans.training import fine_tune, split
from toneflow.schemas import LABELS, RAW_PAGE, Request
from toneflow.session import scratch_path, use_utc
from toneflow.sources import readers, writers
from toneflow.streaming import daily as live_daily
from toneflow.streaming import ingest as live_ingest

_CLEANED = sql.clean("concat_ws(' ', nullif(title, ''), nullif(description, ''), nullif(content, ''))")
_TAGGED = f"CASE WHEN contains(lower({_CLEANED}), lower(request)) THEN request ELSE '' END"


def article_rows(df):
    return df.select("request", "hash", "source", "title", "description", F.length("content").cast("bigint").alias("n"),
                     F.unix_micros("published_at").alias("published_us"), "url", "language",
                     F.array_join("tickers", "|").alias("tickers"))


_ARTICLE_COLUMNS = f"""request, hash, source, title, description, length(content) AS n,
  epoch_us(published_at) AS published_us, url, language, {_TAGGED} AS tickers"""


@query("ingest_articles", f"""WITH {_ACCEPTED}
SELECT {_ARTICLE_COLUMNS} FROM en""")
def ingest_articles(spark, d):
    return article_rows(ingest(feed(spark, d), profile(spark, d)))


@query("ingest_limited", f"""WITH {_ACCEPTED}
SELECT {_ARTICLE_COLUMNS} FROM en
QUALIFY row_number() OVER (PARTITION BY request ORDER BY doc_id) <= 60""")
def ingest_limited(spark, d):
    """The limit per request as a feature of its own."""
    return article_rows(ingest(feed(spark, d), profile(spark, d), max_articles=60))


_TERMS = ["the", "der", "R1"]
_MENTIONED = " OR ".join(
    f"contains(lower(coalesce({c}, '')), '{t.strip().lower()}')" for t in _TERMS for c in ("title", "description", "content"))


@query("ingest_request", f"""WITH {sql.RAW}, {sql.profile()}, asked AS (
  SELECT * FROM keyed WHERE request = 'R1' AND ({_MENTIONED})
    AND (published_at IS NULL OR published_at BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00')
  QUALIFY row_number() OVER (PARTITION BY request, hash ORDER BY doc_id) = 1),
  detected AS ({sql.detect("asked", "request, hash", _SMALL)}),
  en AS (SELECT * FROM asked JOIN detected USING (request, hash) WHERE published_at IS NOT NULL AND language = 'en'), days AS (
  SELECT strftime(published_at, '%Y%m%d') AS day, count(*) AS n FROM en GROUP BY 1), modal AS (
  SELECT day FROM days ORDER BY n DESC, day LIMIT 1)
SELECT hash, lower(request) AS ticker, day AS batch_date, title FROM en, modal""")
def ingest_one_request(spark, d):
    """Pages to stored articles of one request: time window, terms, dedup, filters, tags, modal day."""
    request = Request(company=_TERMS[0], ticker="R1", keywords=_TERMS[1:], from_date=datetime(2024, 1, 5),
                      to_date=datetime(2024, 1, 20, 12), max_articles=1_000_000)
    path = scratch_path(spark, "request")
    writers.write_articles(ingest_request(feed(spark, d), request, profile(spark, d)), path)
    return spark.read.schema("hash string, title string, ticker string, batch_date string") \
        .parquet(path).select("hash", "ticker", "batch_date", "title")


_LABEL_TEXT = (f"regexp_replace(coalesce(title, '') || '. ' || coalesce(description, ''), "
               f"'\\A{sql.SPACE}|{sql.SPACE}\\z', '', 'g')")
_LEX = sql.lexicon_score(_LABEL_TEXT, COMMON.positive, COMMON.negative)


def labelled(spark, d):
    raw = fixtures.raw_articles(spark, d).select(
        F.col("doc_id"), "request", F.col("article.title").alias("title"),
        F.col("article.description").alias("description"),
        F.try_to_timestamp("article.publishedAt").alias("published_at"))
    return build_dataset(raw.withColumn("tickers", F.array("request")), COMMON)


@query("build_labelled_dataset", f"""WITH {sql.RAW}
SELECT doc_id, {sql.label_of(_LEX)} AS weak_label, round_even({_LEX}, 6) + 0.0 AS lex_score FROM raw""")
def build_labelled(spark, d):
    return labelled(spark, d).select("doc_id", "weak_label", sql.r6("lex_score").alias("lex_score"))


@query("label_and_report", f"""WITH {sql.RAW}, ev AS (
  SELECT request AS ticker, published_at, {sql.label_of(_LEX)} AS weak_label FROM keyed
  WHERE published_at IS NOT NULL), {sql.trend(7, 'unused AS (SELECT 1)').replace('unused AS (SELECT 1), ', '')}
SELECT {sql.TREND_COLUMNS} FROM trend""")
def label_and_report(spark, d):
    return shown(daily_report(labelled(spark, d), 7), TREND)


_BACKFILLED = f"""{sql.EVENTS.replace('ev AS', 'tagged AS')}, ev AS (
  SELECT hash, published_at, 'U5' AS ticker, weak_label FROM tagged WHERE ticker = 'U5' OR k % 4 = 0)"""


@query("report_job", f"""WITH {sql.trend(7, _BACKFILLED)}, alerts AS ({sql.alerts(2.0)})
SELECT 'daily' AS kind, date, ticker, article_count, round_even(rolling_z, 6) + 0.0 AS z_value FROM trend
UNION ALL SELECT 'alert', date, ticker, NULL, z_value FROM alerts""")
def report_job(spark, d):
    """The stored report of one ticker, untagged articles counted as its own."""
    articles = fixtures.events_as_articles(spark, d)
    tickers = F.when(F.col("k") % 4 == 0, F.array().cast("array<string>")).otherwise(F.col("tickers"))
    path = writers.write_table(articles.select("hash", "published_at", tickers.alias("tickers"), "weak_label"),
                               scratch_path(use_utc(spark), "labelled") + ".parquet")
    paths = build_reports(spark, path, scratch_path(spark, "reports"), ticker="U5", z_threshold=2.0, backfill=True)
    days = spark.read.parquet(paths["daily"]).select(
        F.lit("daily").alias("kind"), "date", "ticker", "article_count", sql.r6("rolling_z").alias("z_value"))
    return days.unionByName(spark.read.parquet(paths["alerts"]).select(
        F.lit("alert").alias("kind"), "date", "ticker", F.lit(None).cast("bigint").alias("article_count"), sql.r6("z_value").alias("z_value")))


@query("jn1_label_once", f"""WITH {sql.EVENTS}
SELECT hash, weak_label, value FROM ev""")
def jn1_once(spark, d):
    """Labels from a table that repeats articles; articles that arrive twice."""
    ev = fixtures.events_as_articles(spark, d).withColumn("url", F.lit("u"))
    repeated = ev.select("hash", "weak_label").union(ev.where("k % 3 = 0").select("hash", "weak_label"))
    twice = ev.drop("weak_label").union(ev.where("k % 5 = 0").drop("weak_label"))
    return label_once(twice, repeated).select("hash", "weak_label", "value")


def gold_rows(spark, d):
    return readers.standardise_gold(fixtures.gold(spark, d), fixtures.GOLD_COLUMNS).select("doc_id", "text", "label")


def split_rows(spark, d):
    return split(gold_rows(spark, d), "doc_id")


def sound(scored):
    """A known label with the highest probability, and probabilities that sum to 1."""
    total = F.aggregate(F.map_values("probs"), F.lit(0.0).cast("double"), lambda a, x: a + x)
    return (F.col("pred").isin(*LABELS) & (F.abs(total - 1) < 1e-9) & (F.element_at("probs", F.col("pred")) == F.col("confidence"))
            & (F.col("confidence") == F.array_max(F.map_values("probs")))).alias("sound")


@query("ml1_train_classifier", f"""WITH {_RANKED}
SELECT doc_id, label, TRUE AS sound FROM ranked WHERE rn <= tail""")
def ml1(spark, d):
    train, val = split_rows(spark, d)
    scored = M.predict(M.train(train, max_iter=10), val)
    return scored.select("doc_id", "label", sound(scored))


@query("ml2_select_variant", f"""WITH {_RANKED}, held AS (SELECT count(*) AS n_held_out FROM ranked WHERE rn <= tail)
SELECT v.*, n_held_out, TRUE AS share_of_rows, TRUE AS best_by_loss, TRUE AS best_by_accuracy
FROM (VALUES ('original', 0.01::DOUBLE), ('improved', 0.05::DOUBLE), ('aggressive', 0.3::DOUBLE)) AS v(variant, reg_param), held""")
def ml2(spark, d):
    """Losses and accuracies of all variants against those that predictions on the held-out rows give anew."""
    train, val = split_rows(spark, d)
    rows, held = [], val.count()
    kept = M.select_variant(train, val, max_iter=10)
    best, tried = kept.variant, kept.tried
    hits = M.predict(kept.model, val).where("pred = label").count()
    for name, reg, loss, accuracy in tried:
        # An accuracy is a whole number of held-out rows; that of the kept model is counted again.
        whole = abs(accuracy * held - round(accuracy * held)) < 1e-6 and (name != best or round(accuracy * held) == hits)
        rows.append((name, reg, held, whole, tried[[t[0] for t in tried].index(best)][2] <= loss,
                     next(t[3] for t in tried if t[0] == M.best_variant(tried, "accuracy")) >= accuracy))
    return spark.createDataFrame(rows, "variant string, reg_param double, n_held_out long, share_of_rows boolean, "
                                       "best_by_loss boolean, best_by_accuracy boolean")


def keyword_scorer():
    """Factory of a stand-in model that weighs one frequent word against another."""
    class Keywords:
        def predict(self, texts):
            out = []
            for t in texts:
                up, down = t.count(" the "), t.count(" of ")
                p = (1 + up) / (2 + up + down)
                out.append({"label": "positive" if p >= 0.5 else "negative",
                            "probs": {"positive": p, "negative": 1 - p}})
            return out

    return Keywords


_UP, _DOWN = ("((length(text) - length(replace(text, '" + w + "', ''))) / " + str(len(w)) + ")" for w in (" the ", " of "))


@query("ml3_plugin_scoring", f"""SELECT doc_id,
  CASE WHEN (1 + {_UP}) / (2 + {_UP} + {_DOWN}) >= 0.5 THEN 'positive' ELSE 'negative' END AS model_label,
  round_even(greatest((1 + {_UP}) / (2 + {_UP} + {_DOWN}), 1 - (1 + {_UP}) / (2 + {_UP} + {_DOWN})), 6) + 0.0 AS confidence
FROM documents""")
def ml3(spark, d):
    scored = M.score_texts(fixtures.documents(spark, d), "text", keyword_scorer())
    return scored.select("doc_id", "model_label", sql.r6("model_confidence").alias("confidence"))


@query("ml3_missing_model", "SELECT doc_id, 'N/A' AS model_label, 0.0::DOUBLE AS confidence FROM documents")
def ml3_missing(spark, d):
    scored = M.score_texts(fixtures.documents(spark, d), "text", lambda: None)
    return scored.select("doc_id", "model_label", F.col("model_confidence").alias("confidence"))


@query("ml3_model_scoring", "SELECT doc_id, TRUE AS sound FROM documents")
def ml3_model(spark, d):
    train, _ = split_rows(spark, d)
    scored = M.predict(M.train(train, max_iter=10), fixtures.documents(spark, d))
    return scored.select("doc_id", sound(scored))


@query("ml4_evaluate_saved", f"""WITH {_RANKED}, val AS (SELECT label FROM ranked WHERE rn <= tail)
SELECT label, count(*) AS support, TRUE AS in_range FROM val GROUP BY label
UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), (SELECT count(*) FROM val), TRUE""")
def ml4(spark, d):
    train, val = split_rows(spark, d)
    path = scratch_path(spark, "model")
    M.train(train, max_iter=10).write().overwrite().save(path)
    scores = [F.col(c).between(0, 1) for c in ("precision", "recall", "f1")]
    return M.evaluate(path, val).select("label", "support", (scores[0] & scores[1] & scores[2]).alias("in_range"))


@query("ml5_training_history", f"""WITH {_RANKED}, held AS (SELECT count(*) AS n_held_out, count(DISTINCT label) AS classes
  FROM ranked WHERE rn <= tail), seen AS (SELECT count(*) AS n_rows FROM ranked)
SELECT unnest(range(0, 6))::INT AS iteration, n_rows, n_held_out, round_even(ln(classes), 6) + 0.0 AS start_loss,
  round_even(ln(classes), 6) + 0.0 AS start_eval_loss, TRUE AS not_rising, TRUE AS below_start, TRUE AS share_of_rows
FROM held, seen""")
def ml5(spark, d):
    """A run's history: balanced classes start at the logarithm of their number, and from there losses only fall."""
    gold = gold_rows(spark, d)
    run = fine_tune(gold, "doc_id", variants={"improved": 0.05}, max_iter=5)
    history = M.complete_rows(spark.createDataFrame(run.history, M.HISTORY))
    held = split(gold, "doc_id")[1].count()
    before = F.lag("loss").over(Window.orderBy("iteration"))  # one row per iteration
    start, start_eval = run.history[0][1:3]
    hits = F.col("eval_accuracy") * held
    return history.select(
        "iteration", F.lit(gold.count()).cast("bigint").alias("n_rows"), F.lit(held).cast("bigint").alias("n_held_out"),
        sql.r6(F.lit(start)).alias("start_loss"), sql.r6(F.lit(start_eval)).alias("start_eval_loss"),
        (F.coalesce(before, F.lit(1e9)) >= F.col("loss")).alias("not_rising"),
        ((F.col("iteration") == 0) | (F.col("loss") < start)).alias("below_start"),
        (F.abs(hits - F.round(hits)) < 1e-6).alias("share_of_rows"))


def counter_model(up, down):
    """Factory of a stand-in model that compares how often two words occur."""
    class Counter:
        def predict(self, texts):
            return [{"label": "LABEL_2" if t.count(up) >= t.count(down) else "LABEL_0",
                     "probs": {"positive": 0.75, "negative": 0.25}} for t in texts]

    return Counter


def _occurs(word: str) -> str:
    return f"(length(text) - length(replace(text, '{word}', ''))) / {len(word)}"


def _counted(model: str, up: str, down: str) -> str:
    return (f"SELECT doc_id, label, '{model}' AS model, CASE WHEN {_occurs(up)} >= {_occurs(down)} "
            "THEN 'positive' ELSE 'negative' END AS pred FROM documents JOIN gold USING (doc_id)")


@query("compare_models", f"""WITH {sql.GOLD}, p AS (
  {_counted('x', ' the ', ' of ')} UNION ALL {_counted('y', ' to ', ' and ')}
  UNION ALL SELECT doc_id, label, 'absent', 'N/A' FROM gold)
SELECT model, label AS true_label, pred, count(*) AS n FROM p GROUP BY ALL""")
def compare_three(spark, d):
    scorers = {"x": counter_model(" the ", " of "), "y": counter_model(" to ", " and "), "absent": lambda: None}
    compared = compare_models(gold_rows(spark, d), scorers, "doc_id")
    return counts(compared.predictions)


def polled(spark, d):
    """The feed ingested in three overlapping polls; returns the folder of the tables."""
    pages = spark.read.schema(RAW_PAGE).json(fixtures.write_feed(spark, d, scratch_path(spark, "feed")))
    landed, out, checkpoint = (scratch_path(spark, n) for n in ("landed", "live", "checkpoint"))
    known = profile(spark, d)
    for upto, since in ((1, 0), (4, 1), (1 << 30, 2)):
        pages.where(F.col("page_no").between(since, upto)).write.mode("append").json(landed, compression="gzip")
        live_ingest.ingest_stream(live_ingest.page_stream(spark, landed), out, checkpoint, known).awaitTermination()
    return out


@query("stm1_stream_ingest", f"""WITH {_ACCEPTED}
SELECT {_ARTICLE_COLUMNS} FROM en""")
def stm1(spark, d):
    """Polls give what one batch ingestion gives."""
    return article_rows(live_ingest.stored_articles(spark, polled(spark, d)))


@query("stm2_stream_dedup", f"""WITH {sql.RAW}
SELECT DISTINCT request, hash FROM keyed""")
def stm2(spark, d):
    return live_ingest.stored_keys(spark, polled(spark, d))


@query("stm3_stream_daily", f"""WITH {sql.trend(7)}
SELECT 'daily' AS kind, date, ticker, article_count, {sql.rounded(('mean_score', 'tone_volatility', 'rolling_z'))}
FROM trend UNION ALL
SELECT 'alert', date, ticker, NULL, NULL, NULL, round_even(rolling_z, 6) + 0.0 FROM trend WHERE abs(rolling_z) >= 2.0""")
def stm3(spark, d):
    landed, out = scratch_path(use_utc(spark), "labelled"), scratch_path(spark, "live")
    checkpoint = scratch_path(spark, "checkpoint")
    articles = fixtures.events_as_articles(spark, d).select("hash", "published_at", "tickers", "weak_label")
    # All rows arrive in three landings, so every day is touched more than once.
    for part in articles.randomSplit([1.0, 1.0, 1.0], seed=7):
        writers.write_table(part, landed, mode="append")
        stream = spark.readStream.schema(articles.schema).parquet(landed)
        live_daily.maintain_daily(stream, out, checkpoint).awaitTermination()
    days = live_daily.current_daily(spark, out).select(
        F.lit("daily").alias("kind"), "date", "ticker", "article_count",
        *[sql.r6(c).alias(c) for c in ("mean_score", "tone_volatility", "rolling_z")])
    alerts = live_daily.current_alerts(spark, out, 2.0).select(
        F.lit("alert").alias("kind"), "date", "ticker", F.lit(None).cast("bigint").alias("article_count"),
        F.lit(None).cast("double").alias("mean_score"),
        F.lit(None).cast("double").alias("tone_volatility"), sql.r6("z_value").alias("rolling_z"))
    return days.unionByName(alerts)
