"""Readers and writers, each as a round trip over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from toneflow import fixtures
from toneflow.catalog import query, sql
from toneflow.operators import articles, daily
from toneflow.operators.evaluate import to_long
from toneflow.operators.language import learn_profile
from toneflow.plans.ingest import accept, with_fields, with_key, with_tickers
from toneflow.schemas import LABELLED_ARTICLE
from toneflow.session import scratch_path
from toneflow.sources import readers, writers

def profile(spark, d):
    """Language profile of all documents."""
    return learn_profile(fixtures.documents(spark, d))


def feed(spark, d):
    return readers.read_pages(spark, fixtures.write_feed(spark, d, scratch_path(spark, "feed")))


@query("src1_feed_pages", f"""WITH {sql.RAW}
SELECT request, page_no, row_number() OVER (PARTITION BY request, page_no ORDER BY doc_id) - 1 AS pos,
       source, title, description, published, length(content) AS n_content FROM raw""")
def src1(spark, d):
    return feed(spark, d).select(
        "request", "page_no", F.col("pos").cast("bigint").alias("pos"),
        F.col("raw.source.name").alias("source"), F.col("raw.title").alias("title"),
        F.col("raw.description").alias("description"),
        F.col("raw.publishedAt").alias("published"),
        F.length("raw.content").cast("bigint").alias("n_content"))


@query("src2_parquet_table", "SELECT doc_id, lang, source, n_chars FROM documents")
def src2(spark, d):
    return readers.read_table(spark, f"{d}/documents.parquet").select("doc_id", "lang", "source", "n_chars")


@query("src3_csv_table", f"""WITH {sql.EVENTS}
SELECT hash, epoch_us(published_at) AS published_us, ticker, weak_label FROM ev""")
def src3(spark, d):
    path = writers.write_table(fixtures.events_as_articles(spark, d), scratch_path(spark, "articles") + ".csv")
    df = readers.read_table(spark, path, LABELLED_ARTICLE)
    return df.select("hash", F.unix_micros("published_at").alias("published_us"),
                     F.col("tickers")[0].alias("ticker"), "weak_label")


@query("src4_list_literal", """SELECT event_id,
  CASE event_id % 5 WHEN 0 THEN 'U' || user_id WHEN 1 THEN 'U' || user_id || '|X''s' ELSE '' END AS tickers,
  CAST(CASE event_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS BIGINT) AS n FROM events""")
def src4(spark, d):
    user = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    kind = F.col("event_id") % 5
    literal = (
        F.when(kind == 0, F.concat(F.lit("['"), user, F.lit("']")))
        .when(kind == 1, F.concat(F.lit("['"), user, F.lit("', \"X's\"]")))
        .when(kind == 2, F.lit("[]")).when(kind == 3, F.lit("  ")).otherwise(F.lit("not a list"))
    )
    parsed = readers.parse_list(literal)
    return fixtures.table(spark, d, "events").select(
        "event_id", F.array_join(parsed, "|").alias("tickers"),
        F.size(parsed).cast("bigint").alias("n"))


@query("src5_many_files", """SELECT doc_id, lang, CASE WHEN lang = 'en' THEN NULL ELSE n_chars END AS n_chars
FROM documents""")
def src5(spark, d):
    doc = fixtures.table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    root = scratch_path(spark, "processed")
    writers.write_table(doc.where("lang = 'en'").drop("n_chars"), f"{root}/en")
    writers.write_table(doc.where("lang <> 'en'"), f"{root}/other")
    return readers.read_tables(spark, [f"{root}/en", f"{root}/other"]).select("doc_id", "lang", "n_chars")


@query("src5_csv_files", """SELECT doc_id, lang, CASE WHEN lang <> 'en' THEN source END AS source, CAST(n_chars AS BIGINT) AS n_chars
FROM documents""")
def src5_csv(spark, d):
    """CSV files whose headers differ in order and number, in one folder."""
    doc = fixtures.table(spark, d, "documents")
    root = scratch_path(spark, "files")
    writers.write_table(doc.where("lang = 'en'").select("n_chars", "doc_id", "lang"), f"{root}/en.csv")
    writers.write_table(doc.where("lang <> 'en'").select("lang", "source", "doc_id", "n_chars"), f"{root}/other.csv")
    schema = T.StructType().add("doc_id", "long").add("lang", "string").add("source", "string").add("n_chars", "long")
    return readers.read_tables(spark, f"{root}/*.csv", "csv", schema).select("doc_id", "lang", "source", "n_chars")


@query("src6_gold_labels", f"""WITH {sql.GOLD}
SELECT doc_id, text, label, 'FinancialPhraseBank' AS source, 'gold_standard' AS dataset_type
FROM documents JOIN gold USING (doc_id)""")
def src6(spark, d):
    return readers.standardise_gold(fixtures.gold(spark, d), fixtures.GOLD_COLUMNS) \
        .select("doc_id", "text", "label", "source", "dataset_type")


@query("src7_latest_snapshot", f"""WITH {sql.ORDERS}, dated AS (
  SELECT hash, ticker, CAST(year(published_at) AS INT) AS batch_date FROM ev)
SELECT hash, ticker, batch_date FROM dated
QUALIFY batch_date = max(batch_date) OVER (PARTITION BY ticker)""")
def src7(spark, d):
    dated = fixtures.orders_as_articles(spark, d).select(
        "hash", F.col("tickers")[0].alias("ticker"), F.year("published_at").alias("batch_date"))
    path = writers.write_table(dated.hint("rebalance", "ticker", "batch_date"),
                               scratch_path(spark, "snapshots"), "parquet", ("ticker", "batch_date"))
    return readers.latest_snapshot(spark.read.parquet(path)).select("hash", "ticker", "batch_date")


_SMALL = "concat_ws(' ', nullif(title, ''), nullif(description, ''))"

_ACCEPTED = f"""{sql.RAW}, {sql.profile()}, detected AS ({sql.detect("firsts", "request, hash", _SMALL)}),
  en AS (SELECT * FROM firsts JOIN detected USING (request, hash) WHERE published_at IS NOT NULL AND language = 'en')"""


@query("snk1_article_table", f"""WITH {_ACCEPTED}, days AS (
  SELECT request, strftime(published_at, '%Y%m%d') AS day, count(*) AS n FROM en GROUP BY 1, 2),
modal AS (SELECT request, day FROM days
  QUALIFY row_number() OVER (PARTITION BY request ORDER BY n DESC, day) = 1)
SELECT hash, lower(request) AS ticker, day AS batch_date, title FROM en JOIN modal USING (request)""")
def snk1(spark, d):
    raw = fixtures.raw_articles(spark, d).withColumnsRenamed({"article": "raw", "doc_id": "pos"})
    unique = articles.first_arrivals(with_key(raw), ["request", "hash"], ["page_no", "pos"])
    kept = with_tickers(with_fields(accept(unique, profile(spark, d)))).drop("page_no", "pos")
    path = scratch_path(spark, "articles")
    writers.write_articles(kept, path)
    return spark.read.schema("hash string, title string, ticker string, batch_date string") \
        .parquet(path).select("hash", "ticker", "batch_date", "title")


@query("snk2_modal_day", f"""WITH {sql.EVENTS}, days AS (
  SELECT ticker, CAST(published_at AS DATE) AS batch_date, count(*) AS n FROM ev GROUP BY 1, 2)
SELECT ticker, batch_date FROM days
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY n DESC, batch_date) = 1""")
def snk2(spark, d):
    return writers.modal_day(articles.per_ticker(fixtures.events_as_articles(spark, d)), ("ticker",))


@query("snk3_labelled_table", f"""WITH {sql.EVENTS}
SELECT hash, ticker, weak_label, {sql.SCORE} AS tone_score FROM ev""")
def snk3(spark, d):
    scored = daily.prepare_articles(fixtures.events_as_articles(spark, d))
    path = writers.write_table(scored, scratch_path(spark, "labelled") + ".parquet")
    return readers.read_table(spark, path).select(
        "hash", F.col("tickers")[0].alias("ticker"), "weak_label", "tone_score")


@query("snk4_report_tables", f"""WITH {sql.trend(7)}, alerts AS ({sql.alerts(2.0)})
SELECT 'daily' AS kind, date, ticker, NULL AS alert_type, round_even(rolling_z, 6) + 0.0 AS z_value FROM trend
UNION ALL SELECT 'alert', date, ticker, alert_type, z_value FROM alerts""")
def snk4(spark, d):
    per_day = daily.daily_ticker_aggregate(daily.prepare_articles(fixtures.events_as_articles(spark, d)))
    paths = writers.write_report(per_day, scratch_path(spark, "report"), 7, 2.0)
    z = sql.r6("z_value").alias("z_value")
    days = spark.read.parquet(paths["daily"]).withColumnRenamed("rolling_z", "z_value").select(
        F.lit("daily").alias("kind"), "date", "ticker", F.lit(None).cast("string").alias("alert_type"), z)
    alerts = spark.read.parquet(paths["alerts"]).select(
        F.lit("alert").alias("kind"), "date", "ticker", "alert_type", z)
    return days.unionByName(alerts)


@query("snk5_prediction_table", f"""WITH {sql.WIDE}
SELECT row_id, true_label, a_prediction, round_even(a_confidence, 6) + 0.0 AS a_confidence,
       a_prediction = true_label AS a_correct, round_even(a_confidence, 4) AS a_prob_positive,
       c_prediction, c_prediction = true_label AS c_correct, upper(c_prediction) AS c_raw_label
FROM wide""")
def snk5(spark, d):
    long = to_long(fixtures.wide_predictions(spark, d), fixtures.MODELS) \
        .withColumn("raw_label", F.upper("pred")) \
        .withColumn("probs", F.create_map(F.lit("positive"), F.col("confidence")))
    path = writers.write_predictions(long, scratch_path(spark, "predictions"), list(fixtures.MODELS),
                                     with_probs=("a",), with_raw=("c",))
    df = spark.read.options(**readers.CSV_READ).csv(path)
    return df.select(
        F.col("row_id").cast("bigint").alias("row_id"), "true_label", "a_prediction",
        sql.r6(F.col("a_confidence").cast("double")).alias("a_confidence"),
        F.col("a_correct").cast("boolean").alias("a_correct"),
        F.col("a_prob_positive").cast("double").alias("a_prob_positive"),
        "c_prediction", F.col("c_correct").cast("boolean").alias("c_correct"), "c_raw_label")
