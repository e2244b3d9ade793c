"""Predicates, projections, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from toneflow import fixtures
from toneflow.catalog import query, sql
from toneflow.functions import dates
from toneflow.functions import labels as L
from toneflow.functions import text as X
from toneflow.operators import articles, daily
from toneflow.plans.ingest import stamp, with_fields, with_key, with_time
from toneflow.plans.labelling import label_missing

TERMS = X.query_terms("the", "et la", [" und ", " ", "the"])


def raw_fields(spark, d):
    """Feed payloads with article fields; the document number is the arrival position."""
    raw = fixtures.raw_articles(spark, d).withColumnsRenamed({"article": "raw", "doc_id": "pos"})
    return with_fields(with_key(raw))


_BODY = "lower(concat_ws(' ', nullif(title, ''), nullif(description, ''), nullif(content, '')))"


@query("prd1_keyword_match", f"""WITH {sql.RAW}
SELECT doc_id FROM raw WHERE contains({_BODY}, 'the') OR contains({_BODY}, 'et la') OR contains({_BODY}, 'und')""")
def prd1(spark, d):
    return articles.matching_query(raw_fields(spark, d), TERMS).select(F.col("pos").alias("doc_id"))


@query("prd1_watchlist_match", f"""WITH {sql.RAW}, watch(request, a, b) AS (
  VALUES ('R0', 'the', 'der'), ('R1', 'qui', 'que'), ('R2', 'R2', 'los'))
SELECT doc_id, request FROM raw JOIN watch USING (request)
WHERE contains({_BODY}, lower(a)) OR contains({_BODY}, lower(b)) OR contains({_BODY}, lower(request))""")
def prd1_watchlist(spark, d):
    watchlist = spark.createDataFrame(
        [("the", "R0", [" der "]), ("qui", "R1", ["que", ""]), ("R2", "R2", ["los"])],
        "company string, ticker string, keywords array<string>")
    return articles.matching_watchlist(raw_fields(spark, d), watchlist) \
        .select(F.col("pos").alias("doc_id"), "request")


@query("prd2_lookback", f"""WITH {sql.EVENTS} SELECT hash, ticker FROM ev
WHERE published_at BETWEEN TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY AND TIMESTAMP '2024-01-31 00:00:00'""")
def prd2(spark, d):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return articles.in_lookback(fixtures.events_as_articles(spark, d), now, 7) \
        .select("hash", F.col("tickers")[0].alias("ticker"))


@query("prd3_dated_rows", f"""WITH {sql.EVENTS}
SELECT CAST(published_at AS DATE) AS date, count(*) AS n FROM ev WHERE k % 10 <> 0 GROUP BY 1""")
def prd3(spark, d):
    df = fixtures.events_as_articles(spark, d).withColumn(
        "published_at", F.when(F.col("k") % 10 != 0, F.col("published_at")))
    return articles.with_publish_date(df).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query("prd4_language", "SELECT doc_id, source FROM documents WHERE lang = 'en'")
def prd4(spark, d):
    df = fixtures.table(spark, d, "documents").withColumnRenamed("lang", "language")
    return articles.in_language(df, "en").select("doc_id", "source")


@query("prd5_parsed_time", f"""WITH {sql.RAW}
SELECT doc_id, epoch_us(published_at) AS published_us FROM keyed WHERE published_at IS NOT NULL""")
def prd5(spark, d):
    return with_time(raw_fields(spark, d)).select(
        F.col("pos").alias("doc_id"), F.unix_micros("published_at").alias("published_us"))


@query("prd6_ticker_member", f"WITH {sql.EVENTS} SELECT hash, weak_label FROM ev WHERE ticker = 'U1'")
def prd6(spark, d):
    return articles.about(fixtures.events_as_articles(spark, d), "U1").select("hash", "weak_label")


@query("prd6_per_ticker", f"WITH {sql.EVENTS} SELECT ticker, count(*) AS n FROM ev GROUP BY 1")
def prd6_all(spark, d):
    df = fixtures.events_as_articles(spark, d)
    doubled = df.withColumn("tickers", F.concat("tickers", "tickers", F.array(F.lit(None).cast("string"))))
    return articles.per_ticker(doubled).groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))


@query("prd7_alert_predicate", f"""WITH {sql.trend(5)}
SELECT date, ticker, round_even(rolling_z, 6) + 0.0 AS z FROM trend WHERE abs(rolling_z) >= 1.5""")
def prd7(spark, d):
    per_day = daily.daily_ticker_aggregate(daily.prepare_articles(fixtures.events_as_articles(spark, d)))
    return daily.detect_alerts(daily.rolling_trend(per_day, 5), 1.5) \
        .select("date", "ticker", sql.r6("z_value").alias("z"))


@query("prd8_required_columns", f"WITH {sql.EVENTS} SELECT count(*) AS n FROM ev")
def prd8(spark, d):
    df = articles.require_columns(fixtures.events_as_articles(spark, d), {"published_at", "weak_label"})
    return df.agg(F.count(F.lit(1)).alias("n"))


_FRESH = "trim(concat_ws(' ', title, coalesce(description, '')))"
_P, _N = L.FINANCE.positive, L.FINANCE.negative


@query("prd9_label_missing", f"""WITH {sql.RAW}
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'positive' ELSE
  {sql.label_of(sql.lexicon_score(_FRESH, _P, _N))} END AS weak_label FROM raw""")
def prd9(spark, d):
    df = raw_fields(spark, d).withColumn("weak_label", F.when(F.col("pos") % 4 == 0, "positive"))
    return label_missing(df).select(F.col("pos").alias("doc_id"), "weak_label")


@query("prd10_backfill_tickers", f"""WITH {sql.EVENTS}
SELECT hash, CASE WHEN k % 3 = 0 THEN ticker ELSE 'ACME' END AS ticker FROM ev""")
def prd10(spark, d):
    tickers = F.when(F.col("k") % 3 == 0, F.col("tickers")) \
        .when(F.col("k") % 3 == 1, F.array().cast("array<string>"))
    df = fixtures.events_as_articles(spark, d).withColumn("tickers", tickers)
    return articles.backfill_tickers(df, "acme").select("hash", F.col("tickers")[0].alias("ticker"))


@query("prd11_preview", f"""WITH {sql.RAW}
SELECT title, source, epoch_us(published_at) AS published_us FROM keyed WHERE published_at IS NOT NULL
ORDER BY published_at, hash, doc_id LIMIT 5""")
def prd11(spark, d):
    df = with_time(raw_fields(spark, d))
    return articles.preview(df, ("published_at", "hash", "pos")) \
        .select("title", "source", F.unix_micros("published_at").alias("published_us"))


@query("prd12_display", f"""WITH {sql.daily()}
SELECT date AS "Date", ticker AS "Ticker", round_even(mean_score * 1000, 0) / 1000 + 0.0 AS "Tone",
  article_count AS "Articles", round_even(pct_pos * 100 * 10, 0) / 10 AS "Positive%",
  round_even(pct_neg * 100 * 10, 0) / 10 AS "Negative%" FROM daily""")
def prd12(spark, d):
    per_day = daily.daily_ticker_aggregate(daily.prepare_articles(fixtures.events_as_articles(spark, d)))
    return daily.display(per_day).withColumn("Tone", F.col("Tone") + F.lit(0.0))


@query("jn1_attach_labels", f"""WITH {sql.EVENTS}
SELECT hash, CASE WHEN k % 2 = 0 THEN weak_label END AS weak_label FROM ev""")
def jn1(spark, d):
    df = fixtures.events_as_articles(spark, d)
    labels = df.where("k % 2 = 0").select("hash", "weak_label")
    return articles.attach_labels(df.select("hash"), labels.unionAll(labels)).select("hash", "weak_label")


@query("jn2_first_arrivals", f"WITH {sql.RAW} SELECT request, hash, doc_id FROM firsts")
def jn2(spark, d):
    return articles.first_arrivals(raw_fields(spark, d), ["request", "hash"], ["page_no", "pos"]) \
        .select("request", "hash", F.col("pos").alias("doc_id"))


@query("st1_stack", """SELECT doc_id, CASE WHEN lang = 'en' THEN lang END AS lang,
  CASE WHEN lang <> 'en' THEN n_chars END AS n_chars FROM documents""")
def st1(spark, d):
    doc = fixtures.table(spark, d, "documents")
    return articles.stack([doc.where("lang = 'en'").select("doc_id", "lang"),
                           doc.where("lang <> 'en'").select("n_chars", "doc_id")]) \
        .select("doc_id", "lang", "n_chars")


@query("dt1_parse_iso", """SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN epoch_us(date_trunc('second', ts)) END
  AS us FROM events""")
def dt1(spark, d):
    text = F.when(F.col("event_id") % 9 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("soon")
    return fixtures.table(spark, d, "events") \
        .select("event_id", F.unix_micros(dates.parse_iso(text)).alias("us"))


@query("dt2_publish_day", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def dt2(spark, d):
    return fixtures.table(spark, d, "events").select("event_id", dates.day(F.col("ts")).alias("day"))


@query("dt3_day_stamp", "SELECT event_id, strftime(ts, '%Y%m%d') AS stamp FROM events")
def dt3(spark, d):
    return fixtures.table(spark, d, "events") \
        .select("event_id", dates.day_stamp(dates.day(F.col("ts"))).alias("stamp"))


@query("dt4_day_prefix", f"WITH {sql.RAW} SELECT doc_id, substr(published, 1, 10) AS day FROM raw")
def dt4(spark, d):
    return raw_fields(spark, d).select(
        F.col("pos").alias("doc_id"), dates.day_prefix(stamp()).alias("day"))
