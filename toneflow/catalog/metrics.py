"""Daily metrics, trends, alerts and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from toneflow import fixtures
from toneflow.catalog import query, sql
from toneflow.operators import articles, daily
from toneflow.operators.sampling import class_weights
from toneflow.plans.report import alert_report, daily_report

DAILY = ("mean_score", "pct_pos", "pct_neg", "tone_volatility")
TREND = (*DAILY, "rolling_mean", "rolling_z")


def per_day(spark, d, source=fixtures.events_as_articles):
    return daily.daily_ticker_aggregate(daily.prepare_articles(source(spark, d)))


def shown(df, columns):
    return df.select("date", "ticker", "article_count", *[sql.r6(c).alias(c) for c in columns])


@query("agg1_daily", f"WITH {sql.daily()} SELECT {sql.DAILY_COLUMNS} FROM daily")
def agg1(spark, d):
    return shown(per_day(spark, d), DAILY)


@query("agg1_daily_orders", f"WITH {sql.daily(sql.ORDERS)} SELECT {sql.DAILY_COLUMNS} FROM daily")
def agg1_orders(spark, d):
    return shown(per_day(spark, d, fixtures.orders_as_articles), DAILY)


@query("agg1_daily_one_ticker", f"WITH {sql.daily()} SELECT {sql.DAILY_COLUMNS} FROM daily WHERE ticker = 'U7'")
def agg1_one(spark, d):
    df = daily.prepare_articles(fixtures.events_as_articles(spark, d))
    return shown(daily.daily_ticker_aggregate(df, "U7"), DAILY)


@query("agg2_period_summary", f"""WITH {sql.daily()}, s AS (
  SELECT ticker, CAST(sum(article_count) AS BIGINT) AS total_articles, count(*) AS n_days,
         min(date) AS first_date, max(date) AS last_date, avg(mean_score) AS m FROM daily GROUP BY 1)
SELECT ticker, total_articles, n_days, first_date, last_date, round_even(m, 6) + 0.0 AS avg_tone,
       {sql.label_of('m')} AS verdict FROM s""")
def agg2(spark, d):
    return daily.period_summary(per_day(spark, d)) \
        .withColumn("avg_tone", sql.r6("avg_tone"))


@query("agg3_label_distribution", f"""WITH {sql.EVENTS}, domain(label) AS (VALUES ('negative'), ('neutral'), ('positive')),
used AS (SELECT CASE WHEN weak_label = 'neutral' THEN 'mixed' ELSE weak_label END AS l FROM ev)
SELECT label, (SELECT count(*) FROM used WHERE l = label) AS n,
  round_even((SELECT count(*) FROM used WHERE l = label) * 100.0 / (SELECT count(*) FROM used), 6) + 0.0 AS pct FROM domain""")
def agg3(spark, d):
    label = F.when(F.col("weak_label") == "neutral", "mixed").otherwise(F.col("weak_label"))
    df = fixtures.events_as_articles(spark, d).withColumn("weak_label", label)
    return daily.label_distribution(df).withColumn("pct", sql.r6("pct"))


@query("agg4_value_shares", f"""WITH {sql.GOLD}
SELECT label, count(*) AS n, round_even(count(*) * 100.0 / sum(count(*)) OVER (), 6) + 0.0 AS pct
FROM gold GROUP BY 1""")
def agg4(spark, d):
    return daily.value_shares(fixtures.gold_labels(spark, d)).withColumn("pct", sql.r6("pct"))


@query("agg5_class_weights", f"""WITH {sql.GOLD}
SELECT label, count(*) AS n, round_even(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) + 0.0 AS weight
FROM gold GROUP BY 1""")
def agg5(spark, d):
    return class_weights(fixtures.gold_labels(spark, d)).withColumn("weight", sql.r6("weight"))


@query("win1_rolling_mean", f"""WITH {sql.trend(7)}
SELECT date, ticker, round_even(rolling_mean, 6) + 0.0 AS rolling_mean FROM trend""")
def win1(spark, d):
    return daily.rolling_trend(per_day(spark, d), 7) \
        .select("date", "ticker", sql.r6("rolling_mean").alias("rolling_mean"))


@query("win2_rolling_z", f"""WITH {sql.trend(7)}
SELECT date, ticker, round_even(rolling_z, 6) + 0.0 AS rolling_z FROM trend""")
def win2(spark, d):
    return daily.rolling_trend(per_day(spark, d), 7) \
        .select("date", "ticker", sql.r6("rolling_z").alias("rolling_z"))


@query("win2_rolling_z_orders", f"""WITH {sql.trend(30, sql.ORDERS)}
SELECT date, ticker, round_even(rolling_z, 6) + 0.0 AS rolling_z FROM trend""")
def win2_orders(spark, d):
    return daily.rolling_trend(per_day(spark, d, fixtures.orders_as_articles), 30) \
        .select("date", "ticker", sql.r6("rolling_z").alias("rolling_z"))


@query("win3_alerts", f"WITH {sql.trend(7)} {sql.alerts(2.0)}")
def win3(spark, d):
    return alert_report(fixtures.events_as_articles(spark, d), 7, 2.0) \
        .withColumn("z_value", sql.r6("z_value"))


@query("win3_alerts_wide", f"WITH {sql.trend(10)} {sql.alerts(2.5)}")
def win3_wide(spark, d):
    return alert_report(fixtures.events_as_articles(spark, d), 10, 2.5) \
        .withColumn("z_value", sql.r6("z_value"))


@query("win4_recency_rank", f"""WITH {sql.ORDERS}
SELECT hash, ticker, row_number() OVER (PARTITION BY ticker ORDER BY published_at DESC, hash) - 1 AS index
FROM ev""")
def win4(spark, d):
    return daily.recency_index(articles.per_ticker(fixtures.orders_as_articles(spark, d))) \
        .select("hash", "ticker", "index")


@query("win5_report", f"WITH {sql.trend(7)} SELECT {sql.TREND_COLUMNS} FROM trend")
def win5(spark, d):
    return shown(daily_report(fixtures.events_as_articles(spark, d), 7), TREND)


@query("win5_report_orders", f"WITH {sql.trend(7, sql.ORDERS)} SELECT {sql.TREND_COLUMNS} FROM trend")
def win5_orders(spark, d):
    return shown(daily_report(fixtures.orders_as_articles(spark, d), 7), TREND)


@query("srt1_sorted_daily", f"WITH {sql.daily()} SELECT {sql.DAILY_COLUMNS} FROM daily ORDER BY ticker, date")
def srt1(spark, d):
    return shown(per_day(spark, d), DAILY).orderBy("ticker", "date")
