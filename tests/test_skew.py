"""A hot key must not gather a table in one task."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from toneflow.operators import articles, daily, sampling

N = 4000


@pytest.fixture(scope="module")
def hot(spark):
    """One ticker and one label hold everything; thirty days."""
    start = F.lit(datetime(2024, 1, 1)).cast("timestamp")
    return spark.range(N, numPartitions=4).select(
        F.sha2(F.col("id").cast("string"), 256).alias("hash"),
        F.timestamp_seconds(F.unix_seconds(start) + F.col("id") * 648).alias("published_at"),
        F.lit("HOT").alias("ticker"), F.lit("neutral").alias("label"),
        F.lit("HOT").alias("request"), F.col("id").alias("page_no"), F.lit(0).alias("pos"))


def largest_share(df):
    rows = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return max(r["count"] for r in rows) / sum(r["count"] for r in rows)


@pytest.fixture
def fixed_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_positions_spread_over_days(hot, fixed_partitions):
    indexed = daily.recency_index(hot)
    assert largest_share(indexed) < 0.5
    assert [r["index"] for r in indexed.orderBy(F.desc("published_at")).collect()] == list(range(N))


def test_bulk_load_under_one_timestamp_is_divided(hot, fixed_partitions):
    bulk = hot.withColumn("published_at", F.lit(datetime(2024, 1, 1)))
    indexed = daily.recency_index(bulk, cell_limit=100)
    assert largest_share(indexed) < 0.5
    assert [r["index"] for r in indexed.orderBy("hash").collect()] == list(range(N))


def test_distinct_times_of_one_day_are_divided(hot, fixed_partitions):
    """One ticker, one day, no two times alike: neither rows nor a side table gather in one task."""
    busy = hot.withColumn("published_at", F.timestamp_micros(F.lit(1704067200000000) + F.col("page_no") * 21_000_123))
    indexed = daily.recency_index(busy, cell_limit=100)
    assert largest_share(indexed) < 0.5
    assert [r["index"] for r in indexed.orderBy(F.desc("published_at")).collect()] == list(range(N))
    parts = sampling.time_split(busy, "hash")
    newest = [r.split for r in parts.orderBy(F.desc("published_at")).select("split").collect()]
    assert newest == ["val"] * (N // 5) + ["train"] * (N - N // 5)


def test_split_moves_only_the_cut_cell(hot, fixed_partitions):
    parts = sampling.stratified_split(hot, "hash")
    assert largest_share(parts) < 0.5
    assert parts.where("split = 'val'").count() == N // 5


def test_limit_on_one_request(hot, fixed_partitions):
    got = articles.first_accepted(hot, 1500, ["page_no", "pos"])
    assert sorted(r.page_no for r in got.select("page_no").collect()) == list(range(1500))


def test_one_key_everywhere(hot, fixed_partitions):
    assert articles.first_arrivals(hot, ["ticker"], ["page_no"]).first().page_no == 0


def test_daily_metrics_of_one_ticker(hot):
    df = hot.select("published_at", F.array("ticker").alias("tickers"), F.col("label").alias("weak_label"))
    days = daily.daily_ticker_aggregate(daily.prepare_articles(df)).collect()
    assert len(days) == 30 and sum(d.article_count for d in days) == N
    assert max(d.date for d in days) - min(d.date for d in days) == timedelta(days=29)
