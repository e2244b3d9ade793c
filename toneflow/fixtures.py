"""Driver tables in the shape of articles, feeds, gold labels and predictions."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toneflow.session import use_utc
from toneflow.sources.readers import spread

MODELS = ("a", "b", "c")

# Landed pages are read once or twice and then dropped: packing them hard costs more than it saves.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

# Columns of the gold table below and their standard names.
GOLD_COLUMNS = {"text": ("Phrase", "phrase"), "label": ("Code", "code")}


@lru_cache(maxsize=64)
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table; its schema is looked up once per session."""
    return use_utc(spark).read.parquet(f"{folder}/{name}.parquet")


def events_as_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Events as labelled articles, one ticker per user."""
    tone = (
        F.when(F.col("event_type").isin("purchase", "signup"), "positive")
        .when(F.col("event_type") == "error", "negative").otherwise("neutral")
    )
    ticker = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("hash"),
        F.col("ts").alias("published_at"),
        F.array(ticker).alias("tickers"),
        tone.alias("weak_label"),
        F.col("value"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )


def orders_as_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as labelled articles: few tickers, long daily series."""
    tone = (
        F.when(F.col("o_orderstatus") == "F", "positive")
        .when(F.col("o_orderstatus") == "O", "negative").otherwise("neutral")
    )
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("hash"),
        F.col("o_orderdate").alias("published_at"),
        F.array("o_orderpriority").alias("tickers"),
        tone.alias("weak_label"),
    )


@lru_cache(maxsize=8)
def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"), "doc_id")


def raw_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as feed payloads; copies of a text share title, source and day."""
    doc = documents(spark, folder)
    size = F.length("text")
    stamp = F.concat(
        F.lit("2024-01-"), F.lpad((size % 28 + 1).cast("string"), 2, "0"), F.lit("T"),
        F.lpad((F.col("doc_id") % 24).cast("string"), 2, "0"), F.lit(":00:00Z"))
    stamp = F.when(F.col("doc_id") % 50 == 7, "not a date").otherwise(stamp)
    # Found from the start: a pattern would have the whole text decoded for its first two sentences.
    second = F.when(F.contains("text", F.lit(".")), F.substring_index(F.substring_index("text", ".", 2), ".", -1))
    description = F.when(F.col("doc_id") % 7 != 0, second.when(F.col("text").isNotNull(), ""))
    return doc.select(
        F.concat(F.lit("R"), (size % 3).cast("string")).alias("request"),
        F.floor(F.col("doc_id") / 100).alias("page_no"),
        F.col("doc_id"),
        F.struct(
            F.struct(F.col("lang").alias("name")).alias("source"),
            F.substring_index("text", ".", 1).alias("title"),
            description.alias("description"),
            F.col("text").alias("content"),
            F.concat(F.lit("http://news.example/"), F.col("doc_id").cast("string")).alias("url"),
            stamp.alias("publishedAt"),
        ).alias("article"),
    )


def write_feed(spark: SparkSession, folder: str, path: str) -> str:
    """Land the payloads as compressed JSON pages of up to 100 articles per request."""
    ordered = F.array_sort(F.collect_list(F.struct("doc_id", "article")))
    raw_articles(spark, folder).groupBy("request", "page_no") \
        .agg(F.transform(ordered, lambda x: x["article"]).alias("articles")) \
        .write.mode("overwrite").options(**PACKED).json(path)
    return path


def gold(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with human labels, under phrase-bank column names."""
    tone = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).otherwise(1)
    labels = table(spark, folder, "labels").select("doc_id", tone.alias("Code"))
    return documents(spark, folder).join(labels, "doc_id") \
        .select("doc_id", F.col("text").alias("Phrase"), "Code")


def gold_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Keys and labels of the gold rows, without the texts."""
    tone = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive") \
        .otherwise("neutral")
    return table(spark, folder, "labels").select("doc_id", tone.alias("label"))


def wide_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Three made-up models side by side; model c also predicts labels outside the set."""
    k, truth = F.col("k"), F.col("weak_label")
    return events_as_articles(spark, folder).select(
        F.col("hash").cast("bigint").alias("row_id"),
        truth.alias("true_label"),
        F.when(k % 5 == 0, "neutral").otherwise(truth).alias("a_prediction"),
        F.round(0.5 + k / 200.0, 6).alias("a_confidence"),
        F.when(k % 3 == 0, "positive").when(k % 7 == 0, "negative").otherwise(truth)
        .alias("b_prediction"),
        F.round(0.4 + k / 250.0, 6).alias("b_confidence"),
        F.when(k % 2 == 0, "neutral").when(k % 13 == 1, "love").when(k % 11 == 0, "negative")
        .otherwise(truth).alias("c_prediction"),
        F.round(0.3 + k / 300.0, 6).alias("c_confidence"),
    )
