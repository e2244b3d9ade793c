"""Filters, defaults and set operations on article tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toneflow.functions import dates, text
from toneflow.operators.terms import find_terms


def require_columns(df: DataFrame, needed: Iterable[str]) -> DataFrame:
    """Fail while the plan is built when a column is missing."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def in_lookback(df: DataFrame, now: Column, days: int, column: str = "published_at") -> DataFrame:
    return df.where(dates.within_days(F.col(column), now, days))


def with_publish_date(df: DataFrame, column: str = "published_at") -> DataFrame:
    """Add ``date``; rows without one cannot enter a daily group and are dropped."""
    return df.withColumn("date", dates.day(F.col(column))).where(F.col("date").isNotNull())


def in_language(df: DataFrame, language: str = "en") -> DataFrame:
    return df.where(F.col("language") == language)


def with_parsed_time(df: DataFrame, raw: str, name: str = "published_at") -> DataFrame:
    """Parse ISO text and drop the rows that do not parse."""
    return df.withColumn(name, dates.parse_iso(F.col(raw))).where(F.col(name).isNotNull())


def about(df: DataFrame, ticker: str) -> DataFrame:
    """Articles tagged with ``ticker``; the comparison is case-sensitive."""
    return df.where(F.array_contains("tickers", ticker))


def per_ticker(df: DataFrame) -> DataFrame:
    """One row per article and distinct ticker, in column ``ticker``."""
    return df.withColumn("ticker", F.explode(F.array_distinct("tickers"))) \
        .where(F.col("ticker").isNotNull())


def backfill_tickers(df: DataFrame, ticker: str | Column) -> DataFrame:
    """Give untagged articles the requested ticker, in upper case."""
    wanted = F.lit(ticker) if isinstance(ticker, str) else ticker
    filled = F.array(F.upper(wanted))
    if "tickers" not in df.columns:
        return df.withColumn("tickers", filled)
    current = F.col("tickers")
    return df.withColumn("tickers", F.when(F.size(F.coalesce(current, F.array())) == 0, filled)
                         .otherwise(current))


def matching_query(df: DataFrame, terms: Sequence[str],
                   fields: Sequence[str] = ("title", "description", "content")) -> DataFrame:
    """Articles that mention one of a request's terms."""
    return df.where(text.mentions_any(terms, *[F.col(f) for f in fields]))


def matching_watchlist(df: DataFrame, watchlist: DataFrame,
                       fields: Sequence[str] = ("title", "description", "content")) -> DataFrame:
    """Per-request form: each article is checked against the terms of its own request.

    ``watchlist`` has columns (company, ticker, keywords) and joins on the
    request, so there is no article-by-watchlist product.
    """
    keywords = F.filter(F.transform(F.coalesce("keywords", F.array()), text.strip_space),
                        lambda k: k != "")
    terms = F.array_distinct(F.array_compact(F.concat(
        F.array("company", F.nullif("ticker", F.lit(""))), keywords)))
    requests = watchlist.select(F.col("ticker").alias("request"), terms.alias("_terms"))
    hit = text.mentions_any(F.col("_terms"), *[F.col(f) for f in fields])
    return df.join(requests, "request").where(hit).drop("_terms")


def first_arrivals(df: DataFrame, key: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """One row per key, the earliest arrival.

    Spark keeps one row per key and task before the shuffle, so a key with
    very many copies does not flood a task.
    """
    order = Window.partitionBy(*key).orderBy(*arrival)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def first_accepted(df: DataFrame, limit: int, arrival: Sequence[str],
                   by: Sequence[str] = ("request",), salts: int = 16) -> DataFrame:
    """At most ``limit`` articles per request, in arrival order; none for ``limit <= 0``.

    Ranks within salted shares of a request first and among their winners
    second, so one huge request is spread over several tasks.
    """
    if limit <= 0:
        return df.limit(0)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*arrival), F.lit(salts)))
    for group in ((*by, "_salt"), tuple(by)):
        order = Window.partitionBy(*group).orderBy(*arrival)
        salted = salted.withColumn("_rank", F.row_number().over(order)) \
            .where(F.col("_rank") <= limit).drop("_rank")
    return salted.drop("_salt")


def attach_labels(articles: DataFrame, labels: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Left join on ``hash``; repeated label rows never multiply articles.

    Of several labels for one article the first in ``order`` counts, any of
    them without an order.
    """
    unique = first_arrivals(labels, ["hash"], order) if order else labels.dropDuplicates(["hash"])
    return articles.join(unique, "hash", "left")


def mentions(df: DataFrame, key: str, body: Column, watchlist: DataFrame, words_only: bool = True) -> DataFrame:
    """Rows (key, ticker) for every watchlist ticker that occurs as a word, or anywhere in the text.

    For watchlists too long to test one by one: the distinct words of each
    text are joined with the tickers, or its runs of characters with an index
    of them, so there is no text-by-ticker product.
    """
    wanted = watchlist.select("ticker").distinct().withColumn("_word", F.lower("ticker"))
    if words_only:
        found = df.select(key, F.explode(F.array_distinct(text.whole_words(body))).alias("_word"))
    else:
        found = find_terms(df, key, body, wanted, "_word").withColumnRenamed("term", "_word")
    return found.join(wanted, "_word").select(key, "ticker")


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def preview(df: DataFrame, order: Sequence[str] = ("published_at", "hash"), n: int = 5) -> DataFrame:
    return df.orderBy(*order).select("title", "source", "published_at").limit(n)


def head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
