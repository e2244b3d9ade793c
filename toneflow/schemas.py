"""Schemas of the tables that travel between jobs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import types as T

LABELS = ("negative", "neutral", "positive")

RAW_ARTICLE = T.StructType([
    T.StructField("source", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("publishedAt", T.StringType()),
])

# One landed response of the feed.  ``request`` and ``page_no`` say which
# watchlist entry asked for it and at which position it arrived.
RAW_PAGE = T.StructType([
    T.StructField("request", T.StringType()),
    T.StructField("page_no", T.LongType()),
    T.StructField("articles", T.ArrayType(RAW_ARTICLE)),
])

ARTICLE = T.StructType([
    T.StructField("hash", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("url", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("tickers", T.ArrayType(T.StringType())),
    T.StructField("raw", RAW_ARTICLE),
])

LABELLED_ARTICLE = T.StructType([
    *ARTICLE.fields,
    T.StructField("weak_label", T.StringType()),
    T.StructField("lex_label", T.StringType()),
    T.StructField("lex_score", T.DoubleType()),
    T.StructField("model_label", T.StringType()),
    T.StructField("model_probs", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tone_score", T.DoubleType()),
])

DAILY = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("mean_score", T.DoubleType()),
    T.StructField("pct_pos", T.DoubleType()),
    T.StructField("pct_neg", T.DoubleType()),
    T.StructField("article_count", T.LongType()),
    T.StructField("tone_volatility", T.DoubleType()),
])

ALERT = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("alert_type", T.StringType()),
    T.StructField("z_value", T.DoubleType()),
])

@dataclass(frozen=True)
class Request:
    """One watchlist entry: what to look for, when, and how many articles to keep."""

    company: str
    ticker: str
    industry: str | None = None
    keywords: tuple[str, ...] = ()
    from_date: str | datetime | date | None = None
    to_date: str | datetime | date | None = None
    language: str = "en"
    max_articles: int = 500
