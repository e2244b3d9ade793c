"""Labelled articles to daily metrics and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toneflow.operators import articles, daily
from toneflow.schemas import LABELLED_ARTICLE
from toneflow.sources.readers import read_table
from toneflow.sources.writers import write_report


def daily_report(df: DataFrame, window: int = 7, ticker: str | None = None) -> DataFrame:
    """Daily metrics with trend, for all tickers at once."""
    prepared = daily.prepare_articles(df)
    return daily.rolling_trend(daily.daily_ticker_aggregate(prepared, ticker), window)


def alert_report(df: DataFrame, window: int = 7, z_threshold: float = 2.5,
                 ticker: str | None = None) -> DataFrame:
    return daily.detect_alerts(daily_report(df, window, ticker), z_threshold, window)


def build_reports(spark: SparkSession, labelled_path: str, out_dir: str, ticker: str | None = None,
                  window: int = 7, z_threshold: float = 2.5, file_format: str = "parquet",
                  backfill: bool = False) -> dict[str, str]:
    """Read a labelled table, write ``daily`` and ``alerts``, return their locations.

    The report of a single ticker goes to a folder of its own.
    """
    df = read_table(spark, labelled_path, LABELLED_ARTICLE)
    if backfill and ticker:
        df = articles.backfill_tickers(df, ticker)
    per_day = daily.daily_ticker_aggregate(daily.prepare_articles(df), ticker)
    if ticker:
        out_dir = f"{out_dir.rstrip('/')}/{ticker.lower()}"
    return write_report(per_day, out_dir, window, z_threshold, file_format)


def distribution(df: DataFrame) -> DataFrame:
    """Label shares of the whole labelled table, not of one ticker."""
    return daily.label_distribution(df).orderBy(F.col("label"))
