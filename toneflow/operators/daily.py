"""Daily tone per ticker, rolling statistics, alerts and summaries."""

from __future__ import annotations

import math
import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from toneflow.functions import labels
from toneflow.operators import articles
from toneflow.operators.ranking import bounded_levels, number_rows
from toneflow.schemas import ALERT, LABELS

Z_EPSILON = 1e-6


def prepare_articles(df: DataFrame) -> DataFrame:
    """Check the columns a report needs and score the labels if nobody has."""
    articles.require_columns(df, {"published_at", "weak_label"})
    if "tone_score" in df.columns:
        return df
    return df.withColumn("tone_score", labels.label_to_score(F.col("weak_label")))


def daily_ticker_aggregate(df: DataFrame, ticker: str | None = None) -> DataFrame:
    """One row per ticker and publish day, for all tickers unless one is named.

    Scores are averaged over the rows that have one; counts and label shares
    use every row.  Partial aggregates are built before the shuffle.
    """
    if ticker is not None:
        df = articles.about(df, ticker).withColumn("ticker", F.lit(ticker))
    else:
        df = articles.per_ticker(df)
    score = F.nanvl(F.col("tone_score").cast("double"), F.lit(None).cast("double"))

    def share(label: str):
        return F.avg((F.col("weak_label").eqNullSafe(label)).cast("double"))

    return (
        articles.with_publish_date(df)
        .groupBy("date", "ticker")
        .agg(
            F.avg(score).alias("mean_score"),
            share("positive").alias("pct_pos"),
            share("negative").alias("pct_neg"),
            F.count(F.lit(1)).alias("article_count"),
            F.when(F.count(F.lit(1)) > 1, F.stddev_pop(score)).otherwise(F.lit(0.0))
            .alias("tone_volatility"),
        )
    )


def rolling_trend(daily: DataFrame, window: int = 7) -> DataFrame:
    """Rolling mean and z-score over the last ``window`` days that have data.

    The window runs over one row per ticker and day, not over articles.  The
    score is null while fewer than two days are in the frame.
    """
    frame = Window.partitionBy("ticker").orderBy("date").rowsBetween(-(window - 1), 0)
    mean = F.avg("mean_score").over(frame)
    spread = F.when(F.count("mean_score").over(frame) >= 2, F.stddev_pop("mean_score").over(frame))
    return daily.withColumn("rolling_mean", mean).withColumn(
        "rolling_z", (F.col("mean_score") - F.col("rolling_mean")) / (spread + Z_EPSILON))


def detect_alerts(daily: DataFrame, z_threshold: float = 2.5, window: int | None = None) -> DataFrame:
    """Days whose tone leaves the rolling band, with the direction.

    A day belongs to its own frame, so a score never exceeds
    ``sqrt(window - 1)``; a threshold beyond that is worth a warning.
    """
    if "rolling_z" not in daily.columns:
        return daily.sparkSession.createDataFrame([], ALERT)
    if window is not None and z_threshold > math.sqrt(max(window - 1, 0)):
        warnings.warn(f"no z-score over {window} days can reach {z_threshold}", stacklevel=2)
    z = F.col("rolling_z")
    return daily.where(F.abs(z) >= z_threshold).select(
        "date", "ticker",
        F.when(z > 0, "spike_positive").otherwise("spike_negative").alias("alert_type"),
        z.alias("z_value"),
    )


def period_summary(daily: DataFrame) -> DataFrame:
    """Totals per ticker; the tone is the plain mean of the daily means."""
    tone = F.avg("mean_score")
    return daily.groupBy("ticker").agg(
        F.sum("article_count").alias("total_articles"),
        F.count(F.lit(1)).alias("n_days"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        tone.alias("avg_tone"),
        labels.label_from_score(tone).alias("verdict"),
    )


def display(daily: DataFrame) -> DataFrame:
    """Columns for reading: score to 3 places, shares in percent to 1 place."""
    def rounded(column, places):
        factor = F.lit(float(10 ** places))
        return F.rint(column * factor) / factor

    return daily.select(
        F.col("date").alias("Date"),
        F.col("ticker").alias("Ticker"),
        rounded(F.col("mean_score"), 3).alias("Tone"),
        F.col("article_count").alias("Articles"),
        rounded(F.col("pct_pos") * 100, 1).alias("Positive%"),
        rounded(F.col("pct_neg") * 100, 1).alias("Negative%"),
    )


def label_distribution(df: DataFrame, column: str = "weak_label") -> DataFrame:
    """Count and percentage of each tone label among all rows, zeros included."""
    counted = [F.count(F.when(F.col(column) == name, 1)).alias(name) for name in LABELS]
    totals = df.agg(F.count(F.lit(1)).alias("_all"), *counted)
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("label"), F.col(name).alias("n")) for name in LABELS]))
    return (
        totals.select("_all", rows.alias("_r"))
        .select("_r.label", "_r.n",
                F.coalesce(F.try_divide(F.col("_r.n") * 100.0, F.col("_all")), F.lit(0.0)).alias("pct"))
    )


def value_shares(df: DataFrame, column: str = "label") -> DataFrame:
    """Count and percentage of every value that occurs."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") * 100.0 / total)


def recency_index(df: DataFrame, ticker: str = "ticker", ts: str = "published_at",
                  key: str = "hash", cell_limit: int = 2_000_000) -> DataFrame:
    """Position of each article behind the newest one of its ticker, ties by key.

    Cells are days; a day with very many articles is divided by hours, minutes
    and so on down to heads of the key, as far as needed, so neither a busy
    ticker nor a bulk load under one timestamp ends up in a single sort.
    """
    time, name = F.col(ts), F.col(key).cast("string")
    return number_rows(
        df, [ticker],
        bounded_levels(time, name),
        [time.desc(), name], cell_limit=cell_limit,
    )


def decayed_tone(df: DataFrame, half_life: int = 50) -> DataFrame:
    """Tone per ticker with weights that halve every ``half_life`` articles."""
    weight = labels.decay_weight(F.col("index"), half_life)
    score = F.col("tone_score").cast("double")
    return recency_index(df).withColumn("_w", F.when(score.isNotNull(), weight)) \
        .groupBy("ticker") \
        .agg(F.try_divide(F.sum(F.col("_w") * score), F.sum("_w")).alias("decayed_score"),
             F.count(F.lit(1)).alias("n"))
