"""Daily metrics kept up to date while labelled articles arrive.

Every micro-batch is reduced to mergeable sums per ticker and day and stored
under its batch number, by bucket of tickers and month; writing it twice leaves
one copy.  A late article changes its own day and up to ``window - 1`` later rows
of its ticker.  Every month of a bucket therefore has a carry: the last
``window - 1`` rows of every ticker before that month, which is all that its
rolling frames need from the past; one more carry follows the last month.  An
update reads the sums and carries of the months that the batch changes and
nothing of any other month.  How far a change reaches is read from the carries
of the months that follow.

Rows of changed months are made from sums, so a stale copy of such a row in a
carry never counts.  Carries of months that are new come from the next one
there is, and are stored before any other: so an update that was interrupted can
be repeated.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from toneflow.operators import articles
from toneflow.operators.daily import detect_alerts, prepare_articles, rolling_trend
from toneflow.schemas import DAILY
from toneflow.session import sized
from toneflow.sources.writers import write_table

SUMS = ("date date, ticker string, n bigint, n_pos bigint, n_neg bigint, "
        "n_scored bigint, mean double, m2 double, bucket int, month int")
SUM_COLUMNS = ("date", "ticker", "n", "n_pos", "n_neg", "n_scored", "mean", "m2", "bucket", "month")
CARRY = "ticker string, date date, mean_score double, bucket int, month int"
#: Stands for the months to come.
END = 1_000_000

#: A bucket and a month.
Place = tuple[int, int]
TREND = T.StructType([
    *DAILY.fields,
    T.StructField("rolling_mean", T.DoubleType()),
    T.StructField("rolling_z", T.DoubleType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])


def month_of(date: str) -> Column:
    return F.year(date) * 100 + F.month(date)


def day_sums(df: DataFrame, buckets: int) -> DataFrame:
    """Counts, mean and squared deviations per ticker and day."""
    score = F.nanvl(F.col("tone_score").cast("double"), F.lit(None).cast("double"))
    rows = articles.with_publish_date(articles.per_ticker(prepare_articles(df)))
    return rows.groupBy("date", "ticker").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("weak_label") == "positive", 1)).alias("n_pos"),
        F.count(F.when(F.col("weak_label") == "negative", 1)).alias("n_neg"),
        F.count(score).alias("n_scored"),
        F.avg(score).alias("mean"),
        (F.var_pop(score) * F.count(score)).alias("m2"),
    ).withColumn("bucket", F.pmod(F.hash("ticker"), F.lit(buckets))).withColumn("month", month_of("date"))


def combine_sums(sums: DataFrame) -> DataFrame:
    """Sums of any number of batches as sums of one."""
    weight, mean = F.col("n_scored"), F.col("mean")
    total = F.nullif(F.sum(weight), F.lit(0))
    between = F.sum(weight * mean * mean) - F.pow(F.sum(weight * mean), F.lit(2)) / total
    return sums.groupBy("bucket", "month", "date", "ticker").agg(
        F.sum("n").alias("n"), F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg"),
        F.sum(weight).alias("n_scored"),
        (F.sum(weight * mean) / total).alias("mean"),
        (F.sum("m2") + F.greatest(between, F.lit(0.0))).alias("m2"),
    ).select(*SUM_COLUMNS)


def daily_metrics(combined: DataFrame) -> DataFrame:
    """Daily metrics from combined sums."""
    spread = F.sqrt(F.col("m2") / F.nullif("n_scored", F.lit(0)))
    return combined.select(
        "date", "ticker", F.col("mean").alias("mean_score"),
        (F.col("n_pos") / F.col("n")).alias("pct_pos"),
        (F.col("n_neg") / F.col("n")).alias("pct_neg"),
        F.col("n").alias("article_count"),
        F.when(F.col("n") > 1, spread).otherwise(F.lit(0.0)).alias("tone_volatility"),
        "bucket", "month",
    )


def read_sums(spark: SparkSession, out_dir: str, epoch: int) -> DataFrame:
    """Everything up to the present: what was folded before the epoch, and its batches."""
    sums = spark.read.schema(SUMS).parquet(f"{out_dir}/batches/epoch={epoch}").select(*SUM_COLUMNS)
    if epoch == 0:
        return sums
    return spark.read.schema(SUMS).parquet(f"{out_dir}/folded/epoch={epoch}") \
        .select(*SUM_COLUMNS).unionByName(sums)


def stored_months(spark: SparkSession, out_dir: str) -> dict[int, list[int]]:
    """Months of every bucket that have rows, and the end; from names of folders, no file is opened."""
    try:
        files = spark.read.schema(TREND).parquet(f"{out_dir}/daily").inputFiles()
    except AnalysisException:
        return {}
    found = {tuple(map(int, m.groups())) for f in files if (m := re.search(r"/bucket=(\d+)/month=(-?\d+)/", unquote(f)))}
    return {b: [*sorted(m for x, m in found if x == b), END] for b, _ in found}


def at_places(df: DataFrame, places: set[Place]) -> DataFrame:
    """Rows of some buckets and months; other folders are pruned."""
    wanted = df.sparkSession.createDataFrame(sorted(places), "bucket int, month int")
    return df.where(F.col("bucket").isin(*{b for b, _ in places}) & F.col("month").isin(*{m for _, m in places})) \
        .join(F.broadcast(wanted), ["bucket", "month"], "left_semi")


def read_carry(spark: SparkSession, out_dir: str, places: set[Place]) -> DataFrame:
    """Carries of some months; a month without rows before it has none."""
    try:
        return at_places(spark.read.schema(CARRY).parquet(f"{out_dir}/carry"), places)
    except AnalysisException:
        return spark.createDataFrame([], CARRY)


def reached(days: DataFrame, carry: DataFrame, places: set[Place], window: int) -> set[Place]:
    """Of some later months those whose carry changes with new articles on ``days`` (bucket, ticker, date, month).

    It does where fewer than ``window - 1`` rows of the ticker lie between.
    """
    spark = days.sparkSession
    frames = carry.groupBy("bucket", F.col("month").alias("frame"), "ticker").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first"))
    later = F.broadcast(spark.createDataFrame(sorted(places), "bucket int, frame int"))
    both = days.join(later, "bucket").where("month < frame").join(frames, ["bucket", "frame", "ticker"], "left")
    open_frame = (F.coalesce("n", F.lit(0)) < window - 1) | (F.col("date") >= F.col("first"))
    return {(r.bucket, r.frame) for r in both.where(open_frame).select("bucket", "frame").distinct().collect()}


def changed_places(days: DataFrame, touched: set[Place], months: dict[int, list[int]], out_dir: str, window: int) -> set[Place]:
    """Months whose rows or carries change: those of the batch, and as many after them as the change reaches.

    A change that reaches a month reaches those between, so twice as many are asked each time.
    """
    changed, last, step = set(touched), set(touched), 1
    while last:
        ahead = {(b, m) for b, since in last for m in months.get(b, [])[bisect_right(months.get(b, []), since):][:step]} - changed
        last = reached(days, read_carry(days.sparkSession, out_dir, ahead), ahead, window) if ahead else set()
        changed |= last
        step *= 2
    # A bucket that has no months yet gets its end.
    return changed | {(b, END) for b, _ in touched if b not in months}


def update_daily(batch: DataFrame, batch_id: int, out_dir: str, window: int, buckets: int,
                 fold_every: int) -> None:
    """Fold one micro-batch into the tables under ``out_dir``.

    Batches are grouped into epochs of ``fold_every``.  The first batch of an
    epoch folds everything before it into one table, so an update never lists
    more than one epoch of batches.  All paths follow from the batch number:
    repeating a batch writes the same files again.
    """
    spark = batch.sparkSession
    epoch, place = divmod(batch_id, fold_every)
    if place == 0 and epoch > 0:
        write_table(combine_sums(read_sums(spark, out_dir, epoch - 1)),
                    f"{out_dir}/folded/epoch={epoch}", "parquet", ("bucket", "month"))
    own = f"{out_dir}/batches/epoch={epoch}/batch={batch_id}"
    write_table(day_sums(batch, buckets), own, "parquet", ("bucket", "month"))
    days = spark.read.schema(SUMS).parquet(own).select("bucket", "month", "ticker", "date").distinct()
    # At most as many pairs as buckets times months of the batch.
    touched = {(r.bucket, r.month) for r in days.select("bucket", "month").distinct().collect()}
    if not touched:
        return
    months = stored_months(spark, out_dir)
    changed = changed_places(days, touched, months, out_dir, window)
    new = {(b, m) for b, m in changed if m not in months.get(b, [])}
    # Nothing lies between a new month and the next, so what that one carries is what came before both.
    sources = changed | {(b, months[b][bisect_right(months[b], m)]) for b, m in new if b in months}
    fresh = daily_metrics(combine_sums(at_places(read_sums(spark, out_dir, epoch), changed)))
    carried = read_carry(spark, out_dir, sources).select("bucket", month_of("date").alias("month"), "ticker", "date", "mean_score")
    pairs = spark.createDataFrame(sorted(changed), "bucket int, month int")
    carried = carried.dropDuplicates(["ticker", "date"]).join(F.broadcast(pairs), ["bucket", "month"], "left_anti")
    rows = fresh.withColumn("_own", F.lit(True)).unionByName(carried.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    by_day = Window.partitionBy("ticker").orderBy("date")
    rows = sized(rolling_trend(rows, window).withColumn("_later", F.lead("date", window - 1).over(by_day)))

    # A row is carried into the months after its own up to that of the row ``window - 1`` places later.
    frames = pairs.groupBy("bucket").agg(F.collect_list("month").alias("_frames"))
    upto = F.coalesce(month_of("_later"), F.lit(END))
    wanted = F.filter("_frames", lambda m: (m > F.col("month")) & (m <= upto))
    carry = rows.join(F.broadcast(frames), "bucket").select("ticker", "date", "mean_score", "bucket", F.explode(wanted).alias("month"))
    for some in (new, changed - new):
        if some:
            write_table(at_places(carry, some), f"{out_dir}/carry", "parquet", ("bucket", "month"), dynamic=True)
    write_table(rows.where("_own").select(*TREND.names), f"{out_dir}/daily", "parquet", ("bucket", "month"), dynamic=True)


def maintain_daily(labelled: DataFrame, out_dir: str, checkpoint: str, window: int = 7,
                   buckets: int = 16, fold_every: int = 100) -> StreamingQuery:
    """Keep the daily table current for a stream of labelled articles.

    ``window``, ``buckets`` and ``fold_every`` belong to the stored tables and
    must stay the same for one ``out_dir``.
    """
    def fold(batch: DataFrame, batch_id: int) -> None:
        update_daily(batch, batch_id, out_dir, window, buckets, fold_every)

    return (
        labelled.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def current_daily(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(TREND).parquet(f"{out_dir}/daily").drop("bucket", "month")


def current_alerts(spark: SparkSession, out_dir: str, z_threshold: float = 2.5) -> DataFrame:
    """Alerts of the current daily table; a filter, so it never goes stale."""
    return detect_alerts(current_daily(spark, out_dir), z_threshold)
