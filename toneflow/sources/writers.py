"""Sinks for articles, labelled tables, reports and predictions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toneflow.functions.dates import day, day_stamp
from toneflow.operators.daily import detect_alerts, rolling_trend
from toneflow.operators.evaluate import to_wide
from toneflow.sources.readers import CSV_READ, is_csv

CSV_WRITE = {
    "header": "true", "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, which CSV can hold."""
    nested = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def write_table(df: DataFrame, path: str, file_format: str | None = None,
                partition_by: tuple[str, ...] = (), mode: str = "overwrite",
                dynamic: bool = False) -> str:
    """Write a table; without a format the suffix of the path decides.

    ``dynamic`` replaces only the partitions that occur in ``df``.
    """
    csv = (file_format or ("csv" if is_csv(path) else "parquet")).lower() == "csv"
    writer = (flat(df) if csv else df).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if csv:
        writer.options(**CSV_WRITE).csv(path)
    else:
        writer.parquet(path)
    return path


def modal_day(df: DataFrame, by: tuple[str, ...] = (), ts: str = "published_at") -> DataFrame:
    """The most frequent publish day, the earliest one on ties.

    Days are counted first, so what is compared is one row per group and day.
    """
    days = df.select(*by, day(F.col(ts)).alias("_day")).where("_day IS NOT NULL") \
        .groupBy(*by, "_day").agg(F.count(F.lit(1)).alias("_n"))
    rank = F.struct(F.col("_n"), -F.unix_date("_day"))
    return days.groupBy(*by).agg(F.max_by("_day", rank).alias("batch_date"))


def write_articles(df: DataFrame, path: str, file_format: str = "parquet") -> int:
    """Store accepted articles by ticker and modal day; returns the number of rows.

    ``df`` has a column ``request``, the ticker the article was fetched for; rows
    without one, and those of a request without any publish day, are not stored.
    Rows are written once, by request, to a hidden folder in ``path``.  The modal
    days are counted there, from the publish times alone, and the files are then
    moved to the folders of ticker and day.  Such a folder gets its new files
    before its old ones go: a job that breaks off loses nothing, and running it
    again replaces what it left.  Rebalancing merges small partitions and splits
    large ones, so that neither many tiny files nor one huge task comes out.
    """
    spark = df.sparkSession
    staged_at = f"{path.rstrip('/')}/_staged/{uuid.uuid4().hex}"
    rows = df.where("request IS NOT NULL").withColumns({"_request": F.md5("request"), "ticker": F.lower("request")}).drop("request")
    try:
        write_table(rows.hint("rebalance", "_request"), staged_at, file_format, ("_request", "ticker"), mode="errorifexists")
        csv = file_format.lower() == "csv"
        reader = spark.read.schema((flat(rows) if csv else rows).schema)
        staged = reader.options(**CSV_READ).csv(staged_at) if csv else reader.parquet(staged_at)
        rows_of = staged.groupBy("_request").agg(F.count(F.lit(1)).alias("n"))
        days = modal_day(staged, ("_request",)).withColumn("batch_date", day_stamp(F.col("batch_date")))
        found = days.join(rows_of, "_request").collect()  # one row per request
        _publish(spark, path, staged_at, {r["_request"]: r["batch_date"] for r in found})
        return sum(r["n"] for r in found)
    finally:
        _file_system(spark, path).delete(_path(spark, staged_at), True)


def _path(spark: SparkSession, *names: object) -> object:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(*names)


def _file_system(spark: SparkSession, path: str) -> object:
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _publish(spark: SparkSession, path: str, staged_at: str, days: dict[str, str]) -> None:
    """Move the files of staged requests to ``ticker=.../batch_date=...``, in place of what is there."""
    files = _file_system(spark, path)

    def inside(folder: object) -> list:
        return [s.getPath() for s in files.listStatus(folder)] if files.exists(folder) else []

    # Requests that differ in case share a folder, so files are gathered by folder first.
    moves: dict[str, list[tuple[str, object]]] = {}
    folders = {}
    for request, day_name in days.items():
        for ticker in inside(_path(spark, f"{staged_at}/_request={request}")):
            folder = _path(spark, _path(spark, path, ticker.getName()), f"batch_date={day_name}")
            folders[folder.toString()] = folder
            moves.setdefault(folder.toString(), []).extend((request, file) for file in inside(ticker))
    for name, staged in moves.items():
        old = inside(folders[name])
        files.mkdirs(folders[name])
        for request, file in staged:
            if not files.rename(file, _path(spark, folders[name], f"{request}-{file.getName()}")):
                raise OSError(f"could not move {file.toString()} to {name}")
        for file in old:
            files.delete(file, True)


def write_report(daily: DataFrame, out_dir: str, window: int = 7, z_threshold: float = 2.5,
                 file_format: str = "parquet") -> dict[str, str]:
    """Write daily metrics with their trend, then the alerts found in them.

    The rows leave the rolling window sorted by ticker and day, which keeps
    row-group statistics selective; a folder per ticker would mean one tiny
    file per ticker.  Alerts are computed from the stored table, so the
    articles are aggregated once.  Returns the two locations.
    """
    paths = {name: f"{out_dir.rstrip('/')}/{name}" for name in ("daily", "alerts")}
    trend = rolling_trend(daily, window)
    write_table(trend, paths["daily"], file_format)
    spark = daily.sparkSession
    if file_format.lower() == "csv":
        stored = spark.read.schema(trend.schema).options(**CSV_READ).csv(paths["daily"])
    else:
        stored = spark.read.schema(trend.schema).parquet(paths["daily"])
    alerts = detect_alerts(stored, z_threshold, window)
    write_table(alerts, paths["alerts"], file_format)
    return paths


def write_predictions(predictions: DataFrame, path: str, models: list[str],
                      with_probs: tuple[str, ...] = (), with_raw: tuple[str, ...] = ()) -> str:
    """Predictions of several models side by side, as CSV."""
    return write_table(to_wide(predictions, models, with_probs, with_raw), path, "csv")
