"""Reading given tables, storing intermediate ones, and keys for rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toneflow.session import scratch_path

#: Prefix of helper columns, so that they never clash with a caller's.
OWN = "__llm_"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    Cuts the lineage in a way that survives lost executors, and lets the
    planner see the true size of the table.  The shuffle files of the write go
    when it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def once(value: Column) -> Column:
    """A costly value that the optimizer shall neither repeat, move nor merge into what uses it.

    It would copy a deterministic one into filters above it and into lambdas,
    which evaluate it anew for every element.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def row_key(id_col: str, text_col: str) -> Column:
    """Key of a row: id and text.  Rows that agree in both get the same decision."""
    text = F.col(text_col)
    return F.struct(F.col(id_col).cast("string").alias("id"), F.xxhash64(text).alias("hash"),
                    F.length(text).alias("length"))


def with_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add the row key as one never-null string column."""
    k = row_key(id_col, text_col)
    return df.withColumn(f"{OWN}key", F.concat_ws(
        "|", F.coalesce(k["id"], F.lit("-")), k["hash"].cast("string"),
        F.coalesce(k["length"].cast("string"), F.lit("-"))))


#: Rows of ids or decisions up to which a side that was counted is broadcast.
BROADCAST_ROWS = 500_000


def light(side: DataFrame) -> DataFrame:
    """A stored side of a join, to be broadcast if it has few rows; joined by shuffling beyond."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side
