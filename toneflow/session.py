"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import uuid
from functools import cache
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  Sizes that depend on the cluster (executors,
# memory, number of shuffle partitions) are left to the caller.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "toneflow", **conf: str) -> SparkSession:
    """A session with the project defaults; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Calendar days are UTC days whatever session the caller brings."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables.

    Uses the shared folder named by ``spark.checkpoint.dir``.  Only a local
    master without that setting, as in tests, gets a folder in its warehouse
    that goes when the process ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = _local_scratch(spark.conf.get("spark.sql.warehouse.dir"))
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@cache
def _local_scratch(warehouse: str) -> str:
    folder = f"{unquote(urlparse(warehouse).path).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def sized(df: DataFrame) -> DataFrame:
    """Write a side table to the scratch folder so that joins plan with its true size.

    The planner broadcasts it while it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.  Nothing
    stays in the executors' memory, and a lost executor takes nothing along.
    """
    path = scratch_path(df.sparkSession, "side")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
