"""Continuous ingestion of landed feed pages.

Keys of all articles ever seen are a levelled log.  A poll adds one run of
keys; ``FANOUT`` runs of a level are merged to one run of the next, so a poll
looks at no more than ``FANOUT - 1`` runs a level and the number of levels grows
with the logarithm of the polls.  Which runs are live follows from the number of
the batch alone, like the digits of a counter, and run numbers share slots, so
folders and files do not grow with the polls either and repeating a batch writes
the same slots again.

Keys lie in cells by their day in the feed.  A run is sorted by cell, and next
to it lies a small filter: a bitmap per cell in which every key has one bit.  A
poll first asks the filters, and reads keys of those cells only in which one of
its own keys may have been seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from toneflow.functions.dates import day_prefix
from toneflow.operators.articles import first_arrivals
from toneflow.plans.ingest import ARTICLE_COLUMNS, accept, stamp, with_fields, with_key, with_tickers
from toneflow.schemas import ARTICLE, RAW_PAGE
from toneflow.session import sized
from toneflow.sources.readers import explode_pages
from toneflow.sources.writers import write_table

KEYS = "request string, hash string, cell int, batch long"
FILTERS = "cell int, bucket bigint, bitmap binary"
KEY_CELLS, FANOUT = 4096, 8
#: Bits of a cell's filter; a bitmap of Spark holds 32,768, further ones are further buckets.
FILTER_BITS = 1 << 18


def live_runs(batches: int, fanout: int = FANOUT) -> list[tuple[int, int]]:
    """(level, number) of the runs that hold the keys of the first ``batches`` batches."""
    runs, level = [], 0
    while batches:
        batches, rest = divmod(batches, fanout)
        runs += [(level, batches * fanout + k) for k in range(rest)]
        level += 1
    return runs


def run_path(out_dir: str, kind: str, run: tuple[int, int], fanout: int = FANOUT) -> str:
    """Slots are used again two groups later, when nothing can need the older run any more."""
    level, number = run
    return f"{out_dir}/{kind}/fanout={fanout}/level={level}/slot={number % (2 * fanout)}"


def _bit() -> Column:
    return F.pmod(F.xxhash64("request", "hash"), F.lit(FILTER_BITS)) + 1


def _read_runs(spark: SparkSession, out_dir: str, kind: str, runs: list[tuple[int, int]], fanout: int) -> DataFrame:
    schema = KEYS if kind == "keys" else FILTERS
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[run_path(out_dir, kind, r, fanout) for r in runs])


def _write_run(keys: DataFrame, filters: DataFrame | None, out_dir: str, run: tuple[int, int], fanout: int) -> None:
    """Keys sorted by cell in files of the advisory size, then their filter."""
    spark, path = keys.sparkSession, run_path(out_dir, "keys", run, fanout)
    write_table(keys.hint("rebalance", "cell").sortWithinPartitions("cell"), path, "parquet")
    if filters is None:
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(_bit())).alias("bitmap")
        filters = spark.read.schema(KEYS).parquet(path).groupBy("cell", F.bitmap_bucket_number(_bit()).alias("bucket")).agg(bits)
    write_table(filters.hint("rebalance"), run_path(out_dir, "filters", run, fanout), "parquet")


def possible_repeats(keys: DataFrame, filters: DataFrame) -> list[int]:
    """Cells in which a filter has the bit of one of ``keys``; at most ``KEY_CELLS`` numbers."""
    mine = keys.select("cell", F.bitmap_bucket_number(_bit()).alias("bucket"), F.bitmap_bit_position(_bit()).alias("bit"))
    byte = F.conv(F.hex(F.substr("bitmap", (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1
    return [r.cell for r in mine.join(filters, ["cell", "bucket"]).where(hit).select("cell").distinct().collect()]


def page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Raw articles of pages as they land in a folder."""
    pages = spark.readStream.schema(RAW_PAGE).option("maxFilesPerTrigger", files_per_batch).json(path)
    return explode_pages(pages)


def unseen(first: DataFrame, batch_id: int, out_dir: str, fanout: int = FANOUT) -> DataFrame:
    """Rows of ``first`` (request, hash, cell) whose key no earlier batch had."""
    spark, runs = first.sparkSession, live_runs(batch_id, fanout)
    cells = possible_repeats(first, _read_runs(spark, out_dir, "filters", runs, fanout)) if runs else []
    if not cells:
        return first
    # A slot may already hold a repeated batch's own keys.
    seen = _read_runs(spark, out_dir, "keys", runs, fanout).where(F.col("cell").isin(*cells) & (F.col("batch") < batch_id))
    return first.join(seen.select("request", "hash"), ["request", "hash"], "left_anti")


def add_keys(new: DataFrame, batch_id: int, out_dir: str, fanout: int = FANOUT) -> None:
    """Store the keys (request, hash, cell) of a batch as a run, and merge the runs that it completes."""
    spark, run = new.sparkSession, (0, batch_id)
    _write_run(new.select("request", "hash", "cell", F.lit(batch_id).cast("long").alias("batch")), None, out_dir, run, fanout)
    while (run[1] + 1) % fanout == 0:
        level, number = run
        merged = [(level, k) for k in range(number - fanout + 1, number + 1)]
        run = (level + 1, number // fanout)
        filters = _read_runs(spark, out_dir, "filters", merged, fanout).groupBy("cell", "bucket").agg(
            F.bitmap_or_agg("bitmap").alias("bitmap"))
        _write_run(_read_runs(spark, out_dir, "keys", merged, fanout), filters, out_dir, run, fanout)


def ingest_batch(raw: DataFrame, batch_id: int, out_dir: str, profile: DataFrame, language: str = "en",
                 fanout: int = FANOUT) -> None:
    """Store the articles of one poll that no earlier poll had.

    The order is that of batch ingestion: repeats go first, then language and
    timestamp decide, so a rejected first copy removes later ones too.  Keys of
    all articles seen, accepted or not, stay in ``out_dir/keys`` for good.  No
    article is dropped for being late.  Batches are numbered 0, 1, 2, ...;
    article partitions carry the number, so repeating a batch writes the same
    files again.  ``fanout`` must stay the same for one ``out_dir``.
    """
    first = sized(first_arrivals(with_key(raw), ["request", "hash"], ["page_no", "pos"]).withColumn(
        "cell", F.pmod(F.hash(day_prefix(stamp())), F.lit(KEY_CELLS))))
    new = unseen(first, batch_id, out_dir, fanout)
    # Articles first: keys tell that a batch is complete, and a repeated batch doesn't look at its own.
    accepted = with_tickers(with_fields(accept(new.drop("cell"), profile, language))).select(*ARTICLE_COLUMNS) \
        .withColumn("publish_day", F.to_date("published_at")).withColumn("batch", F.lit(batch_id))
    write_table(accepted, f"{out_dir}/articles", "parquet", ("publish_day", "batch"), dynamic=True)
    add_keys(new, batch_id, out_dir, fanout)


def ingest_stream(raw: DataFrame, out_dir: str, checkpoint: str, profile: DataFrame, language: str = "en",
                  fanout: int = FANOUT) -> StreamingQuery:
    """Ingest what has landed so far, poll by poll, then stop; the tables equal those of one batch ingestion.

    That holds when pages land in the order of their numbers; otherwise the
    copy that landed first counts.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, out_dir, profile, language, fanout)

    return raw.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_articles(spark: SparkSession, out_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField("request", T.StringType()), *ARTICLE.fields])
    return spark.read.schema(schema).parquet(f"{out_dir}/articles").select(*ARTICLE_COLUMNS)


def stored_keys(spark: SparkSession, out_dir: str, fanout: int = FANOUT) -> DataFrame:
    """Keys of every article that any poll had; slots that were merged may still list some twice."""
    return spark.read.schema(KEYS).parquet(f"{out_dir}/keys/fanout={fanout}").select("request", "hash").distinct()
