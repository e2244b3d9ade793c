"""Feeds, article tables and gold labels."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toneflow.functions.labels import id_to_label
from toneflow.operators.articles import stack
from toneflow.schemas import ARTICLE, RAW_PAGE
from toneflow.session import sized

# Text values may hold line breaks and quotes.
CSV_READ = {"header": "true", "multiLine": "true", "escape": '"'}

# Where gold labels come from.
GOLD_SOURCE, GOLD_TYPE = "FinancialPhraseBank", "gold_standard"


def explode_pages(pages: DataFrame) -> DataFrame:
    """One row per article; (page_no, pos) is the arrival order within a request."""
    return pages.select("request", "page_no", F.posexplode("articles").alias("pos", "raw"))


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed feed responses, one JSON object per line unless ``multi_line``."""
    return explode_pages(spark.read.schema(RAW_PAGE).option("multiLine", multi_line).json(path))


def csv_schema(schema: T.StructType) -> T.StructType:
    """The same columns with nested values as text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, nested) else f.dataType)
        for f in schema.fields])


def parse_list(text: Column) -> Column:
    """A list literal such as ``['AAPL']``; blank or malformed text gives an empty list."""
    options = {"allowBackslashEscapingAnyCharacter": "true"}
    return F.coalesce(F.from_json(text, "array<string>", options), F.array().cast("array<string>"))


def parse_nested(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Turn the text columns of a CSV back into the nested types of ``schema``."""
    for field in schema.fields:
        if field.name not in df.columns:
            continue
        if isinstance(field.dataType, T.ArrayType):
            df = df.withColumn(field.name, parse_list(F.col(field.name)))
        elif isinstance(field.dataType, (T.MapType, T.StructType)):
            df = df.withColumn(field.name, F.from_json(field.name, field.dataType))
    return df


def is_csv(path: str) -> bool:
    return path.lower().rstrip("/").endswith(".csv")


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"')))


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, at, value): lines with the file and the place of the split they begin in; lines of a split come in order."""
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")


def csv_splits(lines: DataFrame) -> DataFrame:
    """(file, at, odd, first) of every split: whether it begins inside quotes, and its first line."""
    rows = lines.select("file", "at", F.struct(F.monotonically_increasing_id().alias("row"), "value").alias("line"),
                        _quotes(F.col("value")).alias("quotes"))
    splits = rows.groupBy("file", "at").agg(F.sum("quotes").alias("quotes"), F.min("line")["value"].alias("first"))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("file", "at", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("odd"), "first")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of every split, and the pieces of records that cross its ends.

    ``part`` is 0 for a whole record, 1 for what ends a record begun before, 2
    for what begins one that ends later, 3 for a split inside one.  The first
    record of a file, its header, is left out.  A task holds one record and one
    batch.
    """
    schema = pa.schema([("file", pa.string()), ("at", pa.int64()), ("part", pa.int32()), ("record", pa.string())])
    now, begun, held, inside, header = None, False, [], False, False
    out: list[tuple] = []

    def close():
        # What is held at the end of a split is a piece; nothing is held where the last record was complete.
        if now is not None and held:
            out.append((*now, (2 if begun else 3) if inside else (0 if begun else 1), "\n".join(held)))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("file", "at", "odd", "value")]
        for file, at, odd, value in zip(*columns, strict=True):
            if (file, at) != now:
                close()
                now, held, inside = (file, at), [], odd
                begun, header = not odd, at == 0
            held.append(value)
            if value.count('"') % 2:
                inside = not inside
            if not inside:
                if not header:
                    out.append((*now, 0 if begun else 1, "\n".join(held)))
                held, begun, header = [], True, False
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
            out = []
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)


def csv_records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """(file, at, record): the records of CSV files, a record that crosses splits put together.

    Only such pieces, two a split at most, are shuffled.
    """
    rows = lines.join(F.broadcast(splits.select("file", "at", "odd")), ["file", "at"])
    parts = rows.select("file", "at", "odd", "value").mapInArrow(_records, "file string, at long, part int, record string")
    parts = sized(parts)
    pieces = parts.where("part > 0")
    # A record that crosses splits begins where a piece begins one.
    since = Window.partitionBy("file").orderBy("at", "part").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumn("begin", F.max(F.when(F.col("part") == 2, F.col("at"))).over(since))
    whole = pieces.groupBy("file", "begin").agg(F.min("at").alias("at"), F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("at", "part", "record"))), lambda p: p["record"]), "\n").alias("record"))
    return parts.where("part = 0").select("file", "at", "record").unionByName(whole.select("file", "at", "record"))


def read_csv(spark: SparkSession, paths: Sequence[str], schema: T.StructType = ARTICLE,
             multi_line: bool = True) -> DataFrame:
    """CSV files with a header each, as one table; columns are matched by name.

    Values in quotes may hold line breaks and doubled quotes.  A file is read
    in splits all the same: a first pass counts the quotes of every split, so
    the second knows which splits begin inside a value; it also brings the
    headers, which are one line each.  Files with equal headers are read
    together, so there is one plan per header and not one per file.  Values
    that do not fit the type of ``schema`` are null.  Files that have quotes
    inside unquoted values but no line breaks inside values are read by lines
    when ``multi_line`` is off.
    """
    types = {f.name: f.dataType for f in csv_schema(schema).fields}
    splits = sized(csv_splits(_lines(spark, paths)))
    headers = splits.where("at = 0").select("file", F.rtrim(F.ltrim("first", F.lit("\ufeff")), F.lit("\r")).alias("header"))
    groups = headers.groupBy("header").agg(F.collect_list("file").alias("files")).orderBy("header").collect()
    frames = []
    for group in groups:
        files = [unquote(f) for f in group["files"]]
        # The names a CSV reader makes of the header, so repeated and empty ones too.
        names = spark.read.options(**CSV_READ).csv(files[0]).columns
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        if multi_line:
            records = csv_records(_lines(spark, files), splits).select(F.rtrim("record", F.lit("\r")).alias("record"))
            raw = records.where(F.col("record") != "").select(F.from_csv(
                "record", text.toDDL(), {**CSV_READ, "header": "false"}).alias("row")).select("row.*")
        else:
            raw = spark.read.options(**CSV_READ).option("multiLine", False).schema(text).csv(files)
        frames.append(raw.select(*[F.col(f"`{c}`").try_cast(types.get(c, T.StringType())).alias(c) for c in raw.columns]))
    if not frames:
        return parse_nested(spark.createDataFrame([], csv_schema(schema)), schema)
    return parse_nested(stack(frames), schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType = ARTICLE) -> DataFrame:
    """An article table; a path that ends in ``.csv`` is CSV, anything else Parquet.

    Columns of the CSV are matched by name, so files with fewer columns or
    another order work.
    """
    return read_csv(spark, [path], schema) if is_csv(path) else spark.read.parquet(path)


def read_tables(spark: SparkSession, paths: str | Sequence[str], file_format: str = "parquet",
                schema: T.StructType = ARTICLE) -> DataFrame:
    """All files of a folder pattern as one table; columns may differ between files."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    try:
        if file_format.lower() == "csv":
            return read_csv(spark, [p if is_csv(p) else f"{p}/*.csv" for p in paths], schema)
        return spark.read.option("mergeSchema", "true").parquet(*paths)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no {file_format} files under {', '.join(paths)}") from e
        raise


def standardise_gold(df: DataFrame, names: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Gold rows with columns ``text`` and ``label``, labels as lower-case words.

    ``names`` lists for either the columns it may come from, the first that
    exists counts; a column that already has the standard name goes before
    them.  Labels may be class numbers of any numeric type, also as text.
    Columns that are found under neither name are left out; all others stay.
    """
    found = {}
    for standard in ("text", "label"):
        wanted = [standard, *(names or {}).get(standard, ())]
        found[standard] = next((c for c in wanted if c in df.columns), None)
    columns = [F.col(c) for c in df.columns if c not in {*found.values(), "text", "label", "source", "dataset_type"}]
    if found["text"]:
        columns.append(F.col(found["text"]).alias("text"))
    if found["label"]:
        word = F.lower(F.trim(F.col(found["label"]).cast("string")))
        number = F.when(word.rlike(r"^[0-9]+([.]0*)?$"), word.try_cast("double").cast("int"))
        columns.append(F.coalesce(F.lower(id_to_label(number)), word).alias("label"))
    return df.select(*columns, F.lit(GOLD_SOURCE).alias("source"), F.lit(GOLD_TYPE).alias("dataset_type"))


def latest_snapshot(df: DataFrame, by: Sequence[str] = ("ticker",), date: str = "batch_date") -> DataFrame:
    """Rows of the newest batch of every ticker.

    On a table partitioned by these columns the newest batches follow from the
    folders alone, and no file is opened for them; a batch is there if its
    folder holds a file.  The batch dates found (no more than there are days)
    prune the partitions of the second pass.
    """
    spark, setting = df.sparkSession, "spark.sql.optimizer.metadataOnly"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        newest = sized(df.groupBy(*by).agg(F.max(date).alias(date)))
    finally:
        spark.conf.set(setting, before)
    dates = [r[0] for r in newest.select(date).distinct().collect()]
    return df.where(F.col(date).isin(dates)).join(newest, [*by, date], "left_semi")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Distribute the rows of a scan before costly text work when it has few splits.

    A no-op once the scan alone gives every core something to do.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
