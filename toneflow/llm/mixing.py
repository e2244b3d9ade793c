"""Mixing sources to target weights by weighted fair queueing, in SQL functions only.

Every document of a source waits in a shuffled queue; the virtual finish time
of a copy is the number of tokens of its source up to its end, divided by the
source's target.  All queues are then merged in the order of finish times and
cut where the total budget is spent.

No queue is sorted by one task.  The shuffle key of a document is a hash; its
leading digits are a cell, cells are summed per source, and rows are ordered
within cells only.  Copies are sorted by finish time in ranges; the sums of the
ranges tell in which one the budget ends, and only that one is summed row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toneflow.llm.tables import OWN, stored

#: Leading hex digits of a shuffle key that name its cell.
CELL_DIGITS = 3


def size_in_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII blanks; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def targets(sizes: DataFrame, weights: list[float], budget: float, epochs: int) -> DataFrame:
    """(source, source_size, weight, target) of every source of (source, size).

    Sources in the order of code points, nulls last, have the weights in turn.
    The budget, a multiple of all sizes, is shared by weight, no source gets
    more than ``epochs`` times its size, and what is above goes to the others by
    weight: a target is min(level * weight, cap) with the level that spends it all.
    """
    of = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    of = stored(of.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (n % len(weights) + 1).cast("int"))),
                "sources")
    cap = F.col("source_size") * F.lit(epochs)
    # Sources fill up in the order of cap / weight.  Before this one is full, all earlier ones are.
    by = Window.orderBy((cap / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    of = of.withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * F.lit(budget))
    of = of.withColumn("cap", cap).withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0)))
    of = of.withColumn("open", F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)))
    level = (F.col("budget") - F.col("full")) / F.col("open")
    # The first source that stays below its cap sets the level for all that follow.
    level = F.when(level * F.col("weight") < F.col("cap"), level)
    of = of.withColumn("level", F.first(level, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return of.select("source", "source_size", "weight", F.coalesce(
        F.least(F.col("level") * F.col("weight"), F.col("cap")), F.col("cap")).cast("double").alias("target"))


def numbered(sizes: DataFrame, seed: int) -> DataFrame:
    """Add ``order``, the shuffle key of a row, to (id, source, size, hash, nth).

    It is a hash of id and size.  Rows that share it, as null ids and repeated
    rows do, get a hash of source and text instead, and of a number where these
    agree too: they spread over the queue, and which row has which number
    changes nothing that can be seen.  Numbers run on over the partitions that
    ``nth`` names in its upper bits, so equal rows are never in one task.
    """
    base = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("-")), F.col("size").cast("string")))
    rows = sizes.withColumn("base", base).withColumn("part", F.shiftright("nth", 33)).withColumn(
        "same", F.md5(F.concat_ws("|", "base", F.coalesce(F.col("hash").cast("string"), F.lit("-")), F.col("source"))))
    shared = rows.groupBy("base").agg(F.count("*").alias("n")).filter("n > 1").select("base", F.lit(True).alias("shared"))
    within = F.row_number().over(Window.partitionBy("same", "part").orderBy("nth"))
    earlier = Window.partitionBy("same").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = rows.groupBy("same", "part").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(earlier))
    ahead = stored(ahead.filter("before > 0").select("same", "part", "before"), "repeats")
    number = F.col("within") + F.coalesce("before", F.lit(0))
    out = rows.withColumn("within", within).join(ahead, ["same", "part"], "left").join(stored(shared, "shared"), "base", "left")
    order = F.when(F.col("shared"), F.md5(F.concat_ws("|", "same", number.cast("string")))).otherwise(F.col("base"))
    return out.select(*sizes.columns, order.alias("order"))


def queue(sizes: DataFrame, shares: DataFrame, epochs: int, seed: int) -> DataFrame:
    """(id, source, size, nth, order, copy, source_size, target, finish): every copy of a row of some size with its virtual finish time."""
    source = F.col("source").isNull(), F.coalesce("source", F.lit(""))
    rows = numbered(sizes.filter("size > 0"), seed).withColumn("cell", F.substring("order", 1, CELL_DIGITS))
    rows = stored(rows.withColumn("no_source", source[0]).withColumn("source", source[1]), "shuffled")
    cells = rows.groupBy("no_source", "source", "cell").agg(F.sum("size").alias("cell_size"))
    earlier = Window.partitionBy("no_source", "source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = stored(cells.withColumn("ahead", F.coalesce(F.sum("cell_size").over(earlier), F.lit(0))).drop("cell_size"), "cells")
    within = Window.partitionBy("no_source", "source", "cell").orderBy("order", "nth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(within)).join(cells, ["no_source", "source", "cell"])
    shares = shares.select(F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source"),
                           "source_size", "target")
    rows = rows.join(shares, ["no_source", "source"]).filter("target > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    finish = (F.col("ahead") + F.col("upto") + F.col("copy") * F.col("source_size")) / F.col("target")
    return rows.select("id", F.when(~F.col("no_source"), F.col("source")).alias("source"), "size", "nth", "order", "copy",
                       "source_size", "target", finish.alias("finish"))


def mix(docs: DataFrame, weights: list[float], budget: float = 1.5, epochs: int = 2, seed: int = 7,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", nth: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The copies that are taken, the targets of the sources, and the sizes of the documents.

    Copies are (id, source, size, nth, order, copy, source_size, target, finish,
    range): ranges follow each other in the order of ``finish``, and the rows of
    one are stored in that order.  ``nth`` is the place of a row of ``docs``, a
    stored ``monotonically_increasing_id`` if it is given.  Whole documents are
    taken, so a source ends within one document of its target.  Texts without
    words are never taken; a null source is a source of its own; equal rows and
    null ids queue like others, every row for itself.  Without words at all no
    copy is taken.
    """
    sizes = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size_in_words(F.col(text_col)).alias("size"),
                               F.xxhash64(text_col).alias("hash"), (F.monotonically_increasing_id() if nth is None else nth).alias("nth")), "sizes")
    shares = stored(targets(sizes, weights, budget, epochs), "targets")
    place = ["finish", "source", "id", "size", "copy", "order"]
    ranged = queue(sizes, shares, epochs, seed).repartitionByRange(*place).sortWithinPartitions(*place)
    copies = stored(ranged.withColumn("range", F.spark_partition_id()), "queue")
    # Not the sum of the targets, whose last bits depend on the order of adding.
    total = (shares.agg(F.sum("source_size")).first()[0] or 0) * min(budget, epochs)
    sums = copies.groupBy("range").agg(F.sum("size").alias("range_size"))
    running = F.sum("range_size").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
    first = sums.withColumn("upto", running).filter(F.col("upto") > total).orderBy("range").first()
    if first is None:
        return copies, shares, sizes
    at, ahead = first["range"], first["upto"] - first["range_size"]
    upto = F.sum("size").over(Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, 0))
    last = copies.filter(F.col("range") == at).withColumn("upto", upto).filter(F.col("upto") + F.lit(ahead) <= F.lit(total)).drop("upto")
    return copies.filter(F.col("range") < at).union(last), shares, sizes


def taken(docs: DataFrame, weights: list[float], budget: float = 1.5, epochs: int = 2, seed: int = 7,
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken) of every row of ``docs``; ``taken`` counts words, repeats included."""
    copies, shares, sizes = mix(docs, weights, budget, epochs, seed, id_col, text_col, source_col)
    took = copies.groupBy("nth").agg(F.sum("size").alias("taken"))
    source = F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source")
    named = shares.select(*source, "source_size", "target")
    out = sizes.select("id", *source, "size", "nth").join(took, "nth", "left").join(named, ["no_source", "source"])
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixture(docs: DataFrame, weights: list[float], budget: float = 1.5, epochs: int = 2, seed: int = 7,
            id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the mix takes, with ``taken`` words, ``copies`` and ``finish_times``.

    A reader that goes through the copies in the order of ``finish_times``
    meets the sources in their target shares from the start.  Columns of
    ``docs`` with these names are replaced.  Every row has its own copies, at
    most ``epochs``, also where rows repeat or ids are null.
    """
    row, new = f"{OWN}row", ("taken", "copies", "finish_times")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    copies, _, _ = mix(rows, weights, budget, epochs, seed, id_col, text_col, source_col, F.col(row))
    of = copies.groupBy(F.col("nth").alias(row)).agg(
        F.sum("size").alias(f"{OWN}taken"), F.sort_array(F.collect_list("finish")).alias(f"{OWN}times"))
    out = rows.drop(*new).join(stored(of, "decisions"), row)
    times = F.col(f"{OWN}times")
    return out.withColumn("taken", F.col(f"{OWN}taken")).withColumn("copies", F.size(times)).withColumn(
        "finish_times", times).drop(row, f"{OWN}taken", f"{OWN}times")
