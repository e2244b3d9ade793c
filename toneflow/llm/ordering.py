"""Numbers of rows in a total order, without a task that sees a whole table or group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toneflow.llm.tables import OWN, stored

#: Bits of monotonically_increasing_id() that count rows within a partition.
WITHIN = 33


def numbered(rows: DataFrame, *order: Column) -> tuple[DataFrame, int]:
    """``rows`` with ``number``, their place from 0 in the order given, and how many they are.

    The order should tell most rows apart; rows it does not tell apart are told
    apart by their place in the input, so that equal rows spread over tasks.
    Two small tables are as long as there are partitions.
    """
    rows = stored(rows.withColumn(f"{OWN}place", F.monotonically_increasing_id()), "places")
    keys = [*order, F.col(f"{OWN}place")]
    placed = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        f"{OWN}at", F.monotonically_increasing_id()).drop(f"{OWN}place"), "order")
    part = F.shiftright(f"{OWN}at", WITHIN)
    counts = placed.groupBy(part.alias(f"{OWN}part")).agg(F.count("*").alias(f"{OWN}rows"))
    ahead = F.sum(f"{OWN}rows").over(Window.orderBy(f"{OWN}part").rowsBetween(Window.unboundedPreceding, -1))
    counts = stored(counts.withColumn(f"{OWN}ahead", F.coalesce(ahead, F.lit(0))), "offsets")
    n = counts.agg(F.sum(f"{OWN}rows")).first()[0] or 0
    out = placed.withColumn(f"{OWN}part", part).join(F.broadcast(counts.drop(f"{OWN}rows")), f"{OWN}part")
    number = F.col(f"{OWN}ahead") + F.col(f"{OWN}at") - F.shiftleft(F.col(f"{OWN}part"), WITHIN)
    return out.withColumn("number", number).drop(f"{OWN}part", f"{OWN}ahead", f"{OWN}at"), n


def positions(rows: DataFrame, group: str, *order: Column) -> DataFrame:
    """``rows`` with ``pos``, their place from 0 in the order given within their group; nulls are a group."""
    rows, _ = numbered(rows, F.col(group).asc_nulls_first(), *order)
    rows = stored(rows, "numbered")
    heads = rows.groupBy(F.col(group).alias(f"{OWN}group")).agg(F.min("number").alias(f"{OWN}head"))
    # A group with a third of the rows is split by adaptive execution, since the heads are one row a group.
    out = rows.join(stored(heads, "heads"), F.col(group).eqNullSafe(F.col(f"{OWN}group")))
    return out.withColumn("pos", F.col("number") - F.col(f"{OWN}head")).drop("number", f"{OWN}group", f"{OWN}head")
