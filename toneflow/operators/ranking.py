"""Ordered cuts and row numbers without sorting a whole group in one task.

A group may hold most of a table, so neither a window over the group nor a
global sort is safe.  Both operators split every group into cells, coarse keys
that respect the wanted order (a day, a page number, the head of a hash), count
the cells, and work out positions from the running counts.  Only rows inside
one cell are ever sorted together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toneflow.session import sized

Quota = Callable[[Column], Column]


def hash_key(key: Column, seed: int = 42) -> Column:
    """A reproducible pseudo-random order: MD5 of seed and key, as hex text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def hash_cell(hashed: Column, digits: int = 4) -> Column:
    """Leading hex digits of a hash: 65,536 cells of equal expected size."""
    return F.substring(hashed, 1, digits)


def assign_parts(
    df: DataFrame,
    quotas: Sequence[Quota],
    cell: Column,
    order: Sequence[Column],
    strata: Sequence[str] = (),
    name: str = "part",
    inside: Sequence[Sequence[tuple[Column, bool]]] = (),
) -> DataFrame:
    """Number the part each row falls into when its stratum is cut in order.

    Every quota maps the size of a stratum to the position of one cut.  A row
    gets the number of cuts that lie at or before its position, so a single
    quota ``lambda n: F.lit(10)`` gives part 0 to the first ten rows.  ``cell``
    must not decrease along ``order`` nor be null, and ``order`` must identify a
    row.

    ``df`` is read three times here, so it should be a stored table.  All but one
    cell per cut is decided by comparing cells; the rows of the
    cells that hold a cut are the only ones shuffled and ranked.  Cells that
    may be large themselves are ranked through the finer levels ``inside``.
    """
    keyed, joined, groups = _cut_cells(df, quotas, cell, strata)
    if joined is None:
        return df.withColumn(name, F.lit(0))

    numbers = range(len(quotas))
    on_cut = reduce(lambda a, b: a | b,
                    [F.col("_cell").eqNullSafe(F.col(f"_cell_{i}")) for i in numbers])
    past = {i: F.col("_cell") > F.col(f"_cell_{i}") for i in numbers}

    clear = joined.where(~on_cut).withColumn(name, _total([past[i] for i in numbers]))
    edge = number_rows(joined.where(on_cut), [*groups, "_cell"], inside, order, "_pos").withColumn(
        name,
        _total([
            past[i] | ((F.col("_cell") == F.col(f"_cell_{i}"))
                       & (F.col(f"_start_{i}") + F.col("_pos") >= F.col(f"_at_{i}")))
            for i in numbers
        ]),
    )
    columns = [*df.columns, name]
    return clear.select(*columns).unionByName(edge.select(*columns))


def _cut_cells(df: DataFrame, quotas: Sequence[Quota], cell: Column, strata: Sequence[str]) -> tuple:
    """The table with its cells; the same with the cell, start and position of every cut; the grouping columns."""
    keyed = df.withColumn("_cell", cell)
    by = [F.col(s).alias(f"_by_{s}") for s in strata] or [F.lit(0).alias("_by_")]
    groups = [f"_by_{s}" for s in strata] or ["_by_"]

    counts = keyed.groupBy(*by, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(*groups).orderBy("_cell")
    placed = (
        counts
        .withColumn("_end", F.sum("_n").over(running))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(*groups)))
    )
    # The first cell that reaches beyond a cut holds it; none does when the
    # quota covers the whole stratum.
    cuts = []
    for i, quota in enumerate(quotas):
        at = quota(F.col("_total")).cast("bigint")
        beyond = F.col("_end") > at
        cuts += [
            F.min(F.when(beyond, F.col("_cell"))).alias(f"_cell_{i}"),
            F.min(F.when(beyond, F.col("_end") - F.col("_n"))).alias(f"_start_{i}"),
            F.first(at).alias(f"_at_{i}"),
        ]
    cut = placed.groupBy(*groups).agg(*cuts)
    if strata:
        match = [F.col(s).eqNullSafe(F.col(f"_by_{s}")) for s in strata]
        joined = keyed.join(sized(cut), reduce(Column.__and__, match))
    else:
        # One row for the whole table: its values become constants.
        row = cut.first()
        if row is None or all(row[f"_cell_{i}"] is None for i in range(len(quotas))):
            return keyed, None, groups  # no rows, or no cut among them
        joined = keyed.withColumns(
            {f.name: F.lit(row[f.name]).cast(f.dataType) for f in cut.schema.fields})
    return keyed, joined, groups


def _total(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(f.cast("int"), F.lit(0)) for f in flags])


def take_first(
    df: DataFrame,
    quota: Quota,
    cell: Column,
    order: Sequence[Column],
    strata: Sequence[str] = (),
) -> DataFrame:
    """The rows of every stratum that come before its cut.

    Read twice: once to count cells, once for the rows up to the cell that
    holds the cut; only those are shuffled, and ranked within their cells.
    """
    keyed, joined, groups = _cut_cells(df, [quota], cell, strata)
    if joined is None:
        return df
    kept = joined.where(F.col("_cell_0").isNull() | (F.col("_cell") <= F.col("_cell_0")))
    position = F.row_number().over(Window.partitionBy(*groups, "_cell").orderBy(*order)) - 1
    ahead = F.col("_cell_0").isNull() | (F.col("_cell") < F.col("_cell_0"))
    kept = kept.withColumn("_pos", F.when(~ahead, position))
    return kept.where(ahead | (F.col("_start_0") + F.col("_pos") < F.col("_at_0"))).select(*df.columns)


def bounded_levels(time: Column, name: Column, newest_first: bool = True) -> list[list[tuple[Column, bool]]]:
    """Cells from days to single rows for an order by time, then name.

    Every cell has a bounded number of children: hours, minutes, seconds,
    milliseconds, microseconds, then the name two characters at a time.  So no
    side table of one cell grows with its rows, however many share a moment.
    """
    units = [[(F.date_trunc(unit, time), newest_first)]
             for unit in ("day", "hour", "minute", "second", "millisecond", "microsecond")]
    return units + [[(F.substring(name, 1, n), False)] for n in (2, 4, 6, 8, 12, 16, 24)]


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    levels: Sequence[Sequence[tuple[Column, bool]]],
    order: Sequence[Column],
    name: str = "index",
    cell_limit: int = 2_000_000,
) -> DataFrame:
    """Zero-based position of every row within its group.

    ``levels`` lists cells from coarse to fine, each a list of
    ``(expression, descending)``; sorting by all of them must agree with
    ``order``.  Cells of the first level are counted, running counts give their
    offsets, and rows are ranked inside a cell.  Only where a cell holds more
    than ``cell_limit`` rows is it divided by the next level.
    """
    if not levels:
        position = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
        return df.withColumn(name, position)

    # Group and cell travel as one struct: it matches nulls, and the join and
    # the window share the same partitioning.
    depth = len(levels)
    key, n, offset = f"_key{depth}", f"_n{depth}", f"_offset{depth}"
    cells = [(f"cell{j}", cell, desc) for j, (cell, desc) in enumerate(levels[0])]
    keyed = df.withColumn(key, F.struct(*by, *[cell.alias(c) for c, cell, _ in cells]))
    before = Window.partitionBy(*[F.col(f"{key}.{b}") for b in by]).orderBy(*[
        F.col(f"{key}.{c}").desc() if desc else F.col(f"{key}.{c}").asc() for c, _, desc in cells])
    counts = sized(
        keyed.groupBy(key).agg(F.count(F.lit(1)).alias(n))
        .withColumn(offset, F.sum(n).over(before) - F.col(n)))

    placed = keyed.join(counts, key)
    large = F.col(n) > cell_limit
    divide = depth > 1 and not counts.where(large).isEmpty()
    small = number_rows(placed.where(~large) if divide else placed, [key], [], order, name)
    parts = [small]
    if divide:
        parts.append(number_rows(placed.where(large), [key], levels[1:], order, name, cell_limit))
    columns = [*df.columns, (F.col(offset) + F.col(name)).alias(name)]
    return reduce(DataFrame.unionByName, [part.select(*columns) for part in parts])
