"""Exact, reproducible samples and splits.

The random order is a hash of a row key, so a result does not depend on how
the table is partitioned.  ``key`` must identify a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toneflow.operators.ranking import assign_parts, bounded_levels, hash_cell, hash_key, take_first
from toneflow.schemas import LABELS


def _shuffled(df: DataFrame, key: str, seed: int) -> tuple[DataFrame, Column, list[Column]]:
    hashed = df.withColumn("_h", hash_key(F.col(key), seed))
    return hashed, hash_cell(F.col("_h")), [F.col("_h"), F.col(key)]


def sample_rows(df: DataFrame, n: int | None, key: str = "hash", seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement; all rows for a falsy ``n``."""
    if not n:
        return df
    hashed, cell, order = _shuffled(df, key, seed)
    return take_first(hashed, lambda total: F.lit(n), cell, order).drop("_h")


def balanced_sample(df: DataFrame, n: int, key: str, label: str = "label",
                    labels: Sequence[str] = LABELS, seed: int = 42) -> DataFrame:
    """``n // len(labels)`` rows of each label, all rows of a smaller class.

    Column ``shuffle_key`` carries the order that mixes the classes.
    """
    per_label = n // len(labels)
    hashed, cell, order = _shuffled(df.where(F.col(label).isin(*labels)), key, seed)
    return take_first(hashed, lambda total: F.lit(per_label), cell, order, [label]) \
        .withColumnRenamed("_h", "shuffle_key")


def _tail(total: Column, ratio: float) -> Column:
    """Rows of a stratum that go to the held-out side, rounded up."""
    return F.ceil(F.round(total * F.lit(ratio), 9))


def stratified_split(df: DataFrame, key: str, label: str = "label",
                     held_out: Sequence[tuple[str, float]] = (("val", 0.2),),
                     seed: int = 42) -> DataFrame:
    """Add column ``split``: the named shares of every label, the rest ``train``.

    ``held_out=(("val", .1), ("test", .1))`` gives a three-way split: the
    shares are cut off together and then divided.
    """
    return _split(df, *_shuffled(df, key, seed), [label], held_out)


def random_split(df: DataFrame, key: str, held_out: Sequence[tuple[str, float]] = (("val", 0.2),),
                 seed: int = 42) -> DataFrame:
    """Add column ``split`` for tables without a publish date."""
    return _split(df, *_shuffled(df, key, seed), [], held_out)


def time_split(df: DataFrame, key: str, ts: str = "published_at",
               held_out: Sequence[tuple[str, float]] = (("val", 0.2),)) -> DataFrame:
    """Add column ``split``: the newest rows are held out, ties broken by key.

    Rows without a time count as the oldest.
    """
    name, time = F.col(key).cast("string"), F.col(ts).cast("timestamp")
    hours = F.coalesce(-F.floor(F.unix_seconds(time) / 3600), F.lit(1 << 60))
    finer = bounded_levels(time, name)[2:]
    return _split(df, df, hours, [time.desc(), name], [], held_out, finer)


def _split(df: DataFrame, keyed: DataFrame, cell: Column, order: Sequence[Column],
           strata: Sequence[str], held_out: Sequence[tuple[str, float]],
           inside: Sequence[Sequence[tuple[Column, bool]]] = ()) -> DataFrame:
    share = sum(ratio for _, ratio in held_out)
    quotas, upto = [], 0.0
    for _, ratio in held_out:
        upto += ratio
        # Later cuts divide the held-out rows, so that the parts add up exactly.
        quotas.append(lambda total, part=upto / share: F.ceil(F.round(_tail(total, share) * part, 9)))
    names = F.array(*[F.lit(n) for n, _ in held_out], F.lit("train"))
    return (
        assign_parts(keyed, quotas, cell, order, strata, "_part", inside)
        .withColumn("split", F.element_at(names, F.col("_part") + 1))
        .select(*df.columns, "split")
    )


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    share = totals.select((F.col("rows") / F.col("classes"))).scalar()
    return counts.withColumn("weight", share / F.col("n"))
