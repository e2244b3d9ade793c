"""Labelled table to trained and evaluated model."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toneflow.operators import model as M
from toneflow.operators.evaluate import counts, training_metrics
from toneflow.operators.sampling import stratified_split, time_split
from toneflow.session import sized


@dataclass(frozen=True)
class Training:
    """Outcome of a training run."""

    variant: str
    model: PipelineModel
    tried: list[tuple]
    metrics: DataFrame
    history: list[tuple]


def with_label(df: DataFrame) -> DataFrame:
    """Gold tables name their label ``label``, weakly labelled ones ``weak_label``."""
    return df if "label" in df.columns else df.withColumn("label", F.col("weak_label"))


def split(df: DataFrame, key: str, by_time: bool = False) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows: the newest fifth, or a fifth of every label."""
    parts = sized((time_split if by_time else stratified_split)(df, key))
    return parts.where("split = 'train'"), parts.where("split = 'val'")


def fine_tune(df: DataFrame, key: str, by_time: bool = False, metric: str = "loss",
              variants: Mapping[str, float] | None = None, path: str | None = None,
              weights_from_all: bool = False, **settings: int) -> Training:
    """Split, weight, train all variants, keep the best, evaluate it, save it if asked.

    Class weights come from the training rows unless ``weights_from_all``.  The
    history is that of the kept variant, with validation values.
    """
    rows = with_label(df)
    train, val = split(rows, key, by_time)
    kept = M.select_variant(train, val, metric, variants, rows if weights_from_all else None, **settings)
    if path:
        kept.model.write().overwrite().save(path)
    pairs = M.predict(kept.model, val).select(
        F.lit(kept.variant).alias("model"), F.col("label").alias("true_label"), "pred")
    return Training(kept.variant, kept.model, kept.tried, training_metrics(counts(pairs)), kept.histories[kept.variant])
