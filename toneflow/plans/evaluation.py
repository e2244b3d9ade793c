"""Gold labels and models to a comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from toneflow.operators import evaluate as E
from toneflow.operators.model import ScorerFactory, long_predictions, score_wide
from toneflow.operators.sampling import balanced_sample
from toneflow.session import sized


@dataclass(frozen=True)
class Comparison:
    """Tables of one comparison; all but ``predictions`` have a handful of rows."""

    predictions: DataFrame
    accuracy: DataFrame
    class_accuracy: DataFrame
    report: DataFrame
    confusion: DataFrame
    distribution: DataFrame
    confidence: DataFrame
    agreement: DataFrame
    winner: DataFrame


def compare(predictions: DataFrame, models: Sequence[str], base: str | None = None,
            wide: DataFrame | None = None) -> Comparison:
    """All metrics of long predictions; agreement over rows where ``base`` names a tone.

    Predictions are counted once, and every table of labels is made from the
    counts.  ``wide`` has the same predictions side by side; without it they
    are brought together by row.
    """
    count = sized(E.counts(predictions))
    return Comparison(
        predictions=predictions,
        accuracy=E.accuracy(count),
        class_accuracy=E.class_accuracy(count),
        report=E.classification_report(count),
        confusion=E.confusion_matrix(count),
        distribution=E.prediction_distribution(count),
        confidence=E.confidence_summary(predictions),
        agreement=E.agreement(E.to_wide(predictions, models) if wide is None else wide, models, base or models[0]),
        winner=E.winner(E.accuracy(count), models),
    )


def compare_models(gold: DataFrame, scorers: Mapping[str, ScorerFactory], key: str,
                   text: str = "text", sample: int | None = None) -> Comparison:
    """Score gold texts, optionally a balanced sample of them, with every model.

    Answers are held: models are costly and several tables read them.
    """
    if sample:
        gold = balanced_sample(gold, sample, key)
    wide = score_wide(gold, text, scorers, key).persist()
    return compare(long_predictions(wide, list(scorers)), list(scorers), wide=wide)
