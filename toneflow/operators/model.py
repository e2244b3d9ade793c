"""Training and applying tone classifiers."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from toneflow.functions.labels import decide, label_to_id, normalise_label
from toneflow.operators.evaluate import classification_report, counts
from toneflow.operators.sampling import class_weights
from toneflow.operators.softmax import as_model, fit_all
from toneflow.session import sized


class Scorer(Protocol):
    """Any model that labels a batch of texts."""

    def predict(self, texts: list[str]) -> list[dict]:
        """One ``{"label": str, "probs": {name: float}}`` per text."""


ScorerFactory = Callable[[], Scorer | None]

#: Texts that a model is given at a time.
BATCH = 1000


def scored(text: Column, factories: Sequence[ScorerFactory]) -> Column:
    """Struct (label0, probs0, label1, probs1, ...) of a text from plugged-in models.

    Factories run once per Python worker, which serves one core of an executor
    for many tasks, and texts reach all models in one stream of batches of
    ``BATCH``.  Texts that fail are labelled ``ERROR``, all texts ``N/A`` where
    a factory gives no model.  ``failures`` counts the former.
    """
    # Nested, so that it travels to the executors by value.
    def label(scorer: Scorer | None, texts: list[str]) -> list[tuple[str, dict[str, float]]]:
        if scorer is None:
            return [("N/A", {})] * len(texts)
        try:
            return [(r["label"], r["probs"]) for r in scorer.predict(texts)]
        except Exception:
            # One bad text must not take its batch along.
            if len(texts) == 1:
                return [("ERROR", {})]
            return [label(scorer, [t])[0] for t in texts]

    def load() -> Callable[[np.ndarray], np.ndarray]:
        scorers = [factory() for factory in factories]

        def answer(texts: np.ndarray) -> np.ndarray:
            values = [t if isinstance(t, str) else "" for t in texts.tolist()]
            answers = zip(*[label(s, values) for s in scorers], strict=True)
            return np.array([json.dumps({k: v for i, (name, probs) in enumerate(row) for k, v in (
                (f"label{i}", name), (f"probs{i}", {str(p): float(x) for p, x in probs.items()}))}) for row in answers], object)

        return answer

    # Answers travel as JSON: maps are no return type of a batch function.
    fields = ", ".join(f"label{i} string, probs{i} map<string,double>" for i in range(len(factories)))
    return F.from_json(predict_batch_udf(load, return_type=StringType(), batch_size=BATCH)(text), fields)


def confidence(probs: Column) -> Column:
    """Highest probability, 0 when there is none."""
    return F.coalesce(F.array_max(F.map_values(probs)), F.lit(0.0))


def score_texts(df: DataFrame, text: str, factory: ScorerFactory) -> DataFrame:
    """Add ``model_label``, ``model_probs`` and ``model_confidence`` from a plugged-in model."""
    return df.withColumn("_scored", scored(F.col(text), [factory])).withColumns({
        "model_label": F.col("_scored.label0"),
        "model_probs": F.col("_scored.probs0"),
        "model_confidence": confidence(F.col("_scored.probs0")),
    }).drop("_scored")


def failures(predictions: DataFrame) -> DataFrame:
    """How many texts each model failed on, so that a broken model is noticed."""
    return predictions.groupBy("model").agg(F.sum((F.col("raw_label") == "ERROR").cast("bigint")).alias("n_failed"),
                                            F.count(F.lit(1)).alias("n"))


def score_with_all(df: DataFrame, text: str, scorers: Mapping[str, ScorerFactory], key: str,
                   label: str = "label") -> DataFrame:
    """Long predictions of several models, one pass over the texts.

    Labels are brought to the common names; the original stays in ``raw_label``.
    """
    return long_predictions(score_wide(df, text, scorers, key, label), list(scorers))


def score_wide(df: DataFrame, text: str, scorers: Mapping[str, ScorerFactory], key: str, label: str = "label") -> DataFrame:
    """One row per text: row_id, true_label, the models' answers in ``_s``, and ``<model>_prediction`` of each."""
    found = df.select(F.col(key).alias("row_id"), F.col(label).alias("true_label"),
                      scored(F.col(text), list(scorers.values())).alias("_s"))

    def common(name: str) -> Column:
        return F.when(F.col(name).isin("ERROR", "N/A"), F.col(name)).otherwise(normalise_label(F.col(name)))

    return found.withColumns({f"{m}_prediction": common(f"_s.label{i}") for i, m in enumerate(scorers)})


def long_predictions(wide: DataFrame, models: Sequence[str]) -> DataFrame:
    """Rows (row_id, model, true_label, pred, confidence, probs, raw_label) of wide answers."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(f"{m}_prediction").alias("pred"), F.col(f"_s.probs{i}").alias("probs"),
                 F.col(f"_s.label{i}").alias("raw_label")) for i, m in enumerate(models)]))
    return wide.select("row_id", "true_label", rows.alias("r")).select(
        "row_id", "r.model", "true_label", "r.pred", confidence(F.col("r.probs")).alias("confidence"), "r.probs", "r.raw_label")


def with_class_weights(df: DataFrame, basis: DataFrame | None = None) -> DataFrame:
    """Add column ``weight``, balanced over ``basis`` (the rows themselves by default).

    Fails when a label is null or not in ``basis``: such rows have no weight,
    and dropping them would change the training set without a word.
    """
    table = class_weights(df if basis is None else basis).select("label", "weight").collect()  # one row per class
    known = F.create_map(*[F.lit(x) for r in table for x in (r["label"], float(r["weight"]))]) if table else None
    weight = F.try_element_at(known, F.col("label")) if table else F.lit(None).cast("double")
    problem = F.concat(F.lit("no class weight for label "), F.coalesce(F.col("label").cast("string"), F.lit("null")))
    return df.withColumn("weight", F.coalesce(weight, F.raise_error(problem).cast("double")))


FEATURES = 1 << 16


def text_features(features: int = FEATURES) -> Pipeline:
    """Words of a text, hashed and weighted by rarity."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="words", pattern=r"[^\p{L}']+"),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="features"),
    ])


def _with_label_id(df: DataFrame) -> DataFrame:
    return df.withColumn("label_id", label_to_id(F.col("label")).cast("double"))


def train(df: DataFrame, reg_param: float = 0.01, basis: DataFrame | None = None,
          features: int = FEATURES, max_iter: int = 20) -> PipelineModel:
    """Fit on (text, label) with balanced class weights."""
    return select_variant(df, None, variants={"only": reg_param}, basis=basis,
                          features=features, max_iter=max_iter).model


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``pred``, ``confidence`` and ``probs``; stays in the JVM."""
    output = model.transform(df.withColumn("text", F.coalesce("text", F.lit(""))))
    best = decide(vector_to_array("probability"))
    return output.withColumn("_best", best).select(
        *df.columns, F.col("_best.label").alias("pred"),
        F.col("_best.confidence").alias("confidence"), F.col("_best.probs").alias("probs"))


# Regularisation of the three training variants.
VARIANTS = {"original": 0.01, "improved": 0.05, "aggressive": 0.3}


def prepared(train_rows: DataFrame, val_rows: DataFrame | None, basis: DataFrame | None = None,
             features: int = FEATURES) -> tuple[PipelineModel, DataFrame]:
    """The fitted feature extraction and the stored features of all rows; ``weight`` is null in validation rows.

    Validation rows without a known label have no loss and are left out.
    """
    if train_rows.isEmpty():
        raise ValueError("there are no rows to train on")
    ready = _with_label_id(with_class_weights(train_rows, basis))
    extract = text_features(features).fit(ready)
    columns = ["features", "label_id", "weight"]
    rows = extract.transform(ready).select(*columns)
    if val_rows is not None:
        known = _with_label_id(val_rows).where("label_id IS NOT NULL").withColumn("weight", F.lit(None).cast("double"))
        rows = rows.union(extract.transform(known).select(*columns))
    return extract, sized(rows)


@dataclass(frozen=True)
class Selection:
    """The kept variant, its model, rows (variant, regularisation, loss, accuracy), and the history of every variant."""

    variant: str
    model: PipelineModel
    tried: list[tuple[str, float, float | None, float | None]]
    histories: dict[str, list[tuple]]


def select_variant(
    train_rows: DataFrame, val_rows: DataFrame | None, metric: str = "loss",
    variants: Mapping[str, float] | None = None, basis: DataFrame | None = None,
    features: int = FEATURES, max_iter: int = 20,
) -> Selection:
    """Train every variant and keep the best on the validation rows.

    ``metric`` is ``loss`` (lowest) or ``accuracy`` (highest); without
    validation rows the first variant is kept.  Texts are turned into features
    once, and a pass over them steps all variants and judges the points they
    were at on the validation rows.
    """
    extract, rows = prepared(train_rows, val_rows, basis, features)
    fits, deviations = fit_all(rows, variants or VARIANTS, features, max_iter)
    tried = [(name, fit.reg_param, *fit.scores) for name, fit in fits.items()]
    best = tried[0][0] if tried[0][2] is None else best_variant(tried, metric)
    model = PipelineModel(stages=[*extract.stages, as_model(fits[best], deviations)])
    return Selection(best, model, tried, {name: fit.history for name, fit in fits.items()})


def best_variant(tried: Sequence[tuple[str, float, float, float]], metric: str = "loss") -> str:
    """The variant with the lowest ``loss`` or the highest ``accuracy``, the first one on ties."""
    return min(tried, key=lambda t: t[2] if metric == "loss" else -t[3])[0]


def evaluate(model: PipelineModel | str, df: DataFrame) -> DataFrame:
    """Per-label scores of a model, given or loaded from a folder, on labelled rows."""
    if isinstance(model, str):
        model = PipelineModel.load(model)
    pairs = predict(model, df).select(
        F.lit("model").alias("model"), F.col("label").alias("true_label"), "pred")
    return classification_report(counts(pairs))


HISTORY = "iteration int, loss double, eval_loss double, eval_accuracy double"


def complete_rows(history: DataFrame) -> DataFrame:
    """History rows that have every value."""
    return history.na.drop()
