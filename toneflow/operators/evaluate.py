"""Evaluation of predictions.

Predictions are long, one row per (row_id, model).  They are counted once per
(model, true label, predicted label); every metric is derived from that count
table, whose size depends on the labels and not on the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toneflow.functions.labels import is_correct, round_confidence
from toneflow.schemas import LABELS


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def counts(predictions: DataFrame) -> DataFrame:
    """Rows per (model, true_label, pred)."""
    return predictions.groupBy("model", "true_label", "pred").agg(F.count(F.lit(1)).alias("n"))


def accuracy(count: DataFrame) -> DataFrame:
    """Rows, correct rows and accuracy per model."""
    hit = F.when(is_correct(F.col("pred"), F.col("true_label")), F.col("n")).otherwise(0)
    return count.groupBy("model").agg(F.sum("n").alias("n"), F.sum(hit).alias("n_correct")) \
        .withColumn("accuracy", _ratio(F.col("n_correct"), F.col("n")))


def class_accuracy(count: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Share of each true label that was predicted correctly."""
    hit = F.when(is_correct(F.col("pred"), F.col("true_label")), F.col("n")).otherwise(0)
    return (
        count.where(F.col("true_label").isin(*labels)).groupBy("model", "true_label")
        .agg(F.sum("n").alias("support"), F.sum(hit).alias("n_correct"))
        .withColumn("accuracy", _ratio(F.col("n_correct"), F.col("support")))
    )


def confusion_matrix(count: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """One row per model and true label, one column per predicted label, zeros included.

    One pass: a sum per cell of the matrix, turned into rows afterwards.
    """
    def cell(truth: str, pred: str) -> Column:
        return F.coalesce(F.sum(F.when((F.col("true_label") == truth) & (F.col("pred") == pred), F.col("n"))), F.lit(0))

    rows = F.explode(F.array(*[
        F.struct(F.lit(t).alias("true_label"), *[F.col(f"_{i}_{j}").alias(p) for j, p in enumerate(labels)])
        for i, t in enumerate(labels)])).alias("r")
    sums = count.groupBy("model").agg(*[
        cell(t, p).alias(f"_{i}_{j}") for i, t in enumerate(labels) for j, p in enumerate(labels)])
    return sums.select("model", rows).select("model", "r.*")


def _label_totals(count: DataFrame) -> DataFrame:
    """Support, predictions and hits per model and label, true or predicted."""
    hit = F.when(is_correct(F.col("pred"), F.col("true_label")), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("true_label").alias("label"), F.col("n").alias("support"),
                 zero.alias("predicted"), hit.cast("bigint").alias("hit")),
        F.struct(F.col("pred").alias("label"), zero.alias("support"),
                 F.col("n").alias("predicted"), zero.alias("hit")),
    )
    totals = count.select("model", F.explode(sides).alias("s")).groupBy("model", "s.label").agg(
        F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted"),
        F.sum("s.hit").alias("hit"))
    return totals.withColumns({
        "precision": _ratio(F.col("hit"), F.col("predicted")),
        "recall": _ratio(F.col("hit"), F.col("support")),
        "f1": _ratio(2 * F.col("hit"), F.col("predicted") + F.col("support")),
    })


REPORT = ("model", "label", "precision", "recall", "f1", "support")


def label_scores(count: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per model and label."""
    return _label_totals(count).select(*REPORT)


def classification_report(count: DataFrame) -> DataFrame:
    """Scores per label plus ``accuracy``, ``macro avg`` and ``weighted avg``.

    Labels that only occur as predictions take part with support 0 and pull
    the macro average down.
    """
    totals = _label_totals(count)
    metrics = ("precision", "recall", "f1")

    def row(name: str, value) -> Column:
        return F.struct(F.lit(name).alias("label"), *[value(m).alias(m) for m in metrics])

    summary = totals.groupBy("model").agg(
        F.sum("support").alias("support"),
        F.array(
            row("accuracy", lambda m: _ratio(F.sum("hit"), F.sum("support"))),
            row("macro avg", lambda m: F.avg(m)),
            row("weighted avg", lambda m: _ratio(F.sum(F.col(m) * F.col("support")), F.sum("support"))),
        ).alias("rows"),
    )
    overall = summary.select("model", F.explode("rows").alias("r"), "support") \
        .select("model", "r.*", "support")
    return totals.select(*REPORT).unionByName(overall)


def training_metrics(count: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Accuracy, macro precision, recall and F1, and one F1 column per label."""
    per_label = label_scores(count)
    macro = per_label.groupBy("model").agg(
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        *[F.coalesce(F.max(F.when(F.col("label") == x, F.col("f1"))), F.lit(0.0)).alias(f"f1_{x}")
          for x in labels])
    return accuracy(count).select("model", "accuracy").join(macro, "model")


def prediction_distribution(count: DataFrame) -> DataFrame:
    """Count and percentage of each predicted label per model."""
    total = count.groupBy("model").agg(F.sum("n").alias("_all"))
    return count.groupBy("model", "pred").agg(F.sum("n").alias("n")).join(total, "model") \
        .select("model", "pred", "n", (F.col("n") * 100.0 / F.col("_all")).alias("pct"))


def to_wide(predictions: DataFrame, models: Sequence[str], with_probs: Sequence[str] = (),
            with_raw: Sequence[str] = (), labels: Sequence[str] = LABELS) -> DataFrame:
    """One row per row_id with ``<model>_prediction``, ``_confidence`` and ``_correct``.

    Models named in ``with_probs`` add ``<model>_prob_<label>`` from column
    ``probs``, those in ``with_raw`` add ``<model>_raw_label`` from ``raw_label``.
    Probabilities are looked up by name, so their order does not matter.
    """
    def of(model: str, value: Column) -> Column:
        return F.max(F.when(F.col("model") == model, value))

    columns = []
    for m in models:
        columns += [
            of(m, F.col("pred")).alias(f"{m}_prediction"),
            of(m, F.col("confidence")).alias(f"{m}_confidence"),
            of(m, is_correct(F.col("pred"), F.col("true_label"))).alias(f"{m}_correct"),
        ]
        if m in with_raw:
            columns.append(of(m, F.col("raw_label")).alias(f"{m}_raw_label"))
        if m in with_probs:
            columns += [
                of(m, round_confidence(F.try_element_at("probs", F.lit(x)))).alias(f"{m}_prob_{x}")
                for x in labels]
    return predictions.groupBy("row_id", "true_label").agg(*columns)


def to_long(wide: DataFrame, models: Sequence[str], key: str = "row_id") -> DataFrame:
    """The inverse of :func:`to_wide`; also reads ``<model>_pred`` columns."""
    def column(m: str, *names: str) -> Column:
        found = [f"{m}_{n}" for n in names if f"{m}_{n}" in wide.columns]
        return F.col(found[0]) if found else F.lit(None)

    rows = F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), column(m, "prediction", "pred").cast("string").alias("pred"),
                 column(m, "confidence").cast("double").alias("confidence")) for m in models]))
    return wide.select(key, "true_label", rows.alias("_r")).select(
        key, "_r.model", "true_label", "_r.pred", "_r.confidence")


def agreement(wide: DataFrame, models: Sequence[str], base: str | None = None,
              base_labels: Sequence[str] = LABELS) -> DataFrame:
    """How often two models agree, for every pair of the declared models.

    ``base`` restricts the rows to those where that model predicts one of
    ``base_labels``.  A missing prediction agrees with nothing.  One pass: a
    sum per pair, no self-join.
    """
    if base:
        wide = wide.where(F.col(f"{base}_prediction").isin(*base_labels))
    pairs = list(combinations(models, 2))
    same = [F.sum(F.coalesce(F.col(f"{a}_prediction") == F.col(f"{b}_prediction"), F.lit(False)).cast("bigint"))
            .alias(f"s{i}") for i, (a, b) in enumerate(pairs)]
    rows = F.explode(F.array(*[
        F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), F.col(f"s{i}").alias("n_agree"))
        for i, (a, b) in enumerate(pairs)]))
    return (
        wide.agg(F.count(F.lit(1)).alias("n"), *same)
        .select(rows.alias("_r"), "n")
        .select("_r.model_a", "_r.model_b", F.coalesce("_r.n_agree", F.lit(0)).alias("n_agree"), "n",
                (_ratio(F.col("_r.n_agree"), F.col("n")) * 100.0).alias("pct"))
    )


def winner(scores: DataFrame, models: Sequence[str], metric: str = "accuracy") -> DataFrame:
    """The best model; equal scores go to the one declared first."""
    rank = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    return scores.where(rank > 0).orderBy(F.col(metric).desc(), rank).limit(1) \
        .select("model", metric)


def compare_runs(before: DataFrame, after: DataFrame, keys: Sequence[str],
                 metrics: Sequence[str]) -> DataFrame:
    """Scores of two runs side by side with absolute and relative change."""
    a = before.select(*keys, *[F.col(m).alias(f"{m}_before") for m in metrics])
    b = after.select(*keys, *[F.col(m).alias(f"{m}_after") for m in metrics])
    joined = a.join(b, list(keys), "full_outer")
    for m in metrics:
        change = F.col(f"{m}_after") - F.col(f"{m}_before")
        joined = joined.withColumn(f"{m}_change", change) \
            .withColumn(f"{m}_relative", F.try_divide(change, F.col(f"{m}_before")))
    return joined


def confidence_summary(predictions: DataFrame) -> DataFrame:
    """Mean confidence and correct predictions per model and predicted label."""
    correct = is_correct(F.col("pred"), F.col("true_label")).cast("bigint")
    return predictions.groupBy("model", "pred").agg(
        F.avg("confidence").alias("avg_confidence"),
        F.sum(correct).alias("n_correct"),
        F.count(F.lit(1)).alias("n"),
    )
