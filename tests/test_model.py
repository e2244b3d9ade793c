from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from toneflow.operators import model as M
from toneflow.operators import softmax
from toneflow.operators.model import score_with_all
from toneflow.operators.sampling import stratified_split
from toneflow.operators.softmax import as_model, fit_all
from toneflow.plans.evaluation import compare_models
from toneflow.plans.labelling import build_dataset
from toneflow.plans.training import fine_tune

WORDS = {"negative": "loss decline probe", "neutral": "meeting agenda report", "positive": "profit growth record"}


@pytest.fixture(scope="module")
def split(spark):
    sizes = {"negative": 20, "neutral": 120, "positive": 40}
    rows = [(f"{label}{i}", f"{WORDS[label]} item {i % 7} the of and", label)
            for label, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id string, text string, label string").repartition(3)
    parts = stratified_split(df, "id").cache()
    return parts.where("split = 'train'"), parts.where("split = 'val'")


@pytest.fixture(scope="module")
def model(split):
    return M.train(split[0], features=1 << 10, max_iter=10)


def test_beats_the_majority_class(model, split):
    scored = M.predict(model, split[1]).collect()
    assert sum(r.pred == r.label for r in scored) / len(scored) > 0.95
    for r in scored:
        assert r.confidence == max(r.probs.values()) and abs(sum(r.probs.values()) - 1) < 1e-9
        assert r.probs[r.pred] == r.confidence


def test_missing_text_is_scored(spark, model):
    assert M.predict(model, spark.createDataFrame([(None,)], "text string")).first().pred in WORDS


def test_saved_model_evaluates_alike(model, split, tmp_path):
    path = f"{tmp_path}/model"
    model.write().save(path)
    def rows(m):
        return sorted(tuple(r) for r in M.evaluate(m, split[1]).collect())
    assert rows(path) == rows(model)


def test_variants(split):
    kept = M.select_variant(*split, features=1 << 10, max_iter=5)
    losses = {name: loss for name, _, loss, _ in kept.tried}
    assert set(losses) == set(M.VARIANTS) and losses[kept.variant] == min(losses.values())
    by_accuracy = M.select_variant(*split, metric="accuracy", features=1 << 10, max_iter=5)
    scores = {name: acc for name, _, _, acc in by_accuracy.tried}
    assert scores[by_accuracy.variant] == max(scores.values())


def test_history(spark, split):
    kept = M.select_variant(*split, features=1 << 10, max_iter=4)
    alone = M.select_variant(split[0], None, variants={"only": 0.05}, features=1 << 10, max_iter=4)
    for rows in (*kept.histories.values(), *alone.histories.values()):
        losses = [r[1] for r in rows]
        assert [r[0] for r in rows] == [0, 1, 2, 3, 4] and losses == sorted(losses, reverse=True)
        assert losses[0] == pytest.approx(math.log(3)) and losses[-1] < losses[0]
    # Variants do not influence each other, and held-out rows do not train.
    assert [r[1] for r in alone.histories["only"]] == pytest.approx([r[1] for r in kept.histories["improved"]])
    history = spark.createDataFrame([*kept.histories["improved"], *alone.histories["only"]], M.HISTORY)
    assert M.complete_rows(history).count() == 5


@pytest.mark.parametrize("reg_param", [0.01, 0.3])
def test_same_optimum_as_spark_ml(split, reg_param):
    extract, rows = M.prepared(*split, features=1 << 10)
    fits, deviations = fit_all(rows, {"x": reg_param}, 1 << 10, 60)
    theirs = LogisticRegression(labelCol="label_id", weightCol="weight", regParam=reg_param, maxIter=200, tol=1e-9,
                                family="multinomial").fit(rows.where("weight IS NOT NULL"))
    assert fits["x"].loss == pytest.approx(theirs.summary.objectiveHistory[-1], rel=1e-3)
    probs = [{r.text: r.p for r in stage.transform(extract.transform(split[1]))
              .select("text", vector_to_array("probability").alias("p")).collect()} for stage in (as_model(fits["x"], deviations), theirs)]
    for text, p in probs[0].items():
        assert p == pytest.approx(probs[1][text], abs=0.02)


def test_validation_scores_are_those_of_the_model(split):
    kept = M.select_variant(*split, features=1 << 10, max_iter=6)
    scored = M.predict(kept.model, split[1]).collect()
    _, _, loss, accuracy = next(t for t in kept.tried if t[0] == kept.variant)
    assert accuracy == pytest.approx(sum(r.pred == r.label for r in scored) / len(scored))
    assert loss == pytest.approx(-sum(math.log(r.probs[r.label]) for r in scored) / len(scored))


def test_a_pass_is_a_step_of_all_variants(split, monkeypatch):
    passes = []
    real = softmax.one_pass
    monkeypatch.setattr(softmax, "one_pass", lambda *a: passes.append(1) or real(*a))
    M.select_variant(*split, features=1 << 10, max_iter=4)
    assert len(passes) == 5


def test_gradient_is_the_slope_of_the_loss(split, monkeypatch):
    monkeypatch.setattr(softmax, "CHUNK", 7)
    monkeypatch.setattr(softmax, "BLOCK", 3)
    _, rows = M.prepared(*split, features=16)
    at, change = np.random.default_rng(1).normal(size=(2, 16, 3)) * 0.3
    free = np.array([0.1, -0.2, 0.3])
    def value(t):
        return softmax.one_pass(rows, at + t * change, free)[1][0, 0]
    gradient, _ = softmax.one_pass(rows, at, free)
    assert (value(1e-4) - value(-1e-4)) / 2e-4 == pytest.approx((gradient * change).sum(), rel=1e-5)


def test_odd_training_rows(spark, split):
    odd = spark.createDataFrame([("n1", "", "neutral"), ("n2", None, "neutral"), ("n3", "profit " * 30000, "positive")],
                                "id string, text string, label string")
    train = split[0].select("id", "text", "label")
    kept = M.select_variant(train.union(odd.fillna("")), odd.fillna("").withColumn("label", F.lit("mixed")), features=64, max_iter=2)
    assert kept.tried[0][2:] == (None, None)  # no held-out row has a known label
    with pytest.raises(ValueError, match="no rows to train on"):
        M.train(train.limit(0), features=64)
    only = M.train(train.where("label = 'neutral'"), features=64, max_iter=2)
    assert {r.pred for r in M.predict(only, train).collect()} == {"neutral"}


def test_rows_without_a_weight_are_not_dropped(spark):
    df = spark.createDataFrame([("a", "positive"), ("b", None), ("c", "mixed")], "text string, label string")
    basis = df.where("label = 'positive'")
    with pytest.raises(Exception, match="no class weight for label"):
        M.with_class_weights(df, basis).collect()
    assert M.with_class_weights(basis, df).count() == 1


def test_one_definition_of_each_name():
    import ast
    import pathlib
    from collections import Counter

    for path in pathlib.Path(M.__file__).parents[1].rglob("*.py"):
        names = Counter(n.name for n in ast.parse(path.read_text()).body if isinstance(n, (ast.FunctionDef, ast.ClassDef)))
        assert max(names.values(), default=1) == 1, (path, names.most_common(1))


def test_weights_come_from_the_given_rows(spark):
    df = spark.createDataFrame([("a", "positive")] * 3 + [("b", "negative")], "text string, label string")
    weights = {r.label: r.weight for r in M.with_class_weights(df).distinct().collect()}
    assert weights == {"positive": 4 / 6, "negative": 2.0}
    even = df.union(df.where("label = 'negative'")).union(df.where("label = 'negative'"))
    assert {r.weight for r in M.with_class_weights(df, even).collect()} == {1.0}


def make_scorer():
    class Scorer:
        def predict(self, texts):
            if any("bad" in t for t in texts):
                raise ValueError("cannot read")
            return [{"label": "positive", "probs": {"positive": 0.9, "negative": 0.1}} for _ in texts]

    return Scorer


def test_plugged_in_model(spark):
    df = spark.createDataFrame([(i, "bad" if i == 5 else f"text {i}") for i in range(20)] + [(20, None)], "i int, t string")
    got = {r.i: (r.model_label, r.model_confidence) for r in M.score_texts(df.coalesce(1), "t", make_scorer()).collect()}
    assert got.pop(5) == ("ERROR", 0.0) and set(got.values()) == {("positive", 0.9)}
    absent = M.score_texts(df, "t", lambda: None).collect()
    assert {(r.model_label, r.model_confidence) for r in absent} == {("N/A", 0.0)}


def test_models_are_loaded_once_per_worker(spark, tmp_path):
    """Many tasks share what their Python workers have loaded."""
    folder, scorer = str(tmp_path), make_scorer()

    def load():
        import os
        import uuid

        open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return scorer()

    df = spark.range(400).select(F.concat(F.lit("text "), F.col("id").cast("string")).alias("t")).repartition(40)
    assert M.score_texts(df, "t", load).where("model_label = 'positive'").count() == 400
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert 1 <= len(loads) == len(set(loads)) <= 8


def test_models_are_compared_in_one_pass(spark, split):
    gold = split[0].drop("split")

    def by_word(word, label):
        class Scorer:
            def predict(self, texts):
                return [{"label": label if word in t else "Neutral", "probs": {"neutral": 0.5}} for t in texts]

        return Scorer

    scorers = {"up": by_word("profit", "LABEL_2"), "none": lambda: None, "joy": by_word("growth", "joy")}
    result = compare_models(gold, scorers, "id", sample=30)
    assert result.predictions.count() == 90
    plan = score_with_all(gold, "text", scorers, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    acc = {r.model: (r.n, r.n_correct) for r in result.accuracy.collect()}
    assert acc == {"up": (30, 20), "joy": (30, 20), "none": (30, 0)}
    assert result.winner.first().model == "up"
    pairs = {(r.model_a, r.model_b): (r.n_agree, r.n) for r in result.agreement.collect()}
    assert pairs["up", "joy"] == (30, 30) and pairs["up", "none"] == (0, 30)
    assert {r.pred for r in result.distribution.where("model = 'none'").collect()} == {"N/A"}
    assert {r.raw_label for r in result.predictions.where("model = 'up'").collect()} == {"LABEL_2", "Neutral"}
    assert result.report.where("label = 'macro avg'").count() == result.confidence.select("model").distinct().count() == 3
    assert result.confusion.count() == 9 and result.class_accuracy.count() == 9


def test_training_run(spark, split, tmp_path):
    rows = split[0].unionByName(split[1]).drop("split")
    run = fine_tune(rows.withColumnRenamed("label", "weak_label"), "id", variants={"a": 0.01, "b": 0.3},
                    path=f"{tmp_path}/m", features=1 << 10, max_iter=2)
    metrics = run.metrics.first()
    assert metrics.model == run.variant and metrics.accuracy > 0.95 and metrics.f1_macro > 0.9
    assert len(run.tried) == 2 and [r[0] for r in run.history] == [0, 1, 2] and run.history[-1][2] is not None
    assert M.evaluate(f"{tmp_path}/m", rows).where("label = 'accuracy'").first().f1 > 0.95
    dated = rows.withColumn("published_at", F.timestamp_seconds(F.abs(F.hash("id"))))
    by_time = fine_tune(dated, "id", by_time=True, variants={"a": 0.01}, weights_from_all=True,
                        features=1 << 10, max_iter=5)
    assert by_time.metrics.first().accuracy > 0.9


def test_model_decides_in_the_labelled_table(spark):
    df = spark.createDataFrame([("1", "loss", None), ("2", "bad loss", None)], "hash string, title string, description string")
    rows = {r.hash: r.weak_label for r in build_dataset(df, scorer=make_scorer()).collect()}
    assert rows == {"1": "positive", "2": "negative"}


def test_scoring_stays_in_the_jvm(model, split):
    plan = M.predict(model, split[1])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
