from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from toneflow.llm import cotraining, queries

from .conftest import ODD

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = queries.read(spark, FOLDER, "documents"), queries.read(spark, FOLDER, "labels")
    test = F.crc32(F.col("doc_id").cast("string")) % 4 == 0
    model, views = cotraining.learn(docs, labels.filter(~test))
    found = cotraining.scores(views, model).withColumnRenamed("id", "doc_id").join(labels.filter(test), "doc_id").toPandas()
    assert ((found["score"] >= 0.5) == (found["quality"] == 1)).mean() >= 0.95
    good = found.loc[found["quality"] == 1, "score"]
    assert (good >= 0.5).mean() >= 0.97
    assert len(model.rounds) == 6 and any(r["text_learns_from"] >= 0 for r in model.rounds)
    # Scoring the rows of a stage gives what the stored views give.
    kept = cotraining.keep_good(docs, labels.filter(~test))
    assert {r[0] for r in kept.select("doc_id").collect()} == {
        r[0] for r in cotraining.scores(views, model).filter("score >= 0.5").select("id").collect()}


def test_steps_sum_up_like_one_fit(spark):
    """Sums over tasks equal the sums of one matrix."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, cotraining.TEXT_DIM)).astype(np.float32)
    m = rng.standard_normal((200, cotraining.META_DIM)).astype(np.float32)
    table = spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(x, m, strict=True))],
                                  "id long, t array<float>, m array<float>").repartition(5)
    u, v = rng.standard_normal(x.shape[1]) / 9, rng.standard_normal(m.shape[1]) / 9
    limit = cotraining.Limits(0.3, 0.7), cotraining.Limits(0.4, 0.6)
    flat = cotraining._pass(table, (u, v), (u, v), limit)
    p = cotraining.sigmoid(m.astype(float) @ v)
    sure = (p <= 0.4) | (p >= 0.6)
    want = cotraining.sums(x[sure].astype(float), (p[sure] >= 0.5).astype(float), np.ones(int(sure.sum())), u)
    assert flat[:len(want)] == pytest.approx(want)
    assert flat[len(want)] == sure.sum()


def test_limits_ask_for_precision():
    y = np.array([1] * 90 + [0] * 10 + [1] * 10 + [0] * 90, float)
    p = np.linspace(0.99, 0.01, 200)
    found = cotraining.limits(p, y, 0.98)
    assert 0.5 <= found.high <= 1 and y[p >= found.high].mean() >= 0.98 and (1 - y[p <= found.low]).mean() >= 0.98
    assert cotraining.limits(p, 1 - y * 0, 0.98).low == -1.0
    assert cotraining.limits(np.full(20, 0.9), np.ones(20), 0.98) == cotraining.Limits()


def test_odd_rows(spark, documents):
    labels = spark.createDataFrame([(1, 1), (5, 1), (8, 0), (9, None), (77, 1), (None, 1), (2, 0), (3, 7)], "doc_id long, quality int")
    model, views = cotraining.learn(documents(ODD, clash=True), labels)
    assert cotraining.scores(views, model).count() == len(ODD)
    odd = documents(ODD).withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit(None).cast("string")).withColumn(
        "n_chars", F.lit(None).cast("long"))
    assert cotraining.keep_good(odd, labels.limit(0)).count() == len(ODD)
    assert cotraining.keep_good(documents([]), labels).count() == 0
    assert cotraining.keep_good(documents(ODD, clash=True), labels).columns[-1] == "score"
