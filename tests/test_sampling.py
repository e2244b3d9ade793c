from __future__ import annotations

import hashlib
import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from toneflow.operators import ranking, sampling

# One label holds most rows; one is tiny; some rows have none.
ROWS = [(i, "neutral" if i % 3 else ("positive" if i % 2 else "negative")) for i in range(600)]
ROWS += [(600 + i, "rare") for i in range(3)] + [(700 + i, None) for i in range(4)]


@pytest.fixture(scope="module")
def gold(spark):
    return spark.createDataFrame(ROWS, "id long, label string").repartition(5)


def shuffled(rows, seed=42):
    return sorted(rows, key=lambda r: (hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest(), r[0]))


@pytest.mark.parametrize("n", [1, 10, 606, 607, 5000])
def test_sample_is_exact(gold, n):
    got = {r.id for r in sampling.sample_rows(gold, n, "id").collect()}
    assert got == {r[0] for r in shuffled(ROWS)[:n]}


def test_no_sample_size_means_all(gold):
    assert sampling.sample_rows(gold, None, "id") is gold and sampling.sample_rows(gold, 0, "id") is gold


def test_sample_depends_on_seed_only(gold):
    a = {r.id for r in sampling.sample_rows(gold, 50, "id", seed=1).collect()}
    b = {r.id for r in sampling.sample_rows(gold.repartition(11), 50, "id", seed=1).collect()}
    c = {r.id for r in sampling.sample_rows(gold, 50, "id", seed=2).collect()}
    assert a == b != c


def test_sample_of_nothing(spark, gold):
    assert sampling.sample_rows(gold.limit(0), 5, "id").count() == 0


def test_balanced_sample(gold):
    got = sampling.balanced_sample(gold, 200, "id", labels=("positive", "neutral", "rare")).collect()
    sizes = {x: sum(r.label == x for r in got) for x in ("positive", "neutral", "rare")}
    assert sizes == {"positive": 66, "neutral": 66, "rare": 3}
    neutral = {r.id for r in got if r.label == "neutral"}
    assert neutral == {r[0] for r in shuffled([r for r in ROWS if r[1] == "neutral"])[:66]}
    assert len({r.shuffle_key for r in got}) == len(got)


def test_stratified_split(gold):
    got = sampling.stratified_split(gold, "id").collect()
    assert len(got) == len(ROWS)
    for label in {r[1] for r in ROWS}:
        mine = shuffled([r for r in ROWS if r[1] == label])
        held = {r.id for r in got if r.label == label and r.split == "val"}
        assert held == {r[0] for r in mine[:math.ceil(0.2 * len(mine))]}


def test_three_way_split_adds_up(gold):
    got = sampling.stratified_split(gold, "id", held_out=(("test", 0.1), ("val", 0.1))).collect()
    for label in {r[1] for r in ROWS}:
        mine = shuffled([r for r in ROWS if r[1] == label])
        tail = math.ceil(round(0.2 * len(mine), 9))
        test = math.ceil(tail / 2)
        parts = {r.id: r.split for r in got if r.label == label}
        assert [parts[r[0]] for r in mine] == ["test"] * test + ["val"] * (tail - test) + ["train"] * (len(mine) - tail)


def test_time_split_holds_out_the_newest(spark):
    # Half of the rows share one moment, so the cut falls inside it.
    rows = [(f"{i:03d}", datetime(2024, 1, 1) + timedelta(minutes=i if i < 100 else 200)) for i in range(200)]
    df = spark.createDataFrame([*rows, *((f"x{i}", None) for i in range(5))], "key string, published_at timestamp")
    parts = {r.key: r.split for r in sampling.time_split(df, "key").collect()}
    assert {parts.pop(f"x{i}") for i in range(5)} == {"train"}
    newest = sorted(rows, key=lambda r: (-r[1].timestamp(), r[0]))
    assert [parts[k] for k, _ in newest] == ["val"] * 41 + ["train"] * 159


def test_class_weights(spark):
    df = spark.createDataFrame([("negative",)] * 860 + [("neutral",)] * 3130 + [("positive",)] * 1852, "label string")
    got = {r.label: round(r.weight, 2) for r in sampling.class_weights(df).collect()}
    assert got == {"negative": 2.26, "neutral": 0.62, "positive": 1.05}


def test_parts_with_several_cuts_in_one_cell(spark):
    df = spark.range(20).withColumn("g", F.lit("x"))
    cuts = [lambda n: F.lit(0), lambda n: F.lit(3), lambda n: F.lit(3), lambda n: F.lit(99)]
    for cell in (F.lit(1), F.floor(F.col("id") / 4)):
        got = ranking.assign_parts(df, cuts, cell, [F.col("id")], ["g"]).orderBy("id").collect()
        assert [r.part for r in got] == [1] * 3 + [3] * 17
