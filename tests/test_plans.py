"""Physical plans: what may and may not occur in them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from toneflow import catalog
from toneflow.operators import articles

FOLDER = "/root/testdata/sf0.001"
# Fitting and streaming queries run jobs of their own; the scorer query is Python by purpose.
SKIP = ("ml", "stm", "snk1", "snk4", "compare_models")
QUERIES = {n: e.run for n, e in catalog.load().items()}
PURE = sorted(n for n in QUERIES if not n.startswith(SKIP))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_no_products_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert banned not in plan


@pytest.mark.parametrize("name", ["win5_report", "lab9_decay_weight", "jn2_first_arrivals", "spl1_stratified_split"])
def test_windows_are_partitioned(spark, name):
    assert "SinglePartition" not in plan_of(QUERIES[name](spark, FOLDER))


def test_first_arrivals_thin_out_before_the_shuffle(spark):
    plan = plan_of(QUERIES["jn2_first_arrivals"](spark, FOLDER))
    exchange = plan.index("Exchange hashpartitioning")
    assert "Partial" in plan[exchange:] and "WindowGroupLimit" in plan[exchange:]


def test_report_shuffles_twice(spark):
    assert plan_of(QUERIES["win5_report"](spark, FOLDER)).count("Exchange ") == 2


def test_scans_read_needed_columns_only(spark):
    plan = plan_of(QUERIES["agg1_daily"](spark, FOLDER))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    plan = plan_of(articles.in_language(
        spark.read.parquet(f"{FOLDER}/documents.parquet").withColumnRenamed("lang", "language")).select("doc_id"))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan


def test_word_lists_are_hash_sets(spark):
    from toneflow.functions.labels import Lexicon, score_lexicon

    many = tuple(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(100))
    df = spark.range(1).select(score_lexicon(F.concat(F.lit("wab "), F.col("id").cast("string")), Lexicon(many, ())))
    assert "INSET" in plan_of(df)
