from __future__ import annotations

import re

import __spark_entry__ as entry
import corpus_pipeline
from toneflow.llm import cotraining, decontaminate, mixing, queries, secrets

from .test_simhash import slow_components, slow_fingerprint

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = queries.read(spark, FOLDER, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "simhash_dedup", "decontamination", "secrets", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(spark, docs, FOLDER)
        if name != "mixing":
            assert out.columns == columns and out.dtypes == docs.dtypes
        after = {r["doc_id"]: r for r in out.collect()}
        assert after.keys() <= before.keys() and after
        if name == "quality":
            labels = {r["doc_id"]: r["quality"] for r in queries.read(spark, FOLDER, "labels").collect()}
            good = [i for i, q in labels.items() if q == 1]
            bad = [i for i, q in labels.items() if q == 0]
            assert sum(i in after for i in good) >= 0.97 * len(good) and sum(i in after for i in bad) <= 0.2 * len(bad)
        elif name == "simhash_dedup":
            ids = sorted(before)
            roots = slow_components([slow_fingerprint(before[i]["text"]) for i in ids])
            assert set(after) == {ids[r] for r in roots}
        elif name == "decontamination":
            found = decontaminate.contamination(out, queries.read(spark, FOLDER, "benchmark"))
            assert not found.filter("contaminated").count()
            first = {r["doc_id"]: r["contaminated"] for r in decontaminate.contamination(docs, queries.read(spark, FOLDER, "benchmark")).collect()}
            assert any(first.values())
            assert all(after[i] == r for i, r in before.items() if not first[i])
        elif name == "secrets":
            assert after.keys() == before.keys()
            assert not any(re.search("AKIA[A-Z0-9]{16}", r["text"]) for r in after.values())
        else:
            want = {r["doc_id"]: r["taken"] for r in mixing.taken(docs, queries.WEIGHTS).collect() if r["taken"]}
            assert {i: r["taken"] for i, r in after.items()} == want
        docs = spark.createDataFrame(out.collect(), out.schema)


def test_registered_run(spark):
    rows = entry.queries()["pipeline"](spark, FOLDER).collect()
    assert rows and {"doc_id", "text", "taken", "copies"} <= set(rows[0].asDict())


def test_odd_documents(spark, documents, tmp_path):
    from .conftest import ODD

    for name, rows in (("odd", ODD), ("none", [])):
        folder = f"{tmp_path}/{name}"
        documents(rows, clash=True).write.parquet(f"{folder}/documents.parquet")
        for table in ("labels", "benchmark"):
            queries.read(spark, FOLDER, table).write.parquet(f"{folder}/{table}.parquet")
        assert corpus_pipeline.run(spark, folder).count() <= len(rows)


def test_parts_are_the_operators(monkeypatch, spark):
    """Every stage calls its operator."""
    for module, name, stage in ((cotraining, "keep_good", "quality"), (decontaminate, "remove_spans", "decontamination"), (secrets, "redact", "secrets")):
        called = []
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, real=real, called=called, **k: called.append(1) or real(*a, **k))
        dict(corpus_pipeline.STAGES)[stage](spark, queries.read(spark, FOLDER, "documents"), FOLDER)
        assert called
