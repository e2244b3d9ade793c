from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from toneflow.llm import decontaminate

from .conftest import ODD, prose


@pytest.fixture
def items(spark):
    def make(rows):
        return spark.createDataFrame(rows, "item_id long, text string")
    return make


def of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_windows_short_items_and_marks(documents, items):
    passage = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10 k11"
    docs = documents([(1, "x " + passage.upper().replace(" ", "--") + " y"), (2, passage.rsplit(" ", 2)[0]),
                      (3, "short é item here"), (4, "Short, É item"), (5, None), (6, ""), (7, "a1 b2 " + passage + " " + passage)])
    found = of(decontaminate.contamination(docs, items([(10, passage), (9, "short É item"), (8, None), (7, "..."), (9, passage)])))
    assert (found[1]["n_words"], found[1]["n_hit"], found[1]["n_items"], found[1]["contaminated"]) == (13, 11, 2, True)
    assert found[2]["n_hit"] == 0
    assert found[3]["n_hit"] == 0 and found[4]["n_hit"] == 3  # É is not lower-cased
    assert (found[5]["n_words"], found[6]["n_words"], found[5]["n_hit"]) == (0, 0, 0)
    assert found[7]["n_hit"] == 22
    import hashlib

    assert found[1]["items_sha256"] == hashlib.sha256(b"10,9").hexdigest()
    assert found[2]["items_sha256"] == hashlib.sha256(b"").hexdigest()


def test_broadcast_and_shuffle_agree(documents, items, monkeypatch):
    rows = [(i, prose(i % 7, 30) + " " + prose(50 + i, 5)) for i in range(30)]
    bench = items([(k, prose(k, 14)) for k in range(4)])
    want = sorted(decontaminate.contamination(documents(rows), bench).collect())
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert sorted(decontaminate.contamination(documents(rows), bench).collect()) == want
    assert any(r["contaminated"] for r in want) and not all(r["contaminated"] for r in want)


def test_spans_go_and_the_rest_stays(documents, items):
    passage = prose(5, 12)
    docs = documents([(1, f"Before,  it. {passage.title()}! After\nit "), (2, passage), (3, "Clean -- text "), (4, None), (5, "")], clash=True)
    left = of(decontaminate.remove_spans(docs, items([(1, passage)])))
    assert left[1]["text"] == "Before,  it. After\nit " and left[3]["text"] == "Clean -- text "
    assert left[4]["text"] is None and left[5]["text"] == "" and 2 not in left
    again = decontaminate.contamination(docs.sparkSession.createDataFrame(list(left.values()), docs.schema), items([(1, passage)]))
    assert not again.filter("contaminated").count()
    assert decontaminate.remove_spans(docs, items([])).count() == 5


def test_odd_rows(documents, items):
    got = decontaminate.contamination(documents(ODD, clash=True), items([(1, prose(1, 10)), (2, prose(3, 30_000))])).collect()
    assert len(got) == len(ODD)
    assert sorted(r["doc_id"] for r in got if r["contaminated"]) == [1, 5, 5, 8, 9]
    assert [r["n_hit"] for r in got if r["doc_id"] == 8] == [30_000]
    assert decontaminate.contamination(documents([]), items([(1, "a")])).count() == 0
    assert decontaminate.contamination(documents(ODD), items([])).filter("contaminated").count() == 0


def test_no_python_in_the_plan(documents, items):
    df = decontaminate.contamination(documents([(1, "a b")]), items([(1, "a b")])).filter(F.col("n_words") > 0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
