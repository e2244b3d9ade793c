from __future__ import annotations

import random

import pytest

from toneflow.llm import mixing

from .conftest import ODD


def shares(sizes, weights, budget, epochs):
    """Fill the sources in steps: who is full gives what is above to the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = budget * sum(sizes.values()), set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        level = rest / sum(w[s] for s in free) if free else 0
        over = {s for s in free if level * w[s] >= epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in full else level * w[s] for s in order}
        full |= over


@pytest.mark.parametrize("budget", [0.3, 1.0, 1.5, 2.0])
def test_targets(spark, budget):
    rng = random.Random(2)
    for n in (1, 2, 5, 12):
        sizes = {f"s{i}": rng.choice([0, 3, 50, 1000, 7]) for i in range(n)} | {None: 20, "é": 5, "Z": 11}
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.targets(df, [5.0, 2.0, 1.0], budget, 2).collect()}
        assert got == pytest.approx(shares(sizes, [5, 2, 1], budget, 2))


def test_whole_documents_near_the_target(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(1, 60)), None, rng.choice(["a", "a", "a", "b", "c", None]), 0) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.taken(docs, [5.0, 2.0, 1.0]).collect()
    assert len(got) == len(rows)
    assert got and sorted(got) == sorted(mixing.taken(docs.repartition(7), [5.0, 2.0, 1.0]).collect())
    source = {r[0]: r[3] for r in rows}
    sums = {}
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        s = sums.setdefault(source[r["doc_id"]], [0, r["target"], r["source_size"]])
        s[0] += r["taken"]
    for took, target, _ in sums.values():
        assert abs(took - target) <= 60
    total = 1.5 * sum(s[2] for s in sums.values())
    assert total - 60 <= sum(s[0] for s in sums.values()) <= total
    mixture = mixing.mixture(docs, [5.0, 2.0, 1.0]).collect()
    assert {r["doc_id"]: r["taken"] for r in mixture} == {r["doc_id"]: r["taken"] for r in got if r["taken"]}
    # At any time the sources are near their shares.
    for at in (0.25, 0.5, 0.75):
        for s, (_, target, _) in sums.items():
            done = sum(r["taken"] / r["copies"] for r in mixture for f in r["finish_times"] if r["source"] == s and f <= at)
            assert abs(done - at * target) <= 61


def test_odd_rows(documents):
    got = mixing.taken(documents(ODD, clash=True), [5.0, 2.0, 1.0]).collect()
    assert len(got) == len(ODD)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert {r["size"] for r in got if r["doc_id"] in (2, 3, 4)} == {0}
    out = mixing.mixture(documents(ODD, clash=True), [5.0, 2.0, 1.0])
    assert "probability" in out.columns and out.filter("taken = 0").count() == 0
    assert mixing.taken(documents([]), [1.0]).count() == 0
    assert mixing.mixture(documents([(1, None), (2, " ")]), [1.0]).count() == 0
    assert {r["taken"] for r in mixing.taken(documents([(1, None), (2, " ")]), [1.0]).collect()} == {0}


def test_repeated_rows_and_null_ids_have_their_own_copies(documents):
    words = " ".join(["w"] * 10)
    rows = [(1, words, "en", "a", 0)] * 6 + [(None, f"{words} {k}", "en", s, 0) for k in range(6) for s in "abb"]
    rows += [(1, words, "en", "c", 0), (2, words, "en", None, 0), (2, words, "en", None, 0)]
    for budget in (0.5, 1.5, 2.0):
        got = mixing.mixture(documents(rows, clash=True).repartition(3), [5.0, 2.0, 1.0], budget).collect()
        size = [len(r["text"].split()) for r in got]
        assert len(got) <= len(rows)
        assert all(r["taken"] == n * r["copies"] == n * len(r["finish_times"]) <= 2 * n for r, n in zip(got, size, strict=True))
        total = budget * sum(len(r[1].split()) for r in rows)
        assert total - 11 <= sum(r["taken"] for r in got) <= total
    # With the budget for all copies, every row is there with both.
    assert len(got) == len(rows) and {r["copies"] for r in got} == {2}


def test_hot_null_ids_spread_over_the_cells(spark):
    """A third of the rows without an id, of one text: no cell of the shuffle, no range and no task holds them."""
    text = " ".join(["w"] * 8)
    hot = spark.range(0, 4000, 1, 6).selectExpr("CAST(NULL AS LONG) AS doc_id", f"'{text}' AS text", "'a' AS source")
    rest = spark.range(0, 8000, 1, 6).selectExpr("id AS doc_id", "repeat('v ', CAST(id % 9 AS INT)) AS text", "IF(id % 3 = 0, 'a', 'b') AS source")
    docs = hot.union(rest)
    sizes = mixing.stored(docs.selectExpr("doc_id AS id", "source", "size(split(text, ' ')) AS size", "xxhash64(text) AS hash",
                                          "monotonically_increasing_id() AS nth"), "sizes")
    keys = mixing.numbered(sizes, 7)
    assert keys.select("order").distinct().count() == 12_000
    cells = keys.filter("id IS NULL").selectExpr("substring(order, 1, 3) AS c").groupBy("c").count().toPandas()["count"]
    assert cells.max() <= 12 and cells.sum() == 4000
    got = mixing.taken(docs, [5.0, 2.0, 1.0])
    assert got.count() == 12_000
    first, again = (sorted(map(tuple, d.collect()), key=str) for d in (got, mixing.taken(docs.repartition(5), [5.0, 2.0, 1.0])))
    assert first == again


def test_copies_are_in_the_order_of_finish(spark, documents):
    docs = documents([(i, " ".join(["w"] * (1 + i % 40)), "en", "abc"[i % 3], 0) for i in range(900)]).repartition(6)
    copies, shares, _ = mixing.mix(docs, [5.0, 2.0, 1.0])
    spans = copies.groupBy("range").agg({"finish": "min", "*": "count"}).join(
        copies.groupBy("range").agg({"finish": "max"}), "range").orderBy("range").collect()
    assert len(spans) >= 1
    assert all(a["max(finish)"] <= b["min(finish)"] for a, b in zip(spans, spans[1:]))
    total = 1.5 * sum(r["source_size"] for r in shares.collect())
    assert total - 40 <= copies.selectExpr("sum(size)").first()[0] <= total
