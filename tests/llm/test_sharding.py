from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from toneflow.llm import ordering, sharding
from toneflow.llm.sharding import Shuffle

from .conftest import ODD, prose


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 8, 10, 50, 99, 1000, 4097])
def test_permutation_and_its_inverse(spark, n):
    shuffle = Shuffle.of(spark, n, 3)
    shard, slot = shuffle.place(F.col("id"))
    df = spark.range(n).select("id", shard.alias("shard"), slot.alias("slot"))
    df = df.withColumn("back", shuffle.number_at(F.col("shard"), F.col("slot")))
    rows = df.collect()
    assert all(r["back"] == r["id"] for r in rows)
    assert sorted((r["shard"], r["slot"]) for r in rows) == sorted((k % 3, k // 3) for k in range(n))
    if n >= 50:
        assert sum(r["id"] == r["slot"] * 3 + r["shard"] for r in rows) < 10


def test_many_seeds_walk_out(spark):
    """Two numbers beyond the last row, so that some walks take more than one step."""
    further = set()
    for seed in range(12):
        shuffle = Shuffle.of(spark, 7, 1, seed)
        further.add(shuffle.further)
        assert sorted(r[0] for r in spark.range(7).select(shuffle.place(F.col("id"))[1]).collect()) == list(range(7))
    assert max(further) >= 1


def test_no_place_beyond_the_rows(spark):
    shuffle = Shuffle.of(spark, 10, 4)
    at = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (4, 0), (-1, 1), (0, -1), (None, 0)], "shard int, slot long")
    got = [r[0] for r in at.select(shuffle.number_at(F.col("shard"), F.col("slot"))).collect()]
    assert got[0] is not None and got[1] is not None and got[2:] == [None] * 5
    with pytest.raises(ValueError):
        Shuffle.of(spark, 5, 0)


def check(rows, docs, shards):
    assert sorted((r["id"] is None, r["id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted(
        (d[0] is None, d[0] or 0, len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in docs)
    assert sorted(r["number"] for r in rows) == list(range(len(docs)))
    counts = Counter(r["shard"] for r in rows)
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    assert max(counts.values(), default=0) - min((counts[s] for s in range(shards)), default=0) <= 1


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows(spark, documents, clash):
    check(sharding.assign(documents(ODD, clash), 4).collect(), ODD, 4)


def test_empty_table(spark, documents):
    assert sharding.assign(documents([]), 4).collect() == []


def test_places_do_not_depend_on_partitions(spark, documents):
    docs = documents([(i, prose(i, 5)) for i in range(300)])
    one = {tuple(r) for r in sharding.assign(docs.repartition(1), 8).collect()}
    assert one == {tuple(r) for r in sharding.assign(docs.repartition(7, "text"), 8).collect()}
    other = {tuple(r) for r in sharding.assign(docs, 8, seed=5).collect()}
    assert len(one & other) < 60


def test_a_third_of_all_rows_alike_spreads(spark, documents, request):
    docs = documents([(None, "same")] * 400 + [(i, prose(i, 3)) for i in range(800)])
    for key, value in (("spark.sql.adaptive.coalescePartitions.enabled", "false"), ("spark.sql.files.openCostInBytes", "1g")):
        spark.conf.set(key, value)
    request.addfinalizer(lambda: [spark.conf.unset("spark.sql.files.openCostInBytes"),
                                  spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")])
    rows, n = ordering.numbered(docs.select(F.col("doc_id").alias("id")), F.col("id").asc_nulls_last())
    parts = [len(p) for p in rows.rdd.glom().collect()]
    assert n == 1200 and max(parts) < 700
    check(sharding.assign(docs, 8).collect(), [(None, "same")] * 400 + [(i, prose(i, 3)) for i in range(800)], 8)


@pytest.mark.parametrize("parts", [1, 3])
def test_written_shards(spark, documents, tmp_path, parts):
    docs = documents([*ODD, *[(100 + i, prose(i, 6)) for i in range(60)]])
    path = str(tmp_path / "shards")
    out = sharding.write_shards(docs, path, 4, parts=parts)
    assert set(out.columns) == {*docs.columns, "slot", "shard"}
    assert sorted(map(str, out.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    files = list((tmp_path / "shards").glob("shard=*/*.parquet"))
    assert len(files) == 4 * parts
    for f in files:
        slots = [r[0] for r in spark.read.parquet(str(f)).select("slot").collect()]
        assert slots == list(range(slots[0], slots[0] + len(slots)))
    empty = sharding.write_shards(documents([]).withColumn("shard", F.lit("x")), str(tmp_path / "none"), 4) if parts == 1 else None
    assert empty is None or empty.count() == 0
