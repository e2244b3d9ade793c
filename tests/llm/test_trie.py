from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from toneflow.llm import queries, trie

from .conftest import CLASHING


def subtree_sums(up, weights):
    out = weights.copy()
    for i in range(len(up)):
        j = up[i]
        while j >= 0:
            out[j] += weights[i]
            j = up[j]
    return out


@pytest.mark.parametrize("seed", range(12))
def test_centroids_of_random_forests(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 300))
    shape = seed % 4
    up = np.array([-1 if i == 0 or rng.random() < 0.03 else
                   (i - 1 if shape == 0 else 0 if shape == 1 else int(rng.integers(max(0, i - 4), i)) if shape == 2 else int(rng.integers(0, i)))
                   for i in range(n)])
    order = rng.permutation(n)
    up = np.where(up[order] >= 0, np.argsort(order)[up[order]], -1)
    weights = rng.integers(0, 1000, (n, 2))
    assert np.array_equal(trie.centroid_totals(up, weights), subtree_sums(up, weights))


def test_centroids_of_nothing_and_of_a_long_chain():
    assert trie.centroid_totals(np.empty(0, np.int64), np.empty((0, 1), np.int64)).shape == (0, 1)
    up = np.arange(-1, 20_000 - 1)
    weights = np.ones((20_000, 1), np.int64)
    assert np.array_equal(trie.centroid_totals(up, weights)[:, 0], np.arange(20_000, 0, -1))


def conversations_of(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            out[conv].append((turn is not None, turn or 0, role, sha, text))
    return {c: [(r, t) for _, _, r, _, t in sorted(turns)] for c, turns in out.items()}


def rebuild(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(convs):
    members, last = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
        last[tuple(convs[c])].append(c)
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, who in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(who) - 1) * len(k[-1][1].encode()) if k else 0
    return sorted((who[0], len(k), members[k[:-1]][0] if k else None, len(who), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, last[k])).encode()).hexdigest()) for k, who in members.items())


def got(df):
    return sorted((r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"],
                   r["ends_sha256"]) for r in df.collect())


def table(spark, rows, clash=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.select("*", *[F.lit(c).alias(c) for c in CLASHING]) if clash else df


def run(spark, tmp_path, rows, clash=False):
    table(spark, rows, clash).write.parquet(f"{tmp_path}/conversations.parquet")
    return got(queries.op11_trie(spark, str(tmp_path)))


ROWS = [(7, 0, "user", "hi"), (7, 1, "assistant", "yes"), (7, 1, "assistant", "again"), (7, 1, "assistant", "again"), (7, None, None, None),
        (None, 0, "user", "hi"), (None, None, None, None), (8, 0, "user", "hi"), (8, None, "", ""), (11, 0, "user", "é" * 50_000),
        (12, 5, "system", "\x00|,"), (13, 5, "sys", "tem\x00|,"), (0, 3, "user", None), (5, 0, "user", "hi"), (5, 1, "user", "hi"), (6, 2, "x", "y"),
        (-3, 0, "user", "hi"), (-4, 0, "user", "ho"), (10**15, 0, "user", "hi")]


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows(spark, tmp_path, clash):
    assert run(spark, tmp_path, ROWS, clash) == brute(rebuild(conversations_of(ROWS)))


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def random_rows(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, most) if c else 60):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "longer text", None])))
    return rows


def test_pieces_ranks_and_blocks(spark, monkeypatch):
    """Small limits force every round of cutting: ranks of members, pieces of pieces, blocks of digests, runs of ids."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(trie, "BLOCK", 7)
    monkeypatch.setattr(trie, "IDS", 8)
    rows = random_rows(3, 60, 9) + [(c, t, "user", "hot") for c in range(100, 150) for t in range(c % 3 + 4)]
    rows += [(200, t, "user", str(t % 5)) for t in range(45)] + [(201, t, "user", str(t % 5)) for t in range(41)]
    turns = trie.digests(table(spark, rows)).withColumn("depth", (F.col("pos") + 1).cast("long"))
    members = turns.select("conv").distinct().union(spark.createDataFrame([(900,)], "conv long"))
    found = trie.summary(turns, members, width=3, deep=3)
    found = found.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                         F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                         F.col("ends").alias("ends_sha256"))
    assert got(found) == brute({**conversations_of(rows), 900: []})


def test_small_batches_cut_at_pieces():
    import pyarrow as pa

    rng = random.Random(1)
    rows, want = [], {}
    for p in range(40):
        up = [-1] + [rng.randrange(i) for i in range(1, rng.randint(1, 30))]
        w = np.array([[rng.randrange(9)] for _ in up])
        sums = subtree_sums(up, w)
        for i, u in enumerate(up):
            rows.append({"key": f"{p}-{i}", "up": f"{p}-{u}" if u >= 0 else "elsewhere", "piece": f"{p}-0", "w": int(w[i, 0])})
            want[f"{p}-{i}"] = int(sums[i, 0])
    batches = [pa.RecordBatch.from_pylist(rows[i:i + 7]) for i in range(0, len(rows), 7)]
    old, trie.BATCH = trie.BATCH, 20
    try:
        out = [r for b in trie._decompose(["w"], iter(batches)) for r in b.to_pylist()]
    finally:
        trie.BATCH = old
    assert {r["key"]: r["w"] for r in out} == want and len(out) == len(rows)
