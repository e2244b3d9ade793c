from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from .conftest import ODD, prose
from toneflow.llm import queries, suffixes

L = suffixes.LENGTH


def slow(rows):
    """(id, bytes, removed, runs, digest) of (id, text) rows in the order of ids, nulls last."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first: dict[bytes, tuple] = {}
    texts = [(t or "").encode() for _, t in rows]
    for (i, _), t in zip(rows, texts, strict=True):
        for p in range(len(t) - L + 1):
            at = (i is None, i or 0, p)
            first[t[p:p + L]] = min(first.get(t[p:p + L], at), at)
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - L + 1):
            if first[t[p:p + L]] < (i is None, i or 0, p):
                gone[p:p + L] = True
        gone[-1] = False
        kept = bytes(c for c, g in zip(t, gone, strict=False) if not g)
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fast(df):
    rows = suffixes.deduplicate(df).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in rows), key=str)


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in queries.read(spark, folder, "documents").select("doc_id", "text").collect()]
    got = queries.op4_suffixes(spark, folder).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == slow(rows)


@pytest.mark.parametrize("hot, send, shard", [(2048, 64, 4096), (3, 64, 4096), (2048, 2, 2), (1, 1, 3), (1, 1, 1)])
def test_repeats_of_all_kinds(documents, monkeypatch, hot, send, shard):
    """Copies, shared passages in differing surroundings, periodic texts and overlaps, with hot anchors in one shard or several."""
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "SEND", send)
    monkeypatch.setattr(suffixes, "SHARD", shard)
    monkeypatch.setattr(suffixes, "GATHER", 3000)
    monkeypatch.setattr(suffixes, "PIECE", 700)
    monkeypatch.setattr(suffixes, "CHUNK", 2000)
    rng = random.Random(5)
    shared = [prose(100 + k, 40) for k in range(4)]
    rows = []
    for i in range(40):
        parts = [prose(1000 + 7 * i + k, rng.randint(1, 12)) for k in range(3)]
        text = parts[0] + " " + rng.choice(shared) + " " + parts[1] + rng.choice(shared)[rng.randint(0, 60):] + parts[2]
        rows.append((i * 3 % 41, text))
    rows += [(60, "ab" * 400), (61, "x" * 350), (62, "y" * 99), (63, "y" * 100), (64, "é" * 90), (65, "\x00" * 250 + shared[0]),
             (66, shared[0] + "\x00" * 250), (67, rows[3][1]), (68, rows[3][1]), (69, rows[5][1] + rows[5][1])]
    assert fast(documents(rows)) == slow(rows)


def test_odd_rows(documents):
    assert fast(documents(ODD, clash=True)) == slow(ODD)
    assert fast(documents([])) == []


def handed_on(spark, monkeypatch, df, partitions):
    """Rows of every table stored on the way, with a number of shuffle partitions."""
    sizes, keep = {}, suffixes.stored

    def counted(table, name):
        out = keep(table, name)
        sizes[name] = out.count()
        return out

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(suffixes, "stored", counted)
    try:
        return fast(df.repartition(partitions)), sizes
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        monkeypatch.setattr(suffixes, "stored", keep)


@pytest.mark.parametrize("shard", [4096, 7])
def test_rows_do_not_grow_with_partitions(spark, documents, monkeypatch, shard):
    """Exact and near copies of one text: what is compared and merged depends on the texts, not on the tasks."""
    monkeypatch.setattr(suffixes, "HOT", 8)
    monkeypatch.setattr(suffixes, "SHARD", shard)
    text = prose(7, 120)
    rows = [(i, text) for i in range(150)] + [(1000 + i, text[:5 * i] + "~" + text[5 * i:]) for i in range(100)]
    few, small = handed_on(spark, monkeypatch, documents(rows), 4)
    many, large = handed_on(spark, monkeypatch, documents(rows), 48)
    assert few == many == slow(rows)
    assert small["compared"] == large["compared"] > 0 and small["merged"] == large["merged"]
    assert (small["merged"] > 0) == (shard == 7)


def test_repeated_rows_and_many_near_copies(spark, documents):
    """Null-id copies count once each; a group of near copies is linear."""
    text = prose(8, 700)
    rows = [(None, text)] * 400 + [(5, prose(9, 30))] * 50
    assert fast(documents(rows)) == slow(rows)
    text = prose(10, 40)
    rows = [(i, f"{text[:i % len(text)]}{i}{text[i % len(text):]}") for i in range(2000)]
    assert fast(documents(rows)) == slow(rows)


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(1)
    for letters, n in ((2, 300), (4, 1000), (1, 64)):
        data = rng.integers(97, 97 + letters, n).astype(np.uint8)
        text = data.tobytes()
        sa = suffixes.suffix_array(data, n)
        assert sa.tolist() == sorted(range(n), key=lambda i: text[i:])
        sizes = np.array([n // 3, n - n // 3])
        got = suffixes.common_prefixes(data, sa, np.cumsum(sizes) - sizes, sizes, 50)
        for k in range(1, n):
            a, b = text[sa[k]:], text[sa[k - 1]:]
            same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert got[k] == min(same, 50)
