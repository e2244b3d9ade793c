from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from .conftest import ODD, prose
from toneflow.llm import queries, simhash

FOLDER = "/root/testdata/sf0.001"


def slow_fingerprint(text, shingle=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, bits=4):
    """Smallest index reachable, by flooding."""
    a = np.array(prints, np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= bits
    out = np.full(len(a), -1)
    for i in range(len(a)):
        if out[i] >= 0:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if out[j] < 0:
                out[j] = i
                todo += np.flatnonzero(near[j] & (out < 0)).tolist()
    return out.tolist()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAbBéñ \n\t \x1c😀"), max_size=60))
def test_fingerprint_of_any_text(text):
    assert simhash.simhash(text) % (1 << 64) == slow_fingerprint(text)


def test_query_against_brute_force(spark):
    rows = sorted(queries.read(spark, FOLDER, "documents").select("doc_id", "text").collect())
    prints = [slow_fingerprint(r["text"]) for r in rows]
    want = {(r["doc_id"], f"{p:016x}", rows[c]["doc_id"]) for r, p, c in zip(rows, prints, slow_components(prints), strict=True)}
    got = queries.op5_simhash(spark, FOLDER)
    assert {tuple(r) for r in got.select("doc_id", "fingerprint", "component_id").collect()} == want


@pytest.mark.parametrize("large", [8, 4096])
def test_links_in_crowded_entries(spark, monkeypatch, large):
    """Clusters, chains across both halves, and unrelated fingerprints."""
    monkeypatch.setattr(simhash, "LARGE", large)
    rng = np.random.default_rng(3)
    prints = set()
    for centre in rng.integers(0, 1 << 63, 6, dtype=np.uint64):
        at = int(centre)
        for _ in range(120):
            prints.add(at ^ sum(1 << int(b) for b in set(rng.integers(0, 64, 3))))
        for _ in range(40):
            at ^= sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            prints.add(at)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    edges = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fingerprint long")).collect()
    at = {p: i for i, p in enumerate(signed)}
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        assert bin((a ^ b) % (1 << 64)).count("1") <= 4
        x, y = find(at[a]), find(at[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(prints))] == slow_components(prints)


def test_odd_rows(documents):
    got = [tuple(r) for r in simhash.near_duplicates(documents(ODD, clash=True)).collect()]
    assert len(got) == len(ODD)
    of = {(i, p): c for i, p, c in got}
    assert of[2, 0] == of[3, 0] == of[4, 0] == of[None, 0] == 2
    assert {c for (i, _), c in of.items() if i in (1, 5)} == {1}
    kept = simhash.keep_one(documents(ODD, clash=True))
    assert "probability" in kept.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)[:2] == [1, 2]
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.keep_one(documents([])).count() == 0


def test_exactly_one_row_of_every_component_stays(documents):
    """Repeated rows, null ids, and an id that stands for two texts, once first of its group and once a copy."""
    a, b, c, d = (prose(k, 60) for k in (21, 22, 23, 24))
    rows = [(1, a)] * 5 + [(None, a), (7, a), (7, b), (8, b), (None, c), (None, c), (None, d), (9, d)]
    docs = documents(rows, clash=True)
    kept = simhash.keep_one(docs.repartition(3))
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(1, a), (7, b), (None, c), (9, d)], key=str)
