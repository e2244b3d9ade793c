from __future__ import annotations

import numpy as np
import pytest

from toneflow.llm import embeddings


@pytest.fixture
def vectors(spark):
    def make(rows):
        rows = [(i, [float(x) for x in v] if isinstance(v, np.ndarray) else v) for i, v in rows]
        return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
            "*", "'c' AS class", "'c' AS v", "'c' AS id", "'c' AS n", "'c' AS bucket")
    return make


def slow(rows, threshold=0.95):
    ok = [i for i, (_, v) in enumerate(rows) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.float32(rows[i][1]).astype(float) / np.linalg.norm(np.float32(rows[i][1]).astype(float)) for i in ok}
    near = {i: [j for j in ok if i != j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in ok}
    out = []
    for i, (vid, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        root = min(ids) if ids else None
        out.append((vid, len(near.get(i, [])), root, vid is not None and vid == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [2048, 5])
def test_against_brute_force(vectors, monkeypatch, block):
    """Clusters, copies, multiples, chains and lone vectors; large buckets whole and in blocks."""
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(5):
        c = rng.standard_normal(24)
        c /= np.linalg.norm(c)
        rows += [c + rng.standard_normal(24) * 0.025 for _ in range(25)]
    at = rng.standard_normal(24)
    for _ in range(12):
        rows.append(at)
        at = at / np.linalg.norm(at) + rng.standard_normal(24) * 0.05
    rows += [rows[0]] * 6 + [rows[3] * 7, rows[4] * 1e-20, rows[5] * 1e20] + [rng.standard_normal(24) for _ in range(60)]
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(rows)), rows, strict=True)]
    got = [tuple(r) for r in embeddings.near_duplicates(vectors(rows), recall=0.99999).collect()]
    assert sorted(got, key=str) == slow(rows)


def test_recall_at_the_threshold(vectors):
    """Pairs with a cosine of just 0.95 are found as often as promised."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        a = rng.standard_normal(48)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(48)
        b -= b @ a * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a), (2 * i + 1, 0.9501 * a + (1 - 0.9501 ** 2) ** 0.5 * b)]
    found = sum(r["n_links"] for r in embeddings.near_duplicates(vectors(rows)).collect()) / len(rows)
    assert found >= 0.98


def test_odd_rows(vectors):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 2.0]),
            (7, [1.0, 2.0]), (8, [2.0, 4.0]), (None, [1.0, 2.0]), (9, [1.0, 2.0, 0.0]), (10, [0.0, 1.0]), (11, [-0.0, 1.0]), (None, None)]
    got = sorted((tuple(r) for r in embeddings.near_duplicates(vectors(rows)).collect()), key=str)
    assert got == slow(rows)
    assert embeddings.near_duplicates(vectors([])).count() == 0


def test_probabilities_of_meeting():
    rng = np.random.default_rng(3)
    for distance in (0.3, 1.4):
        x = rng.standard_normal(200_000) * distance
        shift = rng.uniform(0, embeddings.WIDTH, len(x))
        meet = (np.floor(shift / embeddings.WIDTH) == np.floor((shift + x) / embeddings.WIDTH)).mean()
        assert abs(meet - embeddings.meeting(distance)) < 0.01
