"""Embedding near-duplicates by p-stable hashing.

A vector of length 1 is projected on random directions, shifted and cut into
steps of ``WIDTH``; ``k`` steps together are its bucket in one of ``L`` tables.
Two vectors with cosine c are sqrt(2 - 2c) apart and share a bucket with a
known probability.  ``k`` is chosen so that unrelated vectors rarely meet at the
present number of vectors, ``L`` so that pairs at the threshold meet somewhere
with probability ``recall``.  Cosines of all that meet are computed in double precision.

Equal vectors are merged first.  A pair counts in the first table where it
meets.  Tasks hand on counts and a spanning forest, never pairs; a bucket
beyond ``BLOCK`` vectors is dealt out as pairs of blocks to many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toneflow.llm.components import components
from toneflow.llm.tables import stored

WIDTH, BLOCK, SMALL = 2.0, 2048, 24


def meeting(distance: float, width: float = WIDTH) -> float:
    """Probability that two points at a distance fall in the same step of one projection."""
    t = width / distance
    return math.erf(t / math.sqrt(2)) - math.sqrt(2 / math.pi) / t * (1 - math.exp(-t * t / 2))


def shape(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(steps per bucket, tables) for n vectors."""
    far, near = meeting(math.sqrt(2)), meeting(math.sqrt(2 - 2 * threshold))
    k = max(4, math.ceil(math.log(max(2, n)) / -math.log(far)))
    return k, math.ceil(math.log(1 - recall) / math.log(1 - near ** k))


def keys_of(unit: np.ndarray, k: int, tables: int, seed: int) -> np.ndarray:
    """Bucket of every vector (row) in every table, as 64-bit hashes."""
    d = unit.shape[1]
    rng = np.random.default_rng((seed, d, k, tables))
    directions, shifts = rng.standard_normal((d, k * tables)), rng.uniform(0, WIDTH, k * tables)
    mixers = rng.integers(1, 1 << 63, k, dtype=np.uint64) | np.uint64(1)
    out = np.empty((len(unit), tables), np.uint64)
    for t in range(tables):
        at = slice(t * k, t * k + k)
        steps = np.floor((unit @ directions[:, at] + shifts[at]) / WIDTH).astype(np.int64).view(np.uint64)
        h = np.full(len(unit), np.uint64(d * 1000003 + t))
        for j in range(k):
            h = (h ^ (steps[:, j] * mixers[j])) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out[:, t] = h
    return out


def _units(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors of length 1) by dimension."""
    sizes = np.asarray(vectors.value_lengths())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        x = flat[starts[rows][:, None] + np.arange(d)]
        x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of large and small components stay finite
        yield rows, x / np.linalg.norm(x, axis=1, keepdims=True)


def _pairs(unit: np.ndarray, cells: np.ndarray, own: np.ndarray, across: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one cell that reach the threshold; rows are in the order of cells.

    Small cells are compared all at once, neighbour by neighbour; each large
    one by a product of matrices.  ``across`` marks cells of two blocks, whose
    rows only meet those of the other block.
    """
    cuts = np.flatnonzero(np.diff(cells)) + 1
    starts = np.concatenate(([0], cuts))
    sizes = np.diff(np.concatenate((starts, [len(cells)])))
    small = np.repeat(sizes <= SMALL, sizes)
    for gap in range(1, SMALL):
        a = np.flatnonzero((cells[gap:] == cells[:-gap]) & small[gap:]) if gap < len(cells) else []
        if not len(a):
            break
        b = a + gap
        good = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
        good &= ~across[a] | (own[a] != own[b])
        if good.any():
            yield a[good], b[good]
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        x, o = unit[s:s + n], own[s:s + n]
        for k in range(0, n, 256):
            near = x[k:k + 256] @ x.T >= threshold
            if across[s]:
                near &= o[k:k + 256, None] != o[None, :]
            a, b = np.nonzero(near)
            later = a + k < b
            if later.any():
                yield a[later] + k + s, b[later] + s


def _meet(cells: np.ndarray, blocks: np.ndarray, table: np.ndarray, ids: np.ndarray, times: np.ndarray, vectors: pa.Array,
          threshold: float, k: int, tables: int, seed: int) -> tuple[dict[int, int], set[tuple[int, int]]]:
    """Links within cells: the copies that each vector links to, and edges that connect them.

    ``blocks`` has (own, other) of each row; rows of one block pair meet across, those of a block with itself all.
    """
    links: dict[int, int] = {}
    edges: set[tuple[int, int]] = set()
    for rows, unit in _units(vectors):
        order = rows[np.argsort(cells[rows], kind="stable")]
        unit = unit[np.argsort(cells[rows], kind="stable")]
        t, who, n = table[order], ids[order], times[order]
        names, name = np.unique(who, return_inverse=True)
        sums, parent = np.zeros(len(names)), np.arange(len(names))
        known: dict[int, np.ndarray] = {}
        for a, b in _pairs(unit, cells[order], blocks[order, 0], blocks[order, 0] != blocks[order, 1], threshold):
            # A pair counts in the first table where it meets.
            need = np.unique(np.concatenate((a, b)))
            fresh = [i for i in need[np.unique(name[need], return_index=True)[1]].tolist() if int(name[i]) not in known]
            if fresh:
                known.update(zip(name[fresh].tolist(), keys_of(unit[fresh], k, tables, seed), strict=True))
            at = np.unique(name[need])
            keys = np.stack([known[i] for i in at.tolist()])
            for c in range(0, len(a), 32768):
                x, y = a[c:c + 32768], b[c:c + 32768]
                same = keys[np.searchsorted(at, name[x])] == keys[np.searchsorted(at, name[y])]
                new = ~(same & (np.arange(tables) < t[x][:, None])).any(axis=1)
                x, y = x[new], y[new]
                sums += np.bincount(name[x], n[y], len(names)) + np.bincount(name[y], n[x], len(names))
                x, y = name[x], name[y]
                while len(x):
                    rx, ry = parent[x], parent[y]
                    apart = rx != ry
                    x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
                    if not len(x):
                        break
                    high, low = np.maximum(rx, ry), np.minimum(rx, ry)
                    first = np.unique(high, return_index=True)[1]
                    edges.update(zip(names[x[first]].tolist(), names[y[first]].tolist(), strict=True))
                    parent[high[first]] = low[first]
                    while not np.array_equal(up := parent[parent], parent):
                        parent = up
        for i in np.flatnonzero(sums):
            links[int(names[i])] = links.get(int(names[i]), 0) + int(sums[i])
    return links, edges


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, recall: float = 0.995, seed: int = 5,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    ``n_links`` counts the other rows with a cosine of at least ``threshold``
    that were found, copies included; ``component_id`` is the smallest id
    reachable over links, itself included; ``kept`` tells whether that is the
    row's own.  Null, empty and zero vectors and those with null or non-finite
    components link with nothing, nor do vectors of different lengths.  Rows
    with a null id take part; alone they have a null component and aren't kept.  An empty
    table gives an empty one.
    """
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & \
        F.exists(v, lambda x: x != 0)
    # -0.0 and 0.0 are the same.
    rows = stored(rows.select("id", F.when(sound, F.transform(v, lambda x: x + F.lit(0.0))).alias("v")).withColumn(
        "class", F.when(F.col("v").isNotNull(), F.xxhash64("v"))), "vectors")
    classes = stored(rows.filter("class IS NOT NULL").groupBy("class").agg(
        F.min("id").alias("id"), F.count("*").alias("times"), F.first("v").alias("v")), "classes")
    k, tables = shape(classes.count(), threshold, recall)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2000):
                b = whole.slice(at, 2000)
                ids = b.column(0).to_numpy(zero_copy_only=False)
                for found, unit in _units(b.column(1)):
                    keys = keys_of(unit, k, tables, seed)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(ids[found], tables)), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(found))),
                        pa.array(keys.ravel().view(np.int64))], ["class", "table", "bucket"])

    entries = stored(classes.select("class", "v").mapInArrow(enter, "class long, table int, bucket long"), "entries")
    shared = stored(entries.groupBy("table", "bucket").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    # Only entries that meet another one carry their vector.
    met = entries.join(shared, ["table", "bucket"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    met = met.withColumn("own", F.pmod(F.xxhash64("class", F.lit(1)), blocks).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    met = stored(met.select("class", "table", "own", "other", F.xxhash64("table", "bucket", low, high).alias("cell")), "met")
    dealt = met.join(classes.select("class", "times", "v"), "class").repartition("cell").sortWithinPartitions("cell")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(table: pa.Table) -> pa.RecordBatch:
            c = {n: table.column(n).combine_chunks() for n in table.column_names}
            c = {n: x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for n, x in c.items()}
            num = {n: c[n].to_numpy(zero_copy_only=False) for n in ("cell", "own", "other", "table", "class", "times")}
            links, edges = _meet(num["cell"], np.column_stack((num["own"], num["other"])), num["table"], num["class"],
                                 num["times"], c["v"], threshold, k, tables, seed)
            a = list(links) + [e[0] for e in edges]
            b = [None] * len(links) + [e[1] for e in edges]
            n = list(links.values()) + [0] * len(edges)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "n"])

        held: list[pa.RecordBatch] = []  # rows of the last cell so far, which may go on
        for whole in batches:
            for at in range(0, len(whole), 4096):
                b = whole.slice(at, 4096)
                cells = b.column(0).to_numpy(zero_copy_only=False)
                first = int(np.flatnonzero(cells == cells[-1])[0])
                goes_on = bool(held) and cells[0] == held[-1].column(0)[0].as_py()
                if first or held and not goes_on:
                    if done := [*held, b.slice(0, first)]:
                        yield flush(pa.Table.from_batches(done))
                    held = []
                held.append(b.slice(first))
        if held:
            yield flush(pa.Table.from_batches(held))

    found = stored(dealt.select("cell", "own", "other", "table", "class", "times", "v").mapInArrow(
        meet, "a long, b long, n long"), "links")
    counts = found.groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    roots = components(found.filter("b IS NOT NULL").select("a", "b"))
    named = classes.select("class", "id", "times").join(roots.withColumnRenamed("node", "class"), "class", "left")
    named = stored(named.withColumn("root", F.coalesce("root", "class")).join(counts, "class", "left"), "named")
    least = stored(named.groupBy("root").agg(F.min("id").alias("component")), "least")
    judged = stored(named.join(least, "root").select(
        F.col("class"), (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n"), "component"), "judged")
    out = rows.select("id", "class").join(judged, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
