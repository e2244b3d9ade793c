"""SimHash near-duplicates by multi-index hashing.

A fingerprint has two halves of 32 bits.  Two fingerprints within four bits
differ by at most two bits in one of the halves, and two halves within two
bits have a common neighbour within one bit of both.  So every fingerprint is
entered in a table under each half and its 32 neighbours (66 entries), equal
entries are candidates, and their complete distance is checked.  Candidates
grow with N^2 / 2^22 only, so entries, not pairs, are the cost.

Equal fingerprints are merged first, so a group of copies is one row.  A task
never emits all pairs of an entry: it checks them in blocks and hands on a
spanning forest, which has the same components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toneflow.llm.components import components
from toneflow.llm.tables import OWN, light, stored

SEED = 42
#: Pairs of an entry are compared neighbour by neighbour up to this size, in blocks beyond it.
SMALL, BLOCK, LARGE = 16, 1024, 4096


def simhash(text: str | None, shingle: int = 4) -> int:
    """Fingerprint of one text as a signed 64-bit number; 0 without words."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[:n - 1] + 1)).tolist()
    ends = ends[-n:].tolist()
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in
                           zip(starts[k:k + (1 << 16)], ends[k:k + (1 << 16)], strict=True)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """Column of fingerprints, 64 bits as a long.  Null and blank texts give 0."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return of(text)


def _near(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= bits


def _forest(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges that connect what links connect among distinct fingerprints, compared in blocks."""
    parent = np.arange(len(fps))
    edges = []
    for i in range(0, len(fps), BLOCK):
        for j in range(i, len(fps), BLOCK):
            x, y = np.nonzero(_near(fps[i:i + BLOCK, None], fps[None, j:j + BLOCK], bits))
            x, y = x + i, y + j
            keep = x < y
            x, y = x[keep], y[keep]
            while len(x):
                # One hook per root and pass; all labels are flat before and after.
                rx, ry = parent[x], parent[y]
                apart = rx != ry
                x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
                if not len(x):
                    break
                high, low = np.maximum(rx, ry), np.minimum(rx, ry)
                first = np.unique(high, return_index=True)[1]
                edges += zip(fps[x[first]].tolist(), fps[y[first]].tolist(), strict=True)
                parent[high[first]] = low[first]
                while not np.array_equal(up := parent[parent], parent):
                    parent = up
    return edges


def _split(fps: np.ndarray, shift: int, bits: int) -> list[tuple[int, int]]:
    """The same for a large entry: enter the 16-bit quarters of the half at ``shift`` in a table of their own."""
    edges = []
    for part in (shift, shift + 16):
        quarter = (fps >> np.uint64(part)) & np.uint64(0xFFFF)
        flips = np.concatenate(([0], 1 << np.arange(16))).astype(np.uint64)
        keys = (quarter[:, None] ^ flips).ravel()
        order = np.argsort(keys, kind="stable")
        who = np.repeat(np.arange(len(fps)), 17)[order]
        cuts = np.flatnonzero(np.diff(keys[order])) + 1
        for group in np.split(who, cuts):
            if len(group) > 1:
                edges += _forest(fps[group], bits)
    return list(set(edges))


def links_of(keys: np.ndarray, fps: np.ndarray, bits: int) -> np.ndarray:
    """Edges among fingerprints with equal table entries; the entry's top bit tells the half."""
    order = np.lexsort((fps, keys))
    keys, fps = keys[order], fps[order].view(np.uint64)
    cuts = np.flatnonzero(np.diff(keys)) + 1
    starts = np.concatenate(([0], cuts))
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    found = []
    small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
    k, f = keys[small], fps[small]
    for gap in range(1, SMALL):
        same = np.flatnonzero((k[gap:] == k[:-gap]) if gap < len(k) else [])
        if not len(same):
            break
        a, b = f[same], f[same + gap]
        near = _near(a, b, bits)
        found.append(np.column_stack((a[near], b[near])))
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        group = fps[s:s + n]
        other = 0 if keys[s] >> 32 else 32  # bits of the half that this entry doesn't hold
        found.append(np.array(_forest(group, bits) if n <= LARGE else _split(group, other, bits), np.uint64).reshape(-1, 2))
    return np.unique(np.concatenate(found), axis=0).view(np.int64) if found else np.empty((0, 2), np.int64)


def near_links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Edges (a, b) of a graph whose components are those of all links of at most ``max_bits`` bits.

    ``fps`` has one distinct long column ``fingerprint``.
    """
    if not 0 <= max_bits <= 5:
        raise ValueError("two halves with balls of one bit find distances up to 5")
    fp = F.col("fingerprint")
    halves = []
    for top, half in ((1, F.shiftrightunsigned(fp, 32)), (0, fp.bitwiseAND(F.lit(0xFFFFFFFF)))):
        ball = [half] + [half.bitwiseXOR(F.lit(1 << i)) for i in range(32)]
        halves += [h.bitwiseOR(F.lit(top << 32)) for h in ball]
    entries = fps.select("fingerprint", F.explode(F.array(*halves)).alias("entry"))

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = [], []
        for b in batches:
            keys.append(b.column(0).to_numpy(zero_copy_only=False))
            prints.append(b.column(1).to_numpy(zero_copy_only=False))
        if keys:
            found = links_of(np.concatenate(keys), np.concatenate(prints), max_bits)
            for k in range(0, len(found), 1 << 16):
                part = found[k:k + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], ["a", "b"])

    dealt = entries.repartition("entry").select("entry", "fingerprint")
    return dealt.mapInArrow(within, "a long, b long")


def _first_of(prints: DataFrame, order: Column, max_bits: int) -> DataFrame:
    """(fingerprint, first): the smallest ``order`` among the rows of ``prints`` in the component of every fingerprint."""
    distinct = stored(prints.groupBy("fingerprint").agg(F.min(order).alias("first")), "distinct")
    roots = components(near_links(distinct.select("fingerprint"), max_bits))
    roots = stored(roots.select(F.col("node").alias("fingerprint"), "root"), "roots")
    named = distinct.join(roots, "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    least = stored(named.groupBy("root").agg(F.min("first").alias("first")), "least")
    return stored(named.drop("first").join(least, "root").select("fingerprint", "first"), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(id, fingerprint long, component_id) of every row.

    component_id is the smallest id reachable over links of at most
    ``max_bits`` differing bits.  Null and blank texts have fingerprint 0 and
    link like others.  Null ids never name a component unless all of it are
    null.  Repeated rows come back as often as they came; other columns are not
    read.  An empty table gives an empty one.
    """
    prints = stored(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fingerprint")),
                    "fingerprints")
    classes = _first_of(prints, F.col("id"), max_bits)
    out = prints.join(classes, "fingerprint")
    return out.select(F.col("id").alias(id_col), "fingerprint", F.col("first").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of ``docs`` of every component: the smallest id, nulls last, then the smallest text hash.

    Of rows that agree in both, one stays.
    """
    row = f"{OWN}row"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    order = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
                     F.xxhash64(text_col).alias("hash"), F.col(row).alias("nth"))
    prints = stored(rows.select(order.alias("order"), fingerprint(F.col(text_col), shingle).alias("fingerprint")), "fingerprints")
    found = prints.join(_first_of(prints, F.col("order"), max_bits), "fingerprint")
    nth = F.col("order")["nth"]
    gone = stored(found.filter(nth != F.col("first")["nth"]).select(nth.alias(row)), "gone")
    return rows.join(light(gone), row, "left_anti").drop(row)
