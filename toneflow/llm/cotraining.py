"""Quality classifier by co-training.

Two logistic models see different views of a document: one its text (kinds of
bytes, byte pairs, words and their repetition), one its metadata (source,
language, stated length, layout in lines).  Both start from labelled rows; then,
for some rounds, each learns again from the documents of the whole corpus of
which the other one is confident.  A last model combines the calibrated views.

Features are computed once and stored.  A round of learning is a few Newton
steps, each one pass over that table: every task adds up its gradient and
curvature, sums are merged in tasks, and the driver solves a small system.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toneflow.llm.tables import stored

PAIRS, SOURCES, LANGS, LENGTHS = 64, 32, 8, 12
SYMBOLS = np.frombuffer(b"#$%&*+/<=>@\\^_`{|}~", np.uint8)
STATS = 18
TEXT_DIM, META_DIM = 1 + STATS + PAIRS, 1 + SOURCES + LANGS + LENGTHS + 5


def text_view(text: str | None) -> np.ndarray:
    """Features of a whole text; without any character all but the constant are 0."""
    out = np.zeros(TEXT_DIM, np.float32)
    out[0] = 1
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    n = len(data)
    if not n:
        return out
    counts = np.bincount(data, minlength=256)
    upper, lower, digits, high = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum(), counts[128:].sum()
    words = text.split()
    m = max(1, len(words))
    distinct = len(set(words))
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    out[1:1 + STATS] = (
        upper / max(1, upper + lower), lower / n, digits / n, high / n, counts[SYMBOLS].sum() / n, counts[33] / n,
        counts[124] / n, counts[46] / n, counts[44] / n, counts[32] / n, (counts[9:14].sum() - counts[10]) / n,
        counts[10] / n, counts[:9].sum() / n, np.log1p(n) / 10, distinct / m, np.log1p(distinct) / np.log1p(m),
        again / m, (n - counts[32] - counts[10]) / m / 10)
    pairs = (data[:-1].astype(np.uint16) * 31 + data[1:]) % PAIRS
    out[1 + STATS:] = np.sqrt(np.bincount(pairs, minlength=PAIRS) / max(1, n - 1))
    return out


def meta_view(source: str | None, lang: str | None, n_chars: float | None, text: str | None) -> np.ndarray:
    """Features of what is stated about a document and of its layout; a null is a value of its own."""
    out = np.zeros(META_DIM, np.float32)
    out[0], at = 1, 1
    for value, size in ((source, SOURCES), (lang, LANGS)):
        out[at + zlib.crc32(repr(value).encode("utf-8", "replace")) % size] = 1
        at += size
    known = n_chars is not None and n_chars == n_chars and n_chars >= 0
    out[at + (min(LENGTHS - 1, 1 + int(np.log2(1 + n_chars) / 2)) if known else 0)] = 1
    at += LENGTHS
    text = text or ""
    lines = 1 + text.count("\n")
    out[at:] = np.log1p(lines) / 5, np.log1p(len(text) / lines) / 10, known and n_chars == len(text), \
        "\n\n" in text, text.count("http") / lines
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Curvature and gradient of the weighted log-likelihood, flat."""
    p = sigmoid(x @ w)
    return np.concatenate((((x * (weight * p * (1 - p))[:, None]).T @ x).ravel(), x.T @ (weight * (y - p))))


def step(flat: np.ndarray, w: np.ndarray, ridge: float) -> np.ndarray:
    d = len(w)
    penalty = np.full(d, ridge)
    penalty[0] = 1e-6
    change = np.linalg.solve(flat[:d * d].reshape(d, d) + np.diag(penalty), flat[d * d:] - penalty * w)
    return w + change * min(1.0, 10 / max(1e-9, np.abs(change).max()))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        w = step(sums(x, y, np.ones(len(y)), w), w, ridge)
    return w


@dataclass(frozen=True)
class Limits:
    """Probabilities beyond which a view's word is taken for a label; none where it isn't reliable enough."""

    low: float = -1.0
    high: float = 2.0


def limits(p: np.ndarray, y: np.ndarray, precision: float, least: int = 50) -> Limits:
    """The widest limits with at least ``precision`` right and ``least`` rows among labelled ones."""
    def widest(order: np.ndarray, right: np.ndarray) -> int | None:
        share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(share >= precision)
        return int(good[-1]) if len(good) and good[-1] + 1 >= least else None

    up, down = np.argsort(-p, kind="stable"), np.argsort(p, kind="stable")
    high, low = widest(up, y), widest(down, 1 - y)
    return Limits(min(0.5, p[down[low]]) if low is not None else -1.0, max(0.5, p[up[high]]) if high is not None else 2.0)


@dataclass(frozen=True)
class Model:
    """Coefficients of both views and of their combination (constant, text, metadata)."""

    text: np.ndarray
    meta: np.ndarray
    both: np.ndarray
    rounds: list[dict] = field(default_factory=list)

    def score(self, t: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = sigmoid(t @ self.text), sigmoid(m @ self.meta)
        views = np.column_stack((np.ones(len(a)), logit(a), logit(b)))
        return a, b, sigmoid(views @ self.both)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten() if len(column) else pa.array([], pa.float32())
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _lists(x: np.ndarray) -> pa.Array:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel().astype(np.float32)))


def features(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, chars_col: str) -> DataFrame:
    """(id, t, m): both views of every row."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), 1000):
                b = whole.slice(k, 1000)
                ids, texts, sources, langs, chars = (b.column(i) for i in range(5))
                texts = texts.to_pylist()
                rows = zip(sources.to_pylist(), langs.to_pylist(), chars.to_pylist(), texts, strict=True)
                t = np.array([text_view(x) for x in texts], np.float32).reshape(-1, TEXT_DIM)
                m = np.array([meta_view(*r) for r in rows], np.float32).reshape(-1, META_DIM)
                yield pa.RecordBatch.from_arrays([ids, _lists(t), _lists(m)], ["id", "t", "m"])

    columns = docs.select(F.col(id_col).alias("id"), F.col(text_col), F.col(source_col).cast("string").alias("s"),
                          F.col(lang_col).cast("string").alias("l"), F.col(chars_col).cast("double").alias("c"))
    return columns.mapInArrow(of, f"id {dict(docs.dtypes)[id_col]}, t array<float>, m array<float>")


def _pass(table: DataFrame, now: tuple, word: tuple, limit: tuple[Limits, Limits]) -> np.ndarray:
    """One pass over all documents: sums of both views for the labels that the other view gives, and their numbers."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            views = _matrix(b.column(0), TEXT_DIM).astype(float), _matrix(b.column(1), META_DIM).astype(float)
            parts = []
            for k in (0, 1):
                p = sigmoid(views[1 - k] @ word[1 - k])  # what the other view says
                sure = (p <= limit[1 - k].low) | (p >= limit[1 - k].high)
                y = (p[sure] >= 0.5).astype(float)
                parts += [sums(views[k][sure], y, np.ones(len(y)), now[k]), [len(y), y.sum()]]
            part = np.concatenate(parts)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [np.frombuffer(x.as_py()) for b in batches for x in b.column(0)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([np.sum(rows, axis=0).tobytes()], pa.binary())], ["sums"])

    rows = table.select("t", "m").mapInArrow(add, "sums binary").repartition(16).mapInArrow(merge, "sums binary").collect()
    empty = TEXT_DIM * (TEXT_DIM + 1) + META_DIM * (META_DIM + 1) + 4
    return np.sum([np.frombuffer(r[0]) for r in rows], axis=0) if rows else np.zeros(empty)


def train(table: DataFrame, labels: DataFrame, id_col: str, label_col: str, labelled_rows: int = 20_000,
          rounds: int = 2, steps: int = 3, precision: float = 0.98, pseudo_weight: float = 0.2) -> Model:
    """Co-train on ``table`` (id, t, m) with labels 0 and 1.

    At most ``labelled_rows`` labelled rows are used, those with the smallest
    hashes of their ids; a quarter of them only calibrates.  Pseudo-labels come
    from all rows of the table; together they weigh ``pseudo_weight`` of the
    labelled rows' number at most.  Labels other than 0 and 1 and ids that aren't
    found are ignored.  With labels of one class only, or none, every score is 0.5.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("y IN (0, 1)")
    order = F.xxhash64(F.col("id").cast("string"))
    sample = stored(known.orderBy(order, "id", "y").limit(labelled_rows), "labelled")
    rows = table.join(sample, "id").select("id", "y", "t", "m").orderBy(order, "id", "y").limit(labelled_rows).toPandas()
    y = rows["y"].to_numpy(float)
    if len(np.unique(y)) < 2:
        return Model(np.zeros(TEXT_DIM), np.zeros(META_DIM), np.zeros(3))
    views = np.stack(rows["t"]).astype(float), np.stack(rows["m"]).astype(float)
    test = np.arange(len(y)) % 4 == 3
    if len(np.unique(y[~test])) < 2 or len(np.unique(y[test])) < 2:
        test = np.zeros(len(y), bool)
    hold = test if test.any() else ~test
    w = [fit(v[~test], y[~test]) for v in views]
    log = []
    for _ in range(rounds):
        word = tuple(w)
        limit = tuple(limits(sigmoid(v[hold] @ u), y[hold], precision) for v, u in zip(views, word, strict=True))
        for _ in range(steps):
            flat = _pass(table, tuple(w), word, limit)
            at = 0
            for k, v in enumerate(views):
                d = v.shape[1]
                part, (n, ones) = flat[at:at + d * d + d], flat[at + d * d + d:at + d * d + d + 2]
                at += d * d + d + 2
                share = pseudo_weight * (~test).sum() / n if n else 0.0
                own = sums(v[~test], y[~test], np.ones((~test).sum()), w[k])
                w[k] = step(own + min(1.0, share) * part, w[k], 1.0)
                if k == 0:
                    log.append({"text_learns_from": int(n), "of_them_good": int(ones)})
    a, b = (sigmoid(v @ u) for v, u in zip(views, w, strict=True))
    both = fit(np.column_stack((np.ones(hold.sum()), logit(a[hold]), logit(b[hold]))), y[hold], ridge=0.1)
    return Model(w[0], w[1], both, log)


def scores(table: DataFrame, model: Model) -> DataFrame:
    """(id, text_score, meta_score, score) of every row of (id, t, m)."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = model.score(_matrix(b.column(1), TEXT_DIM).astype(float), _matrix(b.column(2), META_DIM).astype(float))
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, found)], ["id", "text_score", "meta_score", "score"])

    return table.mapInArrow(of, f"id {dict(table.dtypes)['id']}, text_score double, meta_score double, score double")


def scorer(model: Model) -> Callable[..., Column]:
    """The combined score as a column of (text, source, lang, n_chars)."""
    @F.pandas_udf("double")
    def of(text: pd.Series, source: pd.Series, lang: pd.Series, chars: pd.Series) -> pd.Series:
        found = [np.empty(0)]
        for k in range(0, len(text), 1000):
            rows = list(zip(source[k:k + 1000], lang[k:k + 1000], chars[k:k + 1000], text[k:k + 1000], strict=True))
            t = np.array([text_view(r[3]) for r in rows], np.float32)
            found.append(model.score(t.astype(float), np.array([meta_view(*r) for r in rows], np.float32).astype(float))[2])
        return pd.Series(np.concatenate(found))

    return of


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          source_col: str = "source", lang_col: str = "lang", chars_col: str = "n_chars", **options) -> tuple[Model, DataFrame]:
    """The co-trained model and the stored views of all rows of ``docs``."""
    table = stored(features(docs, id_col, text_col, source_col, lang_col, chars_col), "views")
    return train(table, labels, id_col, label_col, **options), table


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", source_col: str = "source", lang_col: str = "lang",
              chars_col: str = "n_chars", **options) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, unchanged; empty and null texts are scored like others."""
    model, _ = learn(docs, labels, id_col, text_col, label_col, source_col, lang_col, chars_col, **options)
    score = scorer(model)(F.col(text_col), F.col(source_col).cast("string"), F.col(lang_col).cast("string"),
                          F.col(chars_col).cast("double"))
    return docs.filter(score >= threshold)
