"""Softmax regressions trained side by side: one pass over the rows is a step of all of them."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.stat import Summarizer
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toneflow.schemas import LABELS

#: Steps a regression remembers for its next direction.
MEMORY = 6
#: Features whose sums are added up as one row.
BLOCK = 4096
#: Values (of words in texts) that a task looks at together.
CHUNK = 1 << 18
#: A regression has converged when a step lowers its loss by less than this share.
TOLERANCE = 1e-6

K = len(LABELS)
# Totals of a regression: loss, weight, loss of held-out rows, hits among them, their number, then K sums of residuals.
TOTALS = 5 + K


@dataclass
class Fit:
    """A regression in training; ``history`` has a row per pass, the first one before any step.

    Rows are (iteration, loss, eval_loss, eval_accuracy) of the best point so far,
    so that losses never rise; the last two are null without held-out rows.
    """

    reg_param: float
    point: np.ndarray
    best: np.ndarray | None = None
    loss: float = np.inf
    gradient: np.ndarray | None = None
    direction: np.ndarray | None = None
    step: float = 1.0
    done: bool = False
    scores: tuple[float | None, float | None] = (None, None)
    history: list[tuple] = field(default_factory=list)
    pairs: deque = field(default_factory=lambda: deque(maxlen=MEMORY))

    def tell(self, loss: float, gradient: np.ndarray, scores: tuple[float | None, float | None]) -> None:
        """Take the loss and gradient at ``point`` and choose the next point.

        A point that does not lower the loss enough is given up for one halfway
        back, which is the next pass's.
        """
        first = self.gradient is None
        if first or loss <= self.loss + 1e-4 * self.step * (self.direction @ self.gradient):
            if not first:
                moved, turned = self.point - self.best, gradient - self.gradient
                if moved @ turned > 1e-12 * (turned @ turned):
                    self.pairs.append((moved, turned))
                self.done = self.loss - loss <= TOLERANCE * abs(self.loss)
            self.best, self.loss, self.gradient, self.scores = self.point, loss, gradient, scores
            self.direction = -self._curved(gradient)
            size = np.linalg.norm(gradient)
            self.step = 1.0 if self.pairs else min(1.0, 1.0 / size) if size else 0.0
        else:
            self.step /= 2
        self.done = self.done or self.step < 1e-10
        self.history.append((len(self.history), float(self.loss), *self.scores))
        self.point = self.best + self.step * self.direction

    def _curved(self, gradient: np.ndarray) -> np.ndarray:
        """The gradient times the inverse curvature that the remembered steps tell."""
        q, shares = gradient.copy(), []
        for moved, turned in reversed(self.pairs):
            share = moved @ q / (moved @ turned)
            q -= share * turned
            shares.append(share)
        if self.pairs:
            moved, turned = self.pairs[-1]
            q *= moved @ turned / (turned @ turned)
        for (moved, turned), share in zip(self.pairs, reversed(shares), strict=True):
            q += moved * (share - turned @ q / (moved @ turned))
        return q


def sums(batches: Iterator[pa.RecordBatch], weights: np.ndarray, intercepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients (features x regressions*K) and totals (regressions x TOTALS) over a task's rows.

    ``weight`` is null in held-out rows.
    """
    models = len(intercepts) // K
    gradient, totals = np.zeros_like(weights), np.zeros((models, TOTALS))
    for batch in batches:
        vectors = batch.column("features")
        indices, values = vectors.field("indices"), vectors.field("values")
        offsets = indices.offsets.to_numpy()
        words, counts = indices.values.to_numpy(), values.values.to_numpy()
        labels = batch.column("label_id").to_numpy(zero_copy_only=False).astype(np.int64)
        row_weights = batch.column("weight").to_numpy(zero_copy_only=False).astype(float)
        first, rows = 0, len(labels)
        while first < rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1)
            last = min(last, rows)
            part = slice(offsets[first], offsets[last])
            row = np.repeat(np.arange(last - first), np.diff(offsets[first:last + 1]))
            word, value, y, w = words[part], counts[part], labels[first:last], row_weights[first:last]
            scores = np.tile(intercepts, (last - first, 1))
            for c in range(models * K):
                scores[:, c] += np.bincount(row, value * weights[word, c], minlength=last - first)
            scores = scores.reshape(-1, models, K)
            scores -= scores.max(axis=2, keepdims=True)
            odds = np.exp(scores)
            probs = odds / odds.sum(axis=2, keepdims=True)
            held = np.isnan(w).astype(float)
            w = np.nan_to_num(w)
            own = np.log(np.maximum(probs[np.arange(len(y)), :, y], 1e-15))
            totals[:, 0] -= w @ own
            totals[:, 1] += w.sum()
            totals[:, 2] -= held @ own
            totals[:, 3] += held @ (probs.argmax(axis=2) == y[:, None])
            totals[:, 4] += held.sum()
            probs[np.arange(len(y)), :, y] -= 1
            residuals = probs * w[:, None, None]
            totals[:, 5:] += residuals.sum(axis=0)
            residuals = residuals.reshape(len(y), -1)
            used, place = np.unique(word, return_inverse=True)
            for c in range(models * K):
                gradient[used, c] += np.bincount(place, value * residuals[row, c], minlength=len(used))
            first = last
    return gradient, totals


def one_pass(rows: DataFrame, weights: np.ndarray, intercepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``sums`` over a whole table.

    A task hands on its sums in blocks of features; every block is added up by
    one task, and the driver gets one row a block.  Neighbouring splits share a
    task, so that there are as many sums as cores, however many rows.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((weights, intercepts))
    shape = (len(intercepts) // K, TOTALS)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient, totals = sums(batches, *shared.value)
        blocks = [(-1, totals.tobytes())]
        for start in range(0, len(gradient), BLOCK):
            block = gradient[start:start + BLOCK]
            if block.any():
                blocks.append((start // BLOCK, block.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in blocks], pa.int32()), pa.array([s for _, s in blocks], pa.binary())], ["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column("block").to_pylist(), batch.column("sums"), strict=True):
                part = np.frombuffer(part.as_buffer())
                found[block] = found[block] + part if block in found else part.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), pa.array([s.tobytes() for s in found.values()], pa.binary())], ["block", "sums"])

    schema = "block int, sums binary"
    parts = rows.coalesce(max(2, 2 * spark.sparkContext.defaultParallelism)).mapInArrow(partial, schema)
    added = parts.repartition("block").mapInArrow(add, schema).collect()
    shared.destroy()
    gradient, totals = np.zeros_like(weights), np.zeros(shape)
    for block, part in added:
        part = np.frombuffer(part)
        if block < 0:
            totals += part.reshape(shape)
        else:
            gradient[block * BLOCK:(block + 1) * BLOCK] += part.reshape(-1, weights.shape[1])
    return gradient, totals


def fit_all(rows: DataFrame, reg_params: Mapping[str, float], features: int, max_iter: int) -> tuple[dict[str, Fit], np.ndarray]:
    """Train a regression per regularisation; returns them and the features' deviations.

    ``rows`` has ``features`` (sparse vectors), ``label_id`` and ``weight``, null
    in held-out rows, and should be stored: it is read once for deviations and
    classes, once for the starting point and once per iteration, whatever the
    number of regressions.  Coefficients are penalised per standard deviation,
    intercepts are not.
    """
    trained = rows.where("weight IS NOT NULL")
    found = trained.select(
        Summarizer.metrics("std").summary(F.col("features"), F.col("weight")).alias("s"),
        *[F.sum(F.when(F.col("label_id") == k, F.col("weight")).otherwise(0.0)).alias(f"w{k}") for k in range(K)]).first()
    by_class = np.array([found[f"w{k}"] or 0.0 for k in range(K)])
    if not by_class.sum():
        raise ValueError("no row to train on has a weight")
    deviations = found["s"]["std"].toArray()
    scale = np.divide(1.0, deviations, out=np.zeros(features), where=deviations > 0)[:, None]
    start = np.zeros((features + 1) * K)
    start[-K:] = np.log(np.maximum(by_class, 1e-10 * by_class.sum()) / by_class.sum())
    fits = {name: Fit(reg_param, start) for name, reg_param in reg_params.items()}
    for _ in range(max_iter + 1):
        going = [f for f in fits.values() if not f.done]
        if not going:
            break
        weights = np.hstack([f.point[:-K].reshape(-1, K) * scale for f in going])
        gradients, totals = one_pass(rows, weights, np.concatenate([f.point[-K:] for f in going]))
        for i, (f, total) in enumerate(zip(going, totals, strict=True)):
            flat = (gradients[:, i * K:(i + 1) * K] * scale).ravel() / total[1] + f.reg_param * f.point[:-K]
            loss = total[0] / total[1] + f.reg_param / 2 * (f.point[:-K] @ f.point[:-K])
            scores = (float(total[2] / total[4]), float(total[3] / total[4])) if total[4] else (None, None)
            f.tell(loss, np.concatenate([flat, total[5:] / total[1]]), scores)
    return fits, deviations


def as_model(fit: Fit, deviations: np.ndarray) -> LogisticRegressionModel:
    """The best point of a regression as a Spark ML model, which scores in the JVM and can be saved."""
    scale = np.divide(1.0, deviations, out=np.zeros_like(deviations), where=deviations > 0)[:, None]
    coefficients = DenseMatrix(K, len(deviations), (fit.best[:-K].reshape(-1, K) * scale).ravel())
    return LogisticRegressionModel(JavaWrapper._new_java_obj(
        "org.apache.spark.ml.classification.LogisticRegressionModel", LogisticRegressionModel._randomUID(),
        coefficients, Vectors.dense(fit.best[-K:]), K, True))
