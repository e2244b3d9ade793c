"""Toxicity of texts whose words may be disguised.

A word with look-alike signs, drawn-out letters or inner separators is a
lattice: every sign may stand for some letters, a run of one letter for one or
two of it, a separator for nothing.  The cheapest way through the lattice under
a character model restores the word (Viterbi over pairs of letters).  Blanks are
part of the lattice where letters stand apart or pieces may belong together: a
blank is nothing or the end of a word, and what the lexicon knows is cheaper.
Plain words have one way only and are left as they are.

The character model counts the letter triples of the whole corpus.  A lexicon
of words and word beginnings that set toxic documents apart is learnt from the
restored words of labelled documents, and a small logistic model turns what it
finds in a document into a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Container, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toneflow.llm.cotraining import fit, sigmoid
from toneflow.llm.tables import stored

LETTERS = 64
DIM = 7
LEXICON, CACHE = 20_000, 200_000
READINGS, MARGIN = 8, 8.0

# Signs and the letters they stand for.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SEPARATORS = ".-_*~'’/"

DRAWN_OUT = re.compile(r"([^\W\d_])\1\1")
SIGN = re.compile("[" + re.escape("".join(LOOKALIKES) + SEPARATORS) + "]")
TRAILING = re.compile(r"(?:([^\w\s])\1{2,}|[.,!?;:\"')\]}%&#*])+$")
LEADING = re.compile(r"^[\"'(\[{.,;:#*&%-]+")
#: Marks around the first or last of some letters that stand apart.
AROUND = ".,;:?!\"'()[]"
COSTS = {"sign": 1.0, "one_of_run": 0.5, "two_of_run": 1.5, "separator": 0.5, "word_end": 1.0, "joined": 1.0}
#: What a reading gains by a word that the lexicon has, and code points from which on there are no letters.
GAIN, LAST_LETTER = 4.0, 0x32400


def code(c: str) -> int:
    """Class of a letter: 1 to 26 for a to z, others share the rest; 0 for what isn't a letter."""
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % 37 if c.isalpha() else 0


@cache
def codes_table() -> np.ndarray:
    """The class of every code point in lower case, as ``code`` gives it."""
    return np.array([code(chr(i).lower()[0]) for i in range(LAST_LETTER)] + [0], np.int64)


def triples(docs: DataFrame, text_col: str) -> np.ndarray:
    """Counts of letter triples over all texts; a word begins and ends with 0."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = codes_table(), np.zeros(LETTERS ** 3, np.int64)
        for b in batches:
            for text in b.column(0):
                points = np.frombuffer((text.as_py() or "").encode("utf-32-le", "replace"), np.uint32)
                for k in range(0, len(points), 1 << 20):
                    part = points[max(0, k - 2):k + (1 << 20)]
                    c = table[np.minimum(part, LAST_LETTER)]
                    c = np.concatenate(([0], c, [0])) if len(points) <= 1 << 20 else c
                    total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=LETTERS ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["triple", "n"])

    rows = docs.select(text_col).mapInArrow(count, "triple int, n long").groupBy("triple").agg(F.sum("n").alias("n"))
    out = np.zeros(LETTERS ** 3)
    for r in rows.collect():  # bounded by the alphabet
        out[r["triple"]] = r["n"]
    return out.reshape(LETTERS, LETTERS, LETTERS)


def costs_of(counts: np.ndarray) -> np.ndarray:
    """Negative log-probability of a letter after two others, smoothed with shorter contexts."""
    one = (counts.sum(axis=(0, 1)) + 1) / (counts.sum() + LETTERS)
    pairs = counts.sum(axis=0)
    two = (pairs + 20 * one) / (pairs.sum(axis=1, keepdims=True) + 20)
    return -np.log((counts + 20 * two[None]) / (counts.sum(axis=2, keepdims=True) + 20))


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """For every sign or run of a lower-cased word, what it may stand for and at which cost."""
    out, i = [], 0
    while i < len(word):
        c, j = word[i], i + 1
        while j < len(word) and word[j] == c:
            j += 1
        run = j - i
        letters = [(c, 0.0)] if c.isalpha() else [(x, COSTS["sign"]) for x in LOOKALIKES.get(c, "")]
        ways = [("", COSTS["separator"])] if c in SEPARATORS else []
        for x, cost in letters:
            if run == 1:
                ways.append((x, cost))
            elif run == 2 and c.isalpha():
                ways.append((x + x, cost))
            else:
                ways += [(x, cost + COSTS["one_of_run"]), (x + x, cost + COSTS["two_of_run"])]
        # A sign that stands for no letter ends a part of the word.
        out.append(ways or [(" ", 0.0)])
        i = j
    return out


def restore(word: str, costs: np.ndarray, n: int = 1) -> list[tuple[float, str]]:
    """The ``n`` cheapest readings of a lower-cased word with their costs, cheapest first (list Viterbi)."""
    now: dict[tuple[int, int], list[float]] = {(0, 0): [0.0]}
    back: list[dict[tuple[int, int], list[tuple]]] = []
    for ways in [*lattice(word), [(" ", 0.0)]]:
        after: dict[tuple[int, int], list[tuple]] = {}
        for state, best in now.items():
            for letters, extra in ways:
                (x, y), step = state, extra
                for c in letters:
                    z = code(c)
                    step += costs[x, y, z]
                    x, y = y, z
                after.setdefault((x, y), []).extend((cost + step, state, i, letters) for i, cost in enumerate(best))
        after = {s: sorted(found)[:n] for s, found in after.items()}
        now = {s: [f[0] for f in found] for s, found in after.items()}
        back.append(after)
    ends = sorted((cost, state, i) for state, best in now.items() for i, cost in enumerate(best))[:n]
    out = []
    for cost, state, i in ends:
        parts = []
        for found in reversed(back):
            _, state, i, letters = found[state][i]
            parts.append(letters)
        out.append((cost, "".join(reversed(parts)).strip()))
    return out


def plain(word: str) -> str:
    """A word without the marks around it, lower-cased."""
    return LEADING.sub("", TRAILING.sub("", word)).lower()


def reading(word: str, costs: np.ndarray, known: Container[str] = ()) -> str:
    """A word as it is, or restored where it may be disguised.

    Of the cheapest readings, one that ``known`` has goes before others that
    are cheaper by no more than ``MARGIN``.
    """
    low = word.lower() if word.isalpha() else plain(word)
    disguised = DRAWN_OUT.search(low) or not word.isalpha() and SIGN.search(low) and any(c.isalpha() for c in low)
    if not disguised:
        return low
    found = restore(low, costs, READINGS)
    return next((text for cost, text in found if text in known and cost <= found[0][0] + MARGIN), found[0][1])


Way = tuple[str, float]


def spaced(signs: list[str]) -> list[list[Way]]:
    """The lattice of single signs that stand apart; a blank between two is nothing or a word end."""
    out: list[list[Way]] = []
    i = 0
    while i < len(signs):
        j = i + 1
        while j < len(signs) and signs[j] == signs[i]:
            j += 1
        # Three of one sign are drawn out; two may belong to two words.
        step = j - i if j - i >= 3 else 1
        if out:
            out.append([("", 0.0), (" ", COSTS["word_end"])])
        out += lattice(signs[i] * step)
        i += step
    return out


def pieces(parts: list[str]) -> list[list[Way]]:
    """The lattice of parts of words; a blank between two is a word end or nothing."""
    out = lattice(parts[0])
    for part in parts[1:]:
        out += [[(" ", 0.0), ("", COSTS["joined"])], *lattice(part)]
    return out


def decode(ways: list[list[Way]], costs: np.ndarray, known: Container[str] = (), begins: Container[str] = (), gain: float = GAIN) -> list[str]:
    """The words of the cheapest way through a lattice with blanks.

    A state is the last two letters and the word so far while some word of
    ``known`` begins with it; ``begins`` has those beginnings.  Every word that
    is in ``known`` makes a way cheaper by ``gain``.
    """
    now: dict[tuple, tuple] = {(0, 0, ""): (0.0, None)}
    for options in [*ways, [(" ", 0.0)]]:
        after: dict[tuple, tuple] = {}
        for (x0, y0, so_far), (cost, path) in now.items():
            for letters, extra in options:
                x, y, word, total = x0, y0, so_far, cost + extra
                for c in letters:
                    z = code(c)
                    total += costs[x, y, z]
                    x, y = y, z
                    if c == " ":
                        total, word = total - (gain if word and word in known else 0.0), ""
                    elif word is not None:
                        word = word + c if word + c in begins else None
                if (x, y, word) not in after or total < after[x, y, word][0]:
                    after[x, y, word] = total, (path, letters)
        now = after
    path, parts = min(now.values(), key=lambda found: found[0])[1], []
    while path is not None:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts)).split()


def alone(word: str) -> bool:
    return word in LOOKALIKES or word.isalpha()


def runs(words: list[str]) -> list[list[str]]:
    """Three or more single signs in a row, two of them letters at least; marks may stand before the first and after the last."""
    out = []
    at = [i for i, w in enumerate(words) if len(w) == 1 and alone(w)]
    k = 0
    while k < len(at):
        j = k + 1
        while j < len(at) and at[j] == at[j - 1] + 1:
            j += 1
        first, after = at[k], at[j - 1] + 1
        signs = words[first:after]
        if len(signs) > 1:
            before = words[first - 1].lstrip(AROUND) if first else ""
            behind = words[after].rstrip(AROUND) if after < len(words) else ""
            signs = [before] * (len(before) == 1 and before.isalpha()) + signs + [behind] * (len(behind) == 1 and behind.isalpha())
            if len(signs) > 2 and sum(c.isalpha() for c in signs) > 1:
                out.append(signs)
        k = j
    return out


def features_of(word: str) -> list[str]:
    """What the lexicon may hold of a restored word: itself and its beginnings."""
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) > n)]


class Reader:
    """Words of texts with their lexicon weights; remembers words it has seen."""

    def __init__(self, costs: np.ndarray, weights: dict[str, float] | None = None):
        self.costs, self.weights = costs, weights or {}
        whole = [w for w in self.weights if not w.endswith("*")]
        self.begins = {w[:n] for w in whole for n in range(1, len(w) + 1)}
        self.seen: dict[str, object] = {}

    def _known(self, word: str, make: Callable[[str], object]) -> object:
        found = self.seen.get(word)
        if found is None:
            if len(self.seen) >= CACHE:
                self.seen.clear()
            found = self.seen[word] = make(word)
        return found

    def words(self, text: str) -> list[str]:
        """Words of a text as they stand, then those that come out of letters set apart and of pieces."""
        words = text.lower().split()
        out = list(words)
        for signs in runs(words):
            out += decode(spaced(signs), self.costs, self.weights, self.begins)
        begins = self.begins
        if begins:
            for i, word in enumerate(words):
                if word in begins:
                    out += self.joined(words, i)
        return out

    def joined(self, words: list[str], i: int) -> list[str]:
        """Words of the lexicon whose pieces begin at place ``i``, if they are more likely whole."""
        out, whole = [], words[i]
        for j in range(i + 1, len(words)):
            if not words[j].isalpha():
                ends = whole + plain(words[j])
            else:
                ends = whole + words[j]
            if ends != whole and ends in self.weights and decode(pieces([*words[i:j], ends[len(whole):]]), self.costs) == [ends]:
                out.append(ends)
            whole += words[j]
            if whole not in self.begins:
                break
        return out

    def restored(self, text: str) -> set[str]:
        out: set[str] = set()
        for w in set(self.words(text)):
            out.update(str(self._known(w, lambda x: reading(x, self.costs))).split())
        return out

    def weight(self, word: str) -> float:
        parts = reading(word, self.costs, self.weights).split()
        return max((self.weights.get(f, 0.0) for p in parts for f in features_of(p)), default=0.0)

    def vector(self, text: str | None) -> list[float]:
        """Features of a whole text: its two heaviest words, how many are heavy, how much all weigh, how many there are."""
        words = self.words(text or "")
        found = [w for x in words if (w := self._known(x, self.weight))]
        top = [*sorted(set(found), reverse=True)[:2], 0.0, 0.0] if found else [0.0, 0.0]
        heavy = sum(w >= 2 for w in found)
        n = len(words)
        return [1.0, top[0], top[1], np.log1p(heavy), np.log1p(sum(found)), heavy / max(1, n) * 10, np.log1p(n) / 10]


@dataclass(frozen=True)
class Model:
    costs: np.ndarray
    weights: dict[str, float]
    w: np.ndarray


def learn(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          labelled_rows: int = 20_000) -> Model:
    """A model from all texts of ``docs`` (characters) and (id, label) rows (words).

    At most ``labelled_rows`` labelled documents are used, those with the
    smallest hashes of their ids: half of them for the lexicon, half for the
    score.  Labels other than 0 and 1 and ids without a document are ignored.
    With labels of one class, or none, all scores are near 0.5.
    """
    costs = costs_of(triples(docs, text_col))
    order = F.xxhash64(F.col("id").cast("string"))
    known = labelled.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("y IN (0, 1)")
    known = stored(known.orderBy(order, "id", "y").limit(labelled_rows), "labelled")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    half = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(3)), F.lit(2))
    rows = stored(texts.join(known, "id").select("id", "y", "text", half.alias("half")), "labelled-texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, counts = Reader(costs), Counter()
        for b in batches:
            for y, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                of = {f for w in reader.restored(text.as_py() or "") for f in features_of(w)}
                counts.update((f, y) for f in of)
            if len(counts) > 1_000_000:
                yield batch(counts)
                counts.clear()
        yield batch(counts)

    def batch(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()),
                                           pa.array(list(counts.values()), pa.int64())], ["feature", "y", "n"])

    first = rows.filter("half = 0")
    n = {r["y"]: r["count"] for r in first.groupBy("y").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    counts = first.select("y", "text").mapInArrow(count, "feature string, y int, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"))
    a, b = F.col("a"), F.col("b")
    odds = F.log((a + 0.5) / (F.lit(toxic) - a + 0.5)) - F.log((b + 0.5) / (F.lit(clean) - b + 0.5))
    error = F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    # The cautious end of the log-odds is the weight; words that are barely over-represented have none.
    weight = counts.filter("a >= 3").select("feature", (odds - 1.64 * error).alias("w"), (odds / error).alias("z"))
    kept = weight.filter("w >= 0.7 AND z >= 3").orderBy(F.desc("z"), "feature").limit(LEXICON).collect()
    weights = {r["feature"]: float(r["w"]) for r in kept} if toxic and clean else {}
    reader = vectors(costs, weights)
    # Documents may repeat an id: the score is fitted on as many rows as there may be labels.
    second = rows.filter("half = 1").select("id", "y", reader(F.col("text")).alias("x"))
    second = second.orderBy(order, "id", "y", "x").limit(labelled_rows).toPandas()
    y = second["y"].to_numpy(float)
    w = fit(np.stack(second["x"]).astype(float), y, ridge=0.5) if len(np.unique(y)) == 2 else np.zeros(DIM)
    return Model(costs, weights, w)


def vectors(costs: np.ndarray, weights: dict[str, float]) -> Callable[[Column], Column]:
    @F.pandas_udf("array<double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(costs, weights)
        for texts in batches:
            yield pd.Series([reader.vector(t) for t in texts], dtype=object)

    return of


def scorer(model: Model) -> Callable[[Column], Column]:
    """Score from 0 to 1 of a text column; null and empty texts get that of a text without words."""
    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(model.costs, model.weights)
        for texts in batches:
            x = np.array([reader.vector(t) for t in texts], float).reshape(-1, DIM)
            yield pd.Series(sigmoid(x @ model.w))

    return of


def score(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          **options) -> DataFrame:
    """(id, score, predicted) of every row of ``docs``; repeated rows get equal scores, null ids are kept."""
    model = learn(docs, labelled, id_col, text_col, label_col, **options)
    out = docs.select(F.col(id_col), scorer(model)(F.col(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
