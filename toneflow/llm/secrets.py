"""Secret scans with a random forest that removes false positives.

Candidates are runs of key-like characters with a digit, values assigned to
names like ``password``, and private key blocks.  A forest judges each from
its length, character transitions, dictionary coverage, path and neighbouring
words; it is trained from labelled findings.

The dictionary and the letter transitions come from the whole texts of all
documents.  Only the words kept (``DICTIONARY`` at most) and the
labelled findings that train the forest (``labelled_rows`` at most) are bounded.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toneflow.llm.tables import OWN, light, stored, with_key

DICTIONARY, LEAST_LENGTH, AROUND = 20_000, 12, 80
NEIGHBOURS, PATHS, STATS = 16, 8, 17
DIM = STATS + 2 * NEIGHBOURS + PATHS

# Names that secrets are assigned to.
NAMES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api-key", "access_key", "auth", "credential")

DIGIT = re.compile(r"[0-9]")
RUN = re.compile(r"[A-Za-z0-9+/_.@\-]*={0,2}")
IN_RUN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.@-")
ASSIGNED = re.compile(r"""\s?[:=]\s?["']?([^\s"']{6,})""")
NAME_BEFORE = re.compile("(?:" + "|".join(map(re.escape, NAMES)) + r")[\w\-]{0,16}[\"']?$", re.IGNORECASE)
PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----.*?(?:-----END [A-Z ]*PRIVATE KEY-----|\Z)", re.DOTALL)
WORD = re.compile(r"[^\W\d_]+")


def candidates(text: str | None) -> list[tuple[int, int]]:
    """Spans of candidates in a text, in order and apart; a null text has none."""
    if not text:
        return []
    spans = [m.span() for m in PEM.finditer(text)] if "-----BEGIN " in text else []
    end = 0
    for m in DIGIT.finditer(text):
        at = m.start()
        if at < end:
            continue
        start = at
        while start > end and text[start - 1] in IN_RUN:
            start -= 1
        end = RUN.match(text, at).end()
        stop = start + len(text[start:end].rstrip("."))
        if stop - start >= LEAST_LENGTH:
            spans.append((start, stop))
    for sign in ("=", ":"):
        at = text.find(sign)
        while at >= 0:
            head = text[max(0, at - 40):at].rstrip()
            m = NAME_BEFORE.search(head) and ASSIGNED.match(text, at)
            if m:
                spans.append(m.span(1))
            at = text.find(sign, at + 1)
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def kinds(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def coverage(value: str, dictionary: frozenset[str]) -> float:
    """Share of the letters of a value that lie in dictionary words of three letters and more."""
    letters = covered = 0
    for run in WORD.findall(value):
        run = run.lower()
        letters += len(run)
        best = [0] * (len(run) + 1)
        for e in range(1, len(run) + 1):
            best[e] = max([best[e - 1], *(best[s] + e - s for s in range(max(0, e - 16), e - 2) if run[s:e] in dictionary)])
        covered += best[-1]
    return covered / letters if letters else 0.0


def vector(value: str, before: str, after: str, path: str | None, dictionary: frozenset[str],
           transitions: dict[str, float]) -> list[float]:
    """Features of a candidate; a long one is measured by all its characters."""
    n = len(value)
    groups = [kinds(c) for c in value]
    counts = Counter(value)
    pairs = [transitions.get(a + b, -12.0) for a, b in zip(value.lower(), value.lower()[1:], strict=False)]
    head = before.rstrip(" \"'")
    share = [groups.count(k) / n for k in range(4)]
    out = [math.log1p(n), sum(a != b for a, b in zip(groups, groups[1:], strict=False)) / n,
           sum(pairs) / max(1, len(pairs)), -sum(c / n * math.log2(c / n) for c in counts.values()), *share,
           coverage(value, dictionary), float(all(c in "0123456789abcdefABCDEF" for c in value)),
           value.count("@") / n, value.count(".") / n, float(head.endswith(("=", ":"))),
           float(before[-1:] in "\"'" and before != ""), float(NAME_BEFORE.search(head.rstrip("=: ")) is not None),
           len(counts) / n, math.log1p((path or "").count("/"))]
    words = [0.0] * (2 * NEIGHBOURS + PATHS)
    for k, found in ((0, WORD.findall(before)[-2:]), (1, WORD.findall(after)[:2])):
        for w in found:
            words[k * NEIGHBOURS + zlib.crc32(w.lower().encode("utf-8", "replace")) % NEIGHBOURS] = 1.0
    words[2 * NEIGHBOURS + zlib.crc32(repr(path).encode("utf-8", "replace")) % PATHS] = 1.0
    return out + words


FINDING = "key string, id {id}, path string, start int, end int, value string, before string, after string"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row per candidate: (key, id, path, start, end, value, before, after)."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ids, paths, texts = (b.column(i) for i in range(4))
            rows, who = [], []
            for i, text in enumerate(texts):
                text = text.as_py()
                for s, e in candidates(text):
                    who.append(i)
                    rows.append((s, e, text[s:e], text[max(0, s - AROUND):s], text[e:e + AROUND]))
            who = pa.array(who, pa.int32())
            columns = [pa.array([r[k] for r in rows], t) for k, t in
                       enumerate((pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([keys.take(who), ids.take(who), paths.take(who), *columns], names)

    names = ["key", "id", "path", "start", "end", "value", "before", "after"]
    keyed = with_key(docs.select(F.col(id_col), F.col(text_col), F.col(path_col).cast("string").alias(f"{OWN}path")), id_col, text_col)
    rows = keyed.select(f"{OWN}key", F.col(id_col), f"{OWN}path", F.col(text_col))
    return rows.mapInArrow(of, FINDING.format(id=dict(docs.dtypes)[id_col]))


def letter_pairs(text: Column) -> Column:
    """All pairs of neighbouring characters, in order; looking ahead finds overlapping ones in one pass."""
    return F.regexp_extract_all(text, F.lit(r"(?s)(?=([^\x{DC00}-\x{DFFF}].))"), F.lit(1))


def dictionary_of(docs: DataFrame, values: DataFrame, text_col: str = "text",
                  words: int = DICTIONARY) -> tuple[frozenset[str], dict[str, float]]:
    """The most frequent words of all texts, and the log-probabilities of the pairs of characters in all that blanks separate.

    Pairs have letters, digits and signs.  Only those that occur in the column
    ``value`` of ``values`` are handed back.
    """
    run = F.explode(F.split(F.lower(F.col(text_col)), r"\s+")).alias("run")
    runs = stored(docs.select(run).filter("run != ''").groupBy("run").count(), "runs")
    spelled = runs.select("count", F.explode(F.split("run", r"[^\p{L}]+")).alias("word"))
    counts = spelled.filter("length(word) BETWEEN 3 AND 16").groupBy("word").agg(F.sum("count").alias("count"))
    rows = counts.filter("count >= 3").orderBy(F.desc("count"), "word").limit(words).collect()
    pairs = runs.select("count", F.explode(letter_pairs(F.col("run"))).alias("pair"))
    pairs = stored(pairs.groupBy("pair").agg(F.sum("count").alias("n")), "pairs").withColumn("letter", F.substring("pair", 1, 1))
    firsts = pairs.groupBy("letter").agg(F.sum("n").alias("all"))
    asked = values.select(F.explode(letter_pairs(F.lower(F.col("value")))).alias("pair")).distinct()
    found = pairs.join(asked, "pair", "left_semi").join(firsts, "letter").select("pair", F.log(F.col("n") / F.col("all")).alias("cost"))
    return frozenset(r["word"] for r in rows), {r["pair"]: r["cost"] for r in found.collect()}


def vectors(findings: DataFrame, dictionary: frozenset[str], transitions: dict[str, float]) -> DataFrame:
    """``findings`` with a column ``x`` of features."""
    @F.pandas_udf("array<double>")
    def of(value: pd.Series, before: pd.Series, after: pd.Series, path: pd.Series) -> pd.Series:
        rows = zip(value, before, after, path, strict=True)
        return pd.Series([vector(*r, dictionary, transitions) for r in rows], dtype=object)

    return findings.withColumn("x", of("value", "before", "after", "path"))


def label_by_format(findings: DataFrame) -> DataFrame:
    """Findings whose format settles what they are, with ``label`` 1 (a secret) or 0.

    Stands in for a table of findings that people have labelled.  Secrets:
    cloud access key ids, private key blocks, and hexadecimal values of mixed
    digits and letters assigned to a secret's name.  Not secrets: mail
    addresses, numbers, addresses of pages, dates and words with numbers.
    """
    value, before = F.col("value"), F.rtrim(F.col("before"))
    named = before.rlike(r"(?i)(" + "|".join(map(re.escape, NAMES)) + r")\s*[:=]\s*[\"']?$")
    secret = value.rlike(r"^AKIA[A-Z0-9]{16}$") | value.startswith("-----BEGIN ") | (
        named & value.rlike(r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{16,}$"))
    plain = value.rlike(r"^[\w.+\-]+@[\w\-]+(\.[\w\-]+)+$") | value.rlike(r"^[0-9.\-/+]+$") | value.contains("//") | \
        value.rlike(r"^[A-Za-z_\-./]+[0-9]{1,4}$")
    return findings.withColumn("label", F.when(secret, 1.0).when(~named & plain, 0.0)).filter("label IS NOT NULL")


def train(labelled: DataFrame, labelled_rows: int = 20_000, trees: int = 30, depth: int = 8,
          seed: int = 11) -> RandomForestClassificationModel | None:
    """A forest from (x, label) rows with a key, start and end; ``labelled_rows`` at most, those with the smallest hashes.

    None if the labels are of one class only.
    """
    order = F.xxhash64("key", "start", "end")
    rows = labelled.orderBy(order, "key", "start", "end").limit(labelled_rows)
    rows = stored(rows.select("x", "label"), "labelled").select(array_to_vector("x").alias("features"), "label")
    if rows.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird").fit(rows)


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, id_col: str = "doc_id",
         text_col: str = "text", path_col: str = "source", **options) -> DataFrame:
    """(key, id, start, end, value, probability, secret) of every candidate of ``docs``; ``start`` counts characters from 0.

    ``labelled`` has findings (key, path, start, end, value, before, after) with
    ``label``; without it, formats that leave no doubt label the findings of
    ``docs``.  With labels of one class all candidates get its probability, and
    0.5 without any label.  Null and empty texts have no candidates; repeated rows have theirs each.
    """
    found = stored(find(docs, id_col, text_col, path_col), "findings")
    values = found.select("value") if labelled is None else found.select("value").union(labelled.select("value"))
    words = dictionary_of(docs, values, text_col)
    rows = stored(vectors(found, *words), "vectors")
    labels = label_by_format(rows) if labelled is None else vectors(labelled, *words)
    forest = train(labels, **options)
    if forest is None:
        only = labels.agg(F.max("label")).first()[0]
        judged = rows.withColumn("probability", F.lit(0.5 if only is None else float(only)))
    else:
        judged = forest.transform(rows.withColumn("features", array_to_vector("x")))
        judged = judged.withColumn("probability", vector_to_array(F.col("probability"))[1])
    return judged.select("key", "id", "start", "end", "value", "probability",
                         (F.col("probability") >= threshold).alias("secret"))


def redact(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, mask: str = "[SECRET]",
           id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", **options) -> DataFrame:
    """``docs`` with every secret replaced by ``mask``; rows without secrets are unchanged and none are dropped."""
    found = scan(docs, labelled, threshold, id_col, text_col, path_col, **options).filter("secret")
    spans = found.select("key", "start", "end").distinct().groupBy(F.col("key").alias(f"{OWN}key")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias(f"{OWN}spans"))  # of one document
    spans = light(stored(spans, "spans"))

    text, at = F.col(text_col), F.col(f"{OWN}spans")
    # What lies before each span, after the one before it; then the rest.
    before = F.transform(at, lambda s, i: F.substr(
        text, F.when(i == 0, F.lit(0)).otherwise(F.get(at, i - 1)["end"]) + 1,
        s["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get(at, i - 1)["end"])))
    rest = F.substr(text, F.element_at(at, -1)["end"] + 1)
    hidden = F.concat(F.array_join(before, mask), F.lit(mask), rest)
    joined = with_key(docs, id_col, text_col).join(spans, f"{OWN}key", "left")
    return joined.withColumn(text_col, F.when(at.isNull(), text).otherwise(hidden)).select(*docs.columns)
