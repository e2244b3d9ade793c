from __future__ import annotations

import random

import pytest

#: Columns that clash with names the operators use inside.
CLASHING = ("id", "key", "hash", "row", "rows", "n", "w", "pos", "part", "cell", "copy", "size", "target", "finish",
            "source_size", "hits", "spans", "root", "class", "label", "x", "t", "m", "y", "features", "probability", "score")


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text, lang, source, n_chars), with clashing columns if asked for."""
    def make(rows, clash=False):
        rows = [(i, t, "en", "a", len(t) if t is not None else None) if len(r) == 2 else r
                for r in rows for i, t in [r[:2]]]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        if clash:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit(c).alias(c) for c in CLASHING])
        return df

    return make


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 9))) for _ in range(words))


ODD = [(1, prose(1, 60)), (2, None), (3, ""), (3, ""), (4, "  \n\t "), (None, prose(2, 40)), (None, None), (5, prose(1, 60)),
       (5, prose(1, 60)), (6, "one"), (7, "é ñ ß 😀 \x00 x"), (8, prose(3, 30_000)), (9, prose(1, 59) + " other")]
