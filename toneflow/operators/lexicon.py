"""Scoring against a word list that is itself a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toneflow.functions.text import tokens


def score_by_table(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """(key, lex_score) of every row, from a lexicon of (word, polarity) rows of any size.

    Texts are taken apart where they are read; what is shuffled is keys with
    words at most, and sums where the lexicon is small enough to be broadcast.
    Whoever needs the score next to other columns joins by the key.  Very
    frequent words in a shuffled join are split by the adaptive skew handling.
    Rows without a word of the lexicon score 0; ``key`` identifies a row.
    """
    words = df.select(key, F.explode(tokens(F.col(text))).alias("word"))
    hits = words.join(lexicon.select("word", "polarity"), "word").select(key, F.col("polarity").cast("double").alias("polarity"))
    every = hits.unionByName(df.select(key, F.lit(0.0).alias("polarity"))).groupBy(key)
    return every.agg(F.coalesce(F.try_divide(F.sum("polarity"), F.sum(F.abs("polarity"))), F.lit(0.0)).alias("lex_score"))
