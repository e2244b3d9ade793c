"""Article table to labelled table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toneflow.functions import labels, text
from toneflow.functions.labels import FINANCE, Lexicon
from toneflow.operators import articles
from toneflow.operators.model import ScorerFactory, score_texts
from toneflow.operators.sampling import sample_rows


def weak_label(df: DataFrame, text_column: str, lexicon: Lexicon = FINANCE) -> DataFrame:
    """Word-list label, model label if there is one, and their combination.

    Model output is taken from ``model_label`` and ``model_probs`` when the
    table has them; otherwise both are null and the word list decides.
    """
    if "model_label" not in df.columns:
        df = df.withColumn("model_label", F.lit(None).cast("string")) \
            .withColumn("model_probs", F.lit(None).cast("map<string,double>"))
    return (
        df.withColumn("_lex", labels.lexicon_label(F.col(text_column), lexicon))
        .withColumns({"lex_label": F.col("_lex.label"), "lex_score": F.col("_lex.score")})
        .withColumn("weak_label", labels.combine_labels(
            F.col("model_label"), F.col("model_probs"), F.col("lex_label")))
        .drop("_lex")
    )


def build_dataset(df: DataFrame, lexicon: Lexicon = FINANCE, scorer: ScorerFactory | None = None,
                  sample: int | None = None) -> DataFrame:
    """Label every article in place; optionally a sample of exact size first."""
    df = sample_rows(df, sample)
    df = df.withColumn("_text", text.labelling_text(F.col("title"), F.col("description")))
    if scorer is not None:
        df = score_texts(df, "_text", scorer)
    return weak_label(df, "_text", lexicon).drop("_text")


def label_missing(df: DataFrame, lexicon: Lexicon = FINANCE) -> DataFrame:
    """Label only what has no label yet; texts without words are neutral."""
    body = text.scoring_text(F.col("title"), F.col("description"))
    fresh = F.when(body == "", "neutral").otherwise(
        labels.label_from_score(labels.score_lexicon(body, lexicon)))
    if "weak_label" not in df.columns:
        return df.withColumn("weak_label", fresh)
    return df.withColumn("weak_label", F.coalesce("weak_label", fresh))


def label_once(articles_table: DataFrame, label_table: DataFrame) -> DataFrame:
    """Attach labels kept in a separate table; articles keep their number of rows."""
    return articles.attach_labels(
        articles.first_arrivals(articles_table, ["hash"], ["published_at", "url"]), label_table)
