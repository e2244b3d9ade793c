"""Word-list scores, label rules and label vocabularies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from toneflow.functions import bind, lookup
from toneflow.functions.text import tokens
from toneflow.schemas import LABELS


@dataclass(frozen=True)
class Lexicon:
    """Words that raise and lower the tone of a text, in lower case."""

    positive: tuple[str, ...]
    negative: tuple[str, ...]


# The default financial word lists.
FINANCE = Lexicon(
    positive=("growth", "beat", "surge", "record", "upgrade", "profit"),
    negative=("loss", "downgrade", "decline", "lawsuit", "probe", "miss"),
)

# Numeric tone of a label.
LABEL_SCORE = {"negative": -1.0, "neutral": 0.0, "positive": 1.0}

# Label names of published models and their tone.
MODEL_LABELS = {
    "label_0": "negative", "label_1": "neutral", "label_2": "positive",
    "joy": "positive", "sadness": "negative",
}

# Tone of the emotions an emotion model reports.
EMOTION_TONE = {
    "joy": "positive", "sadness": "negative", "anger": "neutral",
    "fear": "neutral", "surprise": "neutral", "disgust": "neutral",
}

LABEL_CUT = 0.2
TRUST_MODEL_FROM = 0.6


def listed_words(text: Column, words: Sequence[str]) -> Column:
    """Every token of ``text`` that is in ``words``, in lower case."""
    return F.filter(tokens(text), lambda w: w.isin(*words))


def score_lexicon(text: Column, lexicon: Lexicon = FINANCE) -> Column:
    """(pos - neg) / (pos + neg) over all tokens, 0.0 without a hit."""
    def hits(words: Column, listed: Sequence[str]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(*listed)))

    def score(words: Column) -> Column:
        counts = F.struct(hits(words, lexicon.positive).alias("p"),
                          hits(words, lexicon.negative).alias("n"))
        return bind(counts, lambda c: F.coalesce(
            F.try_divide((c["p"] - c["n"]).cast("double"), (c["p"] + c["n"]).cast("double")),
            F.lit(0.0)))

    found = listed_words(F.coalesce(text, F.lit("")), (*lexicon.positive, *lexicon.negative))
    return bind(found, score)


def label_from_score(score: Column) -> Column:
    return F.when(score > LABEL_CUT, "positive").when(score < -LABEL_CUT, "negative") \
        .otherwise("neutral")


def lexicon_label(text: Column, lexicon: Lexicon = FINANCE) -> Column:
    """Struct of label and score."""
    return bind(score_lexicon(text, lexicon),
                lambda s: F.struct(label_from_score(s).alias("label"), s.alias("score")))


def combine_labels(model_label: Column, model_probs: Column, lex_label: Column) -> Column:
    """The model decides when it is sure enough, the word list otherwise."""
    sure = F.array_max(F.map_values(model_probs)) >= TRUST_MODEL_FROM
    usable = model_label.isNotNull() & (model_label != "") & (F.size(model_probs) > 0) & sure
    return F.when(usable, model_label).otherwise(lex_label)


def label_to_score(label: Column) -> Column:
    """-1, 0 or 1; unknown and missing labels count as 0."""
    return F.coalesce(lookup(LABEL_SCORE, label), F.lit(0.0))


def prob_score(probs: Column) -> Column:
    """p(positive) - p(negative), a missing class counting as 0."""
    def p(name: str) -> Column:
        return F.coalesce(F.try_element_at(probs, F.lit(name)), F.lit(0.0))

    return p("positive") - p("negative")


def decay_weight(index: Column, half_life: int = 50) -> Column:
    """0.5 ** (index / half_life); the newest article has index 0."""
    return F.pow(F.lit(0.5), index / F.lit(float(max(1, half_life))))


def normalise_label(label: Column) -> Column:
    """Label of an external model as tone label; others pass through in lower case."""
    return bind(F.lower(label), lambda low: F.coalesce(lookup(MODEL_LABELS, low), low))


def emotion_tone(label: Column) -> Column:
    """Tone of an emotion label; others pass through in lower case."""
    return bind(F.lower(label), lambda low: F.coalesce(lookup(EMOTION_TONE, low), low))


def softmax(logits: Column) -> Column:
    def normalise(exps: Column) -> Column:
        total = F.aggregate(exps, F.lit(0.0), lambda acc, x: acc + x)
        return bind(total, lambda t: F.transform(exps, lambda e: e / t))

    exps = bind(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp(x - top)))
    return bind(exps, normalise)


def decide(probs: Column, names: Sequence[str] = LABELS) -> Column:
    """Struct (label, confidence, probs) of a probability array; the first maximum wins."""
    keys = F.array(*[F.lit(n) for n in names])

    def best(p: Column) -> Column:
        top = F.array_max(p)
        return F.struct(
            F.element_at(keys, F.array_position(p, top).cast("int")).alias("label"),
            top.alias("confidence"),
            F.map_from_arrays(keys, p).alias("probs"),
        )

    return bind(probs, best)


def label_to_id(label: Column) -> Column:
    return lookup({name: i for i, name in enumerate(LABELS)}, label)


def id_to_label(number: Column) -> Column:
    return lookup(dict(enumerate(LABELS)), number)


def is_correct(pred: Column, truth: Column) -> Column:
    """Equal and known; a missing prediction or label is never correct."""
    return F.coalesce(pred == truth, F.lit(False))


def round_confidence(value: Column, places: int = 4) -> Column:
    return F.bround(value, places)
