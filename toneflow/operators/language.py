"""Language identification by smoothed log-probabilities of words and character trigrams.

A profile is a table learnt by counting: for every gram that occurs in a
labelled corpus, the logarithm of its probability in each language.  A text's
score in a language is the sum over its grams, every occurrence counting; grams
the corpus never had say nothing.  Weights are whole thousandths, so sums do not
depend on their order.

Every gram lies in one word, so grams are made of distinct words, not of texts: a
corpus is counted by words first, and a text's score is the sum over its words.
The words most frequent in the profile are broadcast with their weights, as many
as fit a fixed number; sums are added up per row before anything is shuffled.
Only the other words, few in any language, are shuffled, once per row.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toneflow.functions import bind
from toneflow.session import sized

LETTERS = r"\p{L}+"

# Thai, kana and Han are written without blanks: their characters count as words.
UNSPACED = "[฀-๿぀-ヿ㐀-鿿]"

# Three characters around a letter; looking ahead finds overlapping ones in one pass.
TRIGRAM = r"(?=([ \p{L}]\p{L}[ \p{L}]))"

#: What every gram counts in every language beyond its occurrences.
SMOOTHING = 0.5
SCALE = 1000

#: Numbers that are broadcast with the most frequent words: one per word and language.
HEAD_WEIGHTS = 1 << 20
#: Letters beyond which a word goes by its digest.
LONG_WORD = 64

UNKNOWN = "unknown"


def words(text: Column) -> Column:
    """Lower-case words in any script.

    ``text`` is mentioned several times rather than bound by a lambda, beside
    which Spark would not compile an explode of the words.
    """
    lower = F.lower(F.coalesce(text, F.lit("")))
    # Lower case changes none of these characters, and plain ASCII has none: there the lengths tell.
    unspaced = (F.octet_length(text) > F.length(text)) & F.rlike(text, F.lit(UNSPACED))
    spaced = F.when(unspaced, F.regexp_replace(lower, f"({UNSPACED})", " $1 ")).otherwise(lower)
    return F.regexp_extract_all(spaced, F.lit(LETTERS), F.lit(0))


def grams(text: Column) -> Column:
    """Words, marked by ``=``, and the trigrams of words between blanks."""
    def of(found: Column) -> Column:
        line = F.concat(F.lit(" "), F.array_join(found, " "), F.lit(" "))
        return F.concat(F.transform(found, lambda w: F.concat(F.lit("="), w)),
                        F.regexp_extract_all(line, F.lit(TRIGRAM), F.lit(1)))

    return bind(words(text), of)


def word_grams(word: Column) -> tuple[Column, Column]:
    """The marked word and the trigrams of one lower-case word; the grams of a text are those of its words."""
    line = F.concat(F.lit(" "), word, F.lit(" "))
    return F.concat(F.lit("="), word), F.regexp_extract_all(line, F.lit(TRIGRAM), F.lit(1))


def gram_counts(df: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """(gram, counts): occurrences of every gram in every language, ``counts`` being (code, n) in code order.

    Rows without a language are left out.  Only the codes reach the driver.
    """
    known = df.where(F.col(language).isNotNull())
    codes = sorted(r[0] for r in known.select(language).distinct().collect())
    rows = known.select(F.col(language).alias("language"), F.explode(words(F.col(text))).alias("word"))
    names = [f"n{i}" for i in range(len(codes))]
    if not codes:
        return rows.select(F.col("word").alias("gram"), F.array().cast("array<struct<code:string,n:bigint>>").alias("counts"))
    of_words = rows.groupBy("word").agg(*[F.count(F.when(F.col("language") == c, 1)).alias(n) for n, c in zip(names, codes, strict=True)])
    whole, parts = word_grams(F.col("word"))
    of_grams = of_words.select(F.explode(F.concat(F.array(whole), parts)).alias("gram"), *names).groupBy("gram").agg(*[F.sum(n).alias(n) for n in names])
    return of_grams.select("gram", F.array(*[
        F.struct(F.lit(c).alias("code"), F.col(n).alias("n")) for n, c in zip(names, codes, strict=True)]).alias("counts"))


def weigh(counts: DataFrame) -> DataFrame:
    """(gram, counts, weights): smoothed log-probabilities of the grams, ``weights`` being (code, weight) in code order."""
    counts = sized(counts)
    first = counts.first()
    codes = [c["code"] for c in first["counts"]] if first else []
    totals = counts.agg(F.count(F.lit(1)), *[F.sum(F.col("counts")[i]["n"]) for i in range(len(codes))]).first()
    extra = SMOOTHING * totals[0]

    def weight(i: int) -> Column:
        share = (F.col("counts")[i]["n"] + SMOOTHING) / F.lit(totals[i + 1] + extra)
        return F.round(SCALE * F.log(share)).cast("bigint").alias("weight")

    weights = [F.struct(F.lit(c).alias("code"), weight(i)) for i, c in enumerate(codes)]
    return counts.select("gram", "counts", F.array(*weights).cast("array<struct<code:string,weight:bigint>>").alias("weights"))


def learn_profile(df: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """The profile of a labelled corpus, all rows and grams of it, stored with its true size."""
    return sized(weigh(gram_counts(df, text, language)).drop("counts"))


def _word_key(word: Column) -> Column:
    """The word itself, or a digest of a very long one, which would else be repeated with each of its grams."""
    return F.when(F.length(word) > LONG_WORD, F.concat(F.lit("#"), F.sha2(word, 256))).otherwise(word)


def _keyed(words: DataFrame) -> DataFrame:
    # The key comes first: beside a generator it would be computed for every gram.
    return words.withColumn("_key", _word_key(F.col("_word")))


def _word_weights(words: DataFrame, whole: DataFrame, trigrams: DataFrame, codes: list[str]) -> DataFrame:
    """(_key, _sum0, _sum1, ...): the sums of the weights of the words' grams; words of which the profile has none are left out.

    ``whole`` has (_key, weights) of the words themselves, as far as the profile knows them.
    """
    _, parts = word_grams(F.col("_word"))
    pieces = _keyed(words).select("_key", F.explode(parts).alias("gram")).join(trigrams, "gram")
    found = whole.select("_key", "weights").unionByName(pieces.select("_key", "weights"))
    return found.groupBy("_key").agg(*[F.sum(F.col("weights")[i]["weight"]).alias(f"_sum{i}") for i in range(len(codes))])


def _frequent_words(profile: DataFrame, codes: list[str]) -> DataFrame:
    """(_word, weights): the words that are most frequent in any language, as many whole ranks as ``HEAD_WEIGHTS`` allows."""
    ranked = profile.where(F.startswith("gram", F.lit("="))).select(
        F.expr("substring(gram, 2)").alias("_word"), "weights", F.array_max("weights.weight").alias("_rank"))
    least, room = None, HEAD_WEIGHTS // len(codes)
    # One row per weight, a whole thousandth of a logarithm.
    for rank, n in ranked.groupBy("_rank").count().orderBy(F.desc("_rank")).collect():
        room -= n
        if room < 0:
            break
        least = rank
    return ranked.where(F.col("_rank") >= F.lit(least).cast("bigint")).select("_word", "weights")


@lru_cache(maxsize=8)
def _prepared(profile: DataFrame) -> tuple[list[str], DataFrame | None, DataFrame | None]:
    """The codes of a profile, its trigrams, of which there are far fewer than words, and its frequent words with their weights.

    Made once for a profile, however many polls use it.
    """
    first = profile.first()
    codes = [w["code"] for w in first["weights"]] if first else []
    if not codes:
        return codes, None, None
    trigrams = sized(profile.where(~F.startswith("gram", F.lit("="))))
    frequent = _frequent_words(profile, codes)
    return codes, trigrams, sized(_word_weights(frequent, _keyed(frequent), trigrams, codes))


def detect_language(df: DataFrame, keys: list[str], text: Column, profile: DataFrame) -> DataFrame:
    """(keys, language) of every row: the code with the highest sum, ties in code order.

    ``keys`` identify a row.  Texts of which the profile has no gram are ``unknown``.
    """
    codes, trigrams, head = _prepared(profile)
    if not codes:
        return df.select(*keys, F.lit(UNKNOWN).alias("language"))
    sums = [f"_sum{i}" for i in range(len(codes))]
    rows = df.select(*keys, F.explode_outer(words(text)).alias("_word")) \
        .withColumn("_key", _word_key(F.col("_word"))).join(F.broadcast(head), "_key", "left")
    rare = F.when(F.col("_sum0").isNull(), F.col("_word")).alias("_rare")
    parts = sized(rows.groupBy(*keys, rare).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(s) for s in sums]))
    left = parts.where("_rare IS NOT NULL").select(*keys, F.col("_rare").alias("_word"), "_n")
    unlisted = left.select("_word").distinct()
    known = _keyed(unlisted).select("_key", word_grams(F.col("_word"))[0].alias("gram")).join(profile, "gram")
    weights = sized(_word_weights(unlisted, known, trigrams, codes))
    found = left.withColumn("_key", _word_key(F.col("_word"))).join(weights, "_key", "left") \
        .select(*keys, *[(F.col("_n") * F.col(s)).alias(s) for s in sums])
    # Rows without a rare word stay out of the join, where their nulls would meet in one task.
    scores = parts.where("_rare IS NULL").select(*keys, *sums).unionByName(found).groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])
    best = F.array_max(F.array(*[F.struct(F.col(f"_sum{i}").alias("sum"), F.lit(-i).alias("rank"), F.lit(c).alias("code"))
                                 for i, c in enumerate(codes)]))
    return scores.select(*keys, bind(best, lambda top: F.when(top["sum"].isNull(), UNKNOWN).otherwise(top["code"])).alias("language"))
