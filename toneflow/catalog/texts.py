"""Text functions and language identification."""

from __future__ import annotations

from pyspark.sql import functions as F

from toneflow import fixtures
from toneflow.catalog import query, sql
from toneflow.functions import html
from toneflow.functions import text as X
from toneflow.operators import language
from toneflow.operators.articles import mentions
from toneflow.operators.evaluate import counts
from toneflow.operators.terms import find_terms


def pages(spark, d):
    return fixtures.spread(fixtures.table(spark, d, "pages"), "page_id")


@query("txt1_unescape", f"SELECT page_id, {sql.unescape('html')} AS text FROM pages")
def txt1(spark, d):
    return pages(spark, d).select("page_id", html.unescape(F.col("html")).alias("text"))


@query("txt2_strip_tags", f"SELECT page_id, {sql.strip_tags('html')} AS text FROM pages")
def txt2(spark, d):
    return pages(spark, d).select("page_id", X.strip_tags(F.col("html")).alias("text"))


_CURLY = "replace(replace(replace(text, 'e', '’'), 'a', '“'), 'o', '”')"


@query("txt3_plain_quotes", f"SELECT doc_id, {sql.plain_quotes(_CURLY)} AS text FROM documents")
def txt3(spark, d):
    return fixtures.documents(spark, d).select(
        "doc_id", X.straighten_quotes(F.expr(_CURLY)).alias("text"))


_WIRED = ("CASE doc_id % 3 WHEN 0 THEN '(Reuters) - ' || text WHEN 1 THEN text || ' (bloomberg) -- end' "
          "ELSE '(REUTERS)-' || text || '(Bloomberg)' END")


@query("txt4_drop_prefixes", f"SELECT doc_id, {sql.drop_prefixes(_WIRED)} AS text FROM documents")
def txt4(spark, d):
    return fixtures.documents(spark, d).select(
        "doc_id", X.drop_wire_prefixes(F.expr(_WIRED)).alias("text"))


@query("txt5_collapse_space",
       f"""SELECT doc_id, {sql.collapse("replace(text, ' ', chr(160) || chr(28) || ' ')")} AS text FROM documents""")
def txt5(spark, d):
    spaced = F.replace(F.col("text"), F.lit(" "), F.lit(" \x1c "))
    return fixtures.documents(spark, d).select("doc_id", X.collapse_space(spaced).alias("text"))


@query("txt6_clean_text", f"SELECT page_id, {sql.clean('html')} AS text FROM pages")
def txt6(spark, d):
    return pages(spark, d).select("page_id", X.clean_text(F.col("html")).alias("text"))


@query("txt6_clean_documents", f"SELECT doc_id, {sql.clean('text')} AS text FROM documents")
def txt6_documents(spark, d):
    return fixtures.documents(spark, d).select("doc_id", X.clean_text(F.col("text")).alias("text"))


@query("txt7_join_fields", f"""WITH {sql.RAW}
SELECT doc_id, concat_ws(' ', nullif(title, ''), nullif(description, '')) AS small,
       concat_ws(' ', nullif(title, ''), nullif(description, ''), nullif(content, '')) AS whole FROM raw""")
def txt7(spark, d):
    a = F.col("article")
    return fixtures.raw_articles(spark, d).select(
        "doc_id", X.join_fields(a.title, a.description).alias("small"),
        X.join_fields(a.title, a.description, a.content).alias("whole"))


def _strip(expr):
    return f"regexp_replace({expr}, '\\A{sql.SPACE}|{sql.SPACE}\\z', '', 'g')"


_EMPTY = "CASE WHEN doc_id % 5 <> 0 THEN title END"


@query("txt8_labelling_text", f"""WITH {sql.RAW}
SELECT doc_id, {_strip(f"coalesce({_EMPTY}, '') || '. ' || coalesce(description, '')")} AS text FROM raw""")
def txt8(spark, d):
    title = F.when(F.col("doc_id") % 5 != 0, F.col("article.title"))
    return fixtures.raw_articles(spark, d).select(
        "doc_id", X.labelling_text(title, F.col("article.description")).alias("text"))


@query("txt9_scoring_text", f"""WITH {sql.RAW}
SELECT doc_id, {_strip(f"coalesce({_EMPTY}, '') || ' ' || coalesce(description, '')")} AS text FROM raw""")
def txt9(spark, d):
    title = F.when(F.col("doc_id") % 5 != 0, F.col("article.title"))
    return fixtures.raw_articles(spark, d).select(
        "doc_id", X.scoring_text(title, F.col("article.description")).alias("text"))


@query("txt10_article_key", f"WITH {sql.RAW} SELECT doc_id, hash FROM keyed")
def txt10(spark, d):
    a = F.col("article")
    return fixtures.raw_articles(spark, d).select(
        "doc_id", X.article_key(a.title, a.source["name"], a.publishedAt).alias("hash"))


@query("txt11_defaults", f"""WITH {sql.RAW}
SELECT doc_id, coalesce(description, '') AS description,
       CASE WHEN doc_id % 4 = 0 THEN 'unknown' ELSE source END AS source FROM raw""")
def txt11(spark, d):
    name = F.when(F.col("doc_id") % 4 != 0, F.col("article.source.name"))
    return fixtures.raw_articles(spark, d).select(
        "doc_id", X.or_default(F.col("article.description")).alias("description"),
        X.or_default(name, "unknown").alias("source"))


SYMBOLS = ("THE", "Der", "qu", "ER", "xyzzy")


def _tags(test):
    hits = " || ".join(f"CASE WHEN {test(s.lower())} THEN '{s}|' ELSE '' END" for s in SYMBOLS)
    return f"rtrim({hits}, '|')"


@query("txt12_tag_tickers", f"""SELECT doc_id,
  {_tags(lambda s: f"contains(lower({sql.clean('text')}), '{s}')")} AS tickers,
  {_tags(lambda s: f"list_contains(words, '{s}')")} AS whole_words
FROM (SELECT *, regexp_extract_all(lower({sql.clean('text')}), '[\\p{{L}}\\p{{N}}]+') AS words FROM documents)""")
def txt12(spark, d):
    cleaned = X.clean_text(F.col("text"))
    return fixtures.documents(spark, d).select(
        "doc_id", F.array_join(X.tag_tickers(cleaned, SYMBOLS), "|").alias("tickers"),
        F.array_join(X.tag_tickers(cleaned, SYMBOLS, words_only=True), "|").alias("whole_words"))


@query("txt12_mentions", f"""SELECT DISTINCT doc_id, ticker FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS word FROM documents)
JOIN (VALUES {', '.join(f"('{s}', '{s.lower()}')" for s in SYMBOLS)}) AS watch(ticker, word) USING (word)""")
def txt12_mentions(spark, d):
    watchlist = spark.createDataFrame([(s,) for s in SYMBOLS], "ticker string")
    return mentions(fixtures.documents(spark, d), "doc_id", F.col("text"), watchlist)


@query("txt12_mentions_anywhere", f"""SELECT doc_id, ticker FROM documents
JOIN (VALUES {', '.join(f"('{s}')" for s in SYMBOLS)}) AS watch(ticker) ON contains(lower(text), lower(ticker))""")
def txt12_anywhere(spark, d):
    watchlist = spark.createDataFrame([(s,) for s in SYMBOLS], "ticker string")
    return mentions(fixtures.documents(spark, d), "doc_id", F.col("text"), watchlist, words_only=False)


# Thousands of terms at the smallest scales: beginnings of the long words of conversations.
@query("txt12_long_watchlist", r"""WITH terms AS (
  SELECT DISTINCT substr(lower(w), 1, 12) AS term FROM (SELECT unnest(regexp_extract_all(text, '\p{L}{9,}')) AS w FROM conversations)),
low AS MATERIALIZED (SELECT doc_id, lower(text) AS body FROM documents)
SELECT doc_id, term FROM low JOIN terms ON contains(body, term)""")
def txt12_long(spark, d):
    words = F.regexp_extract_all("text", F.lit(r"\p{L}{9,}"), F.lit(0))
    terms = fixtures.table(spark, d, "conversations").select(F.explode(words).alias("word"))
    terms = terms.select(F.substring(F.lower("word"), 1, 12).alias("term")).distinct()
    return find_terms(fixtures.documents(spark, d), "doc_id", F.col("text"), terms)


@query("txt13_tokens", """SELECT doc_id, len(t) AS n,
  md5(array_to_string(list_transform(t, lambda w: lower(w)), ' ')) AS digest
FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z'']+') AS t FROM documents)""")
def txt13(spark, d):
    found = fixtures.documents(spark, d).select("doc_id", X.tokens(F.col("text")).alias("t"))
    return found.select("doc_id", F.size("t").cast("bigint").alias("n"),
                        F.md5(F.array_join("t", " ")).alias("digest"))


@query("txt14_shorten", """SELECT doc_id, CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...'
  ELSE text END AS text FROM documents""")
def txt14(spark, d):
    return fixtures.table(spark, d, "documents").select("doc_id", X.shorten(F.col("text")).alias("text"))


@query("txt15_language_profile", f"WITH {sql.profile()} SELECT gram, code AS language, n, weight FROM profile")
def txt15_profile(spark, d):
    both = language.weigh(language.gram_counts(fixtures.documents(spark, d)))
    return both.select("gram", F.explode(F.arrays_zip("counts", "weights")).alias("of")).select(
        "gram", F.col("of.counts.code").alias("language"), F.col("of.counts.n").alias("n"), F.col("of.weights.weight").alias("weight"))


@query("txt15_detect_language", f"""WITH {sql.profile()}, detected AS ({sql.detect("documents", "doc_id", "text")})
SELECT doc_id, lang, language FROM documents JOIN detected USING (doc_id)""")
def txt15(spark, d):
    doc = fixtures.documents(spark, d)
    return language.detect_language(doc, ["doc_id", "lang"], F.col("text"), language.learn_profile(doc))


# The profile is learnt from one half of the documents and judged on the other.
_LEARN = "md5(CAST(doc_id AS VARCHAR)) < '8'"


@query("txt15_language_accuracy", f"""WITH {sql.profile(_LEARN)}, held_out AS (SELECT * FROM documents WHERE NOT {_LEARN}),
detected AS ({sql.detect("held_out", "doc_id", "text")})
SELECT lang AS true_label, language AS pred, count(*) AS n FROM held_out JOIN detected USING (doc_id) GROUP BY 1, 2""")
def txt15_accuracy(spark, d):
    doc, learn = fixtures.documents(spark, d), F.md5(F.col("doc_id").cast("string")) < "8"
    found = language.detect_language(doc.where(~learn), ["doc_id", "lang"], F.col("text"), language.learn_profile(doc.where(learn)))
    return counts(found.select(
        F.lit("grams").alias("model"), F.col("lang").alias("true_label"), F.col("language").alias("pred"))) \
        .select("true_label", "pred", "n")
