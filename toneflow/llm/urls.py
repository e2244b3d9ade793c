"""URL filtering by association rules, in DataFrame functions and Spark ML only.

A URL is a set of tokens.  FP-growth mines the sets that labelled URLs share;
sets that imply a verdict with enough confidence and support are rules, and a
rule goes when a more general one says the same at least as surely.  Rules are
found through an inverted index: each is entered under its rarest token, URLs
look up their tokens, and the rest of the rule is compared.

Tokens that occur in the same labelled URLs and in no others, such as the
segments of a path that only one site has, are mined as one item, a class: any
of them stands for all, as their rules would say the same.  So a URL of very
many tokens does not have every set of them mined.

URLs that differ in numbers only have the same tokens, so the work is done
once per token set and not once per page.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toneflow.llm.decontaminate import LOWER, UPPER
from toneflow.llm.tables import stored

#: Transactions that a task writes of one row at a time.
PART = 1000
#: Labelled urls that a rule must hold for, however few there are.
LEAST = 2
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` and for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` and for null."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def tokens(url: Column) -> Column:
    """Sorted distinct tokens of a URL: scheme, host labels, top-level domain, path segments, extension, query names, fragment.

    Digits are written as one ``#``, so that page numbers are alike.
    """
    h, p = host(url), path(url)
    text = F.coalesce(url, F.lit(""))
    labels = F.split(h, r"\.")
    segments = F.transform(F.split(p, "/"), lambda s: F.regexp_replace(s, "[0-9]+", "#"))
    query = F.regexp_extract(text, r"(?s)^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda q: F.concat(F.lit("query:"), F.regexp_replace(F.split(q, "=")[0], "[0-9]+", "#")))
    all_of = F.concat(
        F.array(F.concat(F.lit("scheme:"), F.regexp_extract(text, r"(?s)^(.*?)://", 1))),
        F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
        F.array(F.concat(F.lit("top:"), F.element_at(labels, -1))),
        F.transform(segments, lambda s: F.concat(F.lit("path:"), s)),
        F.transform(F.array(F.regexp_extract(p, r"\.([A-Za-z0-9]+)$", 1)), lambda e: F.concat(F.lit("extension:"), e)),
        names, F.array(F.when(text.contains("#"), F.lit("fragment:yes")).otherwise(F.lit("fragment:no"))))
    return F.array_sort(F.array_distinct(F.filter(all_of, lambda t: ~t.endswith(":"))))


def judge_by_list(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, listed) of every url that a listed rule fits.

    ``rules`` has (host, path, verdict).  A rule fits its host and all
    subdomains if the url's path starts with the rule's; the longest rule wins,
    of equally long ones that with the longer host, then the smaller.
    """
    labels = F.split("host", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))).alias("rule_host")
    listed = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("listed"))
    at = urls.select("url", "path", suffix).join(listed, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    order = F.struct(F.length(rule), F.length("rule_host"))
    best = at.groupBy("url").agg(F.max_by(F.struct(rule.alias("rule"), "listed"), order).alias("best"))
    return best.select("url", "best.rule", "best.listed")


def classes(labelled: DataFrame) -> DataFrame:
    """(token, item) of (tokens, verdict, n) rows: tokens of the same rows have the same item, the smallest of them."""
    rows = labelled.select(F.explode("tokens").alias("token"), F.xxhash64("tokens", "verdict").cast("decimal(38,0)").alias("row"),
                           F.xxhash64("verdict", "tokens", F.lit(1)).cast("decimal(38,0)").alias("again"))
    where = stored(rows.groupBy("token").agg(F.count("*").alias("n"), F.sum("row").alias("row"), F.sum("again").alias("again")), "where")
    items = where.groupBy("n", "row", "again").agg(F.min("token").alias("item"))
    return where.join(items, ["n", "row", "again"]).select("token", "item")


def mine(labelled: DataFrame, support: float = 0.002, confidence: float = 0.8, labelled_rows: int = 50_000,
         least: int = LEAST) -> DataFrame:
    """(tokens, verdict, confidence, support, classes) of the rules that (tokens, verdict, n) rows yield.

    ``n`` counts the urls of a row, and support and confidence are those of the
    urls: every row is as many transactions as it has urls.  A rule holds for at
    least ``least`` urls, and for a share of ``support`` of them.  At most
    ``labelled_rows`` different rows are used, those with the smallest hashes.
    Verdicts are ``allow`` and ``block``.  Without enough rows there are no
    rules.  ``tokens`` are items; ``classes`` lists (token, item) of those that
    stand for an item of the rule.
    """
    sample = stored(labelled.orderBy(F.xxhash64("tokens", "verdict"), "verdict").limit(labelled_rows), "sample")
    total = sample.agg(F.sum("n")).first()[0] or 0
    empty = "tokens array<string>, verdict string, confidence double, support double, classes array<struct<token:string,item:string>>"
    if total < least:
        return labelled.sparkSession.createDataFrame([], empty)
    item_of = stored(classes(sample), "classes")
    # Only rows and tokens of the sample are shuffled here, which has a bounded number of rows.
    row = F.struct("tokens", "verdict", "n").alias("of")
    items = sample.select(row, F.explode("tokens").alias("token")).join(item_of, "token").groupBy("of").agg(F.collect_set("item").alias("items"))
    items = items.select(F.array_sort("items").alias("tokens"), "of.verdict", "of.n")
    # A row of many urls is dealt out in parts before it is repeated, so that no task writes all of a large one.
    parts = items.select(F.concat("tokens", F.array(F.concat(F.lit("verdict:"), "verdict"))).alias("items"), "n",
                         F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / PART))).alias("part"))
    parts = parts.repartition(int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions")), "items", "part")
    times = F.least(F.col("n") - F.col("part") * PART, F.lit(PART)).cast("int")
    rows = parts.select("items", F.explode(F.array_repeat(F.lit(0), times)).alias("nth")).select("items")
    rows = stored(rows, "transactions")
    # A little less than the least share, whose product with the total may be rounded up.
    share = max(support, (least - 0.5) / total)
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=confidence).fit(rows)
    found = model.associationRules.filter(F.col("consequent")[0].startswith("verdict:"))
    found = found.select(F.array_sort("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], 9, 99).alias("verdict"),
                         "confidence", "support")
    found = stored(found.filter(~F.exists("tokens", lambda t: t.startswith("verdict:"))), "rules")
    # A rule is not needed if leaving out one of its tokens gives a rule of the same verdict that is as sure.
    smaller = found.filter(F.size("tokens") > 1).select(
        F.col("tokens").alias("of"), "verdict", F.col("confidence").alias("sure"),
        F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t))).alias("tokens"))
    needless = smaller.join(found, ["tokens", "verdict"]).filter("confidence >= sure").select(
        F.col("of").alias("tokens"), "verdict").distinct()
    kept = found.join(needless, ["tokens", "verdict"], "left_anti")
    pairs = kept.select("tokens", "verdict", F.explode("tokens").alias("item")).join(item_of, "item")
    named = pairs.groupBy("tokens", "verdict").agg(F.collect_list(F.struct("token", "item")).alias("classes"))
    return stored(kept.join(named, ["tokens", "verdict"]), "pruned")


def judge_by_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined) of every token set that a mined rule fits: it has a token of each of the rule's items.

    The surest rule wins, then the better supported, then the one with more
    tokens, then ``block`` before ``allow``.
    """
    item_of = stored(rules.select(F.explode("classes").alias("c")).select("c.token", "c.item").distinct(), "items")
    sets = sets.select("tokens", F.explode("tokens").alias("token")).join(item_of, "token").groupBy("tokens").agg(
        F.collect_set("item").alias("items"))
    sets = stored(sets, "item_sets")
    rules = rules.drop("classes")
    counts = rules.select(F.explode("tokens").alias("token")).groupBy("token").count()
    frequent = sets.select(F.explode("items").alias("token")).groupBy("token").agg(F.count("*").alias("seen"))
    # The rarest token among the sets; tokens that none has can't match.
    rarity = counts.join(frequent, "token").select("token", "seen")
    index = rules.select("*", F.explode("tokens").alias("token")).join(rarity, "token").groupBy(
        "tokens", "verdict", "confidence", "support").agg(F.min_by("token", F.struct("seen", "token")).alias("token"))
    index = stored(index.withColumnRenamed("tokens", "needed"), "index")
    at = sets.select("tokens", "items", F.explode("items").alias("token")).join(index, "token")
    fits = at.filter(F.size(F.array_except("needed", "items")) == 0)
    order = F.struct("confidence", "support", F.size("needed"), F.col("verdict") == "block")
    return fits.groupBy("tokens").agg(F.max_by("verdict", order).alias("mined"))


def judge(pages: DataFrame, rules: DataFrame, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow", **options) -> DataFrame:
    """(id, host, path, rule, verdict) of every row of ``pages``.

    A listed rule decides first, then the mined rules, then ``default``.
    ``labelled`` has (url, verdict) to mine from; without it, the pages that
    listed rules judge are the labelled ones.  Null urls and those without
    ``://`` have an empty host and path and no rule; repeated rows come back
    as often as they came.  Other columns are not read.
    """
    urls = pages.select(F.col(url_col).alias("url")).distinct().select(
        "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), tokens(F.col("url")).alias("tokens"))
    urls = stored(urls, "urls")
    listed = stored(judge_by_list(urls.filter("host != '' AND url IS NOT NULL"), rules), "listed")
    if labelled is None:
        known = urls.join(listed, "url").select("tokens", F.col("listed").alias("verdict"))
    else:
        known = labelled.select(tokens(F.col("url")).alias("tokens"), "verdict")
    mined = mine(stored(known.groupBy("tokens", "verdict").agg(F.count("*").alias("n")), "labelled"), **options)
    judged = urls.join(listed, "url", "left")
    sets = stored(judged.filter("rule IS NULL").select("tokens").distinct(), "sets")
    by_set = stored(judge_by_rules(sets, mined), "verdicts")
    judged = judged.join(by_set, "tokens", "left").select(
        F.col("url").alias("key"), "host", "path", "rule", F.coalesce("listed", "mined", F.lit(default)).alias("verdict"))
    judged = stored(judged, "judged")
    out = pages.select(F.col(id_col), F.col(url_col).alias("url")).join(judged, F.col("url").eqNullSafe(F.col("key")))
    return out.select(F.col(id_col), "host", "path", "rule", "verdict")
