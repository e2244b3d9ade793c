"""Benchmark decontamination with a hash set of test n-grams, in SQL functions only.

The benchmark's windows are hashed; documents hash their own windows and look
them up in the set, and the words of every candidate are compared before it
counts.  Up to ``BROADCAST_WINDOWS`` windows the set is a constant of the plan,
which goes to every task once: a document is judged where it is read, and texts
are never shuffled.  Beyond, windows are joined with the set by their hashes;
both ways give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toneflow.functions import bind
from toneflow.llm.tables import OWN, once, stored, with_key

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, after A-Z were lower-cased, and before.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BROADCAST_WINDOWS = 50_000
HITS = "array<struct<pos:int,n:int,gram:string>>"


def words(text: Column) -> Column:
    """Array of the words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(F.translate(text, UPPER, LOWER), F.lit("")), BETWEEN), "")


def window_hashes(words: Column, length: int) -> Column:
    """Hashes of all runs of ``length`` words, in order; none if there are fewer words."""
    last = F.size(words) - F.lit(length)
    return F.when(last >= 0, F.transform(
        F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(words, i, length)))).otherwise(
        F.array().cast("array<bigint>"))


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """(item_id, gram, n, hash): the distinct windows of every item.

    An item of fewer than ``length`` words is one window; one without words has none.
    """
    w = F.col("w")
    of = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).filter(F.size(w) > 0)
    n = F.least(F.size(w), F.lit(length))
    grams = of.select("item_id", n.alias("n"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.slice(w, i, n))).alias("g"))
    return grams.select("item_id", "n", F.array_join("g", " ").alias("gram"), F.xxhash64("g").alias("hash")).distinct()


def _hits_in_row(keyed: DataFrame, text_col: str, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """Hits by looking every window up in constants; the collected rows are at most ``BROADCAST_WINDOWS``."""
    rows = grams.select("n", "hash", "gram").distinct().collect()
    texts = sorted({r["gram"] for r in rows})

    def of(w: Column, n: int) -> Column:
        hashes = sorted({r["hash"] for r in rows if r["n"] == n})
        at = F.transform(window_hashes(w, n), lambda h, i: F.struct(i.alias("pos"), h.alias("hash")))
        at = F.filter(at, lambda x: x["hash"].isin(hashes))
        at = F.transform(at, lambda x: F.struct(
            x["pos"].alias("pos"), F.lit(n).alias("n"), F.array_join(F.slice(w, x["pos"] + 1, n), " ").alias("gram")))
        return F.filter(at, lambda h: h["gram"].isin(texts))

    def judged(w: Column) -> Column:
        hits = F.concat(*[of(w, n) for n in lengths]) if lengths else F.array()
        return F.struct(F.size(w).cast("long").alias("words"), hits.cast(HITS).alias("hits"))

    verdict = F.col(f"{OWN}verdict")
    return keyed.withColumn(f"{OWN}verdict", once(bind(words(F.col(text_col)), judged))).withColumns(
        {f"{OWN}words": verdict["words"], f"{OWN}hits": verdict["hits"]}).drop(f"{OWN}verdict")


def _hits_by_join(keyed: DataFrame, text_col: str, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """Hits by joining all windows with the benchmark's, for sets that are too large for a constant."""
    by_hash = stored(grams.select("hash", "n", "gram").distinct(), "windows")
    keys = by_hash.select("hash", "n").distinct()
    split = keyed.select(F.col(f"{OWN}key").alias("key"), words(F.col(text_col)).alias("w"))
    found = None
    for n in lengths:
        at = split.select("key", F.posexplode(window_hashes(F.col("w"), n)).alias("pos", "hash"))
        at = at.join(keys.filter(F.col("n") == n).select("hash"), "hash").withColumn("n", F.lit(n))
        found = at if found is None else found.union(at)
    found = stored(found.distinct(), "candidates")
    by_doc = found.join(by_hash, ["hash", "n"]).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("pos", "n", "gram"))).alias("hits"))  # at most a document's own windows
    by_doc = stored(by_doc, "hits").select(F.col("key").alias(f"{OWN}key"), F.col("hits").cast(HITS).alias(f"{OWN}hits"))
    joined = keyed.join(by_doc, f"{OWN}key", "left").withColumn(f"{OWN}w", once(words(F.col(text_col))))
    w, hits = F.col(f"{OWN}w"), F.col(f"{OWN}hits")
    true = F.filter(hits, lambda h: F.array_join(F.slice(w, h["pos"] + 1, h["n"]), " ") == h["gram"])
    return joined.withColumn(f"{OWN}words", F.size(w).cast("long")).withColumn(
        f"{OWN}hits", F.when(hits.isNotNull(), true).otherwise(F.array().cast(HITS))).drop(f"{OWN}w")


def find_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text_col: str = "text", length: int = 10) -> DataFrame:
    """Every row of ``docs`` with its key column, ``__llm_words`` long and ``__llm_hits``, an array of (pos, n, gram).

    ``pos`` counts words from 0.  Only verified hits are listed; rows without
    any have an empty array.  Documents and items may be null or empty.
    """
    grams = stored(benchmark_windows(items, item_col, item_text_col, length), "grams")
    lengths = [r[0] for r in grams.select("n").distinct().orderBy("n").collect()]  # at most ``length`` numbers
    way = _hits_in_row if not lengths or grams.count() <= BROADCAST_WINDOWS else _hits_by_join
    return way(with_key(docs, id_col, text_col), text_col, grams, lengths)


def hit_words(hits: Column) -> Column:
    """Sorted places of the words that any hit covers."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["pos"], h["pos"] + h["n"] - 1)))))


def n_hit(hits: Column) -> Column:
    return F.size(hit_words(hits)).cast("long")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", length: int = 10) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``.

    ``n_hit`` counts the words that lie in any benchmark window, ``n_items``
    the items with such windows; ``items_sha256`` digests their ids, sorted as
    strings and joined by commas (of no id: the digest of the empty string).
    Null and empty texts have no words and no hits; repeated rows get equal
    results; null ids are kept; an empty benchmark contaminates nothing.
    """
    found = find_hits(docs, items, id_col, text_col, item_col, item_text_col, length)
    hits = F.col(f"{OWN}hits")
    rows = stored(found.select(
        F.col(f"{OWN}key").alias("key"), F.col(id_col).alias("id"), F.col(f"{OWN}words").alias("n_words"),
        n_hit(hits).alias("n_hit"),
        F.array_distinct(F.transform(hits, lambda h: h["gram"])).alias("grams")), "contamination")
    grams = stored(benchmark_windows(items, item_col, item_text_col, length).select("item_id", "gram").distinct(), "items")
    of = rows.filter("n_hit > 0").select("key", F.explode("grams").alias("gram")).distinct().join(grams, "gram")
    of = of.select("key", F.col("item_id").cast("string").alias("item")).distinct().groupBy("key").agg(
        F.count("*").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("items_sha256"))
    out = rows.join(of, "key", "left")
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_hit", F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def remove_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", length: int = 10) -> DataFrame:
    """``docs`` without the words that benchmark windows cover, and without documents that have no other words.

    What stands after a removed word goes with it, the rest of the text stays
    as it is.  Clean rows, null texts among them, are returned unchanged.
    """
    found = find_hits(docs, items, id_col, text_col, item_col, item_text_col, length)
    hits, text = F.col(f"{OWN}hits"), F.col(text_col)
    # Documents whose words all go, go; the others are cut, clean ones left alone.
    found = found.filter((F.size(hits) == 0) | (n_hit(hits) < F.col(f"{OWN}words")))
    plain, gaps = F.array_remove(F.split(text, BETWEEN_ANY_CASE), ""), F.split(text, WORD_ANY_CASE)

    def rebuild(cuts: Column) -> Column:
        # The text is gap, word, gap, word, ..., gap; outer gaps may be empty.  Between two
        # words that go, the words and the gaps after them stay.
        def run(p: Column, g: Column, i: Column) -> Column:
            start, n = F.element_at(cuts, i) + 2, F.element_at(cuts, i + 1) - F.element_at(cuts, i) - 1
            return F.when(n > 0, F.array_join(F.zip_with(F.slice(p, start, n), F.slice(g, start + 1, n), lambda x, y: F.concat(x, y)), "")).otherwise("")

        return bind(plain, lambda p: bind(gaps, lambda g: F.concat(F.element_at(g, 1), F.array_join(F.transform(
            F.sequence(F.lit(1), F.size(cuts) - 1), lambda i: run(p, g, i)), ""))))

    edges = F.concat(F.array(F.lit(-1)), hit_words(hits), F.array(F.col(f"{OWN}words").cast("int")))
    cut = F.when(F.size(hits) > 0, bind(edges, rebuild)).otherwise(text)
    return found.withColumn(text_col, once(cut)).select(*docs.columns)
