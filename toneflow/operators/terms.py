"""Long lists of search terms, found inside texts in one pass.

Every term is entered in an inverted index under one of its runs of 1, 2, 4 or 8
characters, as long a run as it has, and of these the one that fewest terms
share.  The longest run of letters and digits of a term, its piece, lies inside
one word of any text that has the term, so it is the distinct words of all texts
that are taken apart and looked up in the index, not the texts.  A few words with
a piece are broadcast to the texts, and only the terms found there are searched
for.  When many words have one, the words of all rows are joined with them by
shuffling, in one pass, which finds all terms that are one piece; only longer
ones still need the texts.  Work grows with the texts and the hits, not with texts
times terms.  Terms without letters and digits are looked up by the runs of the
texts, and so are, when too many words have a piece, terms longer than theirs and
lists of terms so short that every word has several.

Texts stay in the task that reads them: what is broadcast comes in blocks of a
measured size, one pass over the texts a block; few lists need a second one.
Up to ``FEW`` terms are searched for one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toneflow.functions import bind
from toneflow.session import sized

#: What words are made of.
SIGN = r"[\p{L}\p{N}]"
#: Terms that every text is searched for one by one.
FEW = 32
GRAMS = (1, 2, 4, 8)
#: Characters of terms and grams that are broadcast at a time.
BLOCK_CHARS = 1 << 24
#: Characters of terms, or of words and their pieces, beyond which the words of all rows are shuffled.
NEAR_CHARS = 1 << 20
#: Passes over the texts that cost no more than taking them apart into runs.
WORD_BLOCKS = 6


def _runs(text: Column, length: int) -> Column:
    """All runs of characters of a length; looking ahead finds overlapping ones."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{length}}}))"), F.lit(1))


def term_index(terms: DataFrame, term: str = "term") -> DataFrame:
    """(gram, size, terms): the terms, in lower case, that are entered under a gram of ``size`` characters."""
    low = terms.select(F.lower(term).alias("term")).where("term <> ''").distinct()
    size, grams = F.lit(GRAMS[0]), _runs(F.col("term"), GRAMS[0])
    for n in GRAMS[1:]:
        enough = F.length("term") >= n
        size, grams = F.when(enough, n).otherwise(size), F.when(enough, _runs(F.col("term"), n)).otherwise(grams)
    entries = sized(low.select("term", size.alias("size"), F.explode(F.array_distinct(grams)).alias("gram")))
    shared = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    chosen = entries.join(shared, "gram").groupBy("term", "size").agg(
        F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    return chosen.groupBy("gram", "size").agg(F.sort_array(F.collect_list("term")).alias("terms"))


def _search(df: DataFrame, keep: list[str], low: Column, terms: DataFrame, found: str, short: bool = False) -> DataFrame:
    """(keep, found) for every term that occurs in the lower-case text ``low``, by the runs of the text.

    ``short`` texts are shuffled where the index does not fit one broadcast.
    """
    index = sized(term_index(terms))
    width = F.sum(F.length("gram") + F.aggregate("terms", F.lit(0), lambda n, t: n + F.length(t)))
    size = index.agg(width, F.sort_array(F.collect_set("size"))).first()
    sizes, blocks = size[1], 1 + (size[0] or 0) // BLOCK_CHARS
    texts = df.select(*keep, low.alias("_low"))
    grams = F.array_distinct(F.flatten(F.array(*[_runs(F.col("_low"), n) for n in sizes or GRAMS[:1]])))
    rows = texts.select(*keep, "_low", F.explode(grams).alias("_gram"))

    def hits(part: DataFrame) -> DataFrame:
        near = rows.join(part, "_gram").select(*keep, "_low", F.explode("terms").alias(found))
        return near.where(F.contains("_low", found)).select(*keep, found)

    index = index.select(F.col("gram").alias("_gram"), "terms")
    if short and blocks > 1:
        return hits(index)
    parts = (F.broadcast(index.where(_block("_gram", blocks) == block)) for block in range(blocks))
    return reduce(DataFrame.unionByName, map(hits, parts))


def _block(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks))


def _long_words(text: Column, least: int) -> Column:
    """Distinct words of a text that have ``least`` signs or more, in the order of their first places."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"{SIGN}{{{least},}}"), F.lit(0)))


def find_terms(df: DataFrame, key: str, text: Column, terms: DataFrame, term: str = "term") -> DataFrame:
    """(key, term) for every term, in lower case, that occurs anywhere in a text, regardless of case.

    ``key`` identifies a row.  Null and empty terms and texts match nothing.
    """
    low, wanted = F.lower(text), sized(terms.select(F.lower(term).alias("term")).where("term <> ''").distinct())
    few = wanted.limit(FEW + 1).collect()
    if len(few) <= FEW:
        listed = F.array(*[F.lit(r["term"]) for r in few]).cast("array<string>")
        within = bind(low, lambda body: F.filter(listed, lambda t: F.contains(body, t)))
        return df.select(key, F.explode(within).alias("term"))
    runs = F.regexp_extract_all("term", F.lit(f"{SIGN}+"), F.lit(0))
    longest = F.array_max(F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), r.alias("run"))))["run"]
    cut = sized(wanted.select("term", longest.alias("piece")))
    least, bare = cut.agg(F.min(F.length("piece")), F.count_if(F.col("piece").isNull())).first()
    by_words = _by_words(df, key, low, cut.where("piece IS NOT NULL"), least) if least else None
    if by_words is None:
        return _search(df, [key], low, wanted, "term")
    return by_words.unionByName(_search(df, [key], low, cut.where("piece IS NULL").select("term"), "term")) if bare else by_words


def _by_words(df: DataFrame, key: str, low: Column, cut: DataFrame, least: int) -> DataFrame | None:
    """(key, term) of terms with a piece, a run of signs that lies inside one word of any text with the term.

    None when so many words have a piece that the texts would be read more than ``WORD_BLOCKS`` times.
    """
    # Words of eight signs and more are few; stored at once, they are taken from the texts only once.
    rows = _words_of_rows(df, key, low, least) if least >= GRAMS[-1] and _chars(cut, "term") > NEAR_CHARS else None
    words = rows.select("_word") if rows else df.select(F.explode(_long_words(low, least)).alias("_word"))
    words = sized(words.groupBy("_word").count())
    pieces = cut.select(F.col("piece").alias("term")).distinct()
    found = sized(_search(words, ["_word"], F.col("_word"), pieces, "piece", short=True))
    if _chars(found, "_word", "piece") <= NEAR_CHARS or _dense(words, found):
        return _near(df, key, low, cut, found, least)
    alone = found.join(cut.where("term = piece"), "piece").select("_word", "term")
    named = (rows or _words_of_rows(df, key, low, least)).join(alone, "_word")
    # A term in several words of a row counts once.
    named = named.dropDuplicates(["_row", "term"]).select(key, "term")
    longer = cut.where("term <> piece")
    if longer.isEmpty():
        return named
    near = _near(df, key, low, longer, found, least)
    return named.unionByName(_search(df, [key], low, longer.select("term"), "term") if near is None else near)


def _chars(df: DataFrame, *columns: str) -> int:
    return df.agg(F.sum(sum(map(F.length, columns), F.lit(0)))).first()[0] or 0


def _dense(words: DataFrame, found: DataFrame) -> bool:
    """Whether the words of all rows and the pieces in them are more than half the characters of these words.

    Short terms, of which every word has some: rows then have most of them again and again.
    """
    n, signs = words.agg(F.sum("count"), F.sum(F.col("count") * F.length("_word"))).first()
    return 2 * (n + found.join(words, "_word").agg(F.sum("count")).first()[0]) > signs


def _words_of_rows(df: DataFrame, key: str, low: Column, least: int) -> DataFrame:
    """(key, _row, _word): the distinct long words of every row; stored, so that the numbers of rows stay."""
    numbered = df.select(key, low.alias("_low"), F.monotonically_increasing_id().alias("_row"))
    return sized(numbered.select(key, "_row", F.explode(_long_words(F.col("_low"), least)).alias("_word")))


def _near(df: DataFrame, key: str, low: Column, cut: DataFrame, found: DataFrame, least: int) -> DataFrame | None:
    """(key, term) of the terms of ``cut``, by broadcasting the words that ``found`` has for their pieces.

    None when that takes more than ``WORD_BLOCKS`` passes over the texts.
    """
    pieces = cut.groupBy("piece").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    hit = sized(found.join(pieces, "piece").groupBy("_word").agg(F.collect_list(F.struct("piece", "terms")).alias("pieces")))
    width = F.length("_word") + F.aggregate("pieces", F.lit(0), lambda n, p: n + F.length(p["piece"]) + F.aggregate(
        p["terms"], F.lit(0), lambda m, t: m + F.length(t)))
    blocks = 1 + (hit.agg(F.sum(width)).first()[0] or 0) // BLOCK_CHARS
    line = F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" "))
    if blocks > WORD_BLOCKS:
        return None
    texts = df.select(key, low.alias("_low")).withColumn("_words", _long_words(F.col("_low"), least)).withColumn("_line", line)
    rows = texts.select(key, "_low", "_line", F.explode("_words").alias("_word"))
    piece, word = F.col("_of.piece"), F.col("_word")
    # Of the words of a text that have a piece, the first one counts.
    first = F.instr("_line", piece) == F.instr("_line", F.concat(F.lit(" "), word, F.lit(" "))) + F.instr(word, piece)

    def hits(block: int) -> DataFrame:
        part = hit.where(_block("_word", blocks) == block)
        near = rows.join(F.broadcast(part), "_word").select(key, "_low", "_line", "_word", F.explode("pieces").alias("_of"))
        named = near.where(first).select(key, "_low", piece.alias("_piece"), F.explode("_of.terms").alias("term"))
        return named.where((F.col("term") == F.col("_piece")) | F.contains("_low", "term")).select(key, "term")

    return reduce(DataFrame.unionByName, map(hits, range(blocks)))
