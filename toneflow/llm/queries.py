"""Registered queries of the operators, with production parameters, and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toneflow.llm import cotraining, decontaminate, embeddings, mixing, secrets, sharding, simhash, structure, suffixes, toxicity, trie, urls, warc
from toneflow.llm.tables import read, stored

# Listed rules (host, path, verdict).
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]

Query = Callable[[SparkSession, str], DataFrame]

#: Weights of the sources in the order of code points, repeating.
WEIGHTS = [5.0, 2.0, 1.0]

SHARDS = 8


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model that never sees the held-out fifth of the labels."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels = read(spark, sf_dir, "labels").filter(~held_out)
    found = toxicity.score(read(spark, sf_dir, "documents"), labels)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with its place and the forest's judgement."""
    found = secrets.scan(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "start", "end", "probability", "secret")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.deduplicate(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(read(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(read(spark, sf_dir, "pages"), rules)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read(spark, sf_dir, "documents"), WEIGHTS, budget=1.5, epochs=2)


def op10_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of both views and of their combination, and the decision, for every document."""
    model, views = cotraining.learn(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return cotraining.scores(views, model).select(
        F.col("id").alias("doc_id"), "text_score", "meta_score", "score", (F.col("score") >= 0.5).alias("kept"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, sha, bytes) of the conversations that begin like another, and all conversations.

    The first h turns are those of the conversation whose id is the multiple of
    five below, h being a checksum of the id modulo nine.
    """
    convs = turns.groupBy("conv").agg(F.count("*").alias("n")).select(
        "conv", "n", (F.crc32(F.col("conv").cast("string")) % 9).alias("h"), (F.col("conv") - F.pmod("conv", F.lit(5))).alias("base"))
    convs = stored(convs, "conversations")
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = stored(convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))), "bases")
    own = turns.join(convs.select("conv", "h", "taken"), "conv").filter("pos >= h").select(
        "conv", (F.col("taken") + F.col("pos") - F.col("h") + 1).cast("long").alias("depth"), "sha", "bytes")
    first = turns.filter("pos < 8").withColumnRenamed("conv", "base").join(
        convs.filter("taken > 0").select("conv", "base", "taken"), "base").filter("pos < taken")
    return own.unionByName(first.select("conv", (F.col("pos") + 1).cast("long").alias("depth"), "sha", "bytes")), convs.select("conv")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations with the totals of its subtree."""
    turns = stored(trie.digests(read(spark, sf_dir, "conversations")), "turns")
    found = trie.summary(*rebuilt(turns))
    names = {"conv": "conv_id", "depth": "depth", "parent_conv": "parent_conv_id", "n": "n_convs", "children": "n_children",
             "leaves": "n_leaves", "saved": "saved_tokens"}
    return found.select(*[F.col(c).cast("long").alias(name) for c, name in names.items()], F.col("ends").alias("ends_sha256"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; counts of shards differ by one at most."""
    places = sharding.assign(read(spark, sf_dir, "documents"), SHARDS)
    return places.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with planted faults, by a checksum of ``conv_id:turn``; nulls are read as one space."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    kind, role, text = F.crc32(key) % 20, F.coalesce("role", blank), F.coalesce("text", blank)
    out = turns.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
                       F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                       F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"))
    return out.filter("times > 0").withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "time")


def op13_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after the damage."""
    original = read(spark, sf_dir, "conversations")
    turns = damaged(original)
    found = stored(structure.faults(turns), "faults")
    parsed = stored(structure.parse(found), "parsed")
    done = structure.summary(found, parsed).withColumnRenamed("conv", "done")
    text = structure.digests(turns, parsed).withColumnRenamed("conv", "told")
    out = original.select("conv_id").distinct().join(stored(done, "summary"), F.col("conv_id").eqNullSafe(F.col("done")), "left")
    out = out.join(stored(text, "digests"), F.col("conv_id").eqNullSafe(F.col("told")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    # A table without rows after damage has no gaps; a span of turns beyond 64 bits has none that can be told.
    gaps = F.when(F.col("done").isNull() & F.col("cost").isNull(), 0).otherwise(F.col("gaps")).cast("long").alias("gaps")
    return out.select("conv_id", gaps, *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cotraining.keep_good(docs, read(spark, sf_dir, "labels"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hidden = secrets.redact(docs)
    return hidden.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = decontaminate.remove_spans(docs, read(spark, sf_dir, "benchmark"))
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that the mix takes, with the words it takes of it and the finish times of its copies."""
    return mixing.mixture(docs, WEIGHTS, budget=1.5, epochs=2)


OP3_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     g AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
           FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
     s AS (SELECT DISTINCT n FROM g),
     p AS (SELECT k, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
           FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, s WHERE len(w) >= n)),
     h AS (SELECT k, i, p.n, item_id FROM p JOIN g ON p.gram = g.gram AND p.n = g.n),
     c AS (SELECT k, count(DISTINCT pos) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS pos FROM h) GROUP BY k),
     t AS (SELECT k, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
           FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (k) LEFT JOIN t USING (k)
"""

OP6_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e,
                  embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS sound FROM embeddings),
     l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
           WHERE a.sound AND b.sound AND list_cosine_similarity(a.e, b.e) >= 0.95),
     r AS (SELECT vec_id, vec_id AS other FROM v UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.other = l.a),
     c AS (SELECT vec_id, min(other) AS component_id FROM r GROUP BY vec_id),
     n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""

OP7_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
           FROM pages),
     f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  row_number() OVER () AS k FROM documents),
     s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                  [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::DOUBLE AS w FROM d GROUP BY source),
     o AS (SELECT *, 2 * source_size AS cap, 1.5::DOUBLE * (sum(source_size) OVER ()) AS budget,
                  coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w, encode(source) NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
                  sum(w) OVER (ORDER BY 2 * source_size / w, encode(source) NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM s),
     l AS (SELECT min(2 * source_size / w) AS r FROM o WHERE (budget - filled) / open * w < cap),
     v AS (SELECT (budget - filled) / open AS level FROM o, l WHERE (budget - filled) / open * w < cap AND 2 * source_size / w = r
           ORDER BY encode(source) LIMIT 1),
     t AS (SELECT source, source_size, CAST(coalesce(least((SELECT level FROM v) * w, cap), cap) AS DOUBLE) AS target FROM o),
     q AS (SELECT k, d.size, copy, source_size, target, d.source, doc_id,
                  (CAST(sum(d.size) OVER (PARTITION BY d.source, copy ORDER BY md5('7|' || coalesce(CAST(doc_id AS VARCHAR), '-') || '|'
                   || CAST(d.size AS VARCHAR)), doc_id, d.size, k ROWS UNBOUNDED PRECEDING) AS BIGINT) + copy * source_size) / target AS finish
           FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, (SELECT unnest([0, 1]) AS copy) WHERE d.size > 0),
     c AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, doc_id, size, copy ROWS UNBOUNDED PRECEDING) AS upto FROM q),
     x AS (SELECT k, sum(size) AS taken FROM c WHERE upto <= (SELECT 1.5 * sum(source_size) FROM t) GROUP BY k)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN x USING (k)
"""

# CRC-32 of the bytes in ``b``: the table is the polynomial 0xEDB88320 shifted out bit by bit.
CRC32_SQL = """
crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
               CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, i::BIGINT)) AS tab)
"""


def crc32_sql(text: str) -> str:
    """DuckDB expression for the CRC-32 of a text, next to ``crc``."""
    return f"""xor(4294967295::BIGINT, list_reduce(list_transform(regexp_extract_all(hex(encode({text})), '..'),
        lambda h: ('0x' || h)::BIGINT), lambda c, b: xor(c >> 8, crc.tab[1 + (xor(c, b) & 255)]), 4294967295::BIGINT))"""


OP11_SQL = f"""
WITH {CRC32_SQL},
     t AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''),
                  sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS l
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
     h AS (SELECT conv_id, l, {crc32_sql("conv_id::VARCHAR")} % 9 AS h FROM t, crc),
     r AS (SELECT a.conv_id, list_concat(coalesce(b.l[1:a.h], []), a.l[a.h + 1:]) AS l
           FROM h a LEFT JOIN h b ON b.conv_id = a.conv_id - a.conv_id % 5),
     p AS (SELECT conv_id, l[1:d] AS k, d, len(l) = d AS last FROM (SELECT conv_id, l, unnest(range(len(l) + 1)) AS d FROM r)),
     n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                  string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last) AS members FROM p GROUP BY k, d),
     c AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
     w AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(k[d].x) END AS own
           FROM n LEFT JOIN c USING (k, d)),
     s AS (SELECT k[1:e] AS k, e AS d, sum(own) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
           FROM (SELECT *, unnest(range(d + 1)) AS e FROM w) GROUP BY ALL)
SELECT w.conv_id, w.d AS depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(w.members, '')) AS ends_sha256
FROM w JOIN s USING (k, d) LEFT JOIN n u ON w.d > 0 AND u.d = w.d - 1 AND u.k = w.k[1:w.d - 1]
"""

# Eight rounds of the network; numbers beyond the last row are permuted again.
OP12_SQL = f"""
WITH RECURSIVE {CRC32_SQL},
     d AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {crc32_sql("coalesce(text, '')")} AS text_crc32,
                  row_number() OVER (ORDER BY doc_id NULLS LAST) - 1 AS x, count(*) OVER () AS n FROM documents, crc),
     s AS (SELECT *, CASE WHEN a.a * a.a < n THEN a.a + 1 ELSE a.a END AS a1 FROM d, (SELECT floor(sqrt(count(*)))::BIGINT AS a FROM documents) a),
     t AS (SELECT doc_id, size, text_crc32, x, n, a1 AS a, (n + a1 - 1) // a1 AS b FROM s),
     w AS (SELECT doc_id, size, text_crc32, x AS row, n, a, b, x // b AS l, x % b AS r, 0 AS i FROM t
           UNION ALL
           SELECT doc_id, size, text_crc32, row, n, a, b,
                  CASE WHEN i = 8 THEN (l * b + r) // b WHEN i % 2 = 0 THEN
                       (l + ('0x' || substr(md5('11|' || i || '|' || r), 1, 15))::BIGINT % a) % a ELSE l END,
                  CASE WHEN i < 8 AND i % 2 = 1 THEN (r + ('0x' || substr(md5('11|' || i || '|' || l), 1, 15))::BIGINT % b) % b ELSE r END,
                  CASE WHEN i = 8 THEN 0 ELSE i + 1 END
           FROM w WHERE i < 8 OR l * b + r >= n)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
       CAST((l * b + r) % 8 AS INTEGER) AS shard, CAST((l * b + r) // 8 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM w WHERE i = 8 AND l * b + r < n
"""

# The least edits by states of the pattern, turn after turn; then the repaired lines.
OP13_SQL = rf"""
WITH RECURSIVE {CRC32_SQL},
     o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                  {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations, crc),
     d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                  CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                  unnest(range(CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)) AS time FROM o),
     p AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n, rtrim(text, ' 	
' || chr(11) || chr(12) || chr(13)) AS cut,
                  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, time) AS nth
           FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, time)),
     f AS (SELECT *, left(role, 1) AS letter, CASE WHEN cut = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                  WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM p),
     gap (p, q, cost, audit) AS (VALUES ('B', 'B', 0, ''), ('S', 'S', 0, ''), ('U', 'U', 0, ''), ('A', 'A', 0, ''), ('B', 'U', 5, 'I'),
           ('B', 'A', 10, 'II'), ('S', 'U', 5, 'I'), ('S', 'A', 10, 'II'), ('U', 'A', 5, 'I'), ('A', 'U', 5, 'I')),
     move (p, letter, q) AS (VALUES ('B', 's', 'S'), ('B', 'u', 'U'), ('S', 'u', 'U'), ('U', 'a', 'A'), ('A', 'u', 'U')),
     e AS (SELECT conv_id, k, p, p AS q, 2 AS cost, 'D' AS audit FROM f, (SELECT unnest(['B', 'S', 'U', 'A']) AS p)
           UNION ALL SELECT conv_id, k, p, q, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'K' FROM f JOIN move USING (letter)
           WHERE fault IN ('', 'truncated')
           UNION ALL SELECT conv_id, k, p, q, CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END, 'R' FROM f, move
           WHERE fault IN ('', 'truncated') AND move.letter IN ('u', 'a')),
     r AS (SELECT conv_id, 0::BIGINT AS k, q AS state, struct_pack(cost := cost, audit := audit) AS best
           FROM (SELECT DISTINCT conv_id FROM f), gap WHERE p = 'B'
           UNION ALL
           SELECT r.conv_id, r.k + 1, gap.q, min(struct_pack(cost := r.best.cost + e.cost + gap.cost, audit := r.best.audit || e.audit || gap.audit))
           FROM r JOIN e ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND e.k = r.k + 1 AND e.p = r.state JOIN gap ON gap.p = e.q
           GROUP BY r.conv_id, r.k, gap.q),
     c AS (SELECT r.conv_id, min(best).cost AS cost, min(best).audit AS audit FROM r JOIN (SELECT conv_id, count(*) AS n FROM f GROUP BY ALL) t
           ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.k = t.n WHERE state IN ('B', 'A') GROUP BY r.conv_id),
     l AS (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS i FROM c),
     m AS (SELECT conv_id, i, audit[i] AS edit, count(*) FILTER (audit[i] <> 'I') OVER w AS k, count(*) FILTER (audit[i] <> 'D') OVER w AS place
           FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
     j AS (SELECT m.*, f.role, f.text, max(CASE WHEN place = 1 AND edit = 'K' AND letter = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY m.conv_id) AS led
           FROM m LEFT JOIN f ON m.conv_id IS NOT DISTINCT FROM f.conv_id AND m.k = f.k AND edit <> 'I' WHERE edit <> 'D'),
     s AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
                  || ':' || coalesce(text, ''), chr(10) ORDER BY place)) AS told FROM j GROUP BY conv_id),
     b AS (SELECT conv_id, lag(letter) OVER (PARTITION BY conv_id ORDER BY k) || letter AS pair FROM f),
     i AS (SELECT conv_id, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM b GROUP BY conv_id),
     g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated FROM f GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
       coalesce(told, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN g ON a.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN i ON a.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN s ON a.conv_id IS NOT DISTINCT FROM s.conv_id
"""

QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_secrets": op2_secrets,
    "op3_decontaminate": op3_decontaminate,
    "op4_suffixes": op4_suffixes,
    "op5_simhash": op5_simhash,
    "op6_embeddings": op6_embeddings,
    "op7_warc": op7_warc,
    "op8_mixing": op8_mixing,
    "op9_urls": op9_urls,
    "op10_cotraining": op10_cotraining,
    "op11_trie": op11_trie,
    "op12_sharding": op12_sharding,
    "op13_structure": op13_structure,
}

ORACLES: dict[str, str] = {
    "op3_decontaminate": OP3_SQL,
    "op6_embeddings": OP6_SQL,
    "op7_warc": OP7_SQL,
    "op8_mixing": OP8_SQL,
    "op11_trie": OP11_SQL,
    "op12_sharding": OP12_SQL,
    "op13_structure": OP13_SQL,
}
