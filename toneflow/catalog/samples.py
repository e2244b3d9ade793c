"""Limits, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from toneflow import fixtures
from toneflow.catalog import query, sql
from toneflow.catalog.filters import raw_fields
from toneflow.operators import articles, sampling
from toneflow.plans.ingest import with_time

_ORDER = "md5('42:' || doc_id), doc_id"


@query("lim1_first_accepted", f"""WITH {sql.RAW}
SELECT request, doc_id FROM firsts WHERE published_at IS NOT NULL AND source = 'en'
QUALIFY row_number() OVER (PARTITION BY request ORDER BY doc_id) <= 40""")
def lim1(spark, d):
    unique = articles.first_arrivals(raw_fields(spark, d), ["request", "hash"], ["page_no", "pos"])
    accepted = with_time(unique.where("source = 'en'"))
    return articles.first_accepted(accepted, 40, ["page_no", "pos"]) \
        .select("request", F.col("pos").alias("doc_id"))


@query("lim2_head", "SELECT doc_id, lang, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100")
def lim2(spark, d):
    df = fixtures.table(spark, d, "documents").select("doc_id", "lang", "n_chars", (-F.col("n_chars")).alias("_s"))
    return articles.head(df, ["_s", "doc_id"], 100).drop("_s")


@query("smp1_sample", f"SELECT doc_id, lang, n_chars FROM documents ORDER BY {_ORDER} LIMIT 137")
def smp1(spark, d):
    df = fixtures.table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return sampling.sample_rows(df, 137, key="doc_id")


@query("smp1_sample_all", "SELECT doc_id, lang FROM documents")
def smp1_all(spark, d):
    df = fixtures.table(spark, d, "documents").select("doc_id", "lang")
    return sampling.sample_rows(df, 10_000_000, key="doc_id")


@query("smp2_balanced_sample", f"""WITH {sql.GOLD}
SELECT doc_id, label, md5('42:' || doc_id) AS shuffle_key FROM gold
QUALIFY row_number() OVER (PARTITION BY label ORDER BY {_ORDER}) <= 200 // 3""")
def smp2(spark, d):
    return sampling.balanced_sample(fixtures.gold_labels(spark, d), 200, key="doc_id") \
        .select("doc_id", "label", "shuffle_key")


_RANKED = f"""{sql.GOLD}, ranked AS (
  SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {_ORDER}) AS rn,
         ceil(round(count(*) OVER (PARTITION BY label) * 0.2, 9)) AS tail FROM gold)"""


@query("spl1_stratified_split", f"""WITH {_RANKED}
SELECT doc_id, label, CASE WHEN rn <= tail THEN 'val' ELSE 'train' END AS split FROM ranked""")
def spl1(spark, d):
    return sampling.stratified_split(fixtures.gold_labels(spark, d), "doc_id")


@query("spl2_three_way_split", f"""WITH {_RANKED}
SELECT doc_id, label, CASE WHEN rn <= ceil(tail / 2) THEN 'test' WHEN rn <= tail THEN 'val'
  ELSE 'train' END AS split FROM ranked""")
def spl2(spark, d):
    return sampling.stratified_split(fixtures.gold_labels(spark, d), "doc_id",
                                     held_out=(("test", 0.1), ("val", 0.1)))


@query("spl3_time_split", f"""WITH {sql.EVENTS}
SELECT hash, CASE WHEN row_number() OVER (ORDER BY published_at DESC, hash)
  <= ceil(round((SELECT count(*) FROM ev) * 0.2, 9)) THEN 'val' ELSE 'train' END AS split FROM ev""")
def spl3_time(spark, d):
    return sampling.time_split(fixtures.events_as_articles(spark, d), "hash").select("hash", "split")


@query("spl3_random_split", """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id)
  <= ceil(round((SELECT count(*) FROM documents) * 0.2, 9)) THEN 'val' ELSE 'train' END AS split FROM documents""")
def spl3_random(spark, d):
    return sampling.random_split(fixtures.table(spark, d, "documents").select("doc_id"), "doc_id")
