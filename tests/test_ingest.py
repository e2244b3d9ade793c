from __future__ import annotations

import json
import math
import random
import re
import unicodedata
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from toneflow.functions import dates
from toneflow.operators import articles, language
from toneflow.plans.ingest import in_detected_language, ingest, ingest_request, with_key
from toneflow.schemas import ARTICLE, RAW_PAGE, Request
from toneflow.session import scratch_path
from toneflow.sources import readers, writers


@pytest.fixture(scope="module")
def profile(spark):
    rows = [("the rise and the rest of the other old title", "en"), ("der und die Sache", "de")]
    return language.learn_profile(spark.createDataFrame(rows, "text string, lang string"))


def article(title="The rise of AAPL", day="2024-01-02", name="Wire", description="and the rest", **more):
    base = {"source": {"name": name}, "title": title, "description": description, "content": "",
            "url": "http://x", "publishedAt": f"{day}T10:00:00Z"}
    return base | more


@pytest.fixture
def landed(spark, tmp_path):
    def land(*pages, request="AAPL"):
        folder = tmp_path / "pages"
        folder.mkdir(exist_ok=True)
        for i, items in enumerate(pages):
            body = {"request": request, "page_no": i, "articles": list(items)}
            (folder / f"{request}-{i}.json").write_text(json.dumps(body))
        return readers.read_pages(spark, str(folder))

    return land


def test_defaults_and_null_fields(profile, spark, landed):
    raw = landed([article(), article(title=None, description="of the and", source=None),
                  article(title="the AAPL and", source={"name": None}, content=None)])
    got = ingest(raw, profile).orderBy("source", "title").collect()
    assert [(r.source, r.title, r.tickers) for r in got] == [
        ("Wire", "The rise of AAPL", ["AAPL"]), ("unknown", "", []), ("unknown", "the AAPL and", ["AAPL"])]
    assert got[0].published_at == datetime(2024, 1, 2, 10) and got[0].language == "en"
    assert got[0].raw.publishedAt == "2024-01-02T10:00:00Z"


def test_rejected_first_copy_suppresses_later_ones(profile, landed):
    german = article(title="Same", description="der und die")
    english = article(title=" same ", description="the and of", name="WIRE")
    assert ingest(landed([german, english]), profile).count() == 0
    assert ingest(landed([english, german]), profile).count() == 1


def test_unparsable_time_is_dropped(profile, landed):
    assert ingest(landed([article(), article(title="the x", publishedAt="soon")]), profile).count() == 1


def test_timestamps(spark):
    good = {"2024-01-02T10:00:00Z": datetime(2024, 1, 2, 10), "2024-01-02T10:00:00+02:00": datetime(2024, 1, 2, 8),
            "2024-01-02": datetime(2024, 1, 2), "2024-01-02 10:00:00.5": datetime(2024, 1, 2, 10, 0, 0, 500000),
            "2024-01-02T10:00": datetime(2024, 1, 2, 10), "20240102": datetime(2024, 1, 2),
            "20240102T100000Z": datetime(2024, 1, 2, 10), "20240102T1000+0530": datetime(2024, 1, 2, 4, 30),
            "2024-01-02T10:00:00+0530": datetime(2024, 1, 2, 4, 30), "2024-01-02T10:00:00,25": datetime(2024, 1, 2, 10, 0, 0, 250000),
            "2024-01-02T10": datetime(2024, 1, 2, 10), "2024-01-02T10:00:00.1234567Z": datetime(2024, 1, 2, 10, 0, 0, 123456),
            "2024-01-02x10:00:00-05:00": datetime(2024, 1, 2, 15), "2024-01-02T10:00:00+05:30:15": datetime(2024, 1, 2, 4, 29, 45)}
    bad = ["", "soon", "2024", "2024-01", "10:30", "T10:30:00", "2024-02-30", "2024-01-02T25:00:00Z", " 2024-01-02",
           "2024-01-02T10:00:00 Europe/Paris", "now", None]
    df = spark.createDataFrame(list(enumerate([*good, *bad])), "i int, t string")
    got = [r.o for r in df.select("i", dates.parse_iso(F.col("t")).alias("o")).orderBy("i").collect()]
    assert got == [*good.values(), *[None] * len(bad)]


def test_limit_counts_accepted_articles_in_arrival_order(profile, landed):
    pages = [[article(title=f"the {10 * p + i}", description="der und die" if i == 0 else "and") for i in range(5)]
             for p in range(4)]
    raw = landed(*pages)
    got = ingest(raw, profile, max_articles=6).collect()
    assert sorted(r.title for r in got) == sorted(f"the {n}" for n in (1, 2, 3, 4, 11, 12))
    assert ingest(raw, profile, max_articles=0).count() == 0
    assert ingest(raw, profile, max_articles=5000).count() == 16


def test_limit_beyond_the_group_limit_threshold(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("request"),
        (4999 - F.col("id")).alias("page_no"), F.lit(0).alias("pos"))
    got = articles.first_accepted(df, 1500, ["page_no", "pos"])
    rows = {r.request: (r.n, r.last) for r in
            got.groupBy("request").agg(F.count("*").alias("n"), F.max("page_no").alias("last")).collect()}
    order = {x: sorted(4999 - i for i in range(5000) if (i % 3 == 0) == (x == "A")) for x in "AB"}
    assert rows == {x: (1500, order[x][1499]) for x in "AB"}


def test_requests_do_not_share_keys_or_limits(profile, landed):
    landed([article()], request="AAPL")
    raw = landed([article()], request="MSFT")
    got = {r.request: r.tickers for r in ingest(raw, profile, max_articles=1).collect()}
    assert got == {"AAPL": ["AAPL"], "MSFT": []}
    tagged = ingest(raw, profile, tickers=["AAPL", "RISE", "ZZZ"]).first()
    assert tagged.tickers == ["AAPL", "RISE"]


def test_one_request_with_window_and_terms(profile, landed):
    raw = landed([article(), article(title="the old AAPL", day="2023-01-01"), article(title="and the other"),
                  article(title="the Apple Inc and")])
    request = Request("Apple Inc", "AAPL", keywords=(" ",), from_date="2024-01-01", to_date=datetime(2024, 2, 1))
    assert sorted(r.title for r in ingest_request(raw, request, profile).collect()) == [
        "The rise of AAPL", "the Apple Inc and"]


def test_watchlist_terms(spark, landed):
    raw = with_key(landed([article(), article(title="Something else", description="")]))
    df = raw.select("request", F.col("raw.title").alias("title"), F.col("raw.description").alias("description"),
                    F.col("raw.content").alias("content"))
    schema = "company string, ticker string, keywords array<string>"
    watch = spark.createDataFrame([("Nothing", "AAPL", [" ELSE ", ""])], schema)
    assert articles.matching_watchlist(df, watch).count() == 2
    assert articles.matching_watchlist(df, spark.createDataFrame([("x1", "AAPL", None)], schema)).count() == 1


def test_article_sink(profile, spark, tmp_path, landed):
    raw = landed([article(day="2024-01-03"), article(title="the b", day="2024-01-02"),
                  article(title="the c", day="2024-01-02"), article(title="the d", day="2024-01-03")])
    got = ingest(raw, profile)
    for kind in ("parquet", "csv"):
        assert writers.write_articles(got, f"{tmp_path}/{kind}", kind) == 4
    # Two days tie: the earlier one names the batch.
    assert (tmp_path / "parquet" / "ticker=aapl" / "batch_date=20240102").is_dir()
    back = readers.read_tables(spark, f"{tmp_path}/csv/*/*", "csv", ARTICLE)
    assert back.count() == 4 and back.schema["tickers"].dataType == ARTICLE["tickers"].dataType
    assert back.select("raw.source.name").first()[0] == "Wire"
    assert writers.write_articles(got.limit(0), f"{tmp_path}/none") == 0
    # A second batch replaces its own partition only.
    other = ingest(raw, profile).withColumn("request", F.lit("MSFT"))
    assert writers.write_articles(other, f"{tmp_path}/parquet") == 4
    assert spark.read.parquet(f"{tmp_path}/parquet").count() == 8


def test_article_sink_writes_rows_once(spark, tmp_path, monkeypatch):
    schema = "request string, published_at timestamp, text string"
    def batch(*rows):
        return spark.createDataFrame([(r, datetime.fromisoformat(d) if d else None, t) for r, d, t in rows], schema)

    writes = []
    real = writers.write_table
    monkeypatch.setattr(writers, "write_table", lambda *a, **k: writes.append(a[1]) or real(*a, **k))
    path = f"{tmp_path}/articles"
    odd = "BRK/B=x +%2F"
    first = batch(("Ab", "2024-01-02", "1"), ("Ab", "2024-01-02", "2"), ("aB", "2024-01-02", "3"), ("aB", None, "4"),
                  (odd, "2024-01-05", "5"), ("none", None, "6"), (None, "2024-01-02", "7"))
    def stored():
        back = spark.read.schema("text string, ticker string, batch_date string").parquet(path)
        return sorted((r.ticker, r.batch_date, r.text) for r in back.collect())

    assert writers.write_articles(first, path) == 5
    assert len(writes) == 1 and not list(tmp_path.glob("articles/_staged/*"))
    kept = [("ab", "20240102", t) for t in "1234"] + [(odd.lower(), "20240105", "5")]
    assert stored() == sorted(kept)
    # The same batch again changes nothing; a new one replaces the days it names.
    assert writers.write_articles(first, path) == 5 and stored() == sorted(kept)
    assert writers.write_articles(batch(("AB", "2024-01-02", "8"), ("AB", "2024-01-03", "9"), ("ab", "2024-01-03", "10")), path) == 3
    assert stored() == sorted([("ab", "20240102", "8"), ("ab", "20240102", "9"), ("ab", "20240103", "10"), kept[-1]])


def test_broken_off_article_sink_loses_nothing(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("A", datetime(2024, 1, 2), "old")], "request string, published_at timestamp, text string")
    path = f"{tmp_path}/articles"
    writers.write_articles(df, path)
    def broken(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(writers, "_publish", broken)
        with pytest.raises(OSError, match="gone"):
            writers.write_articles(df.withColumn("text", F.lit("new")), path)
    assert [r.text for r in spark.read.parquet(path).collect()] == ["old"] and not list(tmp_path.glob("articles/_staged/*"))


def test_hot_key_keeps_its_first_copy(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("hash"),
        (3000 - F.col("id")).alias("page_no"))
    first = articles.first_arrivals(df, ["hash"], ["page_no"])
    assert first.count() == 2001 and first.where("hash = 'hot'").first().page_no == 3


def test_labels_never_multiply_articles(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "hash string")
    labels = spark.createDataFrame([("a", "positive")] * 3 + [(None, "neutral")], "hash string, weak_label string")
    got = {r.hash: r.weak_label for r in articles.attach_labels(df, labels).collect()}
    assert got == {"a": "positive", "b": None, None: None}


    first = articles.attach_labels(df, spark.createDataFrame(
        [("a", "x", 2), ("a", "y", 1), ("b", "z", 3)], "hash string, weak_label string, at int"), ["at"])
    assert {r.hash: r.weak_label for r in first.collect()} == {"a": "y", "b": "z", None: None}


def test_mentions_of_a_long_watchlist(spark):
    df = spark.createDataFrame([(1, "It rose. AAPL, aapl!"), (2, "pit"), (3, None)], "id int, body string")
    watch = spark.createDataFrame([("AAPL",), ("IT",), ("IT",), ("A",)], "ticker string")
    got = articles.mentions(df, "id", F.col("body"), watch).collect()
    assert sorted(tuple(r) for r in got) == [(1, "AAPL"), (1, "IT")]


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{shared}/x-") and scratch_path(spark, "x") != scratch_path(spark, "x")


def test_csv_list_literals(spark):
    texts = ["['AAPL']", "[]", "", "  ", None, "nonsense", "['A', \"B's\"]", "['it\\'s']"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.o for r in df.select("i", readers.parse_list(F.col("t")).alias("o")).orderBy("i").collect()]
    assert got == [["AAPL"], [], [], [], [], [], ["A", "B's"], ["it's"]]


def test_csv_round_trip_keeps_text(spark, tmp_path):
    rows = [("1", ' "quoted", \n line\r\nbreak ', ["x"]), ("2", "", []), ("3", None, None)]
    df = spark.createDataFrame(rows, "hash string, title string, tickers array<string>")
    path = writers.write_table(df, f"{tmp_path}/a.csv")
    back = readers.read_table(spark, path).orderBy("hash").collect()
    # CSV has no way to tell an empty text from a missing one; both are missing.
    assert [(r.hash, r.title) for r in back] == [(a, b or None) for a, b, _ in rows]
    assert [r.tickers for r in back] == [["x"], [], []]


def test_missing_files_are_an_error(spark, tmp_path):
    for kind in ("parquet", "csv"):
        with pytest.raises(FileNotFoundError):
            readers.read_tables(spark, f"{tmp_path}/nowhere/*/*.{kind}", kind)


def test_mixed_columns(spark, tmp_path):
    writers.write_table(spark.createDataFrame([(1, "a")], "id int, x string"), f"{tmp_path}/p/one")
    writers.write_table(spark.createDataFrame([(2, 0.5)], "id int, y double"), f"{tmp_path}/p/two")
    got = readers.read_tables(spark, f"{tmp_path}/p/*").orderBy("id").collect()
    assert [(r.id, r.x, r.y) for r in got] == [(1, "a", None), (2, None, 0.5)]


def test_gold_names_and_labels(spark):
    df = spark.createDataFrame([("t", 2)], "Phrase string, Code int")
    names = {"text": ("Phrase", "phrase"), "label": ("Code",)}
    row = readers.standardise_gold(df, names).first()
    assert (row.text, row.label, row.dataset_type) == ("t", "positive", "gold_standard")
    both = spark.createDataFrame([("a", "b", "Neutral")], "Phrase string, other string, label string")
    row = readers.standardise_gold(both, names).first()
    assert (row.text, row.label, row.other) == ("a", "neutral", "b")
    for code, kind in (("1", "string"), (1, "smallint"), (1.0, "double")):
        assert readers.standardise_gold(spark.createDataFrame([("a", code)], f"text string, label {kind}")).first().label == "neutral"


def test_latest_snapshot(spark, tmp_path):
    rows = [("a", "20240101", 1), ("a", "20240103", 2), ("b", "20240102", 3), ("a", "20240103", 4)]
    df = spark.createDataFrame(rows, "ticker string, batch_date string, v int")
    path = writers.write_table(df, f"{tmp_path}/s", "parquet", ("ticker", "batch_date"))
    got = readers.latest_snapshot(spark.read.parquet(path))
    assert sorted(r.v for r in got.collect()) == [2, 3, 4]


def test_latest_snapshot_opens_no_file_for_the_dates(spark, tmp_path):
    rows = [("a", "20240101", 1), ("a", "20240103", 2), ("b", "20240102", 3), (None, "20240104", 5)]
    df = spark.createDataFrame(rows, "ticker string, batch_date string, v int")
    path = writers.write_table(df, f"{tmp_path}/s", "parquet", ("ticker", "batch_date"))
    table = spark.read.schema("v int, ticker string, batch_date string").parquet(path)
    # A file of an old batch is no table any more: whoever opens it fails.
    for old in (tmp_path / "s" / "ticker=a" / "batch_date=20240101").glob("*.parquet"):
        old.write_bytes(b"not a table")
        (old.parent / f".{old.name}.crc").unlink()
    assert sorted(r.v for r in readers.latest_snapshot(table).collect()) == [2, 3]
    # Any other table works too.
    assert sorted(r.v for r in readers.latest_snapshot(df).collect()) == [2, 3]


def test_filters(spark):
    rows = [("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 8)), ("c", datetime(2024, 1, 8, 0, 0, 1)), ("d", None)]
    df = spark.createDataFrame(rows, "hash string, published_at timestamp")
    now = F.lit(datetime(2024, 1, 8))
    assert [r.hash for r in articles.in_lookback(df, now, 7).collect()] == ["a", "b"]
    assert articles.with_publish_date(df).count() == 3
    assert articles.backfill_tickers(df, "acme").first().tickers == ["ACME"]


def plain_grams(text):
    found = re.findall(r"[^\W\d_]+", (text or "").lower())
    line = " " + " ".join(found) + " "
    return ["=" + w for w in found] + [line[i:i + 3] for i in range(len(line) - 2) if line[i + 1] != " "]


CORPUS = [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("die", "de"), ("le chat, l'été", "fr"), ("", "fr"),
          ("no label", None), (None, "de"), ("the", "EN")]


def test_profile_and_detection_by_hand(spark):
    counts = Counter((lang, g) for t, lang in CORPUS if lang for g in plain_grams(t))
    codes, vocabulary = ["EN", "de", "en", "fr"], {g for _, g in counts}
    total = {c: sum(n for (k, _), n in counts.items() if k == c) for c in codes}
    weight = {(c, g): round(1000 * math.log((counts[c, g] + 0.5) / (total[c] + 0.5 * len(vocabulary)))) for c in codes for g in vocabulary}
    profile = language.learn_profile(spark.createDataFrame(CORPUS, "text string, lang string"))
    assert {(w.code, r.gram): w.weight for r in profile.collect() for w in r.weights} == weight
    texts = ["the dog", "THE", "Hunde", "chat", "123", None, "", "xyz qqq", "l'été de la chatte", "the " * 300 + "und " * 299]
    want = []
    for t in texts:
        known = [g for g in plain_grams(t) if g in vocabulary]
        want.append(max(codes, key=lambda c: (sum(weight[c, g] for g in known), [-ord(x) for x in c])) if known else "unknown")
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = language.detect_language(df, ["i"], F.col("text"), profile).orderBy("i").collect()
    assert [r.language for r in got] == want
    assert want[:3] == ["en", "en", "de"] and want[4:8] == ["unknown"] * 4


def test_no_profile(spark):
    profile = language.learn_profile(spark.createDataFrame([], "text string, lang string"))
    df = spark.createDataFrame([(1, "the")], "i int, text string")
    assert [r.language for r in language.detect_language(df, ["i"], F.col("text"), profile).collect()] == ["unknown"]


def test_scripts_without_blanks(spark):
    df = spark.createDataFrame([("公司的利润和公司的", "zh"), ("これは会社の利益です", "ja"), ("the Gewinn и доход 𝒳𐍈𐍉 x", "xx")],
                               "text string, lang string")
    rows = df.select(language.words(F.col("text")).alias("w"), language.grams(F.col("text")).alias("g")).collect()
    assert rows[0].w == list("公司的利润和公司的") and rows[2].w[:4] == ["the", "gewinn", "и", "доход"]
    assert "\ufffd" not in "".join(rows[2].g) and rows[2].g[-1] == " x " and "th" in rows[2].g[6] and len(rows[1].g) == 2 * len(rows[1].w)
    profile = language.learn_profile(df)
    texts = spark.createDataFrame([(0, "公司的"), (1, "会社の利益です"), (2, "доходы the")], "i int, text string")
    got = language.detect_language(texts, ["i"], F.col("text"), profile).orderBy("i").collect()
    assert [r.language for r in got] == ["zh", "ja", "xx"]


def test_words_of_mixed_scripts_by_hand(spark):
    texts = ["ΌΣΟΣ ΣΑΣ, 公司of利润 x2y", "กำไรของ Firma ๑๒", "İstanbul ﬁrm ぁー々 〇 9", "l'été—ÀÉ\n\tok", "plain ASCII 3rd", "", None]

    def plain(text):
        low = re.sub(f"({language.UNSPACED})", r" \1 ", (text or "").lower())
        return "".join(c if unicodedata.category(c).startswith("L") else " " for c in low).split()

    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = df.select("i", F.explode_outer(language.words(F.col("text"))).alias("w")).collect()
    assert [[r.w for r in got if r.i == i and r.w is not None] for i in range(len(texts))] == [plain(t) for t in texts]


def test_words_are_exploded_by_compiled_code(spark, profile):
    """A lambda beside an explode would take it out of the generated code, which then hands on rows word by word."""
    df = spark.createDataFrame([(1, "the dog", "en")], "i int, text string, lang string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = [language.gram_counts(df), df.select("i", F.explode_outer(language.words(F.col("text"))))]
        steps = [line for x in found for line in x._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate " in line]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(steps) == 3 and all("*(" in line.split("Generate ")[0] for line in steps)


def test_frequent_words_bring_their_weights(spark, monkeypatch):
    """They come from the profile, so only their trigrams are looked up."""
    profile, plans = language.learn_profile(spark.createDataFrame(CORPUS, "text string, lang string")), {}
    plain = language.sized
    monkeypatch.setattr(language, "sized", lambda df: plans.update({df.columns[0]: df._jdf.queryExecution().executedPlan().toString()}) or plain(df))
    language._prepared(profile)
    joins = [line for line in plans["_key"].splitlines() if "Join " in line]
    assert len(joins) == 1


def test_a_word_of_a_million_letters(spark):
    df = spark.range(1).select("id", F.repeat(F.lit("aé"), 500_000).alias("text"), F.lit("xx").alias("lang"))
    profile = language.learn_profile(df)
    assert profile.count() == 5
    assert language.detect_language(df, ["id"], F.col("text"), profile).first().language == "xx"


def test_detection_shuffles_sums_only(spark, profile):
    """Grams of a text are joined and added up in the task that reads it."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = language.detect_language(df, ["doc_id"], F.col("text"), profile)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    # Deduplicated articles and their languages meet where they are.
    raw = with_key(spark.createDataFrame([], RAW_PAGE).select("request", "page_no", F.posexplode("articles").alias("pos", "raw")))
    unique = articles.first_arrivals(raw, ["request", "hash"], ["page_no", "pos"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = in_detected_language(unique, profile)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    payload = [line for line in plan.splitlines() if "Exchange hashpartitioning(request" in line]
    assert payload and "SortMergeJoin [request" in plan


@pytest.mark.parametrize("room", [0, 12, 1 << 20])
def test_rare_words_count_like_frequent_ones(spark, monkeypatch, room):
    """Whatever share of the words is broadcast; repeated and null keys are one text each."""
    monkeypatch.setattr(language, "HEAD_WEIGHTS", room)
    profile = language.learn_profile(spark.createDataFrame(CORPUS, "text string, lang string"))
    long = "hund" * 40
    texts = [(1, "the thedog"), (1, "der die die die die"), (None, "katzen"), (None, "l'été chat"), (2, "123"), (3, None), (4, "qqq"), (5, f"{long} {long} the")]
    weight = {(w.code, r.gram): w.weight for r in profile.collect() for w in r.weights}
    codes, want = sorted({c for c, _ in weight}), {}
    for key in {k for k, _ in texts}:
        known = [g for k, t in texts if k == key for g in plain_grams(t) if ("de", g) in weight]
        want[key] = max(codes, key=lambda c: (sum(weight[c, g] for g in known), [-ord(x) for x in c])) if known else "unknown"
    got = language.detect_language(spark.createDataFrame(texts, "i int, text string"), ["i"], F.col("text"), profile).collect()
    assert {r.i: r.language for r in got} == want and len(got) == len(want)


def test_grams_are_not_joined_text_by_text(spark, profile):
    """Also when no table is small enough for the planner to broadcast; a corpus is counted by words first."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert "hashpartitioning(word#" in language.gram_counts(df)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = language.detect_language(df, ["doc_id"], F.col("text"), profile)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "regexp_extract_all" not in plan and "hashpartitioning(_gram#" not in plan


def test_counts_stay_beside_their_weights(spark):
    """A profile with counts needs no join of the two."""
    counts = language.gram_counts(spark.createDataFrame(CORPUS, "text string, lang string"))
    both = language.weigh(counts)
    assert both.columns == ["gram", "counts", "weights"] and "Join" not in both._jdf.queryExecution().executedPlan().toString()
    assert {(r.gram, tuple(map(tuple, r.counts))) for r in both.collect()} == {(r.gram, tuple(map(tuple, r.counts))) for r in counts.collect()}


def test_a_profile_is_prepared_once(spark, monkeypatch):
    """A second poll stores its own sums and rare words only."""
    profile, stored = language.learn_profile(spark.createDataFrame(CORPUS, "text string, lang string")), []
    plain = language.sized
    monkeypatch.setattr(language, "sized", lambda df: stored.append(df.columns) or plain(df))
    df = spark.createDataFrame([(1, "the dog"), (2, "hunde")], "i int, text string")
    first, second = (language.detect_language(df, ["i"], F.col("text"), profile) for _ in range(2))
    assert len(stored) == 6 and sorted(first.collect()) == sorted(second.collect())


def test_feed_is_landed_compressed(spark, tmp_path):
    from toneflow import fixtures

    path = fixtures.write_feed(spark, "/root/testdata/sf0.001", f"{tmp_path}/feed")
    files = [f.name for f in (tmp_path / "feed").iterdir() if f.name.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert readers.read_pages(spark, path).count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_feed_is_packed_fast(spark, tmp_path):
    import zlib

    from toneflow import fixtures

    fixtures.write_feed(spark, "/root/testdata/sf0.001", f"{tmp_path}/feed")
    packed = max((f.read_bytes() for f in (tmp_path / "feed").glob("part-*.gz")), key=len)
    plain = zlib.decompress(packed, 31)
    fast, hard = (abs(len(packed) - len(zlib.compress(plain, level))) for level in (1, 6))
    assert fast < hard


def test_raw_page_schema(spark):
    assert RAW_PAGE.fieldNames() == ["request", "page_no", "articles"]


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("hash,title,url\nh1,\"t,1\",u1\n")
    (tmp_path / "b.csv").write_text("url,hash,title\nu2,h2,\"t\n2\"\n")
    (tmp_path / "c.csv").write_text("hash,extra\nh3,x\n")
    for df in (readers.read_tables(spark, f"{tmp_path}/*.csv", "csv"), readers.read_table(spark, f"{tmp_path}/*.csv")):
        got = sorted((r.hash, r.title, r.url, r.extra) for r in df.collect())
        assert got == [("h1", "t,1", "u1", None), ("h2", "t\n2", "u2", None), ("h3", None, None, "x")]


def odd_csv(rng, rows):
    def value():
        return "".join(rng.choice(["a", "é", ",", '"', "\n", "\r\n", " ", "x" * 40, "😀"]) for _ in range(rng.randint(0, 6)))

    out = []
    for i in range(rows):
        values = [f"h{i}", value(), value() * (200 if rng.random() < 0.05 else 1)]
        out.append(values)
    quoted = [",".join('"' + v.replace('"', '""') + '"' if v and (not v.isalnum() or rng.random() < 0.3) else v for v in r) for r in out]
    return out, quoted


@pytest.mark.parametrize(("size", "end"), [("64b", "\n"), ("300b", "\r\n"), ("2k", "\n"), ("128m", "\n")])
def test_csv_with_line_breaks_splits_anywhere(spark, tmp_path, size, end):
    """Same rows whatever the splits, also where a value is longer than a split."""
    rng = random.Random(len(size))
    want = []
    for n in range(2):
        rows, lines = odd_csv(rng, 60)
        (tmp_path / f"{n}.csv").write_bytes((end.join(["hash,title,description", *lines]) + end * (n % 2)).encode())
        want += [(n, *[v or None for v in r]) for r in rows]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, size if "max" in k else "0")
    try:
        lines = readers._lines(spark, [str(tmp_path)])
        assert lines.rdd.getNumPartitions() > 4 or size == "128m"
        got = []
        for n in range(2):
            df = readers.read_csv(spark, [f"{tmp_path}/{n}.csv"])
            got += [(n, r["hash"], r.title, r.description) for r in df.select("hash", "title", "description").collect()]
        both = readers.read_csv(spark, [f"{tmp_path}/*.csv"]).count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(map(str, got)) == sorted(map(str, want)) and both == len(want)


def test_csv_of_headers_only_and_of_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("hash,title\n\r\nhash,title\n")
    (tmp_path / "b.csv").write_text("\ufeffhash,title\n1,x\n\n2,\"y\n")
    (tmp_path / "c.csv").write_text("")
    got = readers.read_csv(spark, [f"{tmp_path}/*.csv"]).select("hash", "title").collect()
    assert sorted(map(tuple, got)) == [("1", "x"), ("2", "y"), ("hash", "title")]  # a row may look like a header


def test_payloads_take_their_sentences_without_patterns(spark, tmp_path):
    from toneflow import fixtures

    texts = ["a.b.c", "a.b", ".b", ".", "", "..", "a", "a\nb.c\nd.", "é.ü.", None, "a..b", "...x"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    raw = fixtures.raw_articles(spark, str(tmp_path))
    assert "regexp" not in raw._jdf.queryExecution().executedPlan().toString()
    for r in raw.collect():
        text, parts = texts[r.doc_id - 1], (texts[r.doc_id - 1] or "").split(".")
        second = parts[1] if len(parts) > 1 else ""
        want = (None, None) if text is None else (parts[0], second)
        assert (r.article.title, r.article.description) == (want[0], want[1] if r.doc_id % 7 else None)
