from __future__ import annotations

import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from toneflow.operators import daily
from toneflow.operators.language import learn_profile
from toneflow.plans.ingest import ingest
from toneflow.sources import readers
from toneflow.streaming import daily as live
from toneflow.streaming import ingest as landing

LABELLED = "published_at timestamp, weak_label string, tickers array<string>, tone_score double"


def page(number, titles, request="AAPL"):
    return json.dumps({"request": request, "page_no": number, "articles": [
        {"source": {"name": "Wire"}, "title": t, "description": "and the", "content": "AAPL", "url": "u",
         "publishedAt": f"2024-01-{i % 9 + 1:02d}T10:00:00Z"} for i, t in enumerate(titles)]})


@pytest.fixture(scope="module")
def profile(spark):
    return learn_profile(spark.createDataFrame([("the and of the title", "en"), ("der und die Sache", "de")], "text string, lang string"))


@pytest.fixture
def folder(tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    for n in range(4):
        (pages / f"p{n}.json").write_text(page(n, [f"the title {i}" for i in range(n, n + 6)]))
    return str(pages)


def keys(df):
    return sorted((r.hash, r.title, r.published_at, tuple(r.tickers)) for r in df.collect())


def poll(spark, profile, folder, out, checkpoint, files=1):
    landing.ingest_stream(landing.page_stream(spark, folder, files), out, checkpoint, profile).awaitTermination()


def test_stream_equals_batch(spark, profile, folder, tmp_path):
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/cp"
    poll(spark, profile, folder, out, checkpoint)
    assert keys(landing.stored_articles(spark, out)) == keys(ingest(readers.read_pages(spark, folder), profile))
    # A second run picks up what has landed since: a repeat, a very old article, one in another language.
    with open(f"{folder}/p9.json", "w") as f:
        f.write(page(9, ["the title 1", "the newest", "der und die der"]).replace("2024-01-02", "1999-01-02"))
    poll(spark, profile, folder, out, checkpoint)
    assert keys(landing.stored_articles(spark, out)) == keys(ingest(readers.read_pages(spark, folder), profile))
    assert landing.stored_articles(spark, out).where("published_at < '2000-01-01'").count() == 1


def test_rejected_first_copy_removes_later_ones(spark, profile, tmp_path):
    """Repeats go before the filters, across polls too."""
    folder = tmp_path / "pages"
    folder.mkdir()
    late = page(0, ["the only"]).replace('"and the"', '"der und die der und"')
    for n, text in enumerate((late, page(1, ["the only"]))):
        (folder / f"p{n}.json").write_text(text)
        poll(spark, profile, str(folder), f"{tmp_path}/out", f"{tmp_path}/cp")
    assert landing.stored_keys(spark, f"{tmp_path}/out").count() == 1
    assert ingest(readers.read_pages(spark, str(folder)), profile).count() == 0
    assert landing.stored_articles(spark, f"{tmp_path}/out").count() == 0


def test_repeated_batch_is_stored_once(spark, profile, folder, tmp_path):
    raw, out = readers.read_pages(spark, folder), f"{tmp_path}/out"
    for number in (0, 0, 1, 1):
        landing.ingest_batch(raw, number, out, profile)
    assert keys(landing.stored_articles(spark, out)) == keys(ingest(raw, profile))
    landing.ingest_batch(raw.limit(0), 2, out, profile)


def test_live_runs_stay_few():
    for fanout in (2, 3, 8):
        for batches in range(500):
            runs, held = landing.live_runs(batches, fanout), set()
            for level, number in runs:
                held |= set(range(number * fanout**level, (number + 1) * fanout**level))
            assert held == set(range(batches))
            assert len(runs) <= (fanout - 1) * (1 + math.log(max(1, batches), fanout))
            # Slots of live runs, and of those a repeated batch still needs, are told apart.
            earlier = landing.live_runs(max(0, batches - 1), fanout)
            slots = {(level, number): landing.run_path("o", "keys", (level, number), fanout) for level, number in {*runs, *earlier}}
            assert len(set(slots.values())) == len(slots)
    assert len({landing.run_path("o", "keys", r) for b in range(500) for r in landing.live_runs(b)}) <= 2 * 8 * 3


def test_many_polls_keep_few_files_and_no_repeat(spark, tmp_path):
    out, seen = str(tmp_path / "out"), set()
    for batch in range(20):
        rows = [("r", f"h{batch * 3 + i}", (batch + i) % 5) for i in range(6)] + [(None if batch % 2 else "", "h0", 0)]
        first = spark.createDataFrame([(r or "", h, int(h[1:]) % 7) for r, h, _ in rows], "request string, hash string, cell int").distinct()
        for _ in range(2 if batch in (4, 8, 13) else 1):  # some batches are repeated
            new = landing.unseen(first, batch, out, fanout=3)
            assert {(r.request, r.hash) for r in new.collect()} == {((r or ""), h) for r, h, _ in rows} - seen
            landing.add_keys(new, batch, out, fanout=3)
        seen |= {((r or ""), h) for r, h, _ in rows}
        live = landing.live_runs(batch + 1, 3)
        files = landing._read_runs(spark, out, "keys", live, 3).inputFiles()
        assert len(live) <= 6 and len(files) <= 4 * len(live)
    assert {(r.request, r.hash) for r in landing.stored_keys(spark, out, 3).collect()} == seen
    folders = {p.parent for p in (tmp_path / "out" / "keys").rglob("*.parquet")}
    assert len(folders) <= 6 + 6 + 2


def test_filters_rule_out_cells(spark, tmp_path):
    keys = spark.range(2000).select(F.lit("r").alias("request"), F.col("id").cast("string").alias("hash"), (F.col("id") % 4).cast("int").alias("cell"))
    landing.add_keys(keys, 0, str(tmp_path))
    filters = landing._read_runs(spark, str(tmp_path), "filters", [(0, 0)], landing.FANOUT)
    assert sorted(landing.possible_repeats(keys, filters)) == [0, 1, 2, 3]
    assert landing.possible_repeats(keys.where("hash = '6'"), filters) == [2]
    other = keys.where("cell = 1").limit(40).withColumn("hash", F.concat(F.lit("new"), "hash"))
    few = landing.possible_repeats(other, filters)
    assert few in ([], [1])
    assert landing.possible_repeats(keys.withColumn("cell", F.lit(9)), filters) == []


def test_untouched_months_are_not_written(spark, tmp_path):
    import os

    out = str(tmp_path / "out")
    start = datetime(2024, 1, 10)
    rows = [(start + timedelta(days=10 * d), "positive", ["A"], 0.1 * (d % 5)) for d in range(30)]
    live.update_daily(spark.createDataFrame(rows, LABELLED), 0, out, 3, 4, fold_every=10)

    def written():
        return {os.path.join(f, n): os.stat(os.path.join(f, n)).st_mtime_ns
                for f, _, names in os.walk(f"{out}/daily") for n in names if n.endswith(".parquet")}

    before = written()
    more = [(start + timedelta(days=100), "negative", ["A"], -1.0)]
    live.update_daily(spark.createDataFrame(more, LABELLED), 1, out, 3, 4, fold_every=10)
    after = written()
    kept = [p for p in before if after.get(p) == before[p]]
    assert {p.split("month=")[1][:6] for p in after if p not in before} == {"202404", "202405"}
    assert {p.split("month=")[1][:6] for p in kept} == {"202401", "202402", "202403", "202406", "202407", "202408", "202409", "202410"}
    whole = daily.rolling_trend(daily.daily_ticker_aggregate(spark.createDataFrame(rows + more, LABELLED)), 3)
    def values(df):
        return sorted((r.date, round(r.mean_score, 9), None if r.rolling_z is None else round(r.rolling_z, 6)) for r in df.collect())

    assert values(live.current_daily(spark, out)) == values(whole)


def spoil(folder, keep):
    """Overwrite every data file whose month is not in ``keep``; reading one fails."""
    spoilt = 0
    for path in folder.rglob("month=*/*.parquet"):
        if int(path.parent.name.split("=")[1]) not in keep:
            path.write_bytes(b"not a table")
            (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
            spoilt += 1
    return spoilt


def test_untouched_months_are_not_opened(spark, tmp_path):
    out = tmp_path / "out"
    start = datetime(2024, 1, 10)
    rows = [(start + timedelta(days=10 * d), "positive", ["A"], 0.1 * (d % 5)) for d in range(30)]
    live.update_daily(spark.createDataFrame(rows, LABELLED), 0, str(out), 3, 1, fold_every=10)
    # April changes, and May by its frames; the carries of the next two months tell that nothing further does.
    assert spoil(out / "batches", {202404, 202405}) and spoil(out / "daily", {202404, 202405})
    assert spoil(out / "carry", {202404, 202405, 202406, 202407})
    more = [(start + timedelta(days=100), "negative", ["A"], -1.0)]
    live.update_daily(spark.createDataFrame(more, LABELLED), 1, str(out), 3, 1, fold_every=10)
    whole = daily.rolling_trend(daily.daily_ticker_aggregate(spark.createDataFrame(rows + more, LABELLED)), 3)
    trend = {r.date: round(r.rolling_mean, 9) for r in whole.collect()}
    got = spark.read.parquet(*[f"{out}/daily/bucket=0/month={m}" for m in (202404, 202405)]).collect()
    assert len(got) == 6 and all(round(r.rolling_mean, 9) == trend[r.date] for r in got)


@pytest.mark.parametrize("window", [1, 4])
def test_random_arrivals_equal_batch(spark, tmp_path, window):
    """Late days, new months between old ones, new and rare tickers; some updates are interrupted and repeated."""
    rng = random.Random(window)
    out, everything = str(tmp_path / "out"), []
    for batch in range(5):
        rows = [(datetime(2023, 1, 1) + timedelta(days=rng.choice([rng.randrange(700), rng.randrange(60), 400])),
                 rng.choice(["positive", "negative", None]), [rng.choice(["A", "A", "B", f"N{batch}"])], rng.choice([None, rng.random()]))
                for _ in range(rng.randint(1, 14))]
        everything += rows
        df = spark.createDataFrame(rows, LABELLED)
        if batch % 3 == 1:
            # Stop after the first, or the second, of the three tables written.
            calls, true = [], live.write_table

            def stop(table, path, *a, **k):
                if not path.startswith((f"{out}/batches", f"{out}/folded")):
                    calls.append(path)
                    if len(calls) > 1 + batch % 2:
                        raise InterruptedError
                return true(table, path, *a, **k)

            live.write_table = stop
            try:
                live.update_daily(df, batch, out, window, 2, fold_every=3)
            except InterruptedError:
                pass
            finally:
                live.write_table = true
        live.update_daily(df, batch, out, window, 2, fold_every=3)
        whole = daily.rolling_trend(daily.daily_ticker_aggregate(spark.createDataFrame(everything, LABELLED)), window)

        def values(df):
            return sorted((r.ticker, r.date, r.article_count, *[None if x is None else round(x, 6) + 0.0 for x in (r.mean_score, r.rolling_mean, r.rolling_z)])
                          for r in df.collect())

        assert values(live.current_daily(spark, out)) == values(whole)


def batches():
    """Late articles, a new ticker, odd scores, a missing date."""
    start = datetime(2024, 1, 1)

    def row(day, label, ticker, score):
        return (start + timedelta(days=day) if day is not None else None, label, [ticker], score)

    first = [row(d, "positive", "A", 1.0) for d in range(12)] + [row(3, "negative", "B", 0.3)]
    second = [row(2, "negative", "A", -1.0), row(2, None, "A", None), row(11, "neutral", "A", 0.1), row(None, "x", "A", 1.0)]
    third = [row(40, "positive", "C", 0.7), row(3, "positive", "B", float("nan")), row(4, "positive", "B", -0.2)]
    return [first, second, third]


@pytest.mark.parametrize("fold_every", [1, 2, 100])
def test_live_daily_equals_batch(spark, tmp_path, fold_every):
    everything = []
    out, landed, checkpoint = f"{tmp_path}/live", f"{tmp_path}/landed", f"{tmp_path}/cp"
    for rows in batches():
        everything += rows
        spark.createDataFrame(rows, LABELLED).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(LABELLED).parquet(landed)
        live.maintain_daily(stream, out, checkpoint, window=8, buckets=4, fold_every=fold_every) \
            .awaitTermination()
    whole = daily.rolling_trend(daily.daily_ticker_aggregate(spark.createDataFrame(everything, LABELLED)), 8)

    def rows_of(df):
        return sorted((r.ticker, r.date, r.article_count, *[
            None if v is None else round(v, 6) + 0.0
            for v in (r.mean_score, r.pct_pos, r.pct_neg, r.tone_volatility, r.rolling_mean, r.rolling_z)])
            for r in df.collect())

    assert rows_of(live.current_daily(spark, out)) == rows_of(whole)
    def alerts(df):
        return sorted((r.ticker, r.date, r.alert_type) for r in df.collect())

    assert alerts(live.current_alerts(spark, out, 2.0)) == alerts(daily.detect_alerts(whole, 2.0)) != []


def test_replayed_batch_counts_once(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame(batches()[0], LABELLED)
    for number, total in ((0, 13), (0, 13), (1, 26), (2, 39), (2, 39), (3, 52), (3, 52), (4, 65)):
        live.update_daily(df, number, out, 7, 4, fold_every=2)
        assert live.current_daily(spark, out).agg(F.sum("article_count")).first()[0] == total


def test_empty_batch_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame(batches()[0], LABELLED)
    live.update_daily(df.limit(0), 0, out, 7, 4, fold_every=2)
    live.update_daily(df, 1, out, 7, 4, fold_every=2)
    live.update_daily(df.limit(0), 2, out, 7, 4, fold_every=2)
    assert live.current_daily(spark, out).count() == 13
