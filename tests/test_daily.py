from __future__ import annotations

import warnings
from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from toneflow.operators import daily
from toneflow.plans.report import alert_report, build_reports, daily_report
from toneflow.sources.writers import write_table

SCHEMA = "published_at timestamp, weak_label string, tickers array<string>, tone_score double"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def per_day(df, **kwargs):
    return daily.daily_ticker_aggregate(daily.prepare_articles(df), **kwargs)


def test_one_row_per_date(spark):
    """Five quiet days and a swing, one article each."""
    scores = [0.0, 0.0, -1.0, 1.0, 0.0, 1.0, -1.0, -1.0]
    names = {0.0: "neutral", 1.0: "positive", -1.0: "negative"}
    rows = [(datetime(2023, 11, 27, 6) + timedelta(days=2 * i), names[s], ["ZZT"], s) for i, s in enumerate(scores)]
    df = frame(spark, rows)
    days = per_day(df, ticker="ZZT").orderBy("date").collect()
    assert [d.mean_score for d in days] == scores
    assert [(d.date - days[0].date).days for d in days] == list(range(0, 16, 2))
    assert {(d.article_count, d.tone_volatility) for d in days} == {(1, 0.0)}
    trend = daily.rolling_trend(per_day(df), 4)
    assert daily.detect_alerts(trend, 1.9).count() == 0
    assert daily.detect_alerts(trend, 1.7).columns == ["date", "ticker", "alert_type", "z_value"]


def test_counts_nulls_and_unknown_labels(spark):
    day = datetime(2024, 1, 1, 23, 59)
    df = frame(spark, [
        (day, "positive", ["A", "B", "A"], 1.0), (day, None, ["A"], None), (day, "odd", ["A"], 0.5),
        (None, "positive", ["A"], 1.0), (day, "negative", [], -1.0), (day, "negative", None, -1.0),
        (day, "negative", ["B"], float("nan"))])
    rows = {r.ticker: r for r in per_day(df).collect()}
    a = rows["A"]
    assert (a.date, a.article_count, a.mean_score) == (date(2024, 1, 1), 3, 0.75)
    assert (round(a.pct_pos, 9), a.pct_neg, a.tone_volatility) == (round(1 / 3, 9), 0.0, 0.25)
    assert (rows["B"].article_count, rows["B"].mean_score, rows["B"].pct_neg) == (2, 1.0, 0.5)
    assert set(rows) == {"A", "B"}
    assert per_day(df, ticker="a").count() == 0
    assert per_day(df, ticker="A").select(*a.asDict()).collect() == [a]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="weak_label"):
        daily.prepare_articles(frame(spark, [(datetime(2024, 1, 1),)], "published_at timestamp"))


def test_existing_scores_are_kept(spark):
    df = frame(spark, [(datetime(2024, 1, 1), "negative", ["A"], 0.25)])
    assert daily.prepare_articles(df).first().tone_score == 0.25
    assert daily.prepare_articles(df.drop("tone_score")).first().tone_score == -1.0


SERIES = st.lists(st.one_of(st.none(), st.integers(-4, 4).map(lambda v: v / 4)), min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(SERIES, min_size=1, max_size=6), st.integers(1, 9))
def test_trend_matches_pandas(spark, many, window):
    # Gaps between days do not matter: the frame counts rows.
    rows = [(date(2024, 1, 1) + timedelta(days=3 * i), f"T{t}", v)
            for t, values in enumerate(many) for i, v in enumerate(values)]
    got = daily.rolling_trend(frame(spark, rows, "date date, ticker string, mean_score double"), window) \
        .orderBy("ticker", "date").toPandas()
    for t, values in enumerate(many):
        mine = got[got.ticker == f"T{t}"].reset_index(drop=True)
        s = pd.Series(values, dtype=float)
        mean = s.rolling(window, min_periods=1).mean()
        if window >= 2:
            z = (s - mean) / (s.rolling(window, min_periods=2).std(ddof=0) + 1e-6)
        else:
            z = pd.Series([float("nan")] * len(s))
        pd.testing.assert_series_equal(mine.rolling_mean.astype(float), mean, check_names=False, atol=1e-9)
        # A rounding error in a constant frame is blown up by the small constant.
        pd.testing.assert_series_equal(mine.rolling_z.astype(float), z, check_names=False, atol=1e-6)


def test_score_stays_below_its_bound_and_never_nan(spark):
    rows = [(date(2024, 1, 1) + timedelta(days=i), "A", 1.0 if i == 6 else 0.0) for i in range(7)]
    trend = daily.rolling_trend(frame(spark, rows, "date date, ticker string, mean_score double"), 7)
    zs = [r.rolling_z for r in trend.orderBy("date").collect()]
    assert zs[0] is None and 2.44 < zs[-1] < 6 ** 0.5
    assert daily.detect_alerts(trend, 2.5).count() == 0
    alert = daily.detect_alerts(trend, 2.4).collect()
    assert [(a.date.day, a.alert_type) for a in alert] == [(7, "spike_positive")]
    with pytest.warns(UserWarning):
        daily.detect_alerts(trend, 2.5, window=7)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        daily.detect_alerts(trend, 2.4, window=7)
    assert daily.detect_alerts(trend.drop("rolling_z")).columns == ["date", "ticker", "alert_type", "z_value"]


def test_summary_is_the_mean_of_daily_means(spark):
    start = datetime(2024, 1, 1)
    rows = [(start, "positive", ["A"], 1.0)] + [(start + timedelta(days=1), "neutral", ["A"], 0.0)] * 3
    summary = daily.period_summary(per_day(frame(spark, rows))).first()
    assert (summary.total_articles, summary.n_days, summary.avg_tone, summary.verdict) == (4, 2, 0.5, "positive")


def test_display_rounds_half_to_even(spark):
    df = frame(spark, [(date(2024, 1, 1), "A", 0.0625, 0.125, 1 / 3, 4, 0.0)],
               "date date, ticker string, mean_score double, pct_pos double, pct_neg double, article_count long, v double")
    row = daily.display(df).first()
    assert (row.Tone, row["Positive%"], row["Negative%"]) == (0.062, 12.5, 33.3)


def test_distribution_covers_the_domain(spark):
    df = spark.createDataFrame([("positive",), ("odd",), (None,), ("positive",)], "weak_label string")
    got = {r.label: (r.n, r.pct) for r in daily.label_distribution(df).collect()}
    assert got == {"negative": (0, 0.0), "neutral": (0, 0.0), "positive": (2, 50.0)}
    assert daily.label_distribution(df.limit(0)).where("pct <> 0").count() == 0


@pytest.mark.parametrize("cell_limit", [5, 2_000_000])
def test_recency_matches_brute_force(spark, cell_limit):
    # One ticker holds most rows, many under one timestamp.
    rows = [(f"{i * 7919 % 1000:04d}", datetime(2024, 1, 1, i % 3) if i % 2 else datetime(2024, 1, 2),
             "HOT" if i % 5 else f"T{i % 4}") for i in range(300)]
    rows += [("undated", None, "HOT"), ("undated", None, None), ("x", datetime(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "hash string, published_at timestamp, ticker string")
    got = {(r.ticker, r.hash): r["index"] for r in daily.recency_index(df, cell_limit=cell_limit).collect()}
    for ticker in {t for _, _, t in rows}:
        mine = sorted((r for r in rows if r[2] == ticker), key=lambda r: (r[1] is None, -r[1].timestamp() if r[1] else 0, r[0]))
        assert [got[ticker, h] for h, _, _ in mine] == list(range(len(mine)))


def test_decayed_tone(spark):
    rows = [("a", datetime(2024, 1, 2), "X", 1.0), ("b", datetime(2024, 1, 1), "X", -1.0), ("c", datetime(2023, 1, 1), "X", None)]
    df = spark.createDataFrame(rows, "hash string, published_at timestamp, ticker string, tone_score double")
    row = daily.decayed_tone(df, half_life=1).first()
    assert abs(row.decayed_score - (1 - 0.5) / 1.5) < 1e-12 and row.n == 3


@pytest.mark.parametrize("suffix", ["parquet", "csv"])
def test_report_files(spark, tmp_path, suffix):
    start = datetime(2024, 1, 1)
    rows = [(f"h{i}", start + timedelta(days=i % 9), "positive" if i % 9 == 8 else "negative", ["AAPL", "O'X"])
            for i in range(30)]
    df = spark.createDataFrame(rows, "hash string, published_at timestamp, weak_label string, tickers array<string>")
    source = write_table(df, f"{tmp_path}/labelled.{suffix}")
    paths = build_reports(spark, source, f"{tmp_path}/reports", window=7, z_threshold=2.0, file_format=suffix)
    read = spark.read.option("header", True).csv if suffix == "csv" else spark.read.parquet
    assert read(paths["daily"]).count() == daily_report(df).count() == 18
    assert read(paths["alerts"]).count() == alert_report(df, 7, 2.0).count() == 2
    one = build_reports(spark, source, f"{tmp_path}/reports", ticker="AAPL", z_threshold=2.0, file_format=suffix)
    assert "/aapl/" in one["daily"] and read(one["daily"]).count() == 9
    assert read(paths["daily"]).count() == 18


def test_backfilled_tickers_reach_the_report(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2024, 1, 1), "positive", [])],
                               "published_at timestamp, weak_label string, tickers array<string>")
    source = write_table(df, f"{tmp_path}/labelled.parquet")
    paths = build_reports(spark, source, f"{tmp_path}/r", ticker="ACME", backfill=True)
    assert spark.read.parquet(paths["daily"]).first().ticker == "ACME"
