"""Statistics, the country join, and the streaming operators."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from editlume.operators import countries, stats
from editlume.streaming.activity import live_sessions, once_per_id, revision_stream, run_available, weekly_edits

T0 = datetime(2015, 1, 5)


def values(spark, xs):
    return spark.createDataFrame([(None if x is None else float(x),) for x in xs], "x double")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=40))
def test_gini_and_lorenz(spark, xs):
    r = stats.gini(values(spark, map(float, xs)), "x").first()
    xs = sorted(xs)
    n, s = len(xs), sum(xs)
    if s == 0:
        assert r.gini is None
        return
    want = sum((2 * i - n - 1) * x for i, x in enumerate(xs, 1)) / (n * s)
    assert r.n == n and math.isclose(r.gini, want, abs_tol=1e-9) and -1e-9 <= r.gini < 1
    points = sorted((p.p, p.l) for p in stats.lorenz(values(spark, map(float, xs)), "x").collect())
    assert points[0] == (0.0, 0.0) and math.isclose(points[-1][0], 1) and math.isclose(points[-1][1], 1)
    assert all(l <= p + 1e-9 for p, l in points)


def test_regression_and_boxes(spark):
    df = spark.createDataFrame([(str(i), float(i), 2.0 * i + 1 + (9 if i == 4 else 0)) for i in range(10)] + [("n", None, 1.0)], "k string, x double, y double")
    fit = stats.ols(df, F.col("y"), F.col("x")).first()
    slope, intercept = np.polyfit(np.arange(10), [2 * i + 1 + (9 if i == 4 else 0) for i in range(10)], 1)
    assert fit.n == 10 and math.isclose(fit.slope, slope) and math.isclose(fit.intercept, intercept)
    assert stats.residual_extremes(df, "k", F.col("y"), F.col("x"), 1).first().k == "4"
    assert stats.box_outliers(values(spark, [1, 1, 2, 2, 3, 40]).withColumn("k", F.lit("a")), "k", "x").first().x == 40
    d = stats.describe(values(spark, [1.0, 2.0, 3.0, None]), ["x"]).first()
    assert (d.n, d.missing, d.n_distinct, d.mean, d.p50) == (3, 1, 3, 2.0, 2.0)


def test_series(spark):
    df = spark.createDataFrame([("a", T0.date() + timedelta(days=31 * k), k) for k in (0, 1, 4)], "s string, month date, n int").withColumn("month", F.date_trunc("month", "month").cast("date"))
    filled = stats.fill_months(df, ["s"], "month", "n").orderBy("month").collect()
    assert [r.n for r in filled] == [0, 1, 0, 0, 4]
    ma = stats.moving_mean(spark.range(20), [], "id", "id").orderBy("id").collect()
    assert [r.moving_mean for r in ma[:5]] == [None] * 5 and ma[5].moving_mean == 5.5 and ma[14].moving_mean is None


def test_stl_recovers_parts():
    k = np.arange(120)
    season, trend = 3 * np.sin(2 * np.pi * k / 12), 0.1 * k
    s, t, r = stats.stl_decompose(season + trend)
    assert np.abs(s - season)[12:-12].max() < 0.2 and np.abs(t - trend)[12:-12].max() < 0.2 and np.abs(s + t + r - season - trend).max() < 1e-9


def test_lowess_in_blocks():
    rnd = np.random.default_rng(4)
    x = np.sort(rnd.integers(0, 60, 150)).astype(float)  # with ties
    y = np.sin(x / 9) + rnd.normal(0, 0.2, 150)
    assert np.allclose(stats.lowess_fit(x, y), stats.lowess_fit(x, y, cells=700), rtol=1e-10)


def test_lowess_resists_outliers(spark):
    x = np.arange(40.0)
    y = 2 * x + 1
    y[20] += 500
    assert np.abs(np.delete(stats.lowess_fit(x, y), 20) - np.delete(2 * x + 1, 20)).max() < 1
    df = spark.createDataFrame([("a", float(i), 1.0) for i in range(5)] + [("a", None, 1.0)], "s string, x double, y double")
    assert [r.fitted for r in stats.lowess(df, ["s"], "x", "y").collect()] == pytest.approx([1.0] * 5)


def test_countries(spark):
    ranges = spark.createDataFrame([(10, 20, "A"), (30, 200_000, "B"), (400_000, 400_000, "C"), (None, 5, "D")], "lo long, hi long, country string")
    ips = spark.createDataFrame([(i,) for i in (5, 10, 20, 25, 30, 131_072, 200_000, 200_001, 400_000, 4_000_000_000, None)], "ip long")
    got = {r.ip: r.country for r in countries.attach_country(ips, "ip", ranges).collect()}
    assert got == {5: None, 10: "A", 20: "A", 25: None, 30: "B", 131_072: "B", 200_000: "B", 200_001: None, 400_000: "C", 4_000_000_000: None, None: None}
    located = countries.attach_country(ips, "ip", ranges).withColumn("page", F.lit(1))
    assert math.isclose(sum(r.share for r in countries.country_shares(located, "page").collect()), 1)


def test_streams(spark, tmp_path):
    schema = "rev_id long, rev_user long, rev_timestamp timestamp_ntz"
    folder = str(tmp_path / "in")
    rows = [(i, 1 + i % 2, T0 + timedelta(minutes=10 * i)) for i in range(20)]
    spark.createDataFrame(rows + rows[:5], schema).write.parquet(folder)
    spark.createDataFrame([(100, 9, T0 + timedelta(days=60))], schema).write.mode("append").parquet(folder)
    for name, build in (("weeks", lambda s: weekly_edits(once_per_id(s))), ("sessions", live_sessions)):
        stream = build(revision_stream(spark, folder, spark.read.parquet(folder).schema, 1))
        out = str(tmp_path / name)
        run_available(stream, lambda df, _, out=out: df.write.mode("append").parquet(out), str(tmp_path / f"{name}-state")).awaitTermination()
    weeks = {str(r.week): r.edits for r in spark.read.parquet(str(tmp_path / "weeks")).collect()}
    assert weeks["2015-01-05"] == 20
    s = spark.read.parquet(str(tmp_path / "sessions")).where("rev_user = 1").collect()
    assert len(s) == 1 and s[0].edits >= 10
