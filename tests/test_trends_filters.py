"""Series guards of T1-T7, W2/W3, and the view filters."""

from __future__ import annotations

import datetime as dt

import pytest

from orderlens.operators import filters
from orderlens.operators import trends as T


def series(spark, values):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "d date, y double")


def summary(spark, values):
    return T.trend_summary(series(spark, values), "d", "y", scale=2).first()


def test_short_series_guards(spark):
    for values in ([], [1.0], [1.0, 2.0]):
        s = summary(spark, values) if values else None
        if s is not None:
            assert s.trend == "stable"
    assert summary(spark, [1.0]).slope == 0.0 and summary(spark, [1.0]).growth_rate == 0.0
    assert T.linear_trend_forecast(series(spark, [1.0]), "d", "y").count() == 0


def test_linear_fit_and_forecast(spark):
    f = T.linear_trend_forecast(series(spark, [1.0, 3.0, 5.0]), "d", "y", periods=2, scale=2).collect()
    assert [(r.position, r.forecast) for r in f] == [(3, 7.0), (4, 9.0)]
    assert f[0].slope == 2.0
    s = summary(spark, [1.0, 3.0, 5.0])
    assert s.trend == "increasing" and s.growth_rate == 4.0


def test_constant_and_null_series(spark):
    assert summary(spark, [2.0, 2.0, 2.0, 2.0]).trend == "stable"
    s = summary(spark, [4.0, None, 2.0])  # NaN masked; positions keep the gap
    assert s.slope == pytest.approx(-1.0)
    assert s.growth_rate == -0.5
    assert summary(spark, [0.0, 1.0, 2.0]).growth_rate == 0.0  # zero end


def test_moving_average_min_periods(spark):
    ma = T.moving_average(series(spark, [1.0, 2.0, 3.0, 4.0]), "d", "y", window=2).collect()
    assert [r.moving_average for r in ma] == [1.0, 1.5, 2.5, 3.5]


def test_concentration_and_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "x double, y double")
    assert T.concentration_index(df, "x").first()[0] == 0.5
    zero = spark.createDataFrame([(0.0,)], "x double")
    assert T.concentration_index(zero, "x").first()[0] == 0.0
    r = T.correlation(df, "x", "y").first()
    assert r.correlation > 0.99 and r.correlation_band == "strong positive"
    two = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "x double, y double")
    assert T.correlation(two, "x", "y").first().correlation == 0.0


def test_filters(spark):
    s = series(spark, [1.0, 2.0, 3.0, 4.0])
    assert filters.date_range(s, "2020-01-02", "2020-01-03", "d").count() == 2
    b = filters.date_bounds(s, "d").first()
    assert (b.date_start, b.date_end) == (dt.date(2020, 1, 1), dt.date(2020, 1, 4))
    empty = filters.date_bounds(s.where("false"), "d").first()
    assert empty.date_start == dt.date(2016, 1, 1) and empty.date_end >= empty.date_start
    kv = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert filters.equals_or_all(kv, "k", "All").count() == 2
    assert filters.equals_or_all(kv, "k", "b").count() == 1
    assert [r.k for r in filters.project_sorted(kv, ["k", "v"], "v").collect()] == ["b", "a"]


def test_bucketed_positions_match_a_global_numbering(spark):
    s = series(spark, [float(i % 7) for i in range(100)]).where("d <> date'2020-02-10'")
    got = [(r.d, r.position) for r in T.with_position(s, "d").orderBy("d").collect()]
    assert [p for _, p in got] == list(range(99))
    ma = {r.d: r.moving_average for r in T.moving_average(s, "d", "y", window=3).collect()}
    ys = [r.y for r in s.orderBy("d").collect()]
    ds = [r.d for r in s.orderBy("d").collect()]
    for i, d in enumerate(ds):
        window = ys[max(0, i - 2): i + 1]
        assert ma[d] == pytest.approx(sum(window) / len(window))


def test_partitioned_series(spark):
    rows = [(k, dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i if k == "up" else -i))
            for k in ("up", "down") for i in range(5)]
    df = spark.createDataFrame(rows, "k string, d date, y double")
    got = {r.k: r.trend for r in T.trend_summary(df, "d", "y", scale=0, partition_cols=["k"]).collect()}
    assert got == {"up": "increasing", "down": "decreasing"}
    f = T.linear_trend_forecast(df, "d", "y", periods=1, scale=0, partition_cols=["k"]).collect()
    assert {(r.k, r.position, r.forecast) for r in f} == {("up", 5, 5.0), ("down", 5, -5.0)}
