import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import aggregates, ordering, windows

T0 = dt.datetime(2024, 3, 1)


def brute_swings(data, hours):
    out = {}
    for s, t, _ in data:
        inside = [(u, v) for r, u, v in data if r == s and t <= u <= t + dt.timedelta(hours=hours)]
        hi, lo = max(v for _, v in inside), min(v for _, v in inside)
        out[(s, t)] = (hi, min(u for u, v in inside if v == hi), lo, min(u for u, v in inside if v == lo))
    return out


@pytest.mark.parametrize("block, most", [(60, 100_000), (30, 100_000), (720, 100_000), (60, 3), (720, 20)])
def test_rolling_extremes_equal_brute_force(spark, block, most):
    draw = random.Random(block)
    data = []
    for s, n, days in (("a", 150, 5), ("b", 40, 20), ("c", 1, 1)):
        for _ in range(n):
            minute = draw.choice([draw.randrange(days * 1440), draw.randrange(days) * 1440])
            data.append((s, T0 + dt.timedelta(minutes=minute), float(draw.randrange(8))))
    data += [("edge", T0, 1.0), ("edge", T0 + dt.timedelta(hours=24), 9.0), ("edge", T0 + dt.timedelta(hours=24, microseconds=1), 50.0)]
    df = spark.createDataFrame(data, "s string, t timestamp_ntz, v double")
    got = {
        (r.s, r.start): (r.max_value, r.max_time, r.min_value, r.min_time)
        for r in windows.rolling_extremes(df, ["s"], "t", "v", 24, block, most, slots=4).collect()
    }
    assert got == brute_swings(data, 24)


def test_a_series_within_one_hour_spreads_over_many_tasks(spark):
    draw = random.Random(1)
    data = [("a", T0 + dt.timedelta(microseconds=draw.randrange(3_600_000_000)), float(draw.randrange(1000))) for _ in range(3000)]
    df = spark.createDataFrame(data, "s string, t timestamp_ntz, v double")
    found = windows.rolling_extremes(df, ["s"], "t", "v", 24, most=500, slots=64)
    assert {(r.s, r.start): (r.max_value, r.max_time, r.min_value, r.min_time) for r in found.collect()} == brute_swings(data, 24)
    parts = df.selectExpr("s", "t AS at", "0L AS blk", "unix_micros(cast(t AS timestamp)) AS t", "true AS own", "struct(-v AS v, t AS at) AS hi", "struct(v AS v, t AS at) AS lo")
    sizes = [r[0] for r in ordering.value_slots(parts, ["s", "blk"], "t", [], 64).groupBy("_slot").count().select("count").collect()]
    assert len(sizes) > 50 and max(sizes) < 3 * 3000 / 64


def test_rolling_extremes_refuses_uneven_blocks(spark):
    with pytest.raises(ValueError):
        windows.rolling_extremes(spark.range(1), [], "id", "id", 24, 7)


def test_largest_swing_prefers_the_earliest_start(spark):
    data = [("a", T0, 0.0), ("a", T0 + dt.timedelta(hours=1), 5.0), ("a", T0 + dt.timedelta(days=3), 5.0), ("a", T0 + dt.timedelta(days=3, hours=2), 0.0)]
    df = spark.createDataFrame(data, "s string, t timestamp_ntz, v double")
    best = windows.largest_swing(windows.rolling_extremes(df, ["s"], "t", "v", 24), ["s"]).first()
    assert (best.swing, best.start) == (5.0, T0)


def test_daily_amplitude(spark):
    data = [("a", T0, 1.0), ("a", T0 + dt.timedelta(hours=2), 7.0), ("a", T0 + dt.timedelta(hours=3), 7.0), ("a", T0 + dt.timedelta(days=1), 3.0)]
    df = spark.createDataFrame(data, "s string, t timestamp_ntz, v double")
    days = aggregates.daily_amplitude(df, ["s"], F.to_date("t"), "t", "v").orderBy("day").collect()
    assert [(r.amplitude, r.max_time) for r in days] == [(6.0, T0 + dt.timedelta(hours=2)), (0.0, T0 + dt.timedelta(days=1))]


def daily(spark, values):
    return spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=i), v) for i, v in values], "day date, v double")


def test_rolling_days_keeps_short_windows_unless_told(spark, rows):
    df = daily(spark, [(0, 1.0), (0, 3.0), (1, 8.0), (4, 10.0)])
    means = windows.rolling_days(df, F.col("day"), F.col("v"), 3)
    assert rows(means) == [(dt.date(2024, 1, 1), 4.0), (dt.date(2024, 1, 2), 8.0), (dt.date(2024, 1, 5), 10.0)]
    assert windows.best_window(means).first()[0] == 10.0
    full = windows.rolling_days(df, F.col("day"), F.col("v"), 3, require_full=True)
    assert rows(full) == [(dt.date(2024, 1, 1), 4.0), (dt.date(2024, 1, 2), 8.0)]


def test_best_window_tie_goes_to_the_earlier_day(spark):
    means = daily(spark, [(5, 2.0), (1, 2.0), (0, 1.0)]).withColumnRenamed("v", "mean_value")
    assert windows.best_window(means).first()["start_day"] == dt.date(2024, 1, 2)


def test_dense_periods_previous_and_growth(spark, rows):
    df = spark.createDataFrame([("p", dt.date(2023, 12, 1), 5), ("p", dt.date(2024, 2, 1), 7)], "product string, month date, q long")
    dense = windows.densify(df, ["product"], "month", "1 MONTH", ["q"], "2023-12-01", "2024-03-01")
    grown = windows.parallel_period(dense, ["product"], "month", "q", 1)
    assert rows(grown, "month", "q", "previous", "net_growth") == [
        (dt.date(2023, 12, 1), 5, 0, 5), (dt.date(2024, 1, 1), 0, 5, -5), (dt.date(2024, 2, 1), 7, 0, 7), (dt.date(2024, 3, 1), 0, 7, -7),
    ]


def test_to_date_restarts_and_trailing_crosses_months(spark):
    df = spark.createDataFrame([("p", dt.date(2024, 1, 25) + dt.timedelta(days=i), 1) for i in range(14)], "product string, day date, q long")
    got = windows.trailing(windows.to_date(df, ["product"], [F.trunc("day", "month")], "day", "q", "mtd"), ["product"], "day", "q", 10, "ten")
    by_day = {r.day: (r.mtd, r.ten) for r in got.collect()}
    assert by_day[dt.date(2024, 1, 31)] == (7, 7)
    assert by_day[dt.date(2024, 2, 1)] == (1, 8)
    assert by_day[dt.date(2024, 2, 7)] == (7, 10)


def test_rank_keeps_ties(spark, rows):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 3), ("a", "z", 1), ("b", "x", 1)], "p string, c string, q int")
    assert rows(windows.rank_top(df, ["p"], [F.desc("q")]), "p", "c") == [("a", "x"), ("a", "y"), ("b", "x")]


def test_dense_axis_keeps_every_fact_and_every_null(spark, rows):
    facts = [("p", dt.date(2021, 1, 1), 5), ("p", dt.date(2021, 3, 1), None), ("q", dt.date(2021, 2, 14), 7), (None, dt.date(2021, 2, 1), 1)]
    df = spark.createDataFrame(facts, "product string, month date, q long")
    found = {(r.product, r.month): r.q for r in windows.densify(df, ["product"], "month", "1 MONTH", ["q"], "2021-02-01").collect()}
    assert all(found[(p, m)] == q for p, m, q in facts)
    assert len(found) == 3 * 3 + 1 and found[("q", dt.date(2021, 1, 1))] == 0  # the stray day is a row of its own
