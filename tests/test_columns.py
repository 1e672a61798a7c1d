"""Closed-form checks of column expressions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from liftlens.functions import columns as C


def values(spark, schema, rows, *exprs):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_snap_days_edges(spark):
    days = [24, 25, 35, 36, 54, 55, 65, 66, 84, 85, 95, 96, -30, None]
    got = values(spark, "d int", [(d,) for d in days], C.snap_days(F.col("d")))
    assert [g[0] for g in got] == [24, 30, 30, 36, 54, 60, 60, 66, 84, 90, 90, 96, -30, None]


@pytest.mark.parametrize("limit", [20, 24, 25, 30, 33, 35, 36, 87, 90, 93, 100, 360])
def test_snap_limit_matches_snapping(limit):
    def snap(x):
        return next((w for w in (30, 60, 90) if w - 5 <= x <= w + 5), x)

    wanted = [x for x in range(1, 400) if snap(x) <= limit]
    got = [x for x in range(1, 400) if x <= C.snap_limit(limit)]
    # offsets beyond the limit may snap back below it only around a window
    assert got == [x for x in wanted if x <= max(got, default=0)] and set(got) == set(wanted)


def test_day_diff_floors_like_a_time_delta(spark):
    pairs = [("2024-01-02 00:00:00", "2024-01-01 23:00:00", 0),
             ("2024-01-01 23:00:00", "2024-01-02 00:00:00", -1),
             ("2024-01-03 23:00:00", "2024-01-01 23:00:00", 2),
             ("2024-01-03 22:59:59", "2024-01-01 23:00:00", 1),
             ("2024-03-11 00:00:00", "2024-03-10 00:00:00", 1)]
    ntz = lambda c: F.col(c).cast("timestamp_ntz")
    got = values(spark, "a string, b string", [p[:2] for p in pairs],
                 C.day_diff(ntz("a"), ntz("b")))
    assert [g[0] for g in got] == [p[2] for p in pairs]


def test_status(spark):
    got = values(spark, "d int", [(1,), (0,), (-1,), (None,)], C.period_status(F.col("d")))
    assert [g[0] for g in got] == ["pre", "post", "post", "NA"]


def test_interval_text_and_significance(spark):
    rows = [(-1.005, 2.5), (0.125, 3.0), (-3.0, -0.001), (100.0, 200.0), (None, None)]
    got = values(spark, "a double, b double", rows, C.ci_text(F.col("a"), F.col("b")),
                 C.significance(F.col("a"), F.col("b")))
    assert got == [("[-1 - 2.5]", "Not Significant"), ("[0.12 - 3]", "Significant"),
                   ("[-3 - 0]", "Significant"), ("[100 - 200]", "Significant"), (None, None)]


def test_balance_tiers(spark):
    got = values(spark, "s double", [(0.04,), (-0.05,), (0.0999,), (-0.1,), (None,)],
                 C.balance_tier(F.col("s")))
    assert [g[0] for g in got] == ["Green", "Yellow", "Yellow", "Red", None]


def test_timestamps_of_both_formats(spark):
    rows = [("09-01-2023",), ("2023-09-01",), ("2023-09-01 13:30:00",), ("13-45-2023",),
            ("soon",), (None,)]
    got = values(spark, "t string", rows, C.parse_timestamp(F.col("t")))
    day = dt.datetime(2023, 9, 1)
    assert [g[0] for g in got] == [day, day, day.replace(hour=13, minute=30), None, None, None]


def test_bins_are_left_closed(spark):
    got = values(spark, "`x y` double", [(0.0,), (1.0,), (1.5,), (2.0,), (9.0,), (None,)],
                 C.bin_of("x y", [1.0, 2.0]))
    assert [g[0] for g in got] == [0, 1, 1, 2, 2, -1]
