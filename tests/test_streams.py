"""Streams that arrive in waves against plain computations; starting again changes nothing."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from mentionmill.streaming import events
from mentionmill.streaming.resume import counts_by_window

BASE = dt.datetime(2024, 1, 1)


def at(minutes):
    return BASE + dt.timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def waves(spark):
    r = random.Random(8)
    rows = sorted(((r.randrange(3000), r.choice([None, "a", "b", "c"])) for _ in range(150)), key=lambda x: (x[0], str(x[1])))
    parts = [[x for x in rows if lo <= x[0] < lo + 1000] for lo in (0, 1000, 2000)] + [[(900_000, "end")]]
    return rows, [spark.createDataFrame([(at(m), k) for m, k in p], "ts timestamp, k string") for p in parts]


def test_sessions(spark, waves):
    rows, parts = waves
    want = []
    for k in (None, "a", "b", "c"):
        for m in (m for m, x in rows if x == k):
            if want and want[-1][0] == k and m - want[-1][2] < 60:
                want[-1][2:] = [m, want[-1][3] + 1]
            else:
                want.append([k, m, m, 1])
    out = {again: events.replayed(spark, parts, lambda e: events.sessions(e, "ts", "k", "60 minutes", "5 minutes"), "test-sessions", again).collect() for again in (False, True)}
    got = sorted(([r.k, r.start, r.end, r.n] for r in out[True] if r.k != "end"), key=str)
    assert got == sorted(([k, at(a), at(b), n] for k, a, b, n in want), key=str) and sorted(map(str, out[False])) == sorted(map(str, out[True]))


def test_first_seen_and_forgotten(spark, waves):
    rows, parts = waves
    want, last = [], {}
    for m, k in rows:
        if k not in last or m - last[k] > 100:
            want.append((at(m), k))
        last[k] = m
    out = events.replayed(spark, parts, lambda e: events.first_seen(e, "ts", "k", 100 * 60), "test-first", True).where("k IS NULL OR k <> 'end'")
    assert sorted(((r.ts, r.k) for r in out.collect()), key=str) == sorted(want, key=str)


def test_windows_leave_late_rows_out(spark):
    parts = [[(10, "x"), (70, "x"), (200, "y")], [(20, "x"), (150, "y"), (195, "y"), (205, "y")], [(9000, "end")]]
    parts = [spark.createDataFrame([(at(m), k) for m, k in p], "ts timestamp, k string") for p in parts]
    got = events.replayed(spark, parts, lambda e: counts_by_window(e, "ts", "k", "1 hour", "30 minutes"), "test-windows", True)
    told = {(r.start, r.k): r.n for r in got.where(F.col("k") != "end").collect()}
    assert told == {(at(0), "x"): 1, (at(60), "x"): 1, (at(120), "y"): 1, (at(180), "y"): 3}  # 20 comes when its hour is closed, 150 does not


def test_first_seen_of_keys_that_share_a_bucket(spark):
    """All keys are one bucket's: ties go by number, large numbers and nulls stay whole, keys are forgotten one by one."""
    big = 2**53 + 1
    parts = [
        [(big + 1, 10, 1, 0.5), (big, 10, 1, float("nan")), (None, 10, None, None), (7, 30, 2, 1.0)],
        [(8, 100, 1, 1.0), (9, 131, 2, 1.0), (big + 2, 110, None, 1.0)],
        [(10, 9000, 2, 1.0), (None, 9000, big, 2.0)],
        [(11, 900_000, -1, 1.0)],
    ]
    parts = [spark.createDataFrame([(i, at(m), k, x) for i, m, k, x in p], "id long, ts timestamp, k long, x double").coalesce(1) for p in parts]
    out = events.replayed(spark, parts, lambda e: events.first_seen(e, "ts", "k", 100 * 60, order="id", buckets=1), "test-bucket")
    got = sorted((str(r.id), r.ts, str(r.k), str(r.x)) for r in out.where("k IS NULL OR k <> -1").collect())
    want = [(big, 10, 1, float("nan")), (None, 10, None, None), (7, 30, 2, 1.0), (9, 131, 2, 1.0), (10, 9000, 2, 1.0), (None, 9000, big, 2.0)]
    assert got == sorted((str(i), at(m), str(k), str(x)) for i, m, k, x in want)
