"""Keys that hold most of the rows: the same results, and no task that holds a key's history."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hindcast.operators import aggregates, joins, slices, windows


@pytest.fixture(scope="module")
def events(spark):
    """Two of three rows belong to key 1; many instants and null times repeat."""
    rng = random.Random(9)
    out = []
    for k in range(4000):
        key = rng.choice([1, 1, 1, 1, 2, 3, None])
        at = None if rng.random() < 0.02 else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(1500) * 20)
        out.append((k, key, at, rng.randrange(3), None if rng.random() < 0.1 else rng.randrange(5), rng.random() < 0.5))
    return spark.createDataFrame(out, "id long, k int, ts timestamp, seq int, x int, is_snap boolean").cache()


def pairs(df, a, b):
    return {r[a]: r[b] for r in df.collect()}


def test_slices_are_even(events):
    found = slices.cuts(events, ["k"], "ts", hot=500)
    assert {r["__k"] for r in found.collect()} >= {1}
    rows = slices.sliced(events, ["k"], "ts", found)
    sizes = [r["count"] for r in rows.where("k = 1").groupBy(slices.SLICE).count().collect()]
    total = events.where("k = 1").count()
    assert sum(sizes) == total and max(sizes) < total / 20 and rows.where("k = 3").select(slices.SLICE).distinct().count() <= slices.PIECES


def test_expanding_of_hot_keys(events):
    plain = windows.expanding(events, ["k"], ["ts", "id"], ["x"])
    cut = windows.expanding(events, ["k"], ["ts", "id"], ["x"], hot=500)
    assert cut.columns == plain.columns and pairs(cut, "id", "x_before") == pairs(plain, "id", "x_before")


def test_asof_of_hot_keys(events):
    req = events.where("not is_snap").select("id", "k", "ts", "seq")
    snap = events.where("is_snap").select("k", "ts", F.col("seq").alias("seq_s"), F.col("id").alias("snap"))
    # Snapshots of one instant are told apart by the window only if their order is fixed: one for each instant and sequence.
    snap = snap.groupBy("k", "ts", "seq_s").agg(F.min("snap").alias("snap"))
    for seq in (None, ("seq", "seq_s")):
        some = snap if seq else snap.groupBy("k", "ts").agg(F.min("snap").alias("snap"), F.min("seq_s").alias("seq_s"))
        plain = joins.join_asof_snapshot(req, some, ["k"], "ts", "ts", ["snap"], seq)
        cut = joins.join_asof_snapshot(req, some, ["k"], "ts", "ts", ["snap"], seq, hot=500)
        assert cut.columns == plain.columns and pairs(cut, "id", "snap") == pairs(plain, "id", "snap")


def test_rolling_by_day(events):
    plain = windows.rolling_days(events, ["k"], "ts", 3, ["x"])
    cut = windows.rolling_days(events, ["k"], "ts", 3, ["x"], by_day=True)
    assert cut.columns == plain.columns and pairs(cut, "id", "x_3d") == pairs(plain, "id", "x_3d")


def test_sketch_of_a_hot_group(events):
    exact = pairs(aggregates.point_baseline(events, "id", ["k"]), "k", "median")
    near = pairs(aggregates.point_baseline(events, "id", ["k"], accuracy=200), "k", "median")
    for key, n in ((r["k"], r["count"]) for r in events.groupBy("k").count().collect()):
        ids = sorted(r["id"] for r in events.where(F.col("k").eqNullSafe(F.lit(key))).select("id").collect())
        assert abs(sum(i < near[key] for i in ids) - sum(i < exact[key] for i in ids)) <= n / 200 + 1
