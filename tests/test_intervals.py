"""Merged periods and gaps against a plain sweep."""

import random

import pytest
from pyspark.sql import functions as F

from phasemill.operators.intervals import _parted, continuous_periods, periods_and_gaps

SCHEMA = "take string, s long, e long, start string, kind int, __shard int"


def sweep(rows, join_gap, max_gap):
    out = []
    for take in {r[0] for r in rows}:
        spans = sorted({(s, e) for t, s, e in rows if t == take and s is not None and e is not None and e > s})
        merged = []
        for s, e in spans:
            if merged and s - merged[-1][1] < join_gap:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out += [(take, "period", s, e) for s, e in merged]
        out += [(take, "gap", a[1], b[0]) for a, b in zip(merged, merged[1:], strict=False) if b[0] - a[1] <= max_gap]
    return sorted(out, key=str)


def run(spark, rows, join_gap, max_gap, width):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = periods_and_gaps(df, {"take": F.col("take")}, F.col("s"), F.col("e"), join_gap, max_gap, width)
    return sorted([tuple(r) for r in got.collect()], key=str)


@pytest.mark.parametrize("seed", range(3))
def test_random(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(300):
        s = rng.randint(-500, 3000)
        rows.append((rng.choice(["a", "a", "a", "b", None]), s, s + rng.choice([-3, 0, 1, 4, 30, 200])))
    rows += [("a", None, 5), ("a", 5, None), ("c", 0, 1)] + rows[:20]
    # many shard edges, also right at interval bounds
    assert run(spark, rows, 5, 60, 40) == sweep(rows, 5, 60)


def test_long_interval_over_many_shards(spark):
    rows = [("a", 0, 10_000_000), ("a", 5_000, 5_010), ("a", 9_999_999, 10_000_100), ("b", 5, 6), ("a", 10_000_104, 10_000_110), ("a", 10_000_115, 10_000_120)]
    assert run(spark, rows, 5, 1000, 100) == sweep(rows, 5, 1000)


def test_touching_at_a_shard_edge(spark):
    rows = [("a", 0, 100), ("a", 100, 200), ("a", 204, 300), ("a", 305, 399), ("a", 400, 401)]
    assert run(spark, rows, 5, 1000, 100) == sweep(rows, 5, 1000)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert continuous_periods(df, {"take": F.col("take")}, F.col("s"), F.col("e")).count() == 0


def test_points(spark):
    df = spark.createDataFrame([("a", 0, 10, "x", 1, 2), ("a", 12, 12, "x", 1, 2), ("a", 15, 20, "x", 1, 2), ("b", 7, 7, "x", 1, 2)], SCHEMA)
    got = lambda points: sorted(tuple(r) for r in continuous_periods(df, {"take": F.col("take")}, F.col("s"), F.col("e"), 5, points=points).collect())
    assert got(True) == [("a", 0, 20), ("b", 7, 7)]
    assert got(False) == [("a", 0, 10), ("a", 15, 20)]


def test_one_interval_over_100_000_shards_leaves_stitching_small(spark):
    # 2,000 intervals in 200 shards of one entity, under one that covers 100,000 shards
    small = spark.range(2000).select(F.lit("a").alias("take"), (F.col("id") * 50).alias("s"), (F.col("id") * 50 + 3).alias("e"))
    long = spark.createDataFrame([("a", 1, 50_000_000)], "take string, s long, e long")
    both = small.unionByName(long)
    assert [tuple(r) for r in continuous_periods(both, {"take": F.col("take")}, F.col("s"), F.col("e"), 5, 500).collect()] == [("a", 0, 50_000_000)]
    for df in (small, both):
        pieces = df.select(F.col("take").alias("__k0"), F.col("s").alias("__s"), F.col("e").alias("__e"), F.floor(F.col("s") / 500).alias("__shard"))
        inner, edge = _parted(pieces, ["__k0"], 5)
        assert edge.count() <= 2 * 200
