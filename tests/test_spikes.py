"""Implausible readings against a loop over each series; exact quantiles; windows of bounded reach."""

import math
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from phasemill.operators.quantiles import exact_medians, exact_quantiles
from phasemill.operators.reach import bounded_reach, running_sum
from phasemill.operators.spikes import hampel, implausible_readings

SCHEMA = "take string, i int, ts long, x double, y double, kind string, scale double, field string"
BOUNDS = {"x": (-1.0, 2.0), "y": (0.0, 1.0)}


def plain(rows):
    out = set()
    for take in {r[0] for r in rows}:
        for f, (lo, hi) in BOUNDS.items():
            at = 3 if f == "x" else 4
            series = sorted({(r[1], r[2], r[at]) for r in rows if r[0] == take and r[at] is not None and not math.isnan(r[at])}, key=lambda r: (r[0], r[2]))
            out |= {(take, i, f) for i, _, v in series if v < lo or v > hi}
            s = [r for r in series if lo <= r[2] <= hi]
            v, t = [r[2] for r in s], [r[1] for r in s]
            n, a = len(v), 0
            for b in range(1, n + 1):
                if b == n or v[b] != v[a]:
                    if b - a >= 10:
                        out |= {(take, s[j][0], f) for j in range(a, b)}
                    a = b
            if n < 3:
                continue
            scale = statistics.median(abs(q - p) for p, q in zip(v, v[1:], strict=False))
            for m in (1, 2, 3):
                for i in range(1, n - m):
                    run, p, q = v[i : i + m], v[i - 1], v[i + m]
                    if any(t[j + 1] is None or t[j] is None or t[j + 1] - t[j] > 100 for j in range(i - 1, i + m)):
                        continue
                    if all(r - p > 12 * scale and r - q > 12 * scale for r in run) or all(p - r > 12 * scale and q - r > 12 * scale for r in run):
                        out |= {(take, s[j][0], f) for j in range(i, i + m)}
    return out


def made(seed, n=300):
    rng, rows = random.Random(seed), []
    for take in ("a", "b", None):
        ts, x = 0, 0.5
        i = 0
        while i < n:
            ts += rng.choice([33, 33, 33, 40, 0, 150])
            x += rng.gauss(0, 0.003)
            v = x + rng.choice([0, 0, 0, 0, 0, 0, 0, 0.4, -0.3])
            length = rng.choice([1, 1, 1, 1, 1, 2, 3, 4]) if rng.random() < 0.9 else rng.choice([9, 10, 25])
            for _ in range(length):
                rows.append((take, i, ts if rng.random() > 0.02 else None, rng.choice([v, v, v, v, v, None, math.nan]) if length < 9 else v, rng.choice([0.5 + rng.gauss(0, 0.01), 7.0, math.inf, 0.5, None])))
                i += rng.choice([1, 1, 1, 3])
                ts += 33
    return rows + rows[:40]


@pytest.mark.parametrize(("seed", "width"), [(0, 4), (1, 64), (2, 100_000)])
def test_random(spark, seed, width):
    rows = made(seed)
    df = spark.createDataFrame([(*r, "k", 1.0, "f") for r in rows], SCHEMA).drop("kind", "scale", "field")
    got = implausible_readings(df, ["take"], "i", "ts", BOUNDS, shard_width=width)
    assert {(r["take"], r["i"], r["field"]) for r in got.collect()} == plain(rows)


def test_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert implausible_readings(df, ["take"], "i", "ts", BOUNDS).count() == 0
    rows = [("a", j, j * 33, 0.5 + 0.001 * (j % 3), 0.5, "k", 9.0, "f") for j in range(8)] + [("a", 8, 264, 1.9, 0.5, "k", 9.0, "f"), ("a", 9, 297, 0.5, 0.5, "k", 9.0, "f")]
    got = implausible_readings(spark.createDataFrame(rows, SCHEMA), ["take"], "i", "ts", BOUNDS)
    assert {(r["i"], r["field"], r["kind"]) for r in got.collect()} == {(8, "x", "spike")} | {(j, "y", "frozen") for j in range(10)}


@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_exact_quantiles(spark, limit):
    rng = random.Random(limit)
    groups = {"a": [rng.gauss(0, 1) for _ in range(501)], "b": [1.0] * 100, "c": [rng.choice([0.0, 1e-9, 5.0, 1e9]) for _ in range(400)], None: [3.0, 4.0], "one": [7.5]}
    rows = [(k, v[i : i + 7]) for k, v in groups.items() for i in range(0, len(v), 7)] + [("a", []), ("none", [])]
    df = spark.createDataFrame(rows, "k string, v array<double>")
    got = {r["k"]: r["median"] for r in exact_medians(df, ["k"], "v", limit).collect()}
    assert got == {k: statistics.median(v) for k, v in groups.items()}
    nine = {r["k"]: r["quantile"] for r in exact_quantiles(df, ["k"], "v", 0.9, limit).collect()}
    for k, v in groups.items():
        s, at = sorted(v), 0.9 * (len(v) - 1)
        low = int(at + 1e-9)
        want = s[low] + (s[min(low + 1, len(s) - 1)] - s[low]) * (at - low)
        assert nine[k] == pytest.approx(want, rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("width", [1, 3, 10, 1000])
def test_bounded_reach_equals_a_plain_window(spark, width):
    df = spark.range(120).select(F.when(F.col("id") % 7 < 4, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"), (F.col("id") * 37 % 211).alias("o"), (F.col("id") * 13 % 29).cast("double").alias("v"))

    def f(part, by):
        w = Window.partitionBy(*by).orderBy("o")
        return part.withColumns({"a": F.lag("v", 3).over(w), "b": F.lead("v", 2).over(w), "m": F.max("v").over(w.rowsBetween(-3, 3))})

    got = bounded_reach(df.withColumn("s", F.floor(F.col("o") / width)), ["k"], "s", ["o"], 3, f).drop("s")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, f(df, ["k"]).collect()), key=str)


def test_hampel(spark):
    values = [1.0, 1.1, 0.9, 1.0, 9.0, 1.05, 0.95, 1.0, None, 1.0]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "k string, i int, v double")
    flagged = [r["i"] for r in hampel(df, ["k"], ["i"], "v", 3).filter("outlier").collect()]
    assert flagged == [4]


def test_running_sum(spark):
    df = spark.range(50).select(F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("k"), "id", (F.col("id") % 4).alias("v"), F.floor(F.col("id") / 6).alias("s"))
    got = {r["id"]: r["t"] for r in running_sum(df, ["k"], "s", ["id"], "v", "t").collect()}
    assert got == {i: sum(j % 4 for j in range(i + 1) if (j % 3 > 0) == (i % 3 > 0)) for i in range(50)}


def test_the_wide_filter_runs_over_every_series(spark):
    from phasemill.plans import quality

    sf = "/root/testdata/sf0.001"
    every = quality.p6_hampel_series(spark, sf).collect()
    assert {(r["keypoint_id"], r["field"]) for r in every} >= {(k, f) for k in (0, 4, 8, 9) for f in "xy"}
    wrist = {(r["take"], r["frame_idx"], r["value"]) for r in every if r["keypoint_id"] == 0 and r["field"] == "x"}
    assert wrist == {(r["take"], r["frame_idx"], r["x"]) for r in quality.p6_hampel(spark, sf).collect()}
