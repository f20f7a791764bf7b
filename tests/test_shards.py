"""Steps that carry state along an entity give the same wherever it is cut into shards."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from phasemill.operators import metrics as E
from phasemill.operators import relational as R
from phasemill.operators import segmentation as G
from phasemill.operators.reach import neighbours, running_max
from phasemill.schemas import LABELS, TUNED


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_running_max_and_neighbours(spark, width):
    rng = random.Random(width)
    rows = [(rng.choice("aab"), i, rng.choice([None, rng.random()])) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, i long, v double").withColumn("s", F.floor(F.col("i") / width))
    got = {r["i"]: r for r in neighbours(running_max(df, ["k"], "s", ["i"], "v", "most"), ["k"], F.col("s"), ["i"], {"before": ("i", -1), "after": ("i", 2)}).collect()}
    for k in "ab":
        own = [r for r in rows if r[0] == k]
        for n, (_, i, _) in enumerate(own):
            assert got[i]["most"] == max((v for _, _, v in own[:n] if v is not None), default=None)
            assert got[i]["before"] == (own[n - 1][1] if n else None) and got[i]["after"] == (own[n + 2][1] if n + 2 < len(own) else None)


@pytest.mark.parametrize("width", [3, 50, 10_000])
def test_positions(spark, width):
    rows = [("a", i * 7 % 101, None) for i in range(90)] + [("b", i, None) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, o long, x string")
    plain, cut = R.positioned(df, ["k"], ["o"]), R.positioned(df, ["k"], ["o"], shard=F.floor(F.col("o") / width))
    assert sorted(map(tuple, plain.drop("x").collect())) == sorted(map(tuple, cut.drop("x").collect())) and plain.dtypes == cut.dtypes


@pytest.mark.parametrize("width", [0.5, 3.0, 600.0])
def test_asof_label(spark, width):
    rng, seg, t = random.Random(3), [], 0.0
    for i in range(40):
        t += rng.choice([0.1, 0.5, 4.0])
        seg.append(("a", f"L{i}", t, t + rng.choice([0.05, 0.2, 9.0]), i == 39))
    points = [("a", rng.uniform(0, t + 3)) for _ in range(150)] + [("b", 1.0)]
    s, p = spark.createDataFrame(seg, "take string, label string, start_s double, end_s double, is_last boolean"), spark.createDataFrame(points, "take string, t double")
    got = {r["t"]: r["label_at"] for r in R.asof_label(p, s, ["take"], "t", width).filter("take = 'a'").collect()}
    for _, x in points[:-1]:
        last = max((r for r in seg if r[2] <= x), key=lambda r: r[2:4], default=None)
        assert got[x] == (last[1] if last and x < last[3] else None)
    assert R.asof_label(p, s, ["take"], "t", width).count() == len(points)


def test_points_in_overlapping_intervals(spark):
    rng = random.Random(1)
    spans = [("a", s, s + rng.choice([0.5, 3, 40])) for s in (rng.uniform(0, 100) for _ in range(25))] + [("b", 5.0, 4.0)]
    points = [(rng.choice("abc"), rng.uniform(-5, 120)) for _ in range(300)]
    got = R.in_intervals(spark.createDataFrame(points, "take string, t double"), spark.createDataFrame(spans, "take string, start_s double, end_s double"), ["take"], "t", "inside")
    assert sorted(map(tuple, got.collect())) == sorted((k, x, any(a == k and s - 1e-9 <= x < e - 1e-9 for a, s, e in spans)) for k, x in points)


@pytest.mark.parametrize("width", [1, 5, 256])
def test_rules_by_composed_maps(spark, width):
    rng = np.random.default_rng(width)
    rows = []
    for take in ("a", "b"):
        for i in range(120):
            v = [float(x) for x in (rng.uniform(0, 2.5), rng.uniform(0.1, 1.0), rng.normal(0, 0.1), rng.uniform(0.6, 1.2), rng.normal(0, 0.3))]
            if rng.random() < 0.05:
                v[int(rng.integers(5))] = None
            rows.append((take, i + (take == "b") * 7, *v))
    df = spark.createDataFrame(rows, "take string, segment long, mean_speed double, p_mean double, dp double, mean_aperture double, d_ap double")
    got = {(r["take"], r["segment"]): r["label"] for r in G.label_segments(df, TUNED, width).collect()}
    for take in ("a", "b"):
        before = None
        for _, i, *v in sorted(r for r in rows if r[0] == take):
            before = G.rule_label(*[float("nan") if x is None else x for x in v], before, TUNED)
            assert got[take, i] == before
    assert set(got.values()) == set(LABELS)


def test_chance_draws_do_not_depend_on_tasks():
    rng = np.random.default_rng(5)
    true = np.sort(rng.uniform(0, 60, 40))
    whole = E.chance_hits(35, true, 0.0, 60.0, 0.1)
    parts = [E.chance_hits(35, true, 0.0, 60.0, 0.1, i, 7) for i in range(7)]
    assert whole == (sum(a for a, _ in parts), sum(b for _, b in parts))
    drawn = np.sort(np.random.default_rng(0).uniform(0.0, 60.0, (1000, 35)), axis=1)
    assert whole[1] == sum(E.match_count_error(p, true, 0.1)[0] for p in drawn[:30]) + E.greedy_counts(drawn[30:], true, 0.1).sum()
    assert E.chance_hits(0, true, 0.0, 60.0, 0.1) == (0, 0) and E.chance_hits(3, np.array([]), 0.0, 60.0, 0.1) == (0, 0)


def test_many_chance_boundaries():
    true = np.sort(np.random.default_rng(1).uniform(0, 1e4, 100_000))
    even, hits = E.chance_hits(100_000, true, 0.0, 1e4, 0.1, 0, 200)  # a task's five sets
    assert 50_000 < even <= 100_000 and 5 * 50_000 < hits <= 500_000


def test_no_predictions_recall_nothing(spark):
    seg = "take string, cycle int, label string, start_s double, end_s double"
    truth = spark.createDataFrame([("a", 1, "REST", 0.0, 1.0)], seg)
    got = E.boundary_metrics(spark.createDataFrame([], seg), truth).filter("scope = 'all'").first()
    assert (got["n_true"], got["n_pred"], got["chance_uniform_recall"], got["chance_random_recall"]) == (0, 0, 0.0, 0.0) and got["chance_uniform_precision"] is None
