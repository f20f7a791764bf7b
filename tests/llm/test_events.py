"""Collapsed runs and nearest records against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from phasemill.llm.nearest import nearest_in_time
from phasemill.llm.runs import agglomerate, bigram_dice, collapse_runs

SCHEMA = "take string, label string, s long, e long, f long, shard string, k0 int, start int"


def plain(rows, gap):
    out = []
    best = {}
    for t, lab, s, e, f in rows:
        if lab is not None and s is not None and e is not None:
            best[t, s, e, lab] = max(best.get((t, s, e, lab), 0), f or 0)
    for take in {k[0] for k in best}:
        run = None
        for (_, s, e, lab), f in sorted(((k, v) for k, v in best.items() if k[0] == take), key=lambda x: x[0][1:]):
            if run and run[1] == lab and s <= run[3] + gap:
                run[3], run[4], run[5] = max(run[3], e), run[4] + 1, run[5] + f
            else:
                run = [take, lab, s, e, 1, f]
                out.append(run)
    return sorted([(r[0], r[1], r[2], r[4], r[3] - r[2], r[5]) for r in out], key=str)


def collapse(spark, rows, width, gap=250):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = collapse_runs(df, {"take": F.col("take")}, F.col("label"), F.col("s"), F.col("e"), F.col("f"), 1.0, gap, width)
    return sorted([tuple(r) for r in got.collect()], key=str)


def made(seed, n=250):
    rng, rows, t = random.Random(seed), [], 0
    for _ in range(n):
        t += rng.choice([0, 20, 100, 240, 251, 400, 3000])
        rows.append((rng.choice(["hot", "hot", "b", None]), rng.choice(["A", "A", "A", "B", None, ""]), t if rng.random() > 0.02 else None, t + rng.choice([0, 30, 200, 900, 9000, -50]), rng.choice([None, 3, 5])))
    return rows + rows[:30]


@pytest.mark.parametrize(("seed", "width"), [(0, 150), (1, 1000), (2, 7000), (3, 600_000)])
def test_runs(spark, seed, width):
    rows = made(seed)
    assert collapse(spark, rows, width) == plain(rows, 250)


def test_a_run_over_many_shards_and_what_it_covers(spark):
    rows = [("a", "A", i * 100, i * 100 + 90, 1) for i in range(200)] + [("b", "A", 0, 50_000, 1), ("b", "A", 10, 20, 1), ("b", "A", 40_000, 40_001, 1), ("b", "B", 40_500, 40_600, 1), ("b", "A", 40_700, 40_800, 1)]
    assert collapse(spark, rows, 1000) == plain(rows, 250)


def test_no_rows(spark):
    assert collapse(spark, [], 1000) == [] and collapse(spark, [("a", None, 1, 2, 3)], 1000) == []


def test_near_identical_labels(spark):
    rows = [("a", "GRASPING", 0, 100, 1), ("a", "GRASPIN", 100, 200, 1), ("a", "HOLD", 200, 300, 1)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = collapse_runs(df, {"take": F.col("take")}, F.col("label"), F.col("s"), F.col("e"), F.col("f"), 0.7, 250).orderBy("start")
    assert [(r["label"], r["n_events"]) for r in got.collect()] == [("GRASPING", 2), ("HOLD", 1)]
    assert bigram_dice("a", "a") == 1.0 and bigram_dice("ab", "cd") == 0.0 and bigram_dice("", "x") == 0.0


def test_most_similar_neighbours_first():
    label = ["abcd", "abce", "abcf", "xyz"]
    head = agglomerate(np.zeros(4, int), label, np.array([0, 10, 20, 30]), np.array([9, 19, 29, 39]), 0.6, 5)
    assert head.tolist() == [0, 0, 0, 3]


@pytest.mark.parametrize("width", [150, 1000, 600_000])
def test_near_identical_runs_do_not_depend_on_shards(spark, width):
    rng, rows, t = random.Random(5), [], 0
    for _ in range(200):
        t += rng.choice([0, 20, 100, 240, 251, 400])
        rows.append((rng.choice(["hot", "b"]), rng.choice(["GRASP", "GRASPS", "GRASPING", "HOLD", "HOLDS"]), t, t + rng.choice([30, 200, 900, 9000]), 1))
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = collapse_runs(df, {"take": F.col("take")}, F.col("label"), F.col("s"), F.col("e"), F.col("f"), 0.6, 250, width)
    want = []
    for take in ("hot", "b"):
        run = None
        for s, e, lab in sorted({(s, e, lab) for k, lab, s, e, _ in rows if k == take}):
            if run and bigram_dice(run[5], lab) >= 0.6 and s <= run[3] + 250:
                run[3], run[4], run[5] = max(run[3], e), run[4] + 1, lab
            else:
                run = [take, lab, s, e, 1, lab]
                want.append(run)
    assert sorted((r["take"], r["label"], r["start"], r["n_events"], r["duration"]) for r in got.collect()) == sorted((r[0], r[1], r[2], r[4], r[3] - r[2]) for r in want)


def nearest(left, right, tol):
    out = set()
    for t, x, c in {r for r in left if r[0] is not None and r[1] is not None}:
        cand = [(abs(y - x), y, v) for k, y, v in right if k == t and y is not None and abs(y - x) <= tol]
        if cand:
            d, y, _ = min(cand, key=lambda z: z[:2])
            out.add((t, c, x, y, min((v for k, z, v in right if k == t and z == y and v is not None), default=None)))
    return out


@pytest.mark.parametrize(("seed", "width"), [(0, 50), (1, 333), (2, 120_000)])
def test_nearest(spark, seed, width):
    rng = random.Random(seed)
    take = lambda: rng.choice(["hot", "hot", "b", "only", None])
    left = [(take(), rng.choice([rng.randint(-200, 3000), rng.randint(0, 3000), None]), rng.choice(["m", None])) for _ in range(200)]
    right = [(rng.choice(["hot", "hot", "b", "other", None]), rng.choice([rng.randint(-200, 3000), rng.randint(0, 60) * 50, None]), rng.randint(0, 500)) for _ in range(200)]
    a = spark.createDataFrame(left + left[:20], "take string, s long, c string").withColumn("shard", F.lit(1)).withColumn("i", F.lit(9))
    b = spark.createDataFrame(right + right[:20], "take string, ts long, i int").withColumn("c", F.lit("clash"))
    got = nearest_in_time(a, b, ["take"], F.col("s"), F.col("ts"), 40, ["c"], "i", width)
    assert {tuple(r) for r in got.select("take", "c", "left_time", "right_time", "right_value").collect()} == nearest(left, right, 40)
    assert got.count() == len(nearest(left, right, 40))


def test_nearest_of_nothing(spark):
    a = spark.createDataFrame([("a", 1, "m")], "take string, s long, c string")
    b = spark.createDataFrame([], "take string, ts long, i int")
    assert nearest_in_time(a, b, ["take"], F.col("s"), F.col("ts"), 40, ["c"], "i").count() == 0
    assert nearest_in_time(a.limit(0), b, ["take"], F.col("s"), F.col("ts"), 40, ["c"], "i").count() == 0
    with pytest.raises(ValueError, match="shard_width"):
        nearest_in_time(a, b, ["take"], F.col("s"), F.col("ts"), 40, ["c"], "i", 40)
