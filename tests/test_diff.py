"""Chunked differences against a comparison key by key."""

import math
import random

import pytest
from pyspark.sql import functions as F

from phasemill.operators.diff import copy_differences

SCHEMA = "take string, idx long, name string, x double, n long"


def plain(a, b):
    norm = lambda r: (r[2].strip(" ") if r[2] is not None else None, None if r[3] is None or math.isnan(r[3]) else r[3], r[4])
    left, right = {r[:2]: norm(r) for r in a}, {r[:2]: norm(r) for r in b}
    out = [(*k, "*", "missing_in_copy") for k in left.keys() - right.keys()] + [(*k, "*", "missing_in_source") for k in right.keys() - left.keys()]
    for k in left.keys() & right.keys():
        for i, f in enumerate(("name", "x", "n")):
            p, q = left[k][i], right[k][i]
            same = p == q if f != "x" or p is None or q is None else p == q or abs(p - q) <= 1e-6
            if not same:
                out.append((*k, f, "differs"))
    return sorted(out, key=str)


def run(spark, a, b, **kw):
    s = spark.createDataFrame(a, SCHEMA)
    c = spark.createDataFrame([(*r, "2020") for r in b], SCHEMA + ", published_at string").select("published_at", "n", "x", "name", "idx", "take")
    got = copy_differences(s, c, ["take", "idx"], F.struct("take", F.floor(F.col("idx") / 16)), ["published_at"], **kw)
    return sorted([tuple(r) for r in got.collect()], key=str)


@pytest.mark.parametrize("shards", [1, 7])
def test_random(spark, shards):
    rng = random.Random(shards)
    a = [(rng.choice(["hot", "hot", "b", None]), i, rng.choice(["q", "é", " r", None, ""]), rng.choice([1.0, math.nan, None, i / 7, math.inf]), rng.choice([1, None])) for i in range(400)]
    b = []
    for r in a:
        roll = rng.random()
        if roll < 0.04:
            continue
        x = r[3]
        if roll < 0.08 and x is not None:
            x += 1e-3
        elif roll < 0.5 and x is not None:
            x += rng.choice([3e-7, -2e-9])
        elif roll < 0.55:
            x = None
        b.append((r[0], r[1], rng.choice([r[2], r[2] and r[2] + "  "]) if rng.random() < 0.9 else "other", x, r[4]))
    b += [("new", 1, "q", 1.0, 1), (None, 9_999, None, None, None)]
    assert run(spark, a + a[:50], b + b[:50], shards=shards, mean_chunk_bits=2) == plain(a, b)


def test_empty_sides(spark):
    a = [("a", 1, "q", 1.0, 1)]
    assert run(spark, a, []) == [("a", 1, "*", "missing_in_copy")]
    assert run(spark, [], a) == [("a", 1, "*", "missing_in_source")]
    assert run(spark, [], []) == []


def test_equal_copies_join_no_row(spark):
    a = [("a", i, "q" * 1000, i / 3, i) for i in range(200)]
    assert run(spark, a, a[::-1]) == []


def test_several_rows_of_one_key(spark):
    a, b, c, d = ("k", 1, "a", 1.0, 1), ("k", 1, "b", 1.0, 1), ("k", 1, "c", 1.0, 2), ("k", 1, "d", 1.0, 2)
    other = [("k", i, "q", 0.5, i) for i in range(2, 60)]
    for shards in (None, 1):
        assert run(spark, [a, b, *other], [b, *other], shards=shards) == [("k", 1, "*", "missing_in_copy")]
        assert run(spark, [b, *other], [a, b, *other], shards=shards) == [("k", 1, "*", "missing_in_source")]
        assert run(spark, [a, b, *other], [b, a, *other], shards=shards) == []
        assert run(spark, [a, b, *other], [b, c, *other], shards=shards) == [("k", 1, "n", "differs"), ("k", 1, "name", "differs")]
        assert run(spark, [a, b], [c, d, *other[:1]], shards=shards) == [("k", 1, "*", "missing_in_copy"), ("k", 1, "*", "missing_in_source"), ("k", 2, "*", "missing_in_source")]
