"""The regular grid against a plain loop over readings."""

import math
import random

import pytest
from pyspark.sql import functions as F

from phasemill.operators.grid import COUNTER, GAUGE, reading_spans, regular_grid

SCHEMA = "take string, t long, v double, slot string, how string, shard int"


def plain(rows, cell, kind, fill, mark):
    cells = {}
    for take in {r[0] for r in rows}:
        read = sorted({(t, v) for k, t, v in rows if k == take and t is not None and v is not None and not math.isnan(v)})
        for t, v in read:
            c = cells.setdefault((take, t // cell), {"how": "present", "v": [], "inc": None})
            c["v"].append(v)
        for (t0, v0), (t1, v1) in zip(read, read[1:], strict=False):
            reset = kind == COUNTER and v1 < v0
            inc, base = (v1, 0.0) if reset else (v1 - v0, v0)
            k0, k1 = t0 // cell, t1 // cell
            absent = max(0, k1 - k0 - 1)
            for k in range(k0, k1 + 1):
                inner = k0 < k < k1
                if inner and absent > mark:
                    continue
                c = cells.setdefault((take, k), {"how": "filled" if absent <= fill else "marked", "v": [], "inc": None, "value": base + inc * (k * cell + cell / 2 - t0) / max(t1 - t0, 1) if absent <= fill else None})
                if absent <= fill:
                    part = inc if t0 == t1 else inc * (min(t1, (k + 1) * cell) - max(t0, k * cell)) / (t1 - t0)
                    c["inc"] = (c["inc"] or 0.0) + part
    return {k: (c["how"], len(c["v"]), c["inc"], sum(c["v"]) / len(c["v"]) if c["v"] else c.get("value")) for k, c in cells.items()}


@pytest.mark.parametrize(("kind", "seed"), [(COUNTER, 0), (GAUGE, 1), (COUNTER, 2)])
def test_random(spark, kind, seed):
    rng = random.Random(seed)
    rows = []
    for take in ("a", "b", None):
        t, v = rng.randint(-100, 100), 0.0
        for _ in range(150):
            t += rng.choice([0, 3, 17, 33, 60, 130, 700, 2000])
            v = rng.choice([v + rng.randint(0, 9), v + 1.5, rng.randint(0, 3)])
            rows.append((take, t, float(v)))
    rows += [("a", None, 1.0), ("a", 5, None), ("a", 6, math.nan), ("c", 10, 1.0)] + rows[:30]
    df = spark.createDataFrame([(*r, "s", "h", 1) for r in rows], SCHEMA)
    got = regular_grid(df.withColumnRenamed("slot", "x"), ["take"], "t", "v", 50, kind, 2, 20, shard_width=400)
    out = {(r["take"], r["slot"]): (r["how"], r["n_readings"], r["increment"], r["value"]) for r in got.collect()}
    want = plain(rows, 50, kind, 2, 20)
    assert out.keys() == want.keys()
    for k, w in want.items():
        assert out[k][:2] == w[:2], k
        for a, b in zip(out[k][2:], w[2:], strict=True):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9), (k, out[k], w)


def test_resets_are_counted(spark):
    df = spark.createDataFrame([("a", 0, 5.0), ("a", 40, 9.0), ("a", 80, 2.0)], "take string, t long, v double")
    spans = reading_spans(df, ["take"], "t", "v").orderBy("t0").collect()
    assert [(s["increment"], s["reset"]) for s in spans] == [(4.0, False), (2.0, True), (None, False)]
    assert regular_grid(df, ["take"], "t", "v", 50).agg(F.sum("n_resets")).first()[0] == 1


def test_empty(spark):
    assert regular_grid(spark.createDataFrame([], "take string, t long, v double"), ["take"], "t", "v", 50).count() == 0
