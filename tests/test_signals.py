"""Signals of synthetic motions with known truth, and the stages against NumPy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from phasemill.operators import signals as S
from phasemill.operators.relational import absorb_short_runs, dropout_report, dropout_runs, fill_short_gaps, islands, strictly_increasing


def motion(xs, ts, aperture=1.0, lost=(), take="m", ys=None):
    """Raw rows of a hand of 150 px (0.09 m) whose wrist is at the given pixels."""
    rows = []
    for i, (x, t) in enumerate(zip(map(float, xs), ts, strict=True)):
        y = 500.0 if ys is None else float(ys[i])
        place = {0: (x, y, 0.0), 9: (x + 150, y, 0.09), 4: (x, y, 0.0), 8: (x, y, 0.09 * aperture)}
        for k, (px, py, w) in place.items():
            seen = i not in lost
            rows.append((take, i, round(t * 1000), k, px / 1920 if seen else None, py / 1080 if seen else None, 0.0, w if seen else None, 0.0 if seen else None, 0.0 if seen else None, seen, "Right" if seen else None, 0.9 if seen else None))
    return rows


SCHEMA = "take string, frame_idx int, timestamp_ms long, keypoint_id int, x double, y double, z double, world_x double, world_y double, world_z double, detected boolean, handedness string, handedness_score double"


def derive(spark, rows, window=7):
    raw = spark.createDataFrame(rows + rows[:8], SCHEMA)
    out = S.derive_signals(S.build_frames(raw), S.SignalParams(smooth_win=window)).orderBy("sample_idx").toPandas()
    return out


def test_constant_motion(spark):
    ts = np.arange(120) / 30
    out = derive(spark, motion(400 + 300 * ts, ts, aperture=0.7))
    assert np.allclose(out["speed"], 300 / 150, rtol=0.02)
    assert np.allclose(out["aperture"], 0.7) and np.allclose(out["aperture_slope"], 0, atol=1e-6)
    assert not out["missing"].any() and len(out) == 120


def test_gaps(spark):
    ts = np.arange(90) / 30
    out = derive(spark, motion(400 + 300 * ts, ts, lost={20, 21, 40, 41, 42}))
    assert not out["missing"][20:22].any() and out["interpolated"][20:22].all()
    assert out["missing"][40:43].all() and out["speed"][40:43].isna().all()
    assert not out["interpolated"][40:43].any()


def test_out_and_back(spark):
    ts = np.arange(0, 10, 1 / 30)
    out = derive(spark, motion(400 + 800 * np.sin(np.pi * ts / 10) ** 2, ts))
    assert out["p"][150] > 0.8 and abs(out["p"][0]) < 0.1
    assert out["dp"][75] > 0 > out["dp"][225]


def test_no_motion_and_short_takes(spark):
    ts = np.arange(60) / 30
    still = derive(spark, motion([400.0] * 60, ts))
    assert (still["p"] == 0).all() and (still["speed"].abs() < 1e-6).all()
    assert len(derive(spark, motion([400.0, 401.0], [0, 0.034]))) == 2
    assert derive(spark, motion([400.0] * 30, np.arange(30) / 30, lost=set(range(30)))).shape[0] == 30


def _reference(frames, window=5):
    """The same signals in one pass of NumPy over a take."""
    t, x, y, ap, hand = (np.array(v, float) for v in frames)

    def fill(v):
        v = v.copy()
        bad = np.isnan(v)
        i = 0
        while i < len(v):
            if not bad[i]:
                i += 1
                continue
            j = i
            while j < len(v) and bad[j]:
                j += 1
            if i > 0 and j < len(v) and j - i <= 2:
                v[i:j] = v[i - 1] + (v[j] - v[i - 1]) * (t[i:j] - t[i - 1]) / (t[j] - t[i - 1])
            i = j
        return v

    n = math.floor((t[-1] - t[0] + 1e-9) * 30) + 1
    g = t[0] + np.arange(n) / 30

    def grid(v):
        ok = ~np.isnan(v)
        tt, vv = t[ok], v[ok]
        k = np.searchsorted(tt, g, side="right") - 1
        out = np.full(n, np.nan)
        for i in range(n):
            if k[i] >= 0 and tt[k[i]] == g[i]:
                out[i] = vv[k[i]]
            elif 0 <= k[i] < len(tt) - 1 and tt[k[i] + 1] - tt[k[i]] <= 3.5 / 30:
                out[i] = vv[k[i]] + (vv[k[i] + 1] - vv[k[i]]) * (g[i] - tt[k[i]]) / (tt[k[i] + 1] - tt[k[i]])
        return out

    cols = [grid(fill(v)) for v in (x, y, ap)]
    missing = np.isnan(cols).any(0)
    full = [np.interp(np.arange(n), np.flatnonzero(~np.isnan(v)), v[~np.isnan(v)]) for v in cols]

    def sg(v, d):
        w = S.savgol_weights(window, 2, d, 1 / 30)
        h = window // 2
        return np.array([w[i] @ v[:window] if i < h else w[window - n + i] @ v[n - window :] if i >= n - h else w[h] @ v[i - h : i + h + 1] for i in range(n)])

    xs, ys, vx, vy = sg(full[0], 0), sg(full[1], 0), sg(full[0], 1), sg(full[1], 1)
    size = np.nanmedian(hand)
    ok = np.flatnonzero(~missing)
    home = np.array([np.median(xs[ok[:15]]), np.median(ys[ok[:15]])])
    dist = np.hypot(xs - home[0], ys - home[1])
    far = ~missing & (dist >= np.quantile(dist[ok], 0.9) - 1e-12)
    u = np.array([xs[far].mean(), ys[far].mean()]) - home
    length = np.hypot(*u)
    u = u / length
    out = {"speed": np.hypot(vx, vy) / size, "aperture": sg(full[2], 0), "p": ((xs - home[0]) * u[0] + (ys - home[1]) * u[1]) / length, "dq": (-vx * u[1] + vy * u[0]) / size, "ydev": -(ys - home[1]) / size}
    return missing, {k: np.where(missing, np.nan, v) for k, v in out.items()}


def test_against_numpy_on_an_irregular_take(spark):
    rng = np.random.default_rng(5)
    ts = np.cumsum(np.round(rng.uniform(0.02, 0.045, 400), 3))
    ts[200:] += 1.0
    xs, ys = 500 + np.cumsum(rng.normal(0, 4, 400)), 400 + np.cumsum(rng.normal(0, 3, 400))
    lost = set(rng.choice(400, 60, replace=False).tolist()) | set(range(100, 112))
    rows = motion(xs, ts, 0.8, lost, ys=ys)
    out = derive(spark, rows, 5)
    seen = lambda v: np.array([np.nan if i in lost else x for i, x in enumerate(v)])
    t = np.array([round(x * 1000) / 1000.0 for x in ts])
    missing, want = _reference((t, seen(xs), seen(ys), seen([0.8] * 400), seen([150.0] * 400)))
    assert (out["missing"].to_numpy() == missing).all()
    for k, v in want.items():
        assert np.allclose(out[k].to_numpy(float), v, atol=1e-8, equal_nan=True), k


def test_savgol_weights():
    assert np.allclose(S.savgol_weights(5)[2] * 35, [-3, 12, 17, 12, -3])
    assert np.allclose(S.savgol_weights(7)[0] * 42, [32, 15, 3, -4, -6, -3, 5])
    assert np.allclose(S.savgol_weights(5, 2, 1)[0] * 70, [-54, 13, 40, 27, -26])


def test_features_have_no_null(spark):
    ts = np.arange(200) / 30
    raw = spark.createDataFrame(motion(400 + 300 * np.sin(ts), ts, lost=set(range(50, 70))), SCHEMA)
    feats = S.build_features(S.derive_signals(S.build_frames(raw))).toPandas().sort_values("sample_idx")
    assert len(S.feature_names()) == 61 and not feats.isna().any().any() and 19 <= feats["missing"].sum() <= 21
    v = feats["speed"].to_numpy()
    assert np.allclose(feats["speed_m45"].to_numpy(), [v[max(0, i - 45) : i + 46].mean() for i in range(len(v))])
    for n in (3, 8, 20):
        assert np.allclose(feats[f"speed_m{n}"].to_numpy(), [v[max(0, i - n) : i + n + 1].mean() for i in range(len(v))], atol=1e-11)
    assert np.allclose(feats["speed_trend45"].to_numpy(), [v[i : i + 45].mean() - v[max(0, i - 44) : i + 1].mean() for i in range(len(v))], atol=1e-11)
    assert np.allclose(feats["speed_trend5"].to_numpy(), [v[i : i + 5].mean() - v[max(0, i - 4) : i + 1].mean() for i in range(len(v))])


@pytest.mark.parametrize("width", [3, 1000])
def test_short_gaps(spark, width):
    rng = random.Random(width)
    v = [None if rng.random() < 0.4 else float(i * i) for i in range(100)]
    df = spark.createDataFrame([("a", i, i * 1.0, x) for i, x in enumerate(v)], "k string, i int, t double, v double")
    got = [r["v_filled"] for r in fill_short_gaps(df, ["k"], "i", "t", ["v"], F.floor(F.col("i") / width)).orderBy("i").collect()]
    want, i = list(v), 0
    while i < len(v):
        j = i
        while j < len(v) and v[j] is None:
            j += 1
        if 0 < i < j < len(v) and j - i <= 2:
            for k in range(i, j):
                want[k] = v[i - 1] + (v[j] - v[i - 1]) * (k - i + 1) / (j - i + 1)
        i = max(j, i + 1)
    assert [x is None for x in got] == [x is None for x in want]
    assert all(a is None or abs(a - b) < 1e-9 for a, b in zip(got, want, strict=True))


@pytest.mark.parametrize("width", [2, 7, 1000])
def test_ordered_rows_in_shards(spark, width):
    rng = random.Random(width)
    rows = [("a" if rng.random() < 0.7 else None, i, rng.choice([None, "p", "p", "q"]), rng.randint(0, 40)) for i in range(150)]
    df = spark.createDataFrame(rows, "k string, i int, lab string, ts long")
    shard = F.floor(F.col("i") / width)
    got = sorted([tuple(r) for r in islands(df, ["k"], "i", "lab", shard).select("k", "first", "label", "n", "next_first").collect()], key=str)
    want = []
    for k in ("a", None):
        own = [r for r in rows if r[0] == k]
        runs = []
        for r in own:
            if runs and runs[-1][1] == r[2]:
                runs[-1][2] += 1
            else:
                runs.append([r[1], r[2], 1])
        want += [(k, a, b, c, runs[j + 1][0] if j + 1 < len(runs) else None) for j, (a, b, c) in enumerate(runs)]
    assert got == sorted(want, key=str)
    strict = {(r["k"], r["i"]): r["s"] for r in strictly_increasing(df.filter("k IS NOT NULL"), ["k"], "i", "ts", "s", shard).collect()}
    last = None
    for r in [r for r in rows if r[0] == "a"]:
        last = r[3] if last is None else max(r[3], last + 1)
        assert strict["a", r[1]] == last
    lost = [r["n"] for r in dropout_runs(df, ["k"], "i", F.col("lab").isNull(), width).filter("k = 'a'").orderBy("first").collect()]
    idx, want_runs = [r[1] for r in rows if r[0] == "a" and r[2] is None], []
    for j, i in enumerate(idx):
        if j and idx[j - 1] == i - 1:
            want_runs[-1] += 1
        else:
            want_runs.append(1)
    assert lost == want_runs
    assert dropout_report(dropout_runs(df, ["k"], "i", F.col("lab").isNull(), width), ["k"]).count() == 2


def test_absorb(spark):
    runs = [("a", 0, "x", 2), ("a", 1, "y", 9), ("a", 2, "z", 3), ("a", 3, "x", 1), ("a", 4, "w", 6)]
    got = absorb_short_runs(spark.createDataFrame(runs, "k string, i int, lab string, n int"), ["k"], "i", "lab", "n", 6).orderBy("i").collect()
    assert [r["absorbed"] for r in got] == ["x", "y", "y", "y", "w"]
