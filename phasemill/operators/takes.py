"""Signals and features of takes that fit a task, in one Arrow pass over sorted rows.

The same values as the expressions in :mod:`phasemill.operators.signals`, which stay for takes of more
than ``LIMIT`` frames or samples, but read once instead of once per window and join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasemill.schemas import GRID_HZ, MAX_GAP_FRAMES, SignalParams

LIMIT = 1 << 20  # a task holds about 300 bytes a sample of a take
PIECE = 1 << 15
Columns = dict[str, np.ndarray]


def parted(df: DataFrame, sizes: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the takes that fit a task, and of those larger than ``limit``, None if there are none."""
    large = sizes.filter(F.col("size") > limit).select(F.col("take").alias("__large"))
    if large.isEmpty():
        return df, None
    same = F.col("take").eqNullSafe(F.col("__large"))
    return df.join(large, same, "left_anti"), df.join(large, same, "left_semi")


def each_take(batches: Iterable[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple[str | None, Columns]]:
    """The takes of rows sorted by ``take``, each whole: NULLs are NaN."""
    take, held = None, []

    def whole() -> tuple[str | None, Columns]:
        return take, {n: np.concatenate([h[i] for h in held]) if len(held) > 1 else held[0][i] for i, n in enumerate(names)}

    for b in batches:
        if not b.num_rows:
            continue
        runs = pc.run_end_encode(b.column("take"))
        values = [b.column(n).to_numpy(zero_copy_only=False) for n in names]
        start = 0
        for end, who in zip(runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=True):
            if held and who != take:
                yield whole()
                held = []
            take = who
            held.append([v[start:end] for v in values])
            start = end
    if held:
        yield whole()


def by_whole_take(df: DataFrame, order: str, names: Sequence[str], kernel: Callable[[str | None, Columns], Iterator[tuple[str | None, Columns]]], schema: str) -> DataFrame:
    """What ``kernel`` yields, pieces of rows of one ``take`` each, for every take of ``df`` in order of ``order``; NaN becomes NULL. Small pieces leave together."""
    rows = df.select("take", *dict.fromkeys([order, *names])).repartition("take").sortWithinPartitions("take", order)
    columns = [f.split()[0] for f in schema.split(", ")]

    def batch(pieces: list[tuple[str | None, Columns]]) -> pa.RecordBatch:
        n = [len(next(iter(p.values()))) for _, p in pieces]
        who = pa.DictionaryArray.from_arrays(np.repeat(np.arange(len(n), dtype=np.int32), n), pa.array([t for t, _ in pieces], pa.string())).cast(pa.string())
        arrays = [np.concatenate([p[c] for _, p in pieces]) for c in columns[1:]]
        return pa.RecordBatch.from_arrays([who, *[pa.array(a, from_pandas=True) for a in arrays]], names=columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, n = [], 0
        for take, values in each_take(batches, names):
            for piece in kernel(take, values):
                pieces.append(piece)
                n += len(next(iter(piece[1].values())))
                if n >= PIECE:
                    yield batch(pieces)
                    pieces, n = [], 0
        if n:
            yield batch(pieces)

    return rows.mapInArrow(run, schema)


def _gaps_filled(v: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`relational.fill_short_gaps` of one channel: values, and where one was filled."""
    if not np.isnan(v).any():
        return v, np.zeros(len(v), bool)
    near = lambda a, k: np.concatenate([np.full(min(k, len(a)), np.nan), a[:-k]]) if k > 0 else np.concatenate([a[-k:], np.full(min(-k, len(a)), np.nan)])
    vs, ts = [near(v, k) for k in (2, 1, -1, -2)], [near(t, k) for k in (2, 1, -1, -2)]

    def line(a: int, b: int) -> np.ndarray:
        step = ts[b] - ts[a]
        return vs[a] + (vs[b] - vs[a]) * (t - ts[a]) / np.where(step == 0, np.nan, step)

    null = [np.isnan(x) for x in vs]
    guess = np.where(~null[1] & ~null[2], line(1, 2), np.where(null[1] & ~null[0] & ~null[2], line(0, 2), np.where(null[2] & ~null[1] & ~null[3], line(1, 3), np.nan)))
    was = np.isnan(v) & ~np.isnan(guess)
    return np.where(was, guess, v), was


def _least_at(t: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Times in order, each once, with the least of their values."""
    order = np.lexsort((v, t))
    t, v = t[order], v[order]
    first = np.ones(len(t), bool)
    first[1:] = t[1:] != t[:-1]
    return t[first], v[first]


def _at_points(t: np.ndarray, v: np.ndarray, g: np.ndarray, max_gap: float) -> np.ndarray:
    """:func:`signals.resample` of one channel."""
    seen = ~np.isnan(v)
    t, v = _least_at(t[seen], v[seen])
    if not len(t):
        return np.full(len(g), np.nan)
    k = np.searchsorted(t, g, "right") - 1
    a, b = np.maximum(k, 0), np.minimum(k + 1, len(t) - 1)
    step = t[b] - t[a]
    line = v[a] + (v[b] - v[a]) * (g - t[a]) / np.where(step > 0, step, np.nan)
    return np.where((k >= 0) & (g == t[a]), v[a], np.where((k >= 0) & (k + 1 < len(t)) & (step <= max_gap), line, np.nan))


def full(v: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """:func:`signals.filled_by_index` of one channel."""
    seen = ~np.isnan(v)
    if seen.all() or not seen.any():
        return v
    at = np.arange(len(v)) if at is None else at
    return np.where(seen, v, np.interp(at, at[seen], v[seen]))


def smoothed(v: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """:func:`signals.savgol` of one channel."""
    window, n = len(weights), len(v)
    if n < window:
        return np.full(n, np.nan)
    half, out = window // 2, np.empty(n)
    total = lambda row, of: sum((w * of[j : len(of) - window + 1 + j] for j, w in enumerate(row[1:], 1)), row[0] * of[: len(of) - window + 1])
    out[half : n - half] = total(weights[half], v)
    for r in range(half):
        out[r], out[n - 1 - r] = total(weights[r], v[:window])[0], total(weights[-1 - r], v[n - window :])[0]
    return out


def _quantile(v: np.ndarray, q: float) -> float:
    place = round((len(v) - 1) * q, 9)
    low = int(place)
    high = min(low + 1, len(v) - 1)
    a, b = np.partition(v, [low, high])[[low, high]]
    part = place - low
    return (a + b) / 2 if part == 0.5 else a if part == 0 else a + (b - a) * part


def filled_take(c: Columns) -> tuple[Columns, np.ndarray]:
    """The channels of a take's frames with short gaps filled, and whether a frame had one."""
    pairs = {n: _gaps_filled(c[n], c["t"]) for n in ("X", "Y", "ap")}
    return {"t": c["t"], "hand": c["hand"]} | {n: v for n, (v, _) in pairs.items()}, pairs["X"][1] | pairs["Y"][1] | pairs["ap"][1]


def take_signals(native: Columns, was_gap: np.ndarray, params: SignalParams, weights: Callable[[int], np.ndarray], known: bool = True) -> Columns:
    """:func:`signals.derive_signals` of one take from its filled channels. ``known``: whether it has a name."""
    t, nan = native["t"], np.nan
    t0 = t.min()
    n = int(np.floor((t.max() - t0 + 1e-9) * GRID_HZ)) + 1
    index = np.arange(n, dtype=np.int64)
    g = t0 + index / float(GRID_HZ)
    X, Y, ap = (_at_points(t, native[c], g, (MAX_GAP_FRAMES + 1.5) / GRID_HZ) if known else np.full(n, nan) for c in ("X", "Y", "ap"))
    missing = np.isnan(X) | np.isnan(Y) | np.isnan(ap)
    flagged = np.zeros(n, bool)
    if was_gap.any():
        times, none = _least_at(t, -was_gap.astype(float))
        j = np.searchsorted(times, g)
        flagged = (j > 0) & (j < len(times)) & (none[np.minimum(j, len(times) - 1)] < 0)
    value, slope = weights(0), weights(1)
    Xs, vx, Ys, vy, aperture, ap_slope = (smoothed(v, w) for v in map(full, (X, Y, ap)) for w in (value, slope))
    hand, valid = native["hand"][~np.isnan(native["hand"])], ~missing
    hand = _quantile(hand, 0.5) if len(hand) and known else nan
    hx = hy = fx = fy = nan
    if valid.any() and not np.isnan(hand):
        near = np.flatnonzero(valid)[: params.home_samples]
        hx, hy = np.median(Xs[near]), np.median(Ys[near])
        dist = np.sqrt((Xs - hx) ** 2 + (Ys - hy) ** 2)
        own = dist[valid & ~np.isnan(dist)]
        if len(own):
            away = valid & (dist >= _quantile(own, params.far_quantile))
            fx, fy = Xs[away].mean(), Ys[away].mean()
        else:
            hand = nan
    else:
        hand = nan
    L = np.sqrt((fx - hx) ** 2 + (fy - hy) ** 2)
    px, still = nan if hand == 0 else hand, L < 1e-6
    ux, uy = ((fx - hx) / L, (fy - hy) / L) if L != 0 else (nan, nan)
    dx, dy = Xs - hx, Ys - hy
    flat = lambda e: np.zeros(n) if still else e
    with np.errstate(invalid="ignore", divide="ignore"):
        out = {
            "speed": np.sqrt(vx**2 + vy**2) / px, "aperture": aperture, "aperture_slope": ap_slope,
            "p": flat((dx * ux + dy * uy) / L), "dp": flat((vx * ux + vy * uy) / L), "q": flat((dy * ux - dx * uy) / px), "dq": flat((vy * ux - vx * uy) / px),
            "ydev": -dy / px, "dy": -vy / px,
        }
    return {"sample_idx": index, "t": g} | {k: np.where(missing, nan, v) for k, v in out.items()} | {"missing": missing, "interpolated": flagged & valid}


def _sliding(x: np.ndarray, half: int, op: np.ufunc, pad: float) -> np.ndarray:
    """``op`` over the 2 * half + 1 values around each, by doubling windows."""
    width, n, w = 2 * half + 1, len(x), 1
    y = np.concatenate([np.full(half, pad), x, np.full(half, pad)])
    while 2 * w <= width:
        y, w = op(y[:-w], y[w:]), 2 * w
    return op(y[:n], y[width - w : width - w + n])


def feature_pieces(s: Columns, base: Sequence[str], means: Sequence[int], trends: Sequence[int], trend_channels: Sequence[str]) -> Iterator[tuple[slice, np.ndarray]]:
    """:func:`signals.build_features` of one take, ``PIECE`` samples at a time: the samples, and a row of features for each."""
    n, halo = len(s["sample_idx"]), max(*means, *trends)
    channels = {c: full(s[c], s["sample_idx"]) for c in base}
    channels = {c: np.where(np.isnan(v), 0.0, v) for c, v in channels.items()}
    channels["speed"] = np.sqrt(np.maximum(channels["speed"], 0.0))
    for start in range(0, n, PIECE):
        end = min(n, start + PIECE)
        lo, hi = max(0, start - halo), min(n, end + halo)
        m, i = hi - lo, np.arange(start - lo, end - lo)
        reach = {}
        columns = []

        def mean(total: np.ndarray, back: int, ahead: int) -> np.ndarray:
            if (back, ahead) not in reach:
                a, b = np.maximum(i - back, 0), np.minimum(i + ahead, m - 1) + 1
                reach[back, ahead] = a, b, (b - a).astype(float)
            a, b, k = reach[back, ahead]
            return (total[b] - total[a]) / k

        totals = {c: np.concatenate([[0.0], np.cumsum(channels[c][lo:hi])]) for c in base}
        for c in base:
            columns += [channels[c][start:end], *[mean(totals[c], w, w) for w in means]]
        columns += [mean(totals[c], 0, w - 1) - mean(totals[c], w - 1, 0) for c in trend_channels for w in trends]
        speed = channels["speed"][lo:hi]
        columns.append(_sliding(speed, 8, np.maximum, -np.inf)[i])
        near = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(8, np.nan), speed, np.full(8, np.nan)]), 17)[i]
        off = near - mean(totals["speed"], 8, 8)[:, None]
        columns.append(np.sqrt(np.nansum(off * off, 1) / np.maximum(reach[8, 8][2] - 1, 1)))
        columns.append(_sliding(channels["aperture"][lo:hi], 20, np.minimum, np.inf)[i])
        columns.append(s["missing"][start:end].astype(float))
        yield slice(start, end), np.column_stack(columns)
