"""From keypoints to motion signals on a uniform grid, as expressions and joins.

Interpolation works on spans between known neighbours: a span is found by one look ahead and gives
every grid point inside it, so nothing searches along a take. Smoothing is a fixed linear filter.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasemill.operators.quantiles import exact_quantiles
from phasemill.operators.reach import bounded_reach
from phasemill.operators.relational import SHARD, conditional_pivot, fill_short_gaps
from phasemill.operators.takes import LIMIT, PIECE, Columns, by_whole_take, feature_pieces, filled_take, parted, take_signals
from phasemill.schemas import FRAME_H, FRAME_W, GRID_HZ, LANDMARKS, MAX_GAP_FRAMES, SignalParams
from phasemill.session import known, materialize

FRAME_SHARD, GRID_SHARD = 4096, 4096
BASE = ["speed", "aperture", "aperture_slope", "p", "dp", "q", "dq", "ydev", "dy"]


def build_frames(raw: DataFrame) -> DataFrame:
    """One row per frame: ``take, frame_idx, t, detected, i{k}_x, i{k}_y, w{k}_x.., handedness, handedness_score``.

    Rows delivered twice change nothing. A frame is detected if any of its rows is.
    """
    cells = {"i{}_x": "x", "i{}_y": "y", "w{}_x": "world_x", "w{}_y": "world_y", "w{}_z": "world_z"}
    clean = raw.select("take", "frame_idx", "timestamp_ms", "keypoint_id", "detected", "handedness", "handedness_score", *[known(F.col(c)).alias(c) for c in cells.values()])
    extra = [F.max(F.col("timestamp_ms") / 1000.0).alias("t"), F.max("detected").alias("detected"), F.max("handedness").alias("handedness"), F.max(known(F.col("handedness_score"))).alias("handedness_score")]
    return conditional_pivot(clean, ["take", "frame_idx"], "keypoint_id", LANDMARKS, cells, extra)


def native_channels(frames: DataFrame) -> DataFrame:
    """Wrist position in pixels, hand size in pixels and aperture per frame; NULL where undetected or impossible."""
    at = lambda c: F.when(F.col("detected"), known(F.col(c)))
    hand = F.sqrt(F.pow((at("i0_x") - at("i9_x")) * FRAME_W, 2) + F.pow((at("i0_y") - at("i9_y")) * FRAME_H, 2))
    far = lambda a, b: F.sqrt(sum(F.pow(at(f"w{a}_{c}") - at(f"w{b}_{c}"), 2) for c in "xyz"))
    finite = lambda c: F.when(F.abs(c) < F.lit(float("inf")), c)
    rows = frames.filter(F.col("t").isNotNull())
    return rows.select("take", "frame_idx", "t", finite(at("i0_x") * FRAME_W).alias("X"), finite(at("i0_y") * FRAME_H).alias("Y"), finite(F.try_divide(far(4, 8), far(0, 9))).alias("ap"), finite(hand).alias("hand"))


def bounds_of(rows: DataFrame, t: str = "t") -> DataFrame:
    """Per take the first and last time and the last index of its grid."""
    return rows.groupBy("take").agg(F.min(t).alias("t0"), F.max(t).alias("t1")).withColumn("last_idx", F.floor((F.col("t1") - F.col("t0") + 1e-9) * GRID_HZ).cast("long"))


def grid_of(bounds: DataFrame) -> DataFrame:
    """``(take, shard, sample_idx, t)``: t0 + i / 30, never accumulated. Long takes are spread before their points are made."""
    shards = bounds.withColumn(SHARD, F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("last_idx") / GRID_SHARD)))).repartition("take", SHARD)
    ends = F.least(F.col("last_idx"), (F.col(SHARD) + 1) * GRID_SHARD - 1)
    points = shards.withColumn("sample_idx", F.explode(F.sequence(F.col(SHARD) * GRID_SHARD, ends)))
    return points.select("take", SHARD, "sample_idx", (F.col("t0") + F.col("sample_idx") / float(GRID_HZ)).alias("t"), "last_idx")


def _spans(df: DataFrame, entity: Sequence[str], order: str, cols: Sequence[str], shard: Column) -> DataFrame:
    """Each row with its successor's ``cols`` as ``next_*``."""

    def following(part: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(order)
        return part.withColumns({f"next_{c}": F.lead(c).over(w) for c in cols})

    return bounded_reach(df.withColumn(SHARD, shard), entity, SHARD, [order], 1, following).drop(SHARD)


def resample(channels: DataFrame, bounds: DataFrame, names: Sequence[str], max_gap: float = (MAX_GAP_FRAMES + 1.5) / GRID_HZ) -> DataFrame:
    """Channels at the grid points: ``(take, sample_idx, *names)``, rows only where a channel has a value.

    Linear between the two known samples around a point if they are at most ``max_gap`` apart; a point
    at exactly a sample's time has its value in any case.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("v")) for n in names])
    tall = channels.select("take", "t", F.explode(F.filter(pairs, lambda x: x["v"].isNotNull())).alias("c")).groupBy("take", F.col("c.name").alias("name"), "t").agg(F.min("c.v").alias("v"))
    spans = _spans(tall, ["take", "name"], "t", ["t", "v"], F.floor(F.col("t") / 120)).join(bounds, "take")
    dt = 1.0 / GRID_HZ
    short = F.coalesce(F.col("next_t") - F.col("t") <= max_gap, F.lit(False))
    # a point more on either side, since the exact test below is made on its time
    lo, hi = F.floor((F.col("t") - F.col("t0")) / dt), F.floor((F.when(short, F.col("next_t")).otherwise(F.col("t")) - F.col("t0")) / dt) + 1
    points = spans.withColumn("sample_idx", F.explode(F.sequence(F.greatest(lo, F.lit(0)), F.greatest(F.least(hi, F.col("last_idx")), F.greatest(lo, F.lit(0)))))).withColumn("g", F.col("t0") + F.col("sample_idx") / float(GRID_HZ))
    g, t, n = F.col("g"), F.col("t"), F.col("next_t")
    inside = (g == t) | (short & (g > t) & (g < n))
    value = F.when(g == t, F.col("v")).otherwise(F.col("v") + (F.col("next_v") - F.col("v")) * (g - t) / (n - t))
    points = points.filter(inside & (F.col("sample_idx") <= F.col("last_idx"))).withColumn("value", value)
    return points.groupBy("take", "sample_idx").agg(*[F.max(F.when(F.col("name") == x, F.col("value"))).alias(x) for x in names])


def _each(df: DataFrame, lo: Column, hi: Column, name: str = "k") -> DataFrame:
    """Rows repeated for each integer from ``lo`` to ``hi``, by shards first: no row ever holds the array of a long stretch."""
    cut = df.withColumns({"__lo": lo.cast("long"), "__hi": hi.cast("long")}).withColumn("__piece", F.explode(F.sequence(F.floor(F.col("__lo") / GRID_SHARD), F.floor(F.col("__hi") / GRID_SHARD))))
    ends = F.greatest("__lo", F.col("__piece") * GRID_SHARD), F.least("__hi", (F.col("__piece") + 1) * GRID_SHARD - 1)
    return cut.withColumn(name, F.explode(F.sequence(*ends))).drop("__lo", "__hi", "__piece")


def filled_by_index(grid: DataFrame, names: Sequence[str]) -> DataFrame:
    """Adds ``<name>_full``: NULLs linear in the index between known points, constant beyond the first and last.

    ``grid`` has every sample of a take with ``last_idx``. A take without any known point stays NULL.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("v")) for n in names])
    tall = grid.select("take", "sample_idx", "last_idx", F.explode(F.filter(pairs, lambda x: x["v"].isNotNull())).alias("c")).select("take", "sample_idx", "last_idx", "c.*")
    spans = _spans(tall, ["take", "name"], "sample_idx", ["sample_idx", "v"], F.floor(F.col("sample_idx") / GRID_SHARD))
    i, j = F.col("sample_idx"), F.col("next_sample_idx")
    inner = _each(spans.filter(j - i > 1), i + 1, j - 1).select("take", "name", "k", (F.col("v") + (F.col("next_v") - F.col("v")) / (j - i) * (F.col("k") - i)).alias("full"))
    tail = _each(spans.filter(j.isNull() & (i < F.col("last_idx"))), i + 1, F.col("last_idx")).select("take", "name", "k", F.col("v").alias("full"))
    first = tall.groupBy("take", "name").agg(F.min("sample_idx").alias("i"), F.min_by("v", "sample_idx").alias("full"))
    head = _each(first.filter("i > 0"), F.lit(0), F.col("i") - 1).select("take", "name", "k", "full")
    guesses = inner.unionByName(tail).unionByName(head).groupBy("take", F.col("k").alias("sample_idx")).agg(*[F.max(F.when(F.col("name") == n, F.col("full"))).alias(f"__{n}") for n in names])
    both = grid.join(guesses, ["take", "sample_idx"], "left")
    return both.withColumns({f"{n}_full": F.coalesce(F.col(n), F.col(f"__{n}")) for n in names}).drop(*[f"__{n}" for n in names])


def savgol_weights(window: int, order: int = 2, derivative: int = 0, dt: float = 1.0) -> np.ndarray:
    """Row r: weights of the first ``window`` samples for the least-squares polynomial's value at sample r."""
    x = np.arange(window, dtype=float)
    fit = np.linalg.pinv(np.vander(x, order + 1, increasing=True))
    powers = np.array([[0.0 if m < derivative else np.prod(np.arange(m - derivative + 1, m + 1)) * r ** (m - derivative) for m in range(order + 1)] for r in x])
    return powers @ fit / dt**derivative


def savgol(df: DataFrame, entity: Sequence[str], index: str, last_index: str, values: dict[str, tuple[str, int]], window: int, shard: Column, dt: float = 1.0) -> DataFrame:
    """Savitzky-Golay of order 2: adds ``name`` for each ``name: (column, derivative)``.

    The first and last half windows are the polynomial of the first and last ``window`` samples. The
    filter looks at most ``window - 1`` rows aside, so takes are cut into shards. Takes shorter than
    the window get NULL.
    """
    half = window // 2

    columns = sorted({c for c, _ in values.values()})
    # one SQL text per column: the sums have hundreds of terms
    at = lambda c, k: f"`__{c}{k}`" if k else f"`{c}`"

    def total(c: str, row: np.ndarray, own: int) -> str:
        return " + ".join(f"{float(w)!r}D * {at(c, j - own)}" for j, w in enumerate(row))

    def cases(c: str, derivative: int) -> str:
        weights = savgol_weights(window, 2, derivative, dt)
        edges = [f"WHEN {index} = {r} THEN {total(c, weights[r], r)} WHEN {last_index} - {index} = {r} THEN {total(c, weights[-1 - r], window - 1 - r)}" for r in range(half)]
        return f"CASE WHEN {last_index} < {window - 1} THEN NULL {' '.join(edges)} ELSE {total(c, weights[half], half)} END"

    def smoothed(part: DataFrame, by: list[str]) -> DataFrame:
        over = f"OVER (PARTITION BY {', '.join(by)} ORDER BY {index})"
        near = [(c, k) for c in columns for k in range(1 - window, window) if k]
        part = part.select("*", *[F.expr(f"{'lag' if k < 0 else 'lead'}(`{c}`, {abs(k)}) {over} AS `__{c}{k}`") for c, k in near])
        part = part.select("*", *[F.expr(f"{cases(c, d)} AS `{name}`") for name, (c, d) in values.items()])
        return part.drop(*[f"__{c}{k}" for c, k in near])

    return bounded_reach(df.withColumn(SHARD, shard), entity, SHARD, [index], window - 1, smoothed).drop(SHARD)


def _parts(df: DataFrame, value: Column, shard: Column) -> DataFrame:
    return df.groupBy("take", shard.alias(SHARD)).agg(F.collect_list(value).alias("values"))


NATIVE = ["t", "X", "Y", "ap", "hand"]
SIGNALS = "take string, sample_idx long, t double, " + ", ".join(f"{c} double" for c in BASE) + ", missing boolean, interpolated boolean"


def sizes_of(native: DataFrame) -> DataFrame:
    """:func:`bounds_of` with ``size``, the frames or samples of a take, whichever are more."""
    count = native.groupBy("take").agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.count(F.lit(1)).alias("size"))
    last = F.floor((F.col("t1") - F.col("t0") + 1e-9) * GRID_HZ).cast("long")
    return count.withColumn("last_idx", last).withColumn("size", F.greatest("size", F.col("last_idx") + 1))


def derive_signals(frames: DataFrame, params: SignalParams = SignalParams(), limit: int = LIMIT) -> DataFrame:
    """Motion signals at 30 Hz: ``take, sample_idx, t, speed, aperture, aperture_slope, p, dp, q, dq, ydev, dy, missing, interpolated``.

    Speed in hand lengths a second; aperture as a share of the hand; p and q along and across the axis
    from the take's home point (median of its first valid samples) to its far point (mean of the
    samples beyond the 0.9 quantile of distance); height above home. All are NULL where a channel is
    missing. Takes of up to ``limit`` frames and samples are one call of the kernel each; larger ones
    go by shards, with scalars that are exact and distributed. Both give the same values.
    """
    native = materialize(native_channels(frames), "native")
    return signals_of(native, materialize(sizes_of(native), "sizes"), params, limit)


def signals_of(native: DataFrame, sizes: DataFrame, params: SignalParams, limit: int = LIMIT) -> DataFrame:
    """:func:`derive_signals` of :func:`native_channels`, written."""
    fits, large = parted(native, sizes, limit)
    out = by_whole_take(fits, "frame_idx", NATIVE, signal_kernel(params), SIGNALS)
    return out if large is None else out.unionByName(sharded_signals(large, params))


def weights_of(params: SignalParams):
    """The filter weights of a derivative, as the kernels take them."""
    made = {k: savgol_weights(params.smooth_win, 2, k, 1.0 / GRID_HZ) for k in (0, 1)}
    return made.__getitem__


def signal_kernel(params: SignalParams):
    weights = weights_of(params)

    def run(take: str | None, c: Columns):
        yield take, take_signals(*filled_take(c), params, weights, take is not None)

    return run


def sharded_signals(native: DataFrame, params: SignalParams) -> DataFrame:
    """Signals by expressions and joins over shards of takes of any size."""
    native = fill_short_gaps(native, ["take"], "frame_idx", "t", ["X", "Y", "ap"], F.floor(F.col("frame_idx") / FRAME_SHARD))
    native = native.select("take", "frame_idx", "t", "hand", *[F.col(f"{c}_filled").alias(c) for c in ("X", "Y", "ap")], (F.col("X_was_gap") | F.col("Y_was_gap") | F.col("ap_was_gap")).alias("was_gap"))
    native = materialize(native, "native")
    bounds = materialize(bounds_of(native), "bounds")
    grid = grid_of(bounds).join(resample(native, bounds, ["X", "Y", "ap"]), ["take", "sample_idx"], "left")
    # flagged by the first frame at or after the point; frames are at most one shard of time away
    flags = native.filter("was_gap").select("take", "t", F.lit(True).alias("flag"))
    spans = _spans(native.select("take", "t").distinct(), ["take"], "t", ["t"], F.floor(F.col("t") / 120)).join(bounds, "take").join(flags.withColumnRenamed("t", "next_t").distinct(), ["take", "next_t"])
    lo, hi = F.floor((F.col("t") - F.col("t0")) * GRID_HZ), F.floor((F.col("next_t") - F.col("t0")) * GRID_HZ) + 1
    flagged = _each(spans, F.greatest(lo, F.lit(0)), hi, "sample_idx").withColumn("g", F.col("t0") + F.col("sample_idx") / float(GRID_HZ)).filter((F.col("g") > F.col("t")) & (F.col("g") <= F.col("next_t"))).select("take", "sample_idx", F.lit(True).alias("flag")).distinct()
    grid = grid.join(flagged, ["take", "sample_idx"], "left").withColumn("missing", F.col("X").isNull() | F.col("Y").isNull() | F.col("ap").isNull()).withColumn("interpolated", F.coalesce("flag", F.lit(False)) & ~F.col("missing")).drop("flag")
    # written, since every pass by shards and edges below would otherwise resample again
    grid = materialize(grid, "grid")
    full = filled_by_index(grid, ["X", "Y", "ap"])
    shard = F.floor(F.col("sample_idx") / GRID_SHARD)
    smooth = savgol(full, ["take"], "sample_idx", "last_idx", {"Xs": ("X_full", 0), "Ys": ("Y_full", 0), "vx": ("X_full", 1), "vy": ("Y_full", 1), "aperture": ("ap_full", 0), "aperture_slope": ("ap_full", 1)}, params.smooth_win, shard, 1.0 / GRID_HZ)
    smooth = materialize(smooth.select("take", "sample_idx", "t", "missing", "interpolated", "Xs", "Ys", "vx", "vy", "aperture", "aperture_slope"), "smooth")
    hand = exact_quantiles(_parts(native, F.col("hand"), F.floor(F.col("frame_idx") / FRAME_SHARD)), ["take"], "values", 0.5).select("take", F.col("quantile").alias("hand"))
    valid = smooth.filter(~F.col("missing"))
    # the first of a take are among the first of its shards
    near = valid.withColumn(SHARD, shard).withColumn("__r", F.row_number().over(Window.partitionBy("take", SHARD).orderBy("sample_idx"))).filter(F.col("__r") <= params.home_samples)
    near = near.withColumn("__r", F.row_number().over(Window.partitionBy("take").orderBy("sample_idx"))).filter(F.col("__r") <= params.home_samples)
    home = near.groupBy("take").agg(F.percentile("Xs", 0.5).alias("hx"), F.percentile("Ys", 0.5).alias("hy"))
    away = valid.join(home, "take").withColumn("dist", F.sqrt(F.pow(F.col("Xs") - F.col("hx"), 2) + F.pow(F.col("Ys") - F.col("hy"), 2)))
    reach = exact_quantiles(_parts(away, F.col("dist"), shard), ["take"], "values", params.far_quantile).select("take", F.col("quantile").alias("reach"))
    far = away.join(reach, "take").filter(F.col("dist") >= F.col("reach")).groupBy("take").agg(F.avg("Xs").alias("fx"), F.avg("Ys").alias("fy"))
    scalars = home.join(far, "take").join(hand, "take").withColumn("L", F.sqrt(F.pow(F.col("fx") - F.col("hx"), 2) + F.pow(F.col("fy") - F.col("hy"), 2)))
    s = smooth.join(scalars, "take", "left")
    L, hand_px, still = F.col("L"), F.nullif(F.col("hand"), F.lit(0.0)), F.col("L") < 1e-6
    ux, uy = F.try_divide(F.col("fx") - F.col("hx"), L), F.try_divide(F.col("fy") - F.col("hy"), L)
    dx, dy = F.col("Xs") - F.col("hx"), F.col("Ys") - F.col("hy")
    flat = lambda e: F.when(still, 0.0).otherwise(e)
    signals = {
        "speed": F.sqrt(F.pow("vx", 2) + F.pow("vy", 2)) / hand_px, "aperture": F.col("aperture"), "aperture_slope": F.col("aperture_slope"),
        "p": flat(F.try_divide(dx * ux + dy * uy, L)), "dp": flat(F.try_divide(F.col("vx") * ux + F.col("vy") * uy, L)),
        "q": flat((dy * ux - dx * uy) / hand_px), "dq": flat((F.col("vy") * ux - F.col("vx") * uy) / hand_px),
        "ydev": -dy / hand_px, "dy": -F.col("vy") / hand_px,
    }
    return s.select("take", "sample_idx", "t", *[F.when(~F.col("missing"), e).alias(n) for n, e in signals.items()], "missing", "interpolated")


MEAN_WINDOWS, TREND_WINDOWS = (3, 8, 20, 45), (5, 15, 45)
TREND_CHANNELS = ("aperture", "ydev", "p", "speed")


def feature_names() -> list[str]:
    names = [x for c in BASE for x in (c, *[f"{c}_m{w}" for w in MEAN_WINDOWS])]
    return [*names, *[f"{c}_trend{w}" for c in TREND_CHANNELS for w in TREND_WINDOWS], "speed_max8", "speed_std8", "ap_min20", "missing"]


def take_features(s: Columns):
    """Features of a take's signals in pieces: see :func:`takes.feature_pieces`."""
    return feature_pieces(s, BASE, MEAN_WINDOWS, TREND_WINDOWS, TREND_CHANNELS)


def build_features(signals: DataFrame, limit: int = LIMIT) -> DataFrame:
    """61 features per sample: ``take, sample_idx, t, *feature_names()``, no NULL.

    Rolling means, trends (mean of the next w samples less that of the last w, both with the sample
    itself), maximum, deviation and minimum, truncated at the ends of the take. Takes of more than
    ``limit`` samples go by shards, as in :func:`derive_signals`.
    """
    names = feature_names()
    columns = ["sample_idx", "t", *BASE, "missing"]

    def run(take: str | None, s: Columns):
        for rows, x in take_features(s):
            yield take, {"sample_idx": s["sample_idx"][rows], "t": s["t"][rows]} | {n: x[:, i] for i, n in enumerate(names)}

    fits, large = parted(signals, signals.groupBy("take").agg(F.count(F.lit(1)).alias("size")), limit)
    out = by_whole_take(fits, "sample_idx", columns, run, "take string, sample_idx long, t double, " + ", ".join(f"{n} double" for n in names))
    return out if large is None else out.unionByName(sharded_features(large))


def sharded_features(signals: DataFrame) -> DataFrame:
    """Features by window expressions over shards: all share one partitioning and sort, none reaches more than 45 samples."""
    last = signals.groupBy("take").agg(F.max("sample_idx").alias("last_idx"))
    full = filled_by_index(signals.join(last, "take"), BASE)
    full = full.select("take", "sample_idx", "t", F.col("missing").cast("double").alias("missing"), *[F.coalesce(f"{c}_full", F.lit(0.0)).alias(c) for c in BASE])
    full = full.withColumn("speed", F.sqrt(F.greatest("speed", F.lit(0.0)))).withColumn(SHARD, F.floor(F.col("sample_idx") / GRID_SHARD))

    def rolled(part: DataFrame, by: list[str]) -> DataFrame:
        # as SQL texts: there are hundreds of window expressions
        whole = f"PARTITION BY {', '.join(by)}"
        over, upto = f"OVER ({whole} ORDER BY sample_idx)", f"OVER ({whole} ORDER BY sample_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        near = lambda n: f"OVER ({whole} ORDER BY sample_idx ROWS BETWEEN {n} PRECEDING AND {n} FOLLOWING)"
        # a mean is a difference of running sums: its cost doesn't grow with the window, as a sliding frame's does
        part = part.select("*", F.expr(f"row_number() {over} AS __i"), F.expr(f"count(1) OVER ({whole}) AS __n"), *[F.expr(f"sum({c}) {upto} AS __s_{c}") for c in BASE], *[F.expr(f"sum({c}) OVER ({whole}) AS __t_{c}") for c in BASE])

        def mean(c: str, back: int, ahead: int) -> str:
            high = f"coalesce(lead(__s_{c}, {ahead}) {over}, __t_{c})" if ahead else f"__s_{c}"
            return f"({high} - coalesce(lag(__s_{c}, {back + 1}) {over}, 0.0D)) / (least(__i + {ahead}, __n) - greatest(__i - {back}, 1) + 1)"

        out = {f"{c}_m{n}": mean(c, n, n) for c in BASE for n in MEAN_WINDOWS}
        out |= {f"{c}_trend{n}": f"{mean(c, 0, n - 1)} - {mean(c, n - 1, 0)}" for c in TREND_CHANNELS for n in TREND_WINDOWS}
        out |= {"speed_max8": f"max(speed) {near(8)}", "speed_std8": f"coalesce(stddev_samp(speed) {near(8)}, 0.0D)", "ap_min20": f"min(aperture) {near(20)}"}
        return part.select("*", *[F.expr(f"{e} AS `{n}`") for n, e in out.items()])

    return bounded_reach(full, ["take"], SHARD, ["sample_idx"], max(MEAN_WINDOWS), rolled).select("take", "sample_idx", "t", *feature_names())


def copy_name(take: Column, factor: Column) -> Column:
    return F.concat_ws("x", take, factor)


def time_scaled(frames: DataFrame, segments: DataFrame, factors: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """Frames and labels of the same motions performed faster by each factor; for training takes only."""
    each = F.explode(F.array(*[F.lit(float(f)) for f in factors]))
    fast = frames.withColumn("factor", each).withColumn("t", F.col("t") / F.col("factor"))
    labels = segments.withColumn("factor", each).withColumns({c: F.col(c) / F.col("factor") for c in ("start_s", "end_s")})
    name = copy_name(F.col("take"), F.col("factor"))
    return fast.withColumn("take", name), labels.withColumn("take", name)
