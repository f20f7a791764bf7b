"""Queries over the dirty motion tables by the general operators, each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasemill.operators.diff import copy_differences
from phasemill.operators.grid import COUNTER, GAUGE, regular_grid
from phasemill.operators.intervals import continuous_periods, periods_and_gaps
from phasemill.operators.spikes import hampel, implausible_readings
from phasemill.session import missing, ms_of, table

GAP_MS, PAUSE_MS = 5, 120_000
CELL_MS, FILL, MARK = 50, 2, 2_400
BOUNDS = {"x": (-1.0, 2.0), "y": (-1.0, 2.0), "handedness_score": (0.0, 1.0)}


def _labelled(spark: SparkSession, d: str) -> tuple[DataFrame, dict]:
    # bounds of one millisecond are a usable row, so the order is checked in seconds and points are kept
    df = table(spark, d, "label_segments").filter(~missing(F.col("start_s")) & ~missing(F.col("end_s")) & (F.col("end_s") > F.col("start_s")))
    return df, {"take": F.lower(F.trim("take"))}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    df, take = _labelled(spark, d)
    found = periods_and_gaps(df, take, ms_of(F.col("start_s")), ms_of(F.col("end_s")), GAP_MS, PAUSE_MS, points=True)
    return found.select("take", "kind", F.col("start").alias("start_ms"), F.col("end").alias("end_ms"))


def p1_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Labelled time per take: number of periods, covered milliseconds, span."""
    df, take = _labelled(spark, d)
    periods = continuous_periods(df, take, ms_of(F.col("start_s")), ms_of(F.col("end_s")), GAP_MS, points=True)
    return periods.groupBy("take").agg(F.count(F.lit(1)).alias("n_periods"), F.sum(F.col("end") - F.col("start")).alias("covered_ms"), F.min("start").alias("from_ms"), F.max("end").alias("to_ms"))


def _wrist(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_keypoints").filter((F.col("keypoint_id") == 0) & F.col("detected"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    grid = regular_grid(_wrist(spark, d), ["take"], "timestamp_ms", "x", CELL_MS, GAUGE, FILL, MARK)
    return grid.filter(F.col("how") != "present").select("take", "slot", "how")


def p2_grid(spark: SparkSession, d: str) -> DataFrame:
    """The whole 20 Hz series of the wrist's x."""
    grid = regular_grid(_wrist(spark, d), ["take"], "timestamp_ms", "x", CELL_MS, GAUGE, FILL, MARK)
    return grid.select("take", "slot", "how", "n_readings", F.round("increment", 12).alias("increment"), F.round("value", 12).alias("value"))


def p2_frames(spark: SparkSession, d: str) -> DataFrame:
    """The frame index as a cumulative counter: frames delivered per slot, resets counted."""
    frames = _wrist(spark, d).filter(~missing(F.col("x")))
    grid = regular_grid(frames, ["take"], "timestamp_ms", "frame_idx", CELL_MS, COUNTER, FILL, MARK)
    return grid.select("take", "slot", "how", "n_resets", F.round("increment", 6).alias("frames"))


DIFFED = {
    "phase_events": (["take", "event_idx"], lambda: F.struct("take", F.floor(F.col("event_idx") / 256))),
    # scopes are cycleN, or a name without number: neighbouring cycles of a take stay together
    "scores_full": (["take", "scope"], lambda: F.struct("take", F.floor(F.expr("try_cast(regexp_extract(scope, '[0-9]+', 0) AS bigint)") / 256))),
}


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for name, (key, block) in DIFFED.items():
        diff = copy_differences(table(spark, d, name), table(spark, d, f"{name}_wh"), key, block(), ignore=["published_at"])
        parts.append(diff.select(F.lit(name).alias("table_name"), "take", F.col(key[1]).cast("string").alias("row_key"), "field", "kind"))
    return parts[0].unionByName(parts[1])


def p3_summary(spark: SparkSession, d: str) -> DataFrame:
    return p3_found(spark, d).groupBy("table_name", "field", "kind").agg(F.count(F.lit(1)).alias("n"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "raw_keypoints").filter(F.col("detected"))
    flags = implausible_readings(df, ["take", "keypoint_id"], "frame_idx", "timestamp_ms", BOUNDS, only={"handedness_score": F.col("keypoint_id") == 0})
    # a frozen reading can be the edge of a spike as well
    return flags.select("take", "frame_idx", "keypoint_id", "field").distinct()


def p6_hampel(spark: SparkSession, d: str) -> DataFrame:
    """Outliers of the wrist's x by the classical Hampel filter (5 readings to either side)."""
    df = _wrist(spark, d).filter(F.col("x").between(-1, 2)).select("take", "frame_idx", "x").distinct()
    df = df.withColumn("shard", F.floor(F.col("frame_idx") / 512))
    out = hampel(df, ["take"], ["frame_idx", "x"], "x", 5, 3.0, "shard").filter("outlier")
    return out.select("take", "frame_idx", "x", F.round("rolling_median", 9).alias("rolling_median"), F.round("rolling_mad", 9).alias("rolling_mad"))


def p6_hampel_series(spark: SparkSession, d: str) -> DataFrame:
    """:func:`p6_hampel` over every series that ``p6_found`` judges: x and y of all keypoints, and the handedness score; ``p6_hampel`` is the one series that its SQL names."""
    df = table(spark, d, "raw_keypoints").filter(F.col("detected"))
    held = {n: F.col(n).between(lo, hi) & ((F.col("keypoint_id") == 0) if n == "handedness_score" else F.lit(True)) for n, (lo, hi) in BOUNDS.items()}
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.when(ok, F.col(n).cast("double")).alias("value")) for n, ok in held.items()])
    df = df.select("take", "keypoint_id", "frame_idx", F.explode(F.filter(pairs, lambda x: x["value"].isNotNull())).alias("r")).select("take", "keypoint_id", "frame_idx", "r.*").distinct()
    df = df.withColumn("shard", F.floor(F.col("frame_idx") / 512))
    out = hampel(df, ["take", "keypoint_id", "field"], ["frame_idx", "value"], "value", 5, 3.0, "shard").filter("outlier")
    return out.select("take", "keypoint_id", "field", "frame_idx", "value", F.round("rolling_median", 9).alias("rolling_median"), F.round("rolling_mad", 9).alias("rolling_mad"))


QUERIES = {f.__name__: f for f in (p1_found, p1_coverage, p2_found, p2_grid, p2_frames, p3_found, p3_summary, p6_found, p6_hampel, p6_hampel_series)}

_PERIODS = f"""
seg AS (SELECT lower(trim(take)) AS take, CAST(floor(start_s * 1000 + 0.5) AS BIGINT) AS s, CAST(floor(end_s * 1000 + 0.5) AS BIGINT) AS e
        FROM label_segments WHERE start_s IS NOT NULL AND end_s IS NOT NULL AND NOT isnan(start_s) AND NOT isnan(end_s) AND end_s > start_s),
reached AS (SELECT *, max(e) OVER (PARTITION BY take ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM seg),
numbered AS (SELECT *, sum(CASE WHEN s - r < {GAP_MS} THEN 0 ELSE 1 END) OVER (PARTITION BY take ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS n FROM reached),
periods AS (SELECT take, min(s) AS s, max(e) AS e FROM numbered GROUP BY take, n),
following AS (SELECT *, lead(s) OVER (PARTITION BY take ORDER BY s) AS nxt FROM periods)"""


def _spans(value: str) -> str:
    return f"""
r AS (SELECT DISTINCT take, timestamp_ms AS t0, CAST({value} AS DOUBLE) AS v0 FROM raw_keypoints
      WHERE keypoint_id = 0 AND detected AND timestamp_ms IS NOT NULL AND x IS NOT NULL AND NOT isnan(x)),
spans AS (SELECT *, lead(t0) OVER w AS t1, lead(v0) OVER w AS v1 FROM r WINDOW w AS (PARTITION BY take ORDER BY t0, v0)),
cells AS (SELECT *, CAST(floor(t0 / {CELL_MS}) AS BIGINT) AS k0, CAST(floor(t1 / {CELL_MS}) AS BIGINT) AS k1,
                 coalesce(CAST(floor(t1 / {CELL_MS}) - floor(t0 / {CELL_MS}) - 1 AS BIGINT), 0) AS absent FROM spans),
holes AS (SELECT *, unnest(generate_series(k0 + 1, k1 - 1)) AS slot FROM cells WHERE absent BETWEEN 1 AND {MARK})"""


def _grid(value: str, inc: str) -> str:
    share = "least(t1, (slot + 1) * {c}) - greatest(t0, slot * {c})".format(c=CELL_MS)
    return f"""{_spans(value)},
shares AS (
  SELECT take, k0 AS slot, v0, CASE WHEN absent > {FILL} THEN NULL WHEN t1 = t0 THEN {inc} ELSE {inc} * (least(t1, (k0 + 1) * {CELL_MS}) - t0) / (t1 - t0) END AS part, CAST(0 AS BIGINT) AS rs FROM cells
  UNION ALL
  SELECT take, k1, NULL, CASE WHEN absent > {FILL} THEN NULL ELSE {inc} * (t1 - k1 * {CELL_MS}) / (t1 - t0) END, 0 FROM cells WHERE k1 > k0
  UNION ALL
  SELECT take, k1, NULL, NULL, 1 FROM cells WHERE v1 < v0),
grid AS (
  SELECT take, slot, 'present' AS how, count(v0) AS n_readings, sum(part) AS increment, avg(v0) AS value, CAST(sum(rs) AS BIGINT) AS n_resets FROM shares GROUP BY take, slot
  UNION ALL
  SELECT take, slot, CASE WHEN absent <= {FILL} THEN 'filled' ELSE 'marked' END, 0,
         CASE WHEN absent <= {FILL} THEN {inc} * ({share}) / (t1 - t0) END,
         CASE WHEN absent <= {FILL} THEN v0 + {inc} * (slot * {CELL_MS} + {CELL_MS / 2} - t0) / (t1 - t0) END, 0 FROM holes)"""


PHASE_FIELDS = {"take_group": str, "label": str, "start_s": float, "end_s": float, "duration_s": float, "n_frames": int, "mean_speed": float, "mean_aperture": float, "mean_confidence": float, "frac_missing": float, "model_version": str}
_LABELS = ["rest", "reach", "grasp", "hold", "release", "retract"]
SCORE_FIELDS = {
    "take_group": str, "tolerance_s": float, **dict.fromkeys(["n_true", "n_pred", "n_matched", "recall", "precision", "mae_matched_s", "missed", "false_boundaries", "chance_uniform_recall", "chance_uniform_precision", "chance_random_recall", "chance_random_precision"], float),
    "n_frames": int, "n_unlabelled": int, "frame_accuracy": float, **{f"acc_{x}": float for x in _LABELS}, **{f"n_{x}": int for x in _LABELS},
    "balanced_accuracy": float, "majority_baseline": float, "tolerant_accuracy": float,
}


def _diff_sql(name: str, key: str, fields: dict[str, type]) -> str:
    def known(c: str, kind: type) -> str:
        return f"CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END" if kind is float else f"trim({c})" if kind is str else c

    def rows(t: str) -> str:
        return f"SELECT DISTINCT take, {key} AS k, " + ", ".join(f"{known(f, kind)} AS {f}" for f, kind in fields.items()) + f" FROM {t}"

    tests = [f"(a.{f} IS NULL) <> (b.{f} IS NULL) OR coalesce(abs(a.{f} - b.{f}) > 1e-6, false)" if kind is float else f"a.{f} IS DISTINCT FROM b.{f}" for f, kind in fields.items()]
    pair = f"FROM ({rows(name)}) a JOIN ({rows(name + '_wh')}) b ON a.take = b.take AND a.k = b.k"
    lone = "SELECT '{n}' AS table_name, take, CAST(k AS VARCHAR) AS row_key, '*' AS field, '{kind}' AS kind FROM (SELECT DISTINCT take, {key} AS k FROM {x} EXCEPT SELECT DISTINCT take, {key} FROM {y})"
    parts = [f"SELECT '{name}' AS table_name, a.take, CAST(a.k AS VARCHAR) AS row_key, '{f}' AS field, 'differs' AS kind {pair} WHERE {t}" for f, t in zip(fields, tests, strict=True)]
    parts += [lone.format(n=name, kind=kind, key=key, x=x, y=y) for kind, x, y in (("missing_in_copy", name, f"{name}_wh"), ("missing_in_source", f"{name}_wh", name))]
    return " UNION ALL ".join(parts)


_DIFF = f"{_diff_sql('phase_events', 'event_idx', PHASE_FIELDS)} UNION ALL {_diff_sql('scores_full', 'scope', SCORE_FIELDS)}"


def _spike_sql() -> str:
    outside = {n: f"({n} < {lo} OR {n} > {hi})" for n, (lo, hi) in BOUNDS.items()}
    read = "\n  UNION ALL ".join(f"SELECT take, keypoint_id, '{n}' AS field, frame_idx, timestamp_ms AS t, {n} AS v, {outside[n]} AS wrong FROM rows_ WHERE {n} IS NOT NULL AND NOT isnan({n})" + (" AND keypoint_id = 0" if n == "handedness_score" else "") for n in BOUNDS)
    leads = ", ".join(f"lead(v, {m}) OVER w AS v{m}, lead(t, {m}) OVER w AS t{m}" for m in (1, 2, 3))

    def beyond(m: int) -> str:
        run = ["v", "v1", "v2"][:m]
        steps = " AND ".join(f"{b} - {a} <= 100" for a, b in zip(["bt", "t", "t1", "t2"], ["t", "t1", "t2", "t3"], strict=True) if ["bt", "t", "t1", "t2"].index(a) <= m)
        above = " AND ".join(f"{r} - b > 12 * scale AND {r} - v{m} > 12 * scale" for r in run)
        below = " AND ".join(f"b - {r} > 12 * scale AND v{m} - {r} > 12 * scale" for r in run)
        return f"({steps} AND (({above}) OR ({below})))"

    starts = " UNION ALL ".join(f"SELECT take, keypoint_id, field, p + {j} AS p FROM judged WHERE {beyond(m)}" for m in (1, 2, 3) for j in range(m))
    return f"""
WITH rows_ AS (SELECT DISTINCT take, keypoint_id, frame_idx, timestamp_ms, x, y, handedness_score FROM raw_keypoints WHERE detected),
readings AS ({read}),
ok AS (SELECT *, row_number() OVER w AS p, lag(v) OVER w AS b, lag(t) OVER w AS bt, {leads} FROM readings WHERE NOT wrong WINDOW w AS (PARTITION BY take, keypoint_id, field ORDER BY frame_idx)),
scales AS (SELECT take, keypoint_id, field, median(abs(v - b)) AS scale FROM ok GROUP BY ALL),
judged AS (SELECT * FROM ok JOIN scales USING (take, keypoint_id, field)),
spikes AS (SELECT DISTINCT * FROM ({starts})),
runs AS (SELECT *, sum(CASE WHEN v = b THEN 0 ELSE 1 END) OVER (PARTITION BY take, keypoint_id, field ORDER BY p ROWS UNBOUNDED PRECEDING) AS run FROM ok),
frozen AS (SELECT *, count(*) OVER (PARTITION BY take, keypoint_id, field, run) AS n FROM runs)
SELECT DISTINCT take, frame_idx, keypoint_id, field FROM (
  SELECT take, frame_idx, keypoint_id, field FROM readings WHERE wrong
  UNION ALL SELECT take, frame_idx, keypoint_id, field FROM frozen WHERE n >= 10
  UNION ALL SELECT o.take, o.frame_idx, o.keypoint_id, o.field FROM ok o JOIN spikes USING (take, keypoint_id, field, p))"""


ORACLES = {
    "p1_found": f"WITH {_PERIODS} SELECT take, 'period' AS kind, s AS start_ms, e AS end_ms FROM periods UNION ALL SELECT take, 'gap', e, nxt FROM following WHERE nxt - e <= {PAUSE_MS}",
    "p1_coverage": f"WITH {_PERIODS} SELECT take, count(*) AS n_periods, CAST(sum(e - s) AS BIGINT) AS covered_ms, min(s) AS from_ms, max(e) AS to_ms FROM periods GROUP BY take",
    "p2_found": f"WITH {_spans('x')} SELECT take, slot, CASE WHEN absent <= {FILL} THEN 'filled' ELSE 'marked' END AS how FROM holes",
    "p2_grid": f"WITH {_grid('x', '(v1 - v0)')} SELECT take, slot, how, n_readings, round(increment, 12) AS increment, round(value, 12) AS value FROM grid",
    "p2_frames": f"WITH {_grid('frame_idx', '(CASE WHEN v1 < v0 THEN v1 ELSE v1 - v0 END)')} SELECT take, slot, how, n_resets, round(increment, 6) AS frames FROM grid",
    "p3_found": _DIFF,
    "p3_summary": f"SELECT table_name, field, kind, count(*) AS n FROM ({_DIFF}) GROUP BY ALL",
    "p6_found": _spike_sql(),
    "p6_hampel": """
WITH r AS (SELECT DISTINCT take, frame_idx, x FROM raw_keypoints WHERE keypoint_id = 0 AND detected AND x BETWEEN -1 AND 2),
w AS (SELECT *, list(x) OVER (PARTITION BY take ORDER BY frame_idx, x ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS win FROM r),
m AS (SELECT *, list_median(win) AS med FROM w),
d AS (SELECT *, list_median(list_transform(win, lambda v: abs(v - med))) AS mad FROM m)
SELECT take, frame_idx, x, round(med, 9) AS rolling_median, round(mad, 9) AS rolling_mad FROM d WHERE abs(x - med) > 3 * 1.4826 * mad""",
    "p6_hampel_series": f"""
WITH r AS (SELECT DISTINCT * FROM ({' UNION ALL '.join(f"SELECT take, keypoint_id, frame_idx, '{n}' AS field, CAST({n} AS DOUBLE) AS value FROM raw_keypoints WHERE detected AND {n} BETWEEN {lo} AND {hi}" + (" AND keypoint_id = 0" if n == "handedness_score" else "") for n, (lo, hi) in BOUNDS.items())})),
w AS (SELECT *, list(value) OVER (PARTITION BY take, keypoint_id, field ORDER BY frame_idx, value ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS win FROM r),
m AS (SELECT *, list_median(win) AS med FROM w),
d AS (SELECT *, list_median(list_transform(win, lambda v: abs(v - med))) AS mad FROM m)
SELECT take, keypoint_id, field, frame_idx, value, round(med, 9) AS rolling_median, round(mad, 9) AS rolling_mad FROM d WHERE abs(value - med) > 3 * 1.4826 * mad""",
}
