"""Queries of the engine's own operators over the motion tables and the star schema, each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phasemill.operators import relational as R
from phasemill.operators import signals as S
from phasemill.operators.metrics import boundaries, confusion, frame_metrics, label_frames
from phasemill.operators.parity import parity_check, parity_counts, same_rows
from phasemill.operators.quantiles import exact_quantiles
from phasemill.operators.reach import bounded_reach, neighbours, running_max
from phasemill.plans.governance import label_problems, label_template
from phasemill.plans.serving import accuracy_view, named, phase_columns, phases_view, serve_frames, signals_view
from phasemill.schemas import LABELS, PHASE_NAMES, PROTOCOL
from phasemill.session import missing, table

LABEL_LIST = ", ".join(f"'{x}'" for x in LABELS)
QUERIES, ORACLES = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def events(spark: SparkSession, d: str) -> DataFrame:
    """phase_events with rows repeated exactly counted once and labels spelled alike."""
    return table(spark, d, "phase_events").distinct().withColumn("label", F.upper(F.trim("label")))


def truth(spark: SparkSession, d: str) -> DataFrame:
    """Usable manual labels without overlap: of those that overlap, the one that starts first."""
    rows = table(spark, d, "label_segments").filter((F.col("source") == "manual") & ~missing(F.col("start_s")) & ~missing(F.col("end_s")) & (F.col("end_s") > F.col("start_s")))
    rows = rows.select(F.lower(F.trim("take")).alias("take"), "cycle", F.upper(F.trim("label")).alias("label"), "start_s", "end_s", "source").filter(F.col("label").isin(LABELS)).distinct()
    rows = running_max(rows.withColumn("__shard", F.floor(F.col("start_s") / 600)), ["take"], "__shard", ["start_s", "end_s", "label", "cycle"], "end_s", "__r").drop("__shard")
    return rows.filter(F.col("__r").isNull() | (F.col("start_s") >= F.col("__r") - 1e-9)).drop("__r")


EVENTS = "ev AS (SELECT DISTINCT * REPLACE (upper(trim(label)) AS label) FROM phase_events)"
TRUTH = f"""
t0 AS (SELECT DISTINCT lower(trim(take)) AS take, cycle, upper(trim(label)) AS label, start_s, end_s, source FROM label_segments
       WHERE source = 'manual' AND start_s IS NOT NULL AND end_s IS NOT NULL AND NOT isnan(start_s) AND NOT isnan(end_s) AND end_s > start_s AND upper(trim(label)) IN ({LABEL_LIST})),
t1 AS (SELECT *, max(end_s) OVER (PARTITION BY take ORDER BY start_s, end_s, label, cycle ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM t0),
truth AS (SELECT * EXCLUDE (r) FROM t1 WHERE r IS NULL OR start_s >= r - 1e-9)"""
KNOWN = "CASE WHEN isnan({0}) THEN NULL ELSE {0} END"
_CELLS = [(f"i{k}_{c}", k, c) for k in (0, 4, 8, 9) for c in "xy"] + [(f"w{k}_{c}", k, f"world_{c}") for k in (0, 4, 8, 9) for c in "xyz"]
FRAMES = "frames AS (SELECT take, frame_idx, " + ", ".join(f"max(CASE WHEN keypoint_id = {k} THEN {KNOWN.format(c)} END) AS {n}" for n, k, c in _CELLS) + f", max(timestamp_ms / 1000.0::DOUBLE) AS t, max(detected) AS detected, max(handedness) AS handedness, max({KNOWN.format('handedness_score')}) AS handedness_score FROM raw_keypoints WHERE keypoint_id IN (0, 4, 8, 9) GROUP BY take, frame_idx)"
SEGMENTS = "seg AS (SELECT *, start_s = max(start_s) OVER (PARTITION BY take) AS is_last FROM ev)"
LABEL_AT = "{p}.t >= {s}.start_s AND ({p}.t < {s}.end_s OR ({s}.is_last AND abs({p}.t - {s}.end_s) <= 1e-9 + 1e-5 * abs({s}.end_s)))"


# ---- serving queries and views ----
FOLLOWS = "list_contains([" + ", ".join(f"'{a}>{b}'" for a, b in PROTOCOL.items()) + "], {0} || '>' || {1})"
NAMED_SQL = {
    "q1_avg_duration_by_event_type": "SELECT take_group, label, count(*) AS n_events, round(sum(duration_s) / count(duration_s), 3) AS avg_duration_s, round(min(duration_s), 3) AS min_duration_s, round(max(duration_s), 3) AS max_duration_s FROM ev GROUP BY ALL",
    "q2_most_ambiguous_takes": """
SELECT take, take_group, n_events, s AS short_events, c AS low_confidence_events, b AS ambiguous_events, round(b / n_events, 3) AS ambiguous_share, avg_confidence,
       1 + (SELECT count(*) FROM t u WHERE u.b / u.n_events > t.b / t.n_events) AS ambiguity_rank FROM t""",
    "q3_time_between_consecutive_reaches": """
SELECT take, round(p, 3) AS previous_reach_start_s, round(start_s, 3) AS reach_start_s, round(start_s - p, 3) AS seconds_between_reaches
FROM (SELECT take, start_s, lag(start_s) OVER (PARTITION BY take ORDER BY start_s, event_idx) AS p FROM ev WHERE label = 'REACH') WHERE p IS NOT NULL""",
    "q4_phase_transitions": f"""
SELECT take_group, label AS from_label, nxt AS to_label, count(*) AS n_transitions, CASE WHEN {FOLLOWS.format("label", "nxt")} THEN 'yes' ELSE 'no' END AS follows_protocol_order
FROM (SELECT *, lead(label) OVER (PARTITION BY take ORDER BY event_idx) AS nxt FROM ev) WHERE nxt IS NOT NULL GROUP BY ALL""",
}
_PER_TAKE = "t AS (SELECT take, take_group, count(*) AS n_events, count(*) FILTER (duration_s < 0.3) AS s, count(*) FILTER (mean_confidence < 0.7) AS c, count(*) FILTER (duration_s < 0.3 OR mean_confidence < 0.7) AS b, round(avg(mean_confidence), 3) AS avg_confidence FROM ev GROUP BY ALL)"


def _named(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return named(name, events(spark, d))

    run.__name__ = name
    return run


for _name, _text in NAMED_SQL.items():
    query(f"WITH {EVENTS}, {_PER_TAKE} {_text}")(_named(_name))


def _samples(spark: SparkSession, d: str) -> DataFrame:
    """Frames as samples with detected phase, hand label and visibility; segments cut without overlap."""
    return label_frames(S.build_frames(table(spark, d, "raw_keypoints")), disjoint_events(spark, d), truth(spark, d), keep=["detected"])


def disjoint_events(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).filter(F.col("label").isNotNull()).select("take", "event_idx", "label", "start_s", "end_s")
    rows = neighbours(rows, ["take"], F.floor(F.col("start_s") / 600), ["start_s", "event_idx"], {"__next": ("start_s", 1)})
    return rows.withColumn("end_s", F.least("end_s", F.coalesce("__next", "end_s"))).filter("end_s > start_s").drop("__next")


DISJOINT = "dis AS (SELECT take, event_idx, label, start_s, e AS end_s FROM (SELECT take, event_idx, label, start_s, least(end_s, coalesce(lead(start_s) OVER (PARTITION BY take ORDER BY start_s, event_idx), end_s)) AS e FROM ev WHERE label IS NOT NULL) WHERE e > start_s)"
PAIRS = f"""{EVENTS}, {TRUTH}, {FRAMES}, {DISJOINT},
ps AS (SELECT *, start_s = max(start_s) OVER (PARTITION BY take) AS is_last FROM dis),
ts AS (SELECT *, start_s = max(start_s) OVER (PARTITION BY take) AS is_last FROM truth),
pairs AS (SELECT f.take, f.frame_idx, f.t, f.detected, p.label AS predicted_label, q.label AS true_label FROM frames f
          LEFT JOIN ps p ON f.take = p.take AND {LABEL_AT.format(p='f', s='p')} LEFT JOIN ts q ON f.take = q.take AND {LABEL_AT.format(p='f', s='q')} WHERE f.t IS NOT NULL)"""  # fmt: skip


@query(f"WITH {PAIRS} SELECT take, true_label AS label, count(*) AS n_samples, round(avg(CASE WHEN predicted_label = true_label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 3) AS agreement FROM pairs WHERE detected AND true_label IS NOT NULL GROUP BY take, true_label")
def q5_prediction_agreement_by_label(spark: SparkSession, d: str) -> DataFrame:
    samples = _samples(spark, d).select("take", "predicted_label", F.col("true_label").alias("ground_truth_label"), (~F.col("detected")).alias("missing"))
    return named("q5_prediction_agreement_by_label", samples)


PLACE = f"list_position([{LABEL_LIST}], {{0}})"
PHASE = "[" + ", ".join(f"'{x}'" for x in PHASE_NAMES.values()) + "][{0}]"
TAKE = "printf('Take %s (%s)', take[4:], take_group) AS take_label"


@query(f"WITH {EVENTS}, {TRUTH}, u AS (SELECT take, label, start_s, end_s, 'Detected' AS source FROM ev UNION ALL SELECT take, label, start_s, end_s, 'Hand-labelled' FROM truth), k AS (SELECT u.*, takes.take_group, CAST({PLACE.format('label')} AS INTEGER) AS phase_order FROM u JOIN takes USING (take)) SELECT take, {TAKE}, take_group, source, label, {PHASE.format('phase_order')} AS phase_name, phase_order, start_s, end_s, end_s - start_s AS duration_s FROM k")
def v_tableau_phases(spark: SparkSession, d: str) -> DataFrame:
    return phases_view(events(spark, d), truth(spark, d), table(spark, d, "takes"))


@query(f"WITH {PAIRS}, k AS (SELECT pairs.*, takes.take_group, CAST({PLACE.format('predicted_label')} AS INTEGER) AS phase_order FROM pairs JOIN takes USING (take)) SELECT take, {TAKE}, take_group, t AS t_s, predicted_label, {PHASE.format('phase_order')} AS phase_name, phase_order, NOT detected AS hand_not_visible FROM k")
def v_tableau_signals(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("double")
    samples = _samples(spark, d).select("take", F.col("t").alias("t_s"), none.alias("speed"), none.alias("aperture"), "predicted_label", (~F.col("detected")).alias("missing"))
    return signals_view(samples, table(spark, d, "takes")).drop("speed", "aperture")


@query(f"SELECT DISTINCT take, {TAKE}, take_group, round(frame_accuracy * 100, 1) AS percent_frames_matching_human_labels FROM scores_full WHERE scope = 'all'")
def v_tableau_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return accuracy_view(table(spark, d, "scores_full").distinct()).distinct()


# ---- pivots, islands, interval joins ----
@query(f"WITH {FRAMES} SELECT * FROM frames")
def frames_pivot(spark: SparkSession, d: str) -> DataFrame:
    return S.build_frames(table(spark, d, "raw_keypoints"))


@query("SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_extendedprice END) AS price_1, max(CASE WHEN l_linenumber = 2 THEN l_extendedprice END) AS price_2, max(CASE WHEN l_linenumber = 3 THEN l_extendedprice END) AS price_3, max(l_shipdate) AS last_ship FROM lineitem WHERE l_linenumber IN (1, 2, 3) GROUP BY l_orderkey")
def cond_pivot(spark: SparkSession, d: str) -> DataFrame:
    return R.conditional_pivot(table(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber", [1, 2, 3], {"price_{}": "l_extendedprice"}, [F.max("l_shipdate").alias("last_ship")])


@query(f"WITH {FRAMES} SELECT take, frame_idx, t AS t_s, detected, i0_x AS wrist_x, i0_y AS wrist_y, i4_x AS thumb_tip_x, i4_y AS thumb_tip_y, i8_x AS index_tip_x, i8_y AS index_tip_y, handedness, handedness_score FROM frames")
def serving_frames(spark: SparkSession, d: str) -> DataFrame:
    return serve_frames(S.build_frames(table(spark, d, "raw_keypoints")))


ISLANDS = """
r AS (SELECT user_id, event_type, value, epoch_us(ts) AS o, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rn, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
i AS (SELECT *, sum(CASE WHEN event_type IS NOT DISTINCT FROM before AND rn > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY o ROWS UNBOUNDED PRECEDING) - 1 AS island FROM r),
g AS (SELECT user_id, CAST(island AS BIGINT) AS island, min_by(event_type, o) AS label, min(o) AS first, max(o) AS last, count(*) AS n, count(DISTINCT event_type) AS labels_in_island, sum(value) AS total FROM i GROUP BY user_id, island)"""


def _user_islands(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events").select("user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("o"))
    return R.islands(ev, ["user_id"], "o", "event_type", F.floor(F.col("o") / 86_400_000_000), {"total": F.sum("value")})


@query(f"WITH {ISLANDS} SELECT user_id, island, label, first, last, n, labels_in_island, round(total, 4) AS total, lead(first) OVER (PARTITION BY user_id ORDER BY island) AS next_first FROM g")
def islands(spark: SparkSession, d: str) -> DataFrame:
    return _user_islands(spark, d).withColumn("total", F.round("total", 4))


@query(f"WITH {ISLANDS}, f AS (SELECT *, n >= 2 OR island = 0 AS keep FROM g) SELECT user_id, island, label, last_value(CASE WHEN keep THEN label END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY island ROWS UNBOUNDED PRECEDING) AS absorbed FROM f")
def run_absorb(spark: SparkSession, d: str) -> DataFrame:
    return R.absorb_short_runs(_user_islands(spark, d), ["user_id"], "island", "label", "n", 2).select("user_id", "island", "label", "absorbed")


@query(f"WITH {EVENTS}, {FRAMES}, {SEGMENTS} SELECT f.take, f.frame_idx, s.label, s.event_idx FROM frames f LEFT JOIN seg s ON f.take = s.take AND {LABEL_AT.format(p='f', s='s')} WHERE f.t IS NOT NULL")
def range_label_left(spark: SparkSession, d: str) -> DataFrame:
    seg = R.with_last_flag(events(spark, d).select("take", "event_idx", "label", "start_s", "end_s"), ["take"], "start_s")
    points = S.build_frames(table(spark, d, "raw_keypoints")).select("take", "frame_idx", "t").filter(F.col("t").isNotNull())
    return R.range_join(points, seg, ["take"], "t").select("take", "frame_idx", "label", "event_idx")


@query(f"""WITH {EVENTS}, {FRAMES}, s AS (SELECT *, event_idx = max(event_idx) OVER (PARTITION BY take) AS is_last FROM ev)
SELECT s.take, s.event_idx, count(*) AS n_frames, round(sum(f.handedness_score), 8) AS total_score, round(avg(CASE WHEN f.detected THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END), 6) AS frac_missing
FROM frames f JOIN s ON f.take = s.take AND f.t >= s.start_s AND (f.t < s.end_s OR (s.is_last AND f.t <= s.end_s + 1e-9)) GROUP BY s.take, s.event_idx""")  # fmt: skip
def range_event_inner(spark: SparkSession, d: str) -> DataFrame:
    seg = R.with_last_flag(events(spark, d).select("take", "event_idx", "start_s", "end_s"), ["take"], "event_idx")
    points = S.build_frames(table(spark, d, "raw_keypoints")).select("take", "t", "detected", "handedness_score").filter(F.col("t").isNotNull())
    held = R.range_join(points, seg, ["take"], "t", relative=False, how="inner")
    return held.groupBy("take", "event_idx").agg(F.count(F.lit(1)).alias("n_frames"), F.round(F.sum("handedness_score"), 8).alias("total_score"), F.round(F.avg((~F.col("detected")).cast("double")), 6).alias("frac_missing"))


@query(f"""WITH {FRAMES}, auto AS (SELECT lower(trim(take)) AS take, start_s - 1e-9 AS a, end_s - 1e-9 AS b FROM label_segments WHERE source = 'auto' AND start_s IS NOT NULL AND end_s IS NOT NULL AND NOT isnan(start_s) AND NOT isnan(end_s))
SELECT take, frame_idx, EXISTS (SELECT 1 FROM auto WHERE auto.take = f.take AND f.t >= a AND f.t < b) AS inside FROM frames f WHERE t IS NOT NULL""")  # fmt: skip
def range_semi(spark: SparkSession, d: str) -> DataFrame:
    spans = table(spark, d, "label_segments").filter((F.col("source") == "auto") & ~missing(F.col("start_s")) & ~missing(F.col("end_s"))).withColumn("take", F.lower(F.trim("take")))
    points = S.build_frames(table(spark, d, "raw_keypoints")).select("take", "frame_idx", "t").filter(F.col("t").isNotNull())
    return R.in_intervals(points, spans, ["take"], "t", "inside").select("take", "frame_idx", "inside")


@query(f"""WITH {TRUTH}, {FRAMES}, s AS (SELECT *, start_s = max(start_s) OVER (PARTITION BY take) AS is_last FROM truth)
SELECT f.take, f.frame_idx, CASE WHEN f.t < s.end_s OR (s.is_last AND abs(f.t - s.end_s) <= 1e-9 + 1e-5 * abs(s.end_s)) THEN s.label END AS label_at
FROM (SELECT * FROM frames WHERE t IS NOT NULL) f ASOF LEFT JOIN s ON f.take = s.take AND f.t >= s.start_s""")  # fmt: skip
def asof_label(spark: SparkSession, d: str) -> DataFrame:
    seg = R.with_last_flag(truth(spark, d), ["take"], "start_s")
    points = S.build_frames(table(spark, d, "raw_keypoints")).select("take", "frame_idx", "t").filter(F.col("t").isNotNull())
    return R.asof_label(points, seg, ["take"], "t").select("take", "frame_idx", "label_at")


@query("WITH r AS (SELECT DISTINCT take, frame_idx, timestamp_ms AS ts FROM raw_keypoints WHERE timestamp_ms IS NOT NULL), n AS (SELECT *, row_number() OVER (PARTITION BY take ORDER BY frame_idx) AS i FROM r) SELECT take, frame_idx, ts, CAST(max(ts - i) OVER (PARTITION BY take ORDER BY frame_idx ROWS UNBOUNDED PRECEDING) + i AS BIGINT) AS strict_ms FROM n")
def monotone_ts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "raw_keypoints").filter(F.col("timestamp_ms").isNotNull()).select("take", "frame_idx", F.col("timestamp_ms").alias("ts")).distinct()
    return R.strictly_increasing(rows, ["take"], "frame_idx", "ts", "strict_ms", F.floor(F.col("frame_idx") / 4096))


LOST = "lost AS (SELECT DISTINCT take, frame_idx FROM (SELECT take, frame_idx, max(detected) AS seen FROM raw_keypoints GROUP BY take, frame_idx) WHERE NOT seen), runs AS (SELECT take, min(frame_idx) AS first, max(frame_idx) AS last, count(*) AS n FROM (SELECT *, frame_idx - row_number() OVER (PARTITION BY take ORDER BY frame_idx) AS g FROM lost) GROUP BY take, g)"


@query(f"WITH {LOST} SELECT take, CAST(sum(n) AS BIGINT) AS n_lost, CAST(coalesce(sum(CASE WHEN n >= 3 THEN n END), 0) AS BIGINT) AS n_sustained, coalesce(string_agg(CASE WHEN n >= 3 THEN first || '-' || last END, '; ' ORDER BY first), '') AS sustained_runs FROM runs GROUP BY take")
def dropout_report(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "raw_keypoints").groupBy("take", "frame_idx").agg(F.max("detected").alias("seen"))
    return R.dropout_report(R.dropout_runs(seen, ["take"], "frame_idx", ~F.col("seen")), ["take"])


# ---- aggregates ----
@query(f"WITH {PAIRS} SELECT take, count(*) FILTER (predicted_label IS NOT NULL AND true_label IS NOT NULL) AS n_frames, count(*) FILTER (predicted_label IS NULL OR true_label IS NULL) AS n_unlabelled, round(avg(CASE WHEN predicted_label IS NOT NULL AND true_label IS NOT NULL THEN CAST(predicted_label = true_label AS DOUBLE) END), 6) AS frame_accuracy, " + ", ".join(f"round(avg(CASE WHEN predicted_label IS NOT NULL AND true_label = '{x}' THEN CAST(predicted_label = true_label AS DOUBLE) END), 6) AS acc_{x}, count(*) FILTER (predicted_label IS NOT NULL AND true_label = '{x}') AS n_{x}" for x in LABELS) + " FROM pairs GROUP BY take")
def frame_scores(spark: SparkSession, d: str) -> DataFrame:
    out = frame_metrics(_samples(spark, d), ["take"])
    return out.select("take", "n_frames", "n_unlabelled", F.round("frame_accuracy", 6).alias("frame_accuracy"), *[c for x in LABELS for c in (F.round(f"acc_{x}", 6).alias(f"acc_{x}"), f"n_{x}")])


@query(f"WITH {PAIRS}, per AS (SELECT take, true_label, count(*) AS n, avg(CAST(predicted_label = true_label AS DOUBLE)) AS acc FROM pairs WHERE predicted_label IS NOT NULL AND true_label IS NOT NULL GROUP BY ALL) SELECT take, round(avg(acc), 6) AS balanced_accuracy, round(CAST(max(n) AS DOUBLE) / sum(n), 6) AS majority_baseline FROM per GROUP BY take")
def label_scores(spark: SparkSession, d: str) -> DataFrame:
    out = frame_metrics(_samples(spark, d), ["take"]).filter("n_frames > 0")
    return out.select("take", F.round("balanced_accuracy", 6).alias("balanced_accuracy"), F.round("majority_baseline", 6).alias("majority_baseline"))


@query(f"WITH {PAIRS} SELECT l.true_label, " + ", ".join(f"count(*) FILTER (p.predicted_label = '{x}') AS {x}" for x in LABELS) + f" FROM (SELECT unnest([{LABEL_LIST}]) AS true_label) l LEFT JOIN pairs p ON p.true_label = l.true_label GROUP BY l.true_label")
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return confusion(_samples(spark, d).filter("true_label IS NOT NULL AND predicted_label IS NOT NULL").select("true_label", "predicted_label"))


@query(f"WITH {EVENTS} SELECT take, string_agg(label || '@' || CAST(event_idx AS VARCHAR), ',' ORDER BY start_s, event_idx) AS phases, count(*) AS n FROM ev WHERE label IS NOT NULL GROUP BY take")
def nested_collect(spark: SparkSession, d: str) -> DataFrame:
    arr = F.array_sort(F.collect_list(F.struct("start_s", "event_idx", "label")))
    per = events(spark, d).filter("label IS NOT NULL").groupBy("take").agg(arr.alias("items"))
    return per.select("take", F.array_join(F.transform("items", lambda x: F.concat(x["label"], F.lit("@"), x["event_idx"].cast("string"))), ",").alias("phases"), F.size("items").cast("long").alias("n"))


@query(f"WITH {TRUTH} SELECT take, cycle, min(start_s) AS a, max(end_s) AS z, count(*) AS n FROM truth GROUP BY take, cycle")
def cycle_spans(spark: SparkSession, d: str) -> DataFrame:
    return truth(spark, d).groupBy("take", "cycle").agg(F.min("start_s").alias("a"), F.max("end_s").alias("z"), F.count(F.lit(1)).alias("n"))


@query("SELECT take, count(DISTINCT frame_idx) AS n_frames, count(DISTINCT CASE WHEN NOT detected THEN frame_idx END) AS n_lost, count(DISTINCT CASE WHEN handedness = 'Left' THEN frame_idx END) AS n_left FROM raw_keypoints GROUP BY take")
def take_counts(spark: SparkSession, d: str) -> DataFrame:
    # one row per frame first, so that no distinct count has to expand the rows
    per = table(spark, d, "raw_keypoints").groupBy("take", "frame_idx").agg(F.max((~F.col("detected")).cast("int")).alias("l"), F.max((F.col("handedness") == "Left").cast("int")).alias("h"))
    return per.groupBy("take").agg(F.count(F.lit(1)).alias("n_frames"), F.coalesce(F.sum("l"), F.lit(0)).cast("long").alias("n_lost"), F.coalesce(F.sum("h"), F.lit(0)).cast("long").alias("n_left"))


@query(f"WITH {EVENTS}, c AS (SELECT label, count(*) AS n FROM ev WHERE label IS NOT NULL GROUP BY label) SELECT label, n, round(CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n), 9) AS weight FROM c")
def class_weights(spark: SparkSession, d: str) -> DataFrame:
    rows = R.class_weights(events(spark, d).filter("label IS NOT NULL").select("label"), "label")
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("weight"), 9).alias("weight"))


@query(f"WITH {FRAMES}, h AS (SELECT take, sqrt(pow((i0_x - i9_x) * 1920, 2) + pow((i0_y - i9_y) * 1080, 2)) AS v FROM frames WHERE detected AND t IS NOT NULL), k AS (SELECT * FROM h WHERE v < CAST('inf' AS DOUBLE)) SELECT take, count(*) AS n, round(quantile_cont(v, 0.5), 6) AS hand_px, round(quantile_cont(v, 0.9), 6) AS far_px FROM k GROUP BY take")
def quantile_home_far(spark: SparkSession, d: str) -> DataFrame:
    native = S.native_channels(S.build_frames(table(spark, d, "raw_keypoints")))
    parts = native.groupBy("take", F.floor(F.col("frame_idx") / 4096).alias("s")).agg(F.collect_list("hand").alias("values"))
    mid = exact_quantiles(parts, ["take"], "values", 0.5).select("take", "n", F.round("quantile", 6).alias("hand_px"))
    return mid.join(exact_quantiles(parts, ["take"], "values", 0.9).select("take", F.round("quantile", 6).alias("far_px")), "take")


# ---- windows over ordered rows ----
WRIST = "w AS (SELECT take, frame_idx, min(x) AS v FROM raw_keypoints WHERE keypoint_id = 0 AND detected AND x BETWEEN -1 AND 2 GROUP BY take, frame_idx), o AS (SELECT *, row_number() OVER (PARTITION BY take ORDER BY frame_idx) - 1 AS i, count(*) OVER (PARTITION BY take) - 1 AS z FROM w)"


def _wrist_series(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "raw_keypoints").filter((F.col("keypoint_id") == 0) & F.col("detected") & F.col("x").between(-1, 2)).groupBy("take", "frame_idx").agg(F.min("x").alias("v"))
    return rows.withColumn("shard", F.floor(F.col("frame_idx") / 4096))


def _frames_sql() -> str:
    mean = ", ".join(f"round(avg(v) OVER (PARTITION BY take ORDER BY frame_idx ROWS BETWEEN {n} PRECEDING AND {n} FOLLOWING), 12) AS m{n}" for n in S.MEAN_WINDOWS)
    trend = ", ".join(f"round(avg(v) OVER (PARTITION BY take ORDER BY frame_idx ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) - avg(v) OVER (PARTITION BY take ORDER BY frame_idx ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 12) AS trend{n}" for n in S.TREND_WINDOWS)
    rest = "max(v) OVER (PARTITION BY take ORDER BY frame_idx ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING) AS max8, round(coalesce(stddev_samp(v) OVER (PARTITION BY take ORDER BY frame_idx ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING), 0), 7) AS std8, min(v) OVER (PARTITION BY take ORDER BY frame_idx ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING) AS min20"
    return f"WITH {WRIST} SELECT take, frame_idx, {mean}, {trend}, {rest} FROM w"


@query(_frames_sql())
def rolling_features(spark: SparkSession, d: str) -> DataFrame:
    def rolled(part: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy("frame_idx")
        out = {f"m{n}": F.round(F.avg("v").over(w.rowsBetween(-n, n)), 12) for n in S.MEAN_WINDOWS}
        out |= {f"trend{n}": F.round(F.avg("v").over(w.rowsBetween(0, n - 1)) - F.avg("v").over(w.rowsBetween(1 - n, 0)), 12) for n in S.TREND_WINDOWS}
        return part.withColumns(out | {"max8": F.max("v").over(w.rowsBetween(-8, 8)), "std8": F.round(F.coalesce(F.stddev_samp("v").over(w.rowsBetween(-8, 8)), F.lit(0.0)), 7), "min20": F.min("v").over(w.rowsBetween(-20, 20))})

    return bounded_reach(_wrist_series(spark, d), ["take"], "shard", ["frame_idx"], 45, rolled).drop("shard", "v")


def _savgol_sql(window: int, derivative: int) -> str:
    half, dt = window // 2, 1 / 30
    weights = S.savgol_weights(window, 2, derivative, dt)
    shift = lambda k: f"lead(v, {k}) OVER x" if k > 0 else f"lag(v, {-k}) OVER x" if k < 0 else "v"
    total = lambda row, own: " + ".join(f"CAST({float(weights[row, j])!r} AS DOUBLE) * {shift(j - own)}" for j in range(window))
    cases = " ".join(f"WHEN i = {r} THEN {total(r, r)} WHEN z - i = {r} THEN {total(window - 1 - r, window - 1 - r)}" for r in range(half))
    return f"WITH {WRIST} SELECT take, frame_idx, round(CASE WHEN z < {window - 1} THEN NULL {cases} ELSE {total(half, half)} END, 8) AS smooth FROM o WINDOW x AS (PARTITION BY take ORDER BY frame_idx)"


def _savgol_query(window: int, derivative: int):
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = R.positioned(_wrist_series(spark, d), ["take"], ["frame_idx"], "i", F.col("shard"))
        rows = rows.join(rows.groupBy("take").agg(F.max("i").alias("z")), "take")
        out = S.savgol(rows, ["take"], "i", "z", {"smooth": ("v", derivative)}, window, F.floor(F.col("i") / 4096), 1 / 30)
        return out.select("take", "frame_idx", F.round("smooth", 8).alias("smooth"))

    run.__name__ = f"savgol{window}" + "_deriv" * derivative
    return run


for _w, _d in ((5, 0), (5, 1), (7, 0), (7, 1)):
    query(_savgol_sql(_w, _d))(_savgol_query(_w, _d))

GAPS = f"""g0 AS (SELECT take, frame_idx, max(timestamp_ms / 1000.0::DOUBLE) AS t, max(CASE WHEN keypoint_id = 0 AND detected THEN {KNOWN.format('x')} END) AS v FROM raw_keypoints WHERE keypoint_id IN (0, 4, 8, 9) GROUP BY take, frame_idx),
g AS (SELECT * FROM g0 WHERE t IS NOT NULL),
n AS (SELECT *, lag(v, 2) OVER w AS v0, lag(v) OVER w AS v1, lead(v) OVER w AS v2, lead(v, 2) OVER w AS v3, lag(t, 2) OVER w AS a0, lag(t) OVER w AS a1, lead(t) OVER w AS a2, lead(t, 2) OVER w AS a3 FROM g WINDOW w AS (PARTITION BY take ORDER BY frame_idx))"""


@query(f"""WITH {GAPS} SELECT take, frame_idx, round(coalesce(v, CASE WHEN v1 IS NOT NULL AND v2 IS NOT NULL THEN v1 + (v2 - v1) * (t - a1) / nullif(a2 - a1, 0)
  WHEN v0 IS NOT NULL AND v2 IS NOT NULL AND v1 IS NULL THEN v0 + (v2 - v0) * (t - a0) / nullif(a2 - a0, 0)
  WHEN v1 IS NOT NULL AND v3 IS NOT NULL AND v2 IS NULL THEN v1 + (v3 - v1) * (t - a1) / nullif(a3 - a1, 0) END), 9) AS filled FROM n""")  # fmt: skip
def short_gap_fill(spark: SparkSession, d: str) -> DataFrame:
    frames = S.build_frames(table(spark, d, "raw_keypoints")).filter("t IS NOT NULL").select("take", "frame_idx", "t", F.when(F.col("detected"), F.col("i0_x")).alias("v"))
    return R.fill_short_gaps(frames, ["take"], "frame_idx", "t", ["v"], F.floor(F.col("frame_idx") / 4096)).select("take", "frame_idx", F.round("v_filled", 9).alias("filled"))


@query(f"""WITH k AS (SELECT take, timestamp_ms / 1000.0::DOUBLE AS t, min(x) AS v FROM raw_keypoints WHERE keypoint_id = 0 AND detected AND x BETWEEN -1 AND 2 AND timestamp_ms IS NOT NULL GROUP BY ALL),
b AS (SELECT take, min(t) AS t0, max(t) AS t1 FROM k GROUP BY take), n AS (SELECT *, lead(t) OVER w AS nt, lead(v) OVER w AS nv FROM k WINDOW w AS (PARTITION BY take ORDER BY t)),
g AS (SELECT take, CAST(i AS BIGINT) AS sample_idx, t0 + i / 30.0::DOUBLE AS g FROM (SELECT take, t0, unnest(generate_series(0, CAST(floor((t1 - t0 + 1e-9) * 30) AS BIGINT))) AS i FROM b)),
p AS (SELECT g.take, g.sample_idx, g.g, n.t, n.v, n.nt, n.nv FROM g ASOF LEFT JOIN n ON g.take = n.take AND g.g >= n.t)
SELECT take, sample_idx, round(CASE WHEN g = t THEN v WHEN nt - t <= {3.5 / 30!r} THEN v + (nv - v) * (g - t) / (nt - t) END, 12) AS v FROM p""")  # fmt: skip
def resample_grid(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "raw_keypoints").filter((F.col("keypoint_id") == 0) & F.col("detected") & F.col("x").between(-1, 2) & F.col("timestamp_ms").isNotNull()).groupBy("take", (F.col("timestamp_ms") / 1000.0).alias("t")).agg(F.min("x").alias("v"))
    bounds = S.bounds_of(k)
    out = S.grid_of(bounds).join(S.resample(k, bounds, ["v"]), ["take", "sample_idx"], "left")
    return out.select("take", "sample_idx", F.round("v", 12).alias("v"))


# ---- governance, parity, sets ----
@query("""WITH a AS (SELECT DISTINCT * FROM phase_events), b AS (SELECT DISTINCT * EXCLUDE (published_at) FROM phase_events_wh)
SELECT count(a.take) AS n_expected, count(*) FILTER (b.take IS NULL) AS n_missing, count(*) FILTER (a.take IS NULL) AS n_extra,
 count(*) FILTER (a.take IS NOT NULL AND b.take IS NOT NULL AND a.label IS DISTINCT FROM b.label) AS diff_label,
 count(*) FILTER (a.take IS NOT NULL AND b.take IS NOT NULL AND ((a.mean_confidence IS NULL) <> (b.mean_confidence IS NULL) OR coalesce(abs(a.mean_confidence - b.mean_confidence) > 1e-6, false))) AS diff_mean_confidence
FROM a FULL JOIN b ON a.take = b.take AND a.event_idx = b.event_idx""")  # fmt: skip
def parity_counts_events(spark: SparkSession, d: str) -> DataFrame:
    cols = ["take", "event_idx", "label", "mean_confidence"]
    a, b = (table(spark, d, n).distinct() if n == "phase_events" else table(spark, d, n).drop("published_at").distinct() for n in ("phase_events", "phase_events_wh"))
    return parity_counts(a.select(*cols), b.select(*cols), ["take", "event_idx"], {"MEAN_CONFIDENCE": 1e-6})


@query(None)
def parity_checks(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "scores_full").distinct(), table(spark, d, "scores_full_wh").drop("published_at").distinct()
    floats = {f.name: 1e-12 for f in a.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return parity_check("scores", a, b, ["take", "scope"], floats).unionByName(parity_check("scores with itself", a, a, ["take", "scope"], floats))


@query("""WITH a AS (SELECT take, start_s, row_number() OVER (PARTITION BY take ORDER BY start_s NULLS FIRST, event_idx) - 1 AS position FROM (SELECT DISTINCT * FROM phase_events)),
b AS (SELECT take, start_s, row_number() OVER (PARTITION BY take ORDER BY start_s NULLS FIRST, event_idx) - 1 AS position FROM (SELECT DISTINCT * EXCLUDE (published_at) FROM phase_events_wh))
SELECT a.take, count(*) AS n, count(*) FILTER (b.take IS NULL) AS n_missing, count(*) FILTER (abs(a.start_s - b.start_s) > 1e-9) AS n_differ FROM a LEFT JOIN b ON a.take = b.take AND a.position = b.position GROUP BY a.take""")  # fmt: skip
def positional_parity(spark: SparkSession, d: str) -> DataFrame:
    a = R.positioned(table(spark, d, "phase_events").distinct(), ["take"], ["start_s", "event_idx"], shard=F.floor(F.col("start_s") / 600)).select("take", "position", "start_s")
    b = R.positioned(table(spark, d, "phase_events_wh").drop("published_at").distinct(), ["take"], ["start_s", "event_idx"], shard=F.floor(F.col("start_s") / 600)).select("take", "position", F.col("start_s").alias("other"), F.lit(1).alias("met"))
    return a.join(b, ["take", "position"], "left").groupBy("take").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("met").isNull()).alias("n_missing"), F.count_if(F.abs(F.col("start_s") - F.col("other")) > 1e-9).alias("n_differ"))


@query("WITH a AS (SELECT take, event_idx, label FROM phase_events), b AS (SELECT take, event_idx, label FROM phase_events_wh) SELECT side, count(*) AS n FROM (SELECT 'left' AS side, * FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT 'right', * FROM (FROM b EXCEPT ALL FROM a)) GROUP BY side")
def except_parity(spark: SparkSession, d: str) -> DataFrame:
    cols = ["take", "event_idx", "label"]
    return same_rows(table(spark, d, "phase_events").select(*cols), table(spark, d, "phase_events_wh").select(*cols)).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {TRUTH}, l AS (SELECT *, lag(end_s) OVER w AS before, row_number() OVER w = 1 AS first FROM truth WINDOW w AS (PARTITION BY take ORDER BY start_s)),
p AS (SELECT l.take, sum(CASE WHEN abs(start_s - before) > 1e-6 THEN 1 ELSE 0 END) AS c, sum(CASE WHEN first AND abs(start_s) > 1e-3 THEN 1 ELSE 0 END) AS z, max(end_s) AS e, max(t.duration_s) AS dur FROM l LEFT JOIN takes t ON t.take = l.take GROUP BY l.take)
SELECT take, 'not contiguous' AS problem, CAST(c AS BIGINT) AS n FROM p WHERE c > 0 UNION ALL SELECT take, 'does not start at 0', CAST(z AS BIGINT) FROM p WHERE z > 0
UNION ALL SELECT take, 'last end is not the last frame', 1 FROM p WHERE coalesce(abs(e - dur) > 1e-3, true)""")  # fmt: skip
def label_validation(spark: SparkSession, d: str) -> DataFrame:
    return label_problems(truth(spark, d), table(spark, d, "takes").select("take", F.col("duration_s").alias("last_s")))


@query("SELECT 'new' AS take, CASE WHEN i = 0 THEN 1 ELSE CAST((i - 1) // 6 + 1 AS INTEGER) END AS cycle, CASE WHEN i = 0 THEN 'REST' ELSE ['REACH', 'GRASP', 'HOLD', 'RELEASE', 'RETRACT', 'REST'][(i - 1) % 6 + 1] END AS label FROM range(19) r(i)")
def template(spark: SparkSession, d: str) -> DataFrame:
    return label_template(spark, "new", 3).select("take", "cycle", "label")


@query(f"WITH {EVENTS}, {TRUTH} SELECT take, 'unknown to takes' AS kind FROM (SELECT take FROM truth EXCEPT SELECT take FROM takes) UNION ALL SELECT take, 'labelled and detected' FROM (SELECT take FROM truth INTERSECT SELECT take FROM ev)")
def set_ops(spark: SparkSession, d: str) -> DataFrame:
    t, e = truth(spark, d).select("take"), events(spark, d).select("take")
    return t.subtract(table(spark, d, "takes").select("take")).withColumn("kind", F.lit("unknown to takes")).unionByName(t.intersect(e).withColumn("kind", F.lit("labelled and detected")))


@query(f"WITH {EVENTS}, u AS (SELECT take, 'Detected' AS source, label, start_s FROM ev UNION ALL SELECT take, 'Hand-labelled', label, start_s FROM truth), {TRUTH} SELECT source, label, count(*) AS n, round(min(start_s), 6) AS first_s FROM u GROUP BY ALL")
def union_sources(spark: SparkSession, d: str) -> DataFrame:
    a = events(spark, d).select("take", F.lit("Detected").alias("source"), "label", "start_s")
    b = truth(spark, d).select("take", F.lit("Hand-labelled").alias("source"), "label", "start_s")
    return a.unionByName(b).groupBy("source", "label").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("start_s"), 6).alias("first_s"))


ORACLES["union_sources"] = f"WITH {EVENTS}, {TRUTH}, u AS (SELECT take, 'Detected' AS source, label, start_s FROM ev UNION ALL SELECT take, 'Hand-labelled', label, start_s FROM truth) SELECT source, label, count(*) AS n, round(min(start_s), 6) AS first_s FROM u GROUP BY ALL"


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def topk(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(5).select("o_orderkey", "o_totalprice")


@query("SELECT event_type, count(*) AS n, CAST(sum(coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0)) AS BIGINT) AS k_total FROM events GROUP BY event_type")
def json_struct(spark: SparkSession, d: str) -> DataFrame:
    parsed = table(spark, d, "events").withColumn("p", F.from_json("props", T.StructType([T.StructField("k", T.LongType())])))
    return parsed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("p.k", F.lit(0))).alias("k_total"))


@query(f"WITH {EVENTS} SELECT take, event_idx, CASE label WHEN 'REST' THEN 'At rest' WHEN 'REACH' THEN 'Reaching' WHEN 'GRASP' THEN 'Grasping' WHEN 'HOLD' THEN 'Holding' WHEN 'RELEASE' THEN 'Releasing' WHEN 'RETRACT' THEN 'Returning' END AS phase_name, CAST(list_position([{LABEL_LIST}], label) AS INTEGER) AS phase_order FROM ev")
def map_lookup(spark: SparkSession, d: str) -> DataFrame:
    out = events(spark, d).select("take", "event_idx", *phase_columns(F.col("label")))
    return out


@query(f"WITH {EVENTS}, p AS (SELECT take, label, lead(label) OVER (PARTITION BY take ORDER BY event_idx) AS nxt FROM ev WHERE label IS NOT NULL) SELECT take, count(*) AS n, count(*) FILTER (label || '>' || nxt NOT IN ({', '.join(repr(f'{a}>{b}') for a, b in PROTOCOL.items())})) AS n_off FROM p WHERE nxt IS NOT NULL GROUP BY take")
def protocol_transitions(spark: SparkSession, d: str) -> DataFrame:
    p = neighbours(events(spark, d).filter("label IS NOT NULL"), ["take"], F.floor(F.col("event_idx") / 4096), ["event_idx"], {"nxt": ("label", 1)}).filter("nxt IS NOT NULL")
    return p.groupBy("take").agg(F.count(F.lit(1)).alias("n"), F.count_if(R.lookup(PROTOCOL, F.col("label")) != F.col("nxt")).alias("n_off"))


@query(f"WITH {TRUTH} SELECT take || 'x' || CAST(CAST(f AS DOUBLE) AS VARCHAR) AS take, label, round(start_s / f, 9) AS start_s, round(end_s / f, 9) AS end_s FROM truth, (SELECT unnest([1.0, 1.5, 2.0, 3.0]) AS f)")
def augment(spark: SparkSession, d: str) -> DataFrame:
    _, labels = S.time_scaled(S.build_frames(table(spark, d, "raw_keypoints")), truth(spark, d), [1.0, 1.5, 2.0, 3.0])
    return labels.select("take", "label", F.round("start_s", 9).alias("start_s"), F.round("end_s", 9).alias("end_s"))


@query("WITH old AS (SELECT source AS version, take, start_s FROM label_segments WHERE take IS NOT NULL), fresh AS (SELECT 'auto' AS version, take, start_s FROM phase_events) SELECT version, count(*) AS n FROM (SELECT * FROM old WHERE version IS NULL OR version NOT IN ('auto') UNION ALL SELECT * FROM fresh) GROUP BY version")
def history_replace(spark: SparkSession, d: str) -> DataFrame:
    old = table(spark, d, "label_segments").filter("take IS NOT NULL").select(F.col("source").alias("version"), "take", "start_s")
    fresh = table(spark, d, "phase_events").select(F.lit("auto").alias("version"), "take", "start_s")
    return R.replace_version(old, fresh, "version").groupBy("version").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {EVENTS} SELECT take, round(start_s, 9) AS b FROM (SELECT take, start_s, min(start_s) OVER (PARTITION BY take) AS f FROM ev) WHERE start_s > f")
def boundary_list(spark: SparkSession, d: str) -> DataFrame:
    return boundaries(events(spark, d)).select("take", F.round("b", 9).alias("b"))


@query("SELECT count(*) FILTER (x IS NULL OR isnan(x)) AS null_x, count(*) FILTER (handedness_score IS NULL OR isnan(handedness_score)) AS null_score, round(sum(CASE WHEN x BETWEEN -1 AND 2 THEN x END), 3) AS sum_x FROM raw_keypoints")
def nan_to_null(spark: SparkSession, d: str) -> DataFrame:
    rows = R.nan_to_null(table(spark, d, "raw_keypoints"))
    return rows.agg(F.count_if(F.col("x").isNull()).alias("null_x"), F.count_if(F.col("handedness_score").isNull()).alias("null_score"), F.round(F.sum(F.when(F.col("x").between(-1, 2), F.col("x"))), 3).alias("sum_x"))
