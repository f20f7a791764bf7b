"""Queries of sources, sinks, serving tables, parity checks and governance, each with its DuckDB twin."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasemill.operators.parity import normalised, parity_counts, table_checks
from phasemill.plans import governance as V
from phasemill.plans.catalogue import EVENTS, TRUTH, disjoint_events, events, truth
from phasemill.plans.quality import PHASE_FIELDS, SCORE_FIELDS
from phasemill.plans.serving import run_sql, same_answers, serve_ground_truth, serve_raw_keypoints, serve_takes
from phasemill.schemas import GROUND_TRUTH, LABELS, OUT_OF_FRAME, RAW_KEYPOINTS
from phasemill.session import materialize, missing, scratch, table
from phasemill.sources import landing, sinks

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _meta(spark: SparkSession, d: str) -> DataFrame:
    """The takes table in the form of the extraction's metadata."""
    t = table(spark, d, "takes")
    counts = F.struct((F.col("n_frames") - F.col("left_handedness_frames")).alias("Right"), F.col("left_handedness_frames").alias("Left"))
    return t.select("take", F.col("n_frames").alias("frames_extracted"), F.lit(30.0).alias("nominal_fps"), F.col("duration_s").alias("last_timestamp_s"), F.col("mean_fps").alias("mean_fps_from_timestamps"), "frames_not_detected", "fraction_not_detected", counts.alias("handedness_counts"))


_AWAY = "source = 'auto' AND start_s IS NOT NULL AND end_s IS NOT NULL AND NOT isnan(start_s) AND NOT isnan(end_s)"


def _away(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "label_segments").filter((F.col("source") == "auto") & ~missing(F.col("start_s")) & ~missing(F.col("end_s")))
    return rows.select("take", "start_s", "end_s", F.lit("automatic").alias("cause"))


@query(f"""SELECT 'raw_keypoints' AS table_name, count(*) AS n_rows, count(DISTINCT take) AS n_takes, true AS has_file FROM raw_keypoints
UNION ALL SELECT 'ground_truth', count(*), count(DISTINCT take), true FROM label_segments WHERE cycle IS NOT NULL
UNION ALL SELECT 'out_of_frame_intervals', count(*), count(DISTINCT take), true FROM label_segments WHERE {_AWAY}
UNION ALL SELECT 'take_meta', count(*), count(DISTINCT take), true FROM takes""")  # fmt: skip
def landing_tables(spark: SparkSession, d: str) -> DataFrame:
    """Tables laid down as CSV and multi-line JSON and read by the landing readers, with the file that each row came from."""
    root = scratch(spark, "landing")
    # a blank at either end of a name would be lost in CSV without quotes
    quoted = lambda df, names, path: df.select(*names).write.csv(path, header=True, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    quoted(table(spark, d, "raw_keypoints"), RAW_KEYPOINTS.names, f"{root}/raw/all_keypoints.csv")
    quoted(table(spark, d, "label_segments").filter("cycle IS NOT NULL"), GROUND_TRUTH.names, f"{root}/ground_truth/take_all.csv")
    quoted(_away(spark, d), OUT_OF_FRAME.names, f"{root}/raw/out_of_frame_intervals.csv")
    meta = _meta(spark, d)
    lists = meta.groupBy(F.pmod(F.xxhash64("take"), F.lit(64)).alias("k")).agg(F.to_json(F.collect_list(F.struct(*meta.columns))).alias("value"))
    lists.repartition("k").select("value").write.option("lineSep", "\n").text(f"{root}/lists")
    # a document per file, as extraction writes them
    lists.select("k", "value").write.partitionBy("k").text(f"{root}/raw/takes_meta.json")
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("take").alias("n_takes"), F.bool_and(F.length("source_file") > 0).alias("has_file")).select(F.lit(n).alias("table_name"), "*") for n, df in landing.read_landing(spark, root).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


REFERENCE = [f"vid{i}" for i in range(1, 8)]


@query(f"SELECT take, frame_idx, keypoint_id, timestamp_ms FROM raw_keypoints WHERE take IN ({', '.join(map(repr, REFERENCE))})")
def scanned_takes(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the listed takes, in order."""
    return landing.scan_takes(table(spark, d, "raw_keypoints"), REFERENCE, ["take", "frame_idx", "keypoint_id"]).select("take", "frame_idx", "keypoint_id", "timestamp_ms")


@query("SELECT e.take, count(*) AS n FROM phase_events e WHERE e.take IN (SELECT take FROM scores_full WHERE scope = 'all') GROUP BY e.take")
def reference_events(spark: SparkSession, d: str) -> DataFrame:
    """Events of the takes that a reference table has."""
    known = table(spark, d, "scores_full").filter("scope = 'all'").select("take")
    return table(spark, d, "phase_events").join(known, "take", "left_semi").groupBy("take").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'overwritten' AS step, count(*) AS n FROM (SELECT DISTINCT * FROM scores_full) UNION ALL SELECT 'logged', 2 * count(*) FROM mix_targets
UNION ALL SELECT 'partitioned', count(*) FROM takes UNION ALL SELECT 'published', count(*) FROM takes UNION ALL SELECT 'publish log', 2""")  # fmt: skip
def saved_tables(spark: SparkSession, d: str) -> DataFrame:
    """A managed table overwritten and read back, a log appended to, Parquet partitions, tables published with their log."""
    root, name = scratch(spark, "saved"), f"phasemill_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}/managed'")
    scores, takes, log = table(spark, d, "scores_full").distinct(), table(spark, d, "takes"), table(spark, d, "mix_targets")
    sinks.overwrite_table(takes, f"{name}.scores")
    rows = [("overwritten", sinks.overwrite_table(scores, f"{name}.scores"))]
    for _ in range(2):
        sinks.append_table(log, f"{name}.log")
    rows.append(("logged", spark.table(f"{name}.log").count()))
    sinks.write_parquet(takes, f"{root}/parts", "take_group")
    rows.append(("partitioned", spark.read.parquet(f"{root}/parts").count()))
    for _ in range(2):
        written = sinks.publish({"takes": takes}, f"{root}/published")
    rows += [("published", written["takes"]), ("publish log", spark.read.parquet(f"{root}/published/publish_runs").count())]
    return spark.createDataFrame(rows, "step string, n long")


NAMED_TEXT = """
-- the queries of a report
-- name: long_events
SELECT take, count(*) AS n FROM events WHERE duration_s > 1 GROUP BY take;
-- name: labels_of_takes
-- one row per take
SELECT take, count(DISTINCT label) AS n FROM events GROUP BY take;
"""
_LONG, _LABELLED = "SELECT take, count(*) AS n FROM ev WHERE duration_s > 1 GROUP BY take", "SELECT take, count(DISTINCT label) AS n FROM ev GROUP BY take"


@query(f"WITH {EVENTS} SELECT 'long_events' AS name, * FROM ({_LONG}) UNION ALL SELECT 'labels_of_takes', * FROM ({_LABELLED})")
def named_sql(spark: SparkSession, d: str) -> DataFrame:
    """The named statements of a SQL file, run over the serving tables."""
    parts = [run_sql(spark, sql, events=events(spark, d)).select(F.lit(n).alias("name"), "take", "n") for n, sql in landing.named_queries(NAMED_TEXT).items()]
    return parts[0].unionByName(parts[1])


@query(f"WITH {EVENTS} SELECT 'long_events' AS name, 'PASS' AS status, '0 rows differ' AS detail UNION ALL SELECT 'labels_of_takes', 'FAIL', (SELECT count(*) * 2 FROM (SELECT DISTINCT take FROM ev)) || ' rows differ'")
def same_query_twice(spark: SparkSession, d: str) -> DataFrame:
    """One query on two sets of tables: the same on a shuffled copy, another where the copy has other labels."""
    ev = events(spark, d)
    copies = {"long_events": ev.repartition(7), "labels_of_takes": ev.withColumn("label", F.concat_ws("-", "label", F.col("event_idx").cast("string"), F.lit("x")))}
    extra = ev.select("take").distinct().select(*[F.col("take") if c == "take" else F.lit(None).cast(kind).alias(c) for c, kind in ev.dtypes if c != "label"], F.lit("more").alias("label"))
    copies["labels_of_takes"] = copies["labels_of_takes"].unionByName(extra).unionByName(extra.withColumn("label", F.lit("most")))
    parts = [same_answers(n, run_sql(spark, sql, events=ev), run_sql(spark, sql, events=copies[n])) for n, sql in landing.named_queries(NAMED_TEXT).items()]
    return parts[0].unionByName(parts[1]).withColumnRenamed("check", "name")


@query("SELECT take, count(*) AS n, round(sum(duration_s), 6) AS total_s FROM phase_events WHERE label IS NOT NULL GROUP BY take")
def sql_views(spark: SparkSession, d: str) -> DataFrame:
    """The views that a SQL file creates, one of them over the other."""
    tag = uuid.uuid4().hex[:8]
    table(spark, d, "phase_events").createOrReplaceTempView(f"src_{tag}")
    text = f"-- two views\nCREATE OR REPLACE VIEW Known_{tag} AS SELECT * FROM src_{tag} WHERE label IS NOT NULL;\nCREATE OR REPLACE VIEW per_take_{tag} AS\nSELECT take, count(*) AS n, round(sum(duration_s), 6) AS total_s FROM known_{tag} GROUP BY take;"
    assert landing.create_views(spark, text) == [f"known_{tag}", f"per_take_{tag}"]
    return spark.table(f"per_take_{tag}")


@query("SELECT label, count(*) AS n FROM (SELECT DISTINCT * FROM phase_events) GROUP BY label")
def fetched_sql(spark: SparkSession, d: str) -> DataFrame:
    """A statement over tables that are handed in."""
    return sinks.fetch(spark, "SELECT label, count(*) AS n FROM (SELECT DISTINCT * FROM {ev}) GROUP BY label", {"ev": table(spark, d, "phase_events")})


# ---- serving tables ----
@query("SELECT take, CAST(frame_idx AS BIGINT) AS frame_idx, timestamp_ms, CAST(keypoint_id AS BIGINT) AS keypoint_id, x, y, z, world_x, world_y, world_z, detected, handedness, handedness_score FROM raw_keypoints")
def serving_raw_keypoints(spark: SparkSession, d: str) -> DataFrame:
    return serve_raw_keypoints(table(spark, d, "raw_keypoints"))


@query(f"WITH {TRUTH} SELECT take, CAST(cycle AS BIGINT) AS cycle, label, start_s, end_s, source FROM truth")
def serving_ground_truth(spark: SparkSession, d: str) -> DataFrame:
    return serve_ground_truth(truth(spark, d))


@query(f"""WITH {EVENTS}, {TRUTH} SELECT t.take, t.take_group, t.n_frames, t.duration_s, t.mean_fps, t.frames_not_detected, t.fraction_not_detected, coalesce(t.left_handedness_frames, 0) AS left_handedness_frames,
  (SELECT nullif(count(*), 0) FROM truth g WHERE g.take = t.take) AS n_ground_truth_segments, (SELECT nullif(count(*), 0) FROM ev e WHERE e.take = t.take) AS n_events FROM takes t""")  # fmt: skip
def serving_takes(spark: SparkSession, d: str) -> DataFrame:
    groups = table(spark, d, "takes").select("take", "take_group")
    return serve_takes(_meta(spark, d).join(groups, "take"), truth(spark, d), events(spark, d), F.col("take_group"))


@query(f"WITH {EVENTS} SELECT take, take_group, label, count(*) AS n FROM ev WHERE take IN ({', '.join(map(repr, REFERENCE))}) GROUP BY ALL")
def development_rows(spark: SparkSession, d: str) -> DataFrame:
    """A query's rows for the takes developed on, without ranks, all columns as order."""
    rows = events(spark, d).groupBy("take", "take_group", "label").agg(F.count(F.lit(1)).alias("n")).withColumn("n_rank", F.lit(1))
    kept = rows.filter(F.col("take").isin(REFERENCE)).drop(*[c for c in rows.columns if c.endswith("_rank")])
    return kept.orderBy(*sorted(kept.columns))


# ---- parity ----
def _counted(name: str, key: str, fields: dict[str, type], tolerance: float, alias: str) -> str:
    """One row: the counts of :func:`parity_counts` for a table and its copy; NaN equals NaN there."""
    met = "a.take IS NOT NULL AND b.take IS NOT NULL"
    # NaN is the greatest value to DuckDB, and NaN - NaN is NaN
    apart = lambda f: f"((a.{f} IS NULL) <> (b.{f} IS NULL) OR coalesce(a.{f} IS DISTINCT FROM b.{f} AND (isnan(a.{f}) OR isnan(b.{f}) OR abs(a.{f} - b.{f}) > {tolerance!r}), false))"
    diffs = ", ".join(f"count(*) FILTER ({met} AND {apart(f) if kind is float else f'a.{f} IS DISTINCT FROM b.{f}'}) AS diff_{f}" for f, kind in fields.items())
    return f"{alias} AS (SELECT count(a.take) AS n_expected, count(*) FILTER (b.take IS NULL) AS n_missing, count(*) FILTER (a.take IS NULL) AS n_extra, {diffs} FROM (SELECT DISTINCT * FROM {name}) a FULL JOIN (SELECT DISTINCT * EXCLUDE (published_at) FROM {name}_wh) b ON a.take = b.take AND a.{key} = b.{key})"


def _pair(spark: SparkSession, d: str, name: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, name).distinct(), table(spark, d, f"{name}_wh").drop("published_at").distinct()


@query(f"WITH {_counted('phase_events', 'event_idx', PHASE_FIELDS, 1e-6, 'c')} SELECT * FROM c")
def parity_events(spark: SparkSession, d: str) -> DataFrame:
    """All columns of both copies of the events, compared by key."""
    a, b = _pair(spark, d, "phase_events")
    return parity_counts(a, b, ["take", "event_idx"], {n.upper(): 1e-6 for n, kind in a.dtypes if kind == "double"})


def _detail(alias: str, fields: dict[str, type], columns: list[str], extra_allowed: bool) -> str:
    bad = "concat_ws(', ', " + ", ".join(f"CASE WHEN diff_{c} > 0 THEN '{c} ' || diff_{c} END" for c in columns) + ")"
    ok = f"n_missing = 0 AND {bad} = ''" + ("" if extra_allowed else " AND n_extra = 0")
    return f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status, n_expected || ' rows, missing ' || n_missing || ', extra ' || n_extra || CASE WHEN {bad} = '' THEN '' ELSE ', differ: ' || {bad} END AS detail FROM {alias}"


_PHASE_ORDER = ["take_group", "label", "start_s", "end_s", "duration_s", "n_frames", "mean_speed", "mean_aperture", "mean_confidence", "frac_missing", "model_version"]
_SCORE_ORDER = ["take_group", "tolerance_s", "n_true", "n_pred", "n_matched", "recall", "precision", "mae_matched_s", "missed", "false_boundaries", "chance_uniform_recall", "chance_uniform_precision", "chance_random_recall", "chance_random_precision", "n_frames", "n_unlabelled", "frame_accuracy", *[f"{p}_{x.lower()}" for x in LABELS for p in ("acc", "n")], "balanced_accuracy", "majority_baseline", "tolerant_accuracy"]


@query(f"""WITH {_counted('phase_events', 'event_idx', PHASE_FIELDS, 1e-6, 'c')}, {_counted('scores_full', 'scope', SCORE_FIELDS, 1e-6, 's')}
SELECT 'events' AS name, {_detail('c', PHASE_FIELDS, _PHASE_ORDER, False)} UNION ALL SELECT 'scores', {_detail('s', SCORE_FIELDS, _SCORE_ORDER, True)}
UNION ALL SELECT 'takes', 'PASS', count(*) || ' rows, missing 0, extra 0' FROM takes""")  # fmt: skip
def serving_parity(spark: SparkSession, d: str) -> DataFrame:
    """The checks of serving tables against their copies by the table of keys and tolerances."""
    ev, sc, takes = _pair(spark, d, "phase_events"), _pair(spark, d, "scores_full"), table(spark, d, "takes")
    plan = {n: V.SERVING_CHECKS[n] for n in ("events", "scores", "takes")}
    checks = table_checks({"events": ev[0], "scores": sc[0], "takes": takes}, {"events": ev[1], "scores": sc[1], "takes": takes.repartition(5)}, plan)
    return checks.withColumnRenamed("check", "name")


# of the catalogue's query
ORACLES["parity_checks"] = f"""WITH {_counted('scores_full', 'scope', SCORE_FIELDS, 1e-12, 's')} SELECT 'scores' AS "check", {_detail('s', SCORE_FIELDS, _SCORE_ORDER, False)}
UNION ALL SELECT 'scores with itself', 'PASS', count(*) || ' rows, missing 0, extra 0' FROM (SELECT DISTINCT * FROM scores_full)"""


@query("SELECT count(*) AS n_expected, CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_extra, CAST(0 AS BIGINT) AS diff_detected, CAST(0 AS BIGINT) AS diff_x FROM (SELECT DISTINCT take, frame_idx, keypoint_id, detected, x FROM raw_keypoints)")
def export_check(spark: SparkSession, d: str) -> DataFrame:
    """A BI export (rows in any order, names in capitals, booleans as words) against its table."""
    rows = table(spark, d, "raw_keypoints").select("take", "frame_idx", "keypoint_id", "detected", "x").distinct()
    path = scratch(spark, "export")
    words = F.when(F.col("detected"), F.when(F.col("frame_idx") % 2 == 0, "True").otherwise("TRUE")).otherwise("false")
    rows.withColumn("detected", words).toDF(*[c.upper() for c in rows.columns]).repartition(5).write.csv(path, header=True, quoteAll=True)
    kinds = dict(rows.dtypes)
    back = normalised(spark.read.csv(path, header=True))
    return parity_counts(rows, back.select(*[F.col(c).cast(kinds[c]).alias(c) for c in rows.columns]), ["take", "frame_idx", "keypoint_id"], {"x": 1e-12})


@query("SELECT take_group, bit_xor(CAST('0x' || substr(sha256(take || '|' || CAST(event_idx AS VARCHAR)), 1, 15) AS BIGINT)) AS digest, count(*) AS n FROM phase_events GROUP BY take_group")
def row_digests(spark: SparkSession, d: str) -> DataFrame:
    """SHA-256 of keys, combined over the rows of a group."""
    h = F.sha2(F.concat_ws("|", "take", F.col("event_idx").cast("string")), 256)
    return table(spark, d, "phase_events").groupBy("take_group").agg(F.bit_xor(F.conv(F.substring(h, 1, 15), 16, 10).cast("long")).alias("digest"), F.count(F.lit(1)).alias("n"))


MANIFEST = ("takes", "phase_events", "phase_events_wh", "scores_full", "scores_full_wh", "tableau_phases", "label_segments", "raw_keypoints", "documents", "mix_targets")


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, (SELECT count(*) FROM {n}) AS n_rows, (SELECT string_agg(column_name, ',') FROM (DESCRIBE {n})) AS columns, 64::INTEGER AS digits" for n in MANIFEST))
def manifest_rows(spark: SparkSession, d: str) -> DataFrame:
    """The manifest of all tables: rows, columns, and the length of the hash, which SQL can't compute."""
    rows = V.manifest({n: table(spark, d, n) for n in MANIFEST})
    return rows.select(F.col("table").alias("table_name"), F.col("rows").alias("n_rows"), "columns", F.length("sha256").alias("digits"))


@query("""SELECT * FROM (VALUES ('same rows in another order', true), ('one value changed', false), ('one row twice', false)) v(change, same)""")
def table_hashes(spark: SparkSession, d: str) -> DataFrame:
    """The hash of a table's content doesn't hang on the order of rows, but on each value and row."""
    ev = table(spark, d, "phase_events")
    first = ev.select(F.min_by(F.struct("take", "event_idx"), F.struct("take", "event_idx")).alias("k"))
    changed = ev.join(first.select("k.take", F.col("k.event_idx").alias("__e")), "take", "left").withColumn("label", F.when(F.col("event_idx") == F.col("__e"), F.concat(F.coalesce("label", F.lit("")), F.lit("?"))).otherwise(F.col("label"))).drop("__e")
    twice = ev.unionByName(ev.orderBy("take", "event_idx").limit(1))
    want = V.content_hash(ev).select(F.col("sha256").alias("w"))
    parts = [V.content_hash(df).crossJoin(F.broadcast(want)).select(F.lit(n).alias("change"), (F.col("sha256") == F.col("w")).alias("same")) for n, df in (("same rows in another order", ev.repartition(9)), ("one value changed", changed), ("one row twice", twice))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- governance ----
def _outcome(step: Callable[[], object]) -> str:
    try:
        step()
    except V.GovernanceError as e:
        return str(e)
    return "done"


@query("""SELECT * FROM (VALUES ('gate without a run', 'no run is logged'), ('all checks pass', 'done'), ('gate', 'done'), ('a check fails', 'step second: failed [''parity'']'), ('steps run', 'first, second'), ('gate after it', 'the latest run failed 1 of 1 checks')) v(step, outcome)""")
def gated_run(spark: SparkSession, d: str) -> DataFrame:
    """Steps that log their checks; a failed one stops the rest, and the gate looks at the latest run."""
    path, ran = scratch(spark, "runs"), []
    a, b = _pair(spark, d, "phase_events")
    log = lambda rows: rows.write.mode("append").parquet(path)
    same = lambda: table_checks({"events": a}, {"events": a}, {"events": (["take", "event_idx"], 0.0, False)})
    other = lambda: table_checks({"events": a}, {"events": b}, {"events": (["take", "event_idx"], 0.0, False)}).withColumn("check", F.lit("parity"))
    spark.createDataFrame([], V.RUN_LOG).write.parquet(path)
    read = lambda: spark.read.schema(V.RUN_LOG).parquet(path)
    step = lambda n, f: (n, lambda: (ran.append(n), f())[1])
    rows = [("gate without a run", _outcome(lambda: V.gate(read())))]
    rows.append(("all checks pass", _outcome(lambda: V.run_steps([("only", same)], log))))
    rows.append(("gate", _outcome(lambda: V.gate(read()))))
    rows.append(("a check fails", _outcome(lambda: V.run_steps([step("first", same), step("second", other), step("third", same)], log))))
    rows += [("steps run", ", ".join(ran)), ("gate after it", _outcome(lambda: V.gate(read())))]
    return spark.createDataFrame(rows, "step string, outcome string")


@query("""SELECT * FROM (VALUES ('lock a take trained on', 'seen was trained on'), ('lock', 'done'), ('lock again', 'new is locked already'), ('check', 'done'), ('check other labels', 'new: labels changed since they were locked'), ('check another model', 'new: the model changed since the labels were locked'),
('prepare a locked take', 'new is locked'), ('prepare', 'done'), ('status new', 'locked'), ('status old', 'scored'), ('status later', 'labelled'), ('status blank', 'recorded')) v(step, outcome)""")  # fmt: skip
def holdout_rules(spark: SparkSession, d: str) -> DataFrame:
    """What may be done with a hold-out take, and when; its labels are a template filled in."""
    made = V.label_template(spark, "new", 2).withColumns({"start_s": F.col("ord") * 0.5, "end_s": (F.col("ord") + 1) * 0.5, "source": F.lit("manual")})
    made = made.withColumns({c: F.when(F.col("ord") == 0, F.col(c)).otherwise(F.col(c) - 2.5) for c in ("start_s", "end_s")})
    labels = materialize(made.select(*GROUND_TRUTH.names), "holdout")
    last = labels.groupBy("take").agg(F.max("end_s").alias("last_s"))
    locks: list[DataFrame] = []
    rows = [("lock a take trained on", _outcome(lambda: V.lock(None, "seen", labels, last, ["seen"], "m")))]
    rows.append(("lock", _outcome(lambda: locks.append(V.lock(None, "new", labels, last, ["seen"], "m")))))
    held = locks[0]
    rows.append(("lock again", _outcome(lambda: V.lock(held, "new", labels, last, [], "m"))))
    rows.append(("check", _outcome(lambda: V.check_lock(held, "new", labels, "m"))))
    rows.append(("check other labels", _outcome(lambda: V.check_lock(held, "new", labels.withColumn("end_s", F.col("end_s") + 1), "m"))))
    rows.append(("check another model", _outcome(lambda: V.check_lock(held, "new", labels, "n"))))
    of = lambda *takes: spark.createDataFrame([(t, 1.0) for t in takes], "take string, start_s double")
    status = materialize(V.holdout_status(of("new", "old", "later", "blank"), of("new", "old", "later"), held, of("old")), "status")
    rows.append(("prepare a locked take", _outcome(lambda: V.prepare_holdout("new", status, lambda t: labels, []))))
    rows.append(("prepare", _outcome(lambda: V.prepare_holdout("later", status, lambda t: labels, []))))
    rows += [(f"status {r['take']}", r["status"]) for r in status.collect()]
    return spark.createDataFrame(rows, "step string, outcome string")


@query("SELECT * FROM (VALUES ('worker python', 'PASS'), ('worker pyspark', 'PASS'), ('worker pyarrow', 'PASS'), ('worker phasemill', 'PASS')) v(name, status)")
def environment_check(spark: SparkSession, d: str) -> DataFrame:
    """Whether workers run the driver's versions and import the package."""
    return V.worker_probe(spark).select(F.col("check").alias("name"), "status")


@query("WITH r AS (SELECT * FROM (VALUES ('first', 2, 0, ''), ('second', 3, 2, 'b, c')) v(run_id, n_checks, n_failed, failed)) SELECT run_id, CAST(n_checks AS BIGINT) AS n_checks, CAST(n_failed AS BIGINT) AS n_failed, failed, 64::INTEGER AS digits FROM r")
def evidence(spark: SparkSession, d: str) -> DataFrame:
    """What is kept of each run in the log."""
    rows = [("first", "a", "PASS"), ("first", "b", "PASS"), ("second", "a", "PASS"), ("second", "c", "FAIL"), ("second", "b", "FAIL")]
    log = spark.createDataFrame([(i, datetime(2020, 1, 1, tzinfo=UTC), c, s, "") for i, c, s in rows], V.RUN_LOG)
    return V.run_evidence(log).select("run_id", "n_checks", "n_failed", "failed", F.length("sha256").alias("digits"))


@query(f"WITH {EVENTS}, d AS (SELECT take, event_idx, label, start_s, least(end_s, coalesce(lead(start_s) OVER (PARTITION BY take ORDER BY start_s, event_idx), end_s)) AS e FROM ev WHERE label IS NOT NULL) SELECT take, count(*) AS n, round(sum(e - start_s), 6) AS covered_s FROM d WHERE e > start_s GROUP BY take")
def disjoint_phases(spark: SparkSession, d: str) -> DataFrame:
    """Detected phases cut where the next one starts."""
    return disjoint_events(spark, d).groupBy("take").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("end_s") - F.col("start_s")), 6).alias("covered_s"))
