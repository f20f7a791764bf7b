"""Parity checks notice single changes; locks and gates refuse what they should; readers and sinks."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from phasemill.operators import relational as R
from phasemill.operators.parity import parity_check, parity_counts, same_rows
from phasemill.plans import governance as V
from phasemill.plans import serving
from phasemill.plans.streams import QUERIES as STREAM_QUERIES
from phasemill.schemas import GROUND_TRUTH, OUT_OF_FRAME, RUN_LOG
from phasemill.session import local_session, release, shared_dir
from phasemill.sources import landing, sinks

EVENTS = [("vid1", 0, "REST", 0.0, 2.0, 60, 1.5, None), ("vid1", 1, "REACH", 2.0, 3.0, 30, None, float("nan")), ("vid2", 0, "REST", 0.0, 1.0, 30, 0.5, 0.1)]
SCHEMA = "take string, event_idx long, label string, start_s double, end_s double, n_frames long, mean_speed double, score double"
TOL = {"START_S": 1e-12, "end_s": 1e-12, "mean_speed": 1e-9, "score": 1e-9}


def check(a, b, **kw):
    return parity_check("events", a, b, ["take", "event_idx"], TOL, **kw).first()


def test_parity_passes_and_mutations_fail(spark):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    assert check(df, df.toDF(*[c.upper() for c in df.columns]))["status"] == "PASS"
    one = F.col("take") == "vid2"
    for column, value in [("start_s", F.col("start_s") + 1e-9), ("n_frames", F.col("n_frames") + 1), ("mean_speed", F.col("mean_speed") + 1e-6), ("label", F.lit("HOLD")), ("score", F.lit(float("nan"))), ("mean_speed", F.lit(None).cast("double"))]:
        r = check(df, df.withColumn(column, F.when(one, value).otherwise(F.col(column))))
        assert r["status"] == "FAIL" and column in r["detail"], column
    assert check(df, df.filter(~one))["status"] == "FAIL"
    extra = df.unionByName(df.filter(one).withColumn("event_idx", F.lit(7).cast("long")))
    assert check(df, extra)["status"] == "FAIL" and check(df, extra, allow_extra=True)["status"] == "PASS"
    assert "score 2" in check(df.filter("score IS NOT NULL"), df.drop("score"))["detail"]
    assert check(df, df.drop("score"), skip=["SCORE"])["status"] == "PASS"
    assert parity_counts(df.limit(0), df.limit(0), ["take"]).first()["n_expected"] == 0
    assert same_rows(df, df).count() == 0 and same_rows(df, df.limit(1)).count() == 2


LABELS = [("v", 1, "REST", 0.0, 1.0, "manual"), ("v", 1, "REACH", 1.0, 2.0, "manual"), ("v", 2, "REST", 2.0, 3.5, "manual")]


def test_labels_locks_and_gate(spark):
    good = spark.createDataFrame(LABELS, GROUND_TRUTH)
    last = spark.createDataFrame([("v", 3.5)], "take string, last_s double")
    cycles = spark.createDataFrame([("v", 2)], "take string, n_cycles int")
    assert V.label_problems(good, last, cycles).count() == 0
    bad = spark.createDataFrame([("v", 1, "WAVE", 0.5, 1.0, "auto"), ("v", 1, "REACH", 1.5, 1.4, "manual"), ("v", 3, None, None, 3.0, None)], GROUND_TRUTH)
    found = {r["problem"] for r in V.label_problems(bad, last, cycles).collect()}
    assert found == {"unfilled rows", "unknown label", "source not manual", "end not after start", "not contiguous", "last end is not the last frame", "number of cycles"} or "does not start at 0" in found
    lock = V.lock(None, "v", good, last, ["u"], "m1")
    V.check_lock(lock, "v", good.orderBy(F.col("start_s").desc()), "m1")
    for args, words in [((lock, "v", good.withColumn("end_s", F.col("end_s") + 1e-9), "m1"), "labels changed"), ((lock, "v", good, "m2"), "model changed"), ((lock, "w", good, "m1"), "isn't locked")]:
        with pytest.raises(V.GovernanceError, match=words):
            V.check_lock(*args)
    for call in (lambda: V.lock(lock, "v", good, last, [], "m1"), lambda: V.lock(None, "v", good, last, ["v"], "m1"), lambda: V.lock(None, "v", bad, last, [], "m1")):
        with pytest.raises(V.GovernanceError):
            call()
    rows = [("r1", datetime(2025, 1, 1, tzinfo=UTC), "a", "FAIL", ""), ("r2", datetime(2025, 1, 2, tzinfo=UTC), "a", "PASS", "")]
    log = spark.createDataFrame(rows, RUN_LOG)
    V.gate(log)
    for df in (log.filter("run_id = 'r1'"), log.limit(0)):
        with pytest.raises(V.GovernanceError):
            V.gate(df)
    status = V.holdout_status(spark.createDataFrame([("v",), ("w",)], "take string"), good, lock, lock.limit(0))
    assert {tuple(r) for r in status.collect()} == {("v", "locked"), ("w", "recorded")}


def test_steps_stop_at_a_failure(spark):
    logged = []
    ok = spark.createDataFrame([("a", "PASS", "")], "check string, status string, detail string")
    bad = ok.withColumn("status", F.lit("FAIL"))
    with pytest.raises(V.GovernanceError, match="step two"):
        V.run_steps([("one", lambda: ok), ("none", lambda: None), ("two", lambda: bad), ("three", lambda: ok)], lambda rows: logged.append(rows.count()))
    assert logged == [1, 1]


def test_content_hash_sees_any_change(spark):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    digest = lambda x: V.content_hash(x).first()["sha256"]
    assert digest(df) == digest(df.repartition(3).select(*reversed(df.columns)))
    assert digest(df) != digest(df.unionByName(df)) and digest(df) != digest(df.withColumn("label", F.lit("x")))


def test_landing(spark, tmp_path):
    for name in ("raw", "ground_truth"):
        (tmp_path / name).mkdir()
    (tmp_path / "raw/out_of_frame_intervals.csv").write_text('take,start_s,end_s,cause\nvid5,9.3,9.8,"hand raised, then lowered"\n')
    (tmp_path / "ground_truth/take_1.csv").write_text("take,cycle,label,start_s,end_s,source\nvid1,1,REST,0.0,1.5,manual\n")
    (tmp_path / "raw/vid1_keypoints.csv").write_text("take,frame_idx,timestamp_ms,keypoint_id,x,y,z,world_x,world_y,world_z,detected,handedness,handedness_score\nvid1,0,0,0,0.5,0.5,0,0,0,0,true,Right,0.9\nvid1,1,33,0,,,,,,,false,,\n")
    (tmp_path / "raw/vid1_meta.json").write_text(json.dumps({"take": "vid1", "frames_extracted": 2, "handedness_counts": {"Right": 1, "Left": 0}, "frames_other": 3}, indent=1))
    tables = landing.read_landing(spark, str(tmp_path))
    assert tables["out_of_frame_intervals"].first()["cause"] == "hand raised, then lowered"
    assert tables["take_meta"].first()["handedness_counts"]["Right"] == 1 and "frames_other" not in tables["take_meta"].columns
    assert tables["raw_keypoints"].first()["source_file"] == "vid1_keypoints.csv" and tables["raw_keypoints"].count() == 2
    assert {r["rule"]: r["n"] for r in landing.keypoint_violations(tables["raw_keypoints"]).collect()} == {"keypoint_id in 0..20": 0, "detected = coordinates known": 0, "primary key": 0}
    (tmp_path / "raw/out_of_frame_intervals.csv").write_text("start_s,take,end_s,cause\n9.3,vid5,9.8,x\n")
    with pytest.raises(Exception, match="(?i)header|schema|conform"):
        landing.read_csv(spark, str(tmp_path / "raw/out_of_frame_intervals.csv"), OUT_OF_FRAME).collect()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    assert sinks.replace_partitions(df, str(tmp_path / "t")) == 3
    assert sinks.replace_partitions(df.filter("take = 'vid1'").limit(1), str(tmp_path / "t")) == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    assert sinks.publish({"events": df}, str(tmp_path / "p")) == {"events": 3} and sinks.publish({"events": df}, str(tmp_path / "p")) == {"events": 3}
    assert spark.read.parquet(str(tmp_path / "p/publish_runs")).count() == 2
    assert sinks.fetch(spark, "SELECT count(*) AS n FROM some_events", {"some_events": df}).first()["n"] == 3
    history = spark.createDataFrame([("v1", 1), ("v2", 2)], "version string, n int")
    assert sorted(tuple(r) for r in R.replace_version(history, spark.createDataFrame([("v2", 9)], "version string, n int"), "version").collect()) == [("v1", 1), ("v2", 9)]


def test_named_sql(spark):
    text = "-- intro\nUSE SCHEMA x;\n-- name: one\n-- why?\nSELECT 1 AS a\nFROM t;\n-- name: two\nSELECT 2;\nCREATE OR REPLACE VIEW v_x AS\nSELECT 1 AS a;"
    assert landing.named_queries(text) == {"one": "SELECT 1 AS a\nFROM t", "two": "SELECT 2"}
    assert landing.view_statements(text) == {"v_x": "SELECT 1 AS a"}
    assert landing.create_views(spark, text) == ["v_x"] and spark.table("v_x").first()["a"] == 1


# Durations and confidences of two takes, and what the named queries give for them.
def test_serving_queries(spark):
    rows = [("vid1", "clean", 0, "REST", 0.0, 2.0, 2.0, 0.9), ("vid1", "clean", 1, "REACH", 2.0, 2.25, 0.25, 0.6), ("vid1", "clean", 2, "HOLD", 2.25, 4.0, 1.75, 0.8), ("vid1", "clean", 3, "REACH", 4.0, 5.0, 1.0, None), ("vid2", "fast", 0, "REST", 0.0, 1.0, 1.0, 0.95)]
    ev = spark.createDataFrame(rows, "take string, take_group string, event_idx long, label string, start_s double, end_s double, duration_s double, mean_confidence double")
    run = lambda n: serving.NAMED[n](ev).collect()
    q1 = {(r["take_group"], r["label"]): r["avg_duration_s"] for r in run("q1_avg_duration_by_event_type")}
    assert q1["clean", "REACH"] == 0.625
    q2 = {r["take"]: (r["ambiguous_events"], r["ambiguous_share"], r["ambiguity_rank"]) for r in run("q2_most_ambiguous_takes")}
    assert q2 == {"vid1": (1, 0.25, 1), "vid2": (0, 0.0, 2)}
    assert [r["seconds_between_reaches"] for r in run("q3_time_between_consecutive_reaches")] == [2.0]
    q4 = {(r["from_label"], r["to_label"]): r["follows_protocol_order"] for r in run("q4_phase_transitions")}
    assert q4 == {("REST", "REACH"): "yes", ("REACH", "HOLD"): "no", ("HOLD", "REACH"): "no"}
    q = serving.NAMED["q1_avg_duration_by_event_type"]
    assert serving.same_answers("q1", q(ev), q(ev.repartition(3))).first()["status"] == "PASS"
    assert serving.same_answers("q1", q(ev), q(ev.withColumn("duration_s", F.col("duration_s") + 0.01))).first()["status"] == "FAIL"
    assert serving.run_sql(spark, "SELECT count(*) AS n FROM events JOIN events USING (take, event_idx)", events=ev).first()["n"] == 5
    report = V.score_report(spark.createDataFrame([("clean", "vid1", "all", 1.0, 0.5, None, 0.9, 0.8, 0.95)], "take_group string, take string, scope string, recall double, precision double, mae_matched_s double, frame_accuracy double, balanced_accuracy double, tolerant_accuracy double"))
    assert "| vid1 | 1.000 | 0.500 | - |" in report


def test_shared_folder(spark):
    assert shared_dir(spark) == shared_dir(local_session()) and release(spark) >= 0
    assert "stream_sessions" in STREAM_QUERIES
