"""Boundary and frame scores: hand-made cases, brute force, and known results of a real take."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from phasemill.operators import metrics as E
from phasemill.schemas import LABELS

# Hand labels and detected events of one fast take of three cycles, and its scores at 0.10 s.
TRUTH = [(1, 'REST', 0.0, 0.867),
 (1, 'REACH', 0.867, 1.233),
 (1, 'GRASP', 1.233, 1.667),
 (1, 'HOLD', 1.667, 2.2),
 (1, 'RELEASE', 2.2, 2.333),
 (1, 'RETRACT', 2.333, 2.7),
 (1, 'REST', 2.7, 3.267),
 (2, 'REACH', 3.267, 3.733),
 (2, 'GRASP', 3.733, 4.2),
 (2, 'HOLD', 4.2, 4.9),
 (2, 'RELEASE', 4.9, 5.033),
 (2, 'RETRACT', 5.033, 5.3),
 (2, 'REST', 5.3, 5.935),
 (3, 'REACH', 5.935, 6.368),
 (3, 'GRASP', 6.368, 6.868),
 (3, 'HOLD', 6.868, 7.535),
 (3, 'RELEASE', 7.535, 7.702),
 (3, 'RETRACT', 7.702, 8.035),
 (3, 'REST', 8.035, 9.335)]
EVENTS = [('REST', 0.0, 0.9),
 ('REACH', 0.9, 1.2666666666666666),
 ('GRASP', 1.2666666666666666, 1.6333333333333333),
 ('HOLD', 1.6333333333333333, 2.3),
 ('RETRACT', 2.3, 2.6666666666666665),
 ('REST', 2.6666666666666665, 3.3),
 ('REACH', 3.3, 3.7333333333333334),
 ('GRASP', 3.7333333333333334, 4.166666666666667),
 ('HOLD', 4.166666666666667, 4.966666666666667),
 ('RETRACT', 4.966666666666667, 5.3),
 ('REST', 5.3, 5.966666666666667),
 ('REACH', 5.966666666666667, 6.5),
 ('GRASP', 6.5, 6.866666666666666),
 ('HOLD', 6.866666666666666, 7.6),
 ('RETRACT', 7.6, 8.066666666666666),
 ('REST', 8.066666666666666, 9.335)]
SCORES = {'all': (18.0, 15.0, 14.0, 0.7777777777777778, 0.9333333333333333, 0.030666666666666738, 4.0, 1.0, 0.3333333333333333, 0.4, 0.27405555555555555, 0.3288666666666667),
 'cycle1': (6.0, 5.0, 5.0, 0.8333333333333334, 1.0, 0.03333333333333346, 1.0, 0.0, 0.0, 0.0, 0.1005, 0.1206),
 'cycle2': (6.0, 5.0, 5.0, 0.8333333333333334, 1.0, 0.026600000000000002, 1.0, 0.0, 0.0, 0.0, 0.10383333333333333, 0.12459999999999999),
 'cycle3': (6.0, 5.0, 4.0, 0.6666666666666666, 0.8, 0.03241666666666676, 2.0, 1.0, 0.16666666666666666, 0.2, 0.10233333333333332, 0.1228)}


def brute(pred, true, tol):
    best = (0, 0.0)
    for n in range(1, min(len(pred), len(true)) + 1):
        for a in itertools.combinations(range(len(pred)), n):
            for b in itertools.permutations(range(len(true)), n):
                errors = [abs(pred[i] - true[j]) for i, j in zip(a, b, strict=True)]
                if all(e <= tol + 1e-9 for e in errors) and (n, -sum(errors)) > (best[0], -best[1]):
                    best = (n, sum(errors))
    return best


CASES = [([2, 4, 6], [2, 4, 6], 3), ([2.05, 4.05, 6.05], [2, 4, 6], 3), ([2.3, 4, 6], [2, 4, 6], 2), ([3.95, 4.04], [4.0, 4.09], 2), ([2.1], [2], 1), ([2.1001], [2], 0), ([], [2], 0), ([2, 2.02], [2.01], 1)]


@pytest.mark.parametrize(("pred", "true", "n"), CASES)
def test_matching_cases(pred, true, n):
    assert E.match_count_error(np.array(pred), np.array(true), 0.10)[0] == n


@pytest.mark.parametrize("seed", range(30))
def test_matching_is_optimal(seed):
    rng = np.random.default_rng(seed)
    pred, true = rng.uniform(0, 1, rng.integers(0, 5)), rng.uniform(0, 1, rng.integers(0, 5))
    n, e = E.match_count_error(pred, true, 0.15)
    m, f = brute(pred, true, 0.15)
    assert n == m and e == pytest.approx(f)
    if len(pred):
        assert E.greedy_counts(np.sort(pred)[None, :], np.sort(true), 0.15)[0] == m


def frames_for(spark, rows, step=0.05):
    end = max(r[3] for r in rows)
    return spark.createDataFrame([("v", i, i * step) for i in range(int(end / step) + 1)], "take string, frame_idx int, t double")


def tables(spark):
    t = spark.createDataFrame([("v", c, lab, a, z) for c, lab, a, z in TRUTH], "take string, cycle int, label string, start_s double, end_s double")
    e = spark.createDataFrame([("v", i, lab, a, z) for i, (lab, a, z) in enumerate(EVENTS)], "take string, event_idx long, label string, start_s double, end_s double")
    return t, e


def test_known_scores(spark):
    truth, events = tables(spark)
    got = {r["scope"]: r for r in E.boundary_metrics(events, truth).collect()}
    assert set(got) == set(SCORES)
    names = ["n_true", "n_pred", "n_matched", "recall", "precision", "mae_matched_s", "missed", "false_boundaries", "chance_uniform_recall", "chance_uniform_precision", "chance_random_recall", "chance_random_precision"]
    for scope, want in SCORES.items():
        for n, w in zip(names, want, strict=True):
            assert (got[scope][n] is None) == (w is None) and (w is None or abs(got[scope][n] - w) < 1e-12), (scope, n)


def test_a_shifted_boundary_is_noticed(spark):
    truth, events = tables(spark)
    moved = events.withColumn("start_s", F.col("start_s") + F.when(F.col("event_idx") == 3, 1e-6).otherwise(0.0))
    a, b = (E.boundary_metrics(x, truth).filter("scope = 'all'").first()["mae_matched_s"] for x in (events, moved))
    assert a != b


def test_frame_metrics(spark):
    pairs = [("REST", "REST"), ("REST", "REST"), ("REST", "REACH"), ("REACH", "REACH"), ("HOLD", "GRASP"), (None, "REST"), ("REST", None), ("REST", "REST")]
    df = spark.createDataFrame([("v", t, p) for t, p in pairs], "take string, true_label string, predicted_label string")
    r = E.frame_metrics(df, ["take"]).first()
    assert (r["n_frames"], r["n_unlabelled"], r["frame_accuracy"]) == (6, 2, pytest.approx(4 / 6))
    assert r["balanced_accuracy"] == pytest.approx((0.75 + 1 + 0) / 3) and r["majority_baseline"] == pytest.approx(4 / 6)
    assert r["acc_RELEASE"] is None and r["n_RELEASE"] == 0
    m = {x["true_label"]: x for x in E.confusion(df.dropna()).collect()}
    assert set(m) == set(LABELS) and m["REST"]["REACH"] == 1 and m["RETRACT"]["REST"] == 0


def test_label_lookup_ends(spark):
    seg = spark.createDataFrame([("v", "REST", 0.0, 1.0), ("v", "REACH", 1.0, 2.0)], "take string, label string, start_s double, end_s double")
    pts = spark.createDataFrame([("v", i, t) for i, t in enumerate([0.0, 0.99, 1.0, 1.99, 2.0, 2.5, -0.1])], "take string, frame_idx int, t double")
    got = E.label_frames(pts, seg, seg).orderBy("frame_idx").collect()
    assert [r["predicted_label"] for r in got] == ["REST", "REST", "REACH", "REACH", "REACH", None, None]


def test_full_scores_and_tolerance(spark):
    truth, events = tables(spark)
    out = spark.createDataFrame([("v", 0.5, 0.8)], "take string, start_s double, end_s double")
    rows = {r["scope"]: r for r in E.full_scores(frames_for(spark, TRUTH), events, truth, out_of_frame=out).collect()}
    assert set(rows) == {"all", "cycle1", "cycle2", "cycle3", "out_of_frame"}
    assert rows["out_of_frame"]["n_true"] is None and rows["out_of_frame"]["n_frames"] == 6
    assert rows["all"]["tolerant_accuracy"] >= rows["all"]["frame_accuracy"] > 0.5
    inside = sum(rows[f"cycle{i}"]["n_frames"] for i in (1, 2, 3))
    assert inside >= rows["all"]["n_frames"]
    assert E.objective(E.full_scores(frames_for(spark, TRUTH), truth, truth)).first()["objective"] == pytest.approx(1.0)


def test_empty(spark):
    truth, events = tables(spark)
    assert E.boundary_metrics(events.limit(0), truth).filter("scope = 'all'").first()["precision"] is None
    assert E.boundary_metrics(events, truth.limit(0)).count() == 0
