"""The seeded search and nested selection: trials are those of the seed, scores those of the distributed operators, nothing is chosen by what it is judged on."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from phasemill.operators import models as M
from phasemill.operators.metrics import full_scores, objective
from phasemill.plans import pipeline as P
from phasemill.plans import selection as Q
from phasemill.schemas import LABELS, TUNED, RuleParams
from tests.test_pipeline import labelled_features


def test_settings_follow_the_seed():
    a, b = Q.drawn_settings(30), Q.drawn_settings(30)
    assert a == b and len(a) == 31 and a[0] == (7, RuleParams()) and len(set(a)) == 31
    assert Q.drawn_settings(30, 1)[1:] != a[1:] and Q.drawn_settings(10) == a[:11]
    for w, r in a[1:]:
        values = {"smooth_win": w, **dataclasses.asdict(r)}
        for name, space in Q.SPACE.items():
            assert values[name] in space if isinstance(space, list) else space[-2] <= values[name] <= space[-1]


def test_search_gives_the_objective_of_the_distributed_stages(spark):
    sf = "/root/testdata/sf0.001"
    frames, truth = P.usable_frames(spark, sf), P.materialize(P.truth(spark, sf), "truth")
    truth = truth.join(frames.select("take").distinct(), "take", "left_semi")
    got = {r["trial"]: r for r in Q.search_rules(frames, truth, [(5, TUNED), *Q.drawn_settings(3)], per_task=2).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4] and all(0 <= r["objective"] <= 1 and r["n_takes"] == truth.select("take").distinct().count() for r in got.values())
    events = P.rule_events(spark, sf)
    want = objective(full_scores(P.S.build_frames(P.table(spark, sf, "raw_keypoints")).join(truth.select("take").distinct(), "take", "left_semi"), events, truth)).agg(F.avg("objective")).first()[0]
    assert got[0]["objective"] == pytest.approx(want, abs=0.02)


def test_nested_selection(spark):
    feats, labels = labelled_features(spark, [f"vid{i}" for i in range(8)])
    labels = labels.withColumn("cycle", F.lit(1))
    frames = feats.select("take", F.col("sample_idx").alias("frame_idx"), "t")
    training = P.labelled_samples(feats, labels.drop("cycle")).withColumn("origin", F.col("take"))
    events, chosen = Q.nested_selection(feats, training, frames, labels, ("logreg",), penalties=(1.0, 4.0), folds=2)
    rows = chosen.collect()
    assert len(rows) == 4 and sorted(r["fold"] for r in rows if r["chosen"]) == [0, 1]
    for fold in (0, 1):
        own = [r for r in rows if r["fold"] == fold]
        assert max(own, key=lambda r: (round(r["objective"], 6), r["penalty"]))["chosen"]
    got = events.toPandas()
    assert set(got["take"]) == {f"vid{i}" for i in range(8)} and set(got["label"]) <= set(LABELS)
    assert np.isclose(got.groupby("take")["duration_s"].sum(), 89 / 30).all() and M.FOLDS == 5
