"""The pipeline's plans: which samples a model is fitted on, which settings are tried, what serving tables carry."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from phasemill.operators import models as M
from phasemill.plans import pipeline as P
from phasemill.schemas import LABELS


def labelled_features(spark, takes, seed=4):
    """Features of takes that cycle through the labels, and their labels."""
    rng, rows, labels = np.random.default_rng(seed), [], []
    for k, take in enumerate(takes):
        y = np.repeat(np.arange(6), 15)
        x = rng.normal(0, 1, (len(y), len(P.FEATURES))) + np.eye(len(P.FEATURES))[y + 6 * (k % 4)]
        rows.append(pd.DataFrame(x, columns=P.FEATURES).assign(take=take, sample_idx=np.arange(len(y)), t=np.arange(len(y)) / 30))
        labels += [(take, LABELS[i], i * 0.5, (i + 1) * 0.5) for i in range(6)]
    return spark.createDataFrame(pd.concat(rows)), spark.createDataFrame(labels, "take string, label string, start_s double, end_s double")


def test_takes_are_predicted_by_a_model_that_has_not_seen_them(spark):
    feats, labels = labelled_features(spark, [f"vid{i}" for i in range(12)])
    cols = [f"p_{x}" for x in LABELS]
    got = P.posteriors(feats, P.labelled_samples(feats, labels).withColumn("origin", F.col("take")), folds=M.FOLDS).toPandas().sort_values(["take", "sample_idx"])
    sample = P.labelled_samples(feats, labels).toPandas().sort_values(["take", "sample_idx"])
    fold = {r["take"]: r["fold"] for r in feats.select("take", M.fold_of(F.col("take")).alias("fold")).distinct().collect()}
    assert len(set(fold.values())) > 1
    for take, g in got.groupby("take"):
        own = sample[sample["take"] == take]
        want = M.fit(sample[sample["take"].map(fold) != fold[take]], P.FEATURES).predict(own[P.FEATURES].to_numpy())
        assert np.allclose(g[cols], want, atol=1e-5)
    plain = P.posteriors(feats, P.labelled_samples(feats, labels).withColumn("origin", F.col("take"))).toPandas().sort_values(["take", "sample_idx"])
    assert np.allclose(plain[cols], M.fit(sample, P.FEATURES).predict(sample[P.FEATURES].to_numpy()), atol=1e-5)


def test_every_penalty_of_the_grid_is_tried():
    assert P.PENALTIES == (0.25, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 8.0)


def test_scores_and_penalty_are_out_of_fold(monkeypatch):
    seen = []

    def spy(spark, d, kind="logreg", rows=0, folds=0):
        seen.append(folds)
        raise InterruptedError

    monkeypatch.setattr(P, "_posteriors", spy)
    for query in (P.pipeline_scores, P.penalty_grid):
        try:
            query(None, "")
        except InterruptedError:
            pass
    assert seen == [M.FOLDS, M.FOLDS]


def test_models_are_fitted_on_faster_copies_too(spark):
    sf = "/root/testdata/sf0.001"
    labels = P.truth(spark, sf)
    sig = P.materialize(P.signals(spark, sf), "signals")
    feats = P.materialize(P.S.build_features(sig), "features")
    got = P.materialize(P.training_samples(feats, P.usable_frames(spark, sf), labels), "training")
    assert got.filter("origin IS NULL OR label IS NULL").isEmpty()
    seen = {(r["take"], r["origin"]): r["n"] for r in got.groupBy("take", "origin").agg(F.count(F.lit(1)).alias("n")).collect()}
    plain = {r["take"]: r["n"] for r in P.labelled_samples(feats, labels).groupBy("take").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert plain and {t for t, _ in seen} == {f"{t}{x}" for t in plain for x in ("", "x1.5", "x2.0", "x3.0")}
    for take, n in plain.items():
        assert seen[take, take] == n
        for f in P.FASTER:
            # a copy has its take's samples thinned by the factor
            assert abs(seen[f"{take}x{f}", take] - n / f) < 0.05 * n + 10


@pytest.fixture(scope="module")
def decoded(spark):
    sf = "/root/testdata/sf0.001"
    post, sig = P._posteriors(spark, sf, folds=2)
    return sf, post, sig


def test_serving_tables_carry_what_was_computed(spark, decoded, monkeypatch):
    sf, post, sig = decoded
    monkeypatch.setattr(P, "_posteriors", lambda *a, **k: (post, sig))
    samples = P.materialize(P.serving_signals(spark, sf), "served")
    labels = {(r["take"], r["sample_idx"]): r["label"] for r in P.G.pelt_labels(post).collect()}
    got = samples.select("take", "sample_idx", "predicted_label").collect()
    assert len(got) == sig.count() and all(r["predicted_label"] == labels[r["take"], r["sample_idx"]] for r in got)
    assert {r["predicted_label"] for r in got} <= set(LABELS) and len({r["predicted_label"] for r in got}) > 2
    group = {r["take"]: r["take_group"] for r in P.table(spark, sf, "takes").collect()}
    events = P.pipeline_serving(spark, sf).select("take", "take_group").collect()
    assert events and all(r["take_group"] == group.get(r["take"]) for r in events) and any(r["take_group"] for r in events)
    monkeypatch.setattr(P, "serving_signals", lambda *a: samples)
    view = P.tableau_signals(spark, sf)
    assert view.count() == samples.filter(F.col("take").isin(list(group))).count()
    assert view.filter("NOT hand_not_visible AND (speed IS NULL OR aperture IS NULL OR predicted_label IS NULL)").isEmpty()


def test_each_model_predicts_its_rows_once():
    keys = pd.Series([0, 1, 1, 2, 0], dtype="int32")
    as_lists = lambda models: {k: v.tolist() for k, v in M.rows_by_model(keys, models).items()}
    assert as_lists({None: "all"}) == {None: [0, 1, 2, 3, 4]}
    assert as_lists({0: "a", 1: "b", 2: "c"}) == {0: [0, 4], 1: [1, 2], 2: [3]}
    assert as_lists({1: "b", None: "all"}) == {1: [1, 2], None: [0, 3, 4]}
