"""One pass over whole takes gives what the expressions over shards give, and the pipeline writes no wide tables."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from phasemill.operators import models as M
from phasemill.operators import segmentation as G
from phasemill.operators import signals as S
from phasemill.operators.metrics import full_scores, objective
from phasemill.plans import pipeline as P
from phasemill.plans.serving import serve_events
from phasemill.schemas import LABELS, SignalParams

SF = "/root/testdata/sf0.001"


def same(a, b, keys):
    a, b = (x.toPandas().sort_values(keys).reset_index(drop=True) for x in (a, b))
    assert sorted(a.columns) == sorted(b.columns) and len(a) == len(b) > 0
    for c in a.columns:
        if a[c].dtype.kind == "f":
            np.testing.assert_allclose(a[c], b[c], atol=1e-9)
        else:
            assert (a[c] == b[c]).all(), c


@pytest.fixture(scope="module")
def parts(spark):
    frames = P.materialize(P.usable_frames(spark, SF), "frames")
    sig = P.materialize(S.derive_signals(frames, SignalParams(smooth_win=5)), "signals")
    return frames, sig, P.materialize(S.build_features(sig), "features")


def test_signals_and_features_of_whole_takes_are_those_of_shards(parts):
    frames, sig, feats = parts
    same(sig, S.derive_signals(frames, SignalParams(smooth_win=5), limit=0), ["take", "sample_idx"])
    same(feats, S.build_features(sig, limit=0), ["take", "sample_idx"])


def test_the_chosen_samples_are_those_of_all_labelled_ones(spark, parts):
    frames, sig, feats = parts
    labels = P.materialize(P.truth(spark, SF), "truth")
    want = M.bounded_sample(P.training_samples(feats, frames, labels), ["take", "sample_idx"], 300).select("origin", "take", "sample_idx", "label", *P.FEATURES)
    native = P.materialize(S.native_channels(frames), "native")
    sizes = P.materialize(S.sizes_of(native), "sizes")
    keys = P.materialize(P.training_keys(sizes, labels, 300), "keys")
    for limit in (S.LIMIT, 0):
        same(P.sampled_features(native, sizes, keys, SignalParams(smooth_win=5), limit), want, ["take", "sample_idx"])


def test_features_are_written_of_the_sample_only(spark, monkeypatch):
    written, write = [], P.materialize

    def spy(df, what):
        written.append((what, set(P.FEATURES) <= set(df.columns)))
        return write(df, what)

    for module in (P, S):
        monkeypatch.setattr(module, "materialize", spy)
    P._posteriors(spark, SF)
    assert [what for what, wide in written if wide] == ["sample"]


def test_decoders_of_whole_takes_are_those_of_shards(spark):
    rng = np.random.default_rng(3)
    rows = []
    for take, n in (("a", 1), ("b", 4), ("c", 700), ("d", 97)):
        p = rng.dirichlet(np.ones(6) * 0.4, n // 7 + 1).repeat(7, 0)[:n] * 0.8 + rng.dirichlet(np.ones(6), n) * 0.2
        rows += [(take, i, i / 30, *map(float, x)) for i, x in enumerate(p)]
    post = spark.createDataFrame(rows, "take string, sample_idx long, t double, " + ", ".join(f"p_{x} double" for x in LABELS))
    ends = P.take_ends(post)
    for decode in (G.decode_argmax, G.decode_pelt, G.decode_grammar):
        same(decode(post, ends), decode(post, ends, limit=0), ["take", "event_idx"])
    same(G.pelt_labels(post), G.pelt_labels(post, limit=0), ["take", "sample_idx"])
    for limit in (G.LIMIT, 0):
        every = P.materialize(G.decode_penalties(post, ends, P.PENALTIES, limit=limit), "every")
        for penalty in (0.25, 8.0):
            same(every.filter(F.col("penalty") == penalty).drop("penalty"), G.decode_pelt(post, ends, penalty), ["take", "event_idx"])


@pytest.fixture(scope="module")
def found(spark):
    return P._posteriors(spark, SF, folds=2)


def test_events_of_the_predicting_pass_are_those_of_written_posteriors(found):
    pair = tuple(found)
    for how in P.DECODERS:
        want = P.materialize(P.events_by(pair, how), "want")
        assert P.events_by(found, how).columns == want.columns
        same(P.events_by(found, how), want, ["take", "event_idx"])
    # takes that don't fit a task
    same(P.events_by(replace(found, limit=300, written=None)), P.materialize(P.events_by(pair), "want"), ["take", "event_idx"])


def test_events_need_no_written_posteriors(spark, monkeypatch):
    written, write = [], P.materialize

    def spy(df, what):
        written.append(what)
        return write(df, what)

    monkeypatch.setattr(P, "materialize", spy)
    for query in (P.pelt_events, P.argmax_events, P.grammar_events):
        assert query(spark, SF).count() > 0
    assert set(written) == {"truth", "native", "sizes", "keys", "sample"}


def test_labelled_signals_of_the_predicting_pass_are_those_of_written_posteriors(found):
    want = P.materialize(P.labelled_signals(tuple(found)), "want")
    for each in (found, replace(found, limit=300, written=None)):
        got = P.materialize(P.labelled_signals(each), "got")
        assert got.dtypes == want.dtypes
        same(got.fillna("-", ["predicted_label"]), want.fillna("-", ["predicted_label"]), ["take", "sample_idx"])


def test_served_signals_need_no_written_posteriors(spark, found, monkeypatch):
    monkeypatch.setattr(P, "_posteriors", lambda *a, **k: replace(found, written=None))
    written, write = [], P.materialize

    def spy(df, what):
        written.append(what)
        return write(df, what)

    monkeypatch.setattr(P, "materialize", spy)
    for query in (P.serving_signals, P.tableau_signals):
        assert query(spark, SF).count() > 0 and "posteriors" not in written


def test_served_events_of_the_predicting_pass_are_those_of_written_signals(spark, found, monkeypatch):
    post, sig = found
    ev = P.materialize(P.events_by((post, sig)), "want").withColumn("model_version", F.lit("logreg"))
    groups = P.table(spark, SF, "takes").select("take", "take_group").distinct()
    want = serve_events(ev.join(groups, "take", "left"), S.build_frames(P.table(spark, SF, "raw_keypoints")), sig, F.col("take_group"))
    written, write = [], P.materialize

    def spy(df, what):
        written.append(what)
        return write(df, what)

    monkeypatch.setattr(P, "materialize", spy)
    for limit, wide in ((found.limit, []), (300, ["posteriors"])):
        monkeypatch.setattr(P, "_posteriors", lambda *a, limit=limit, **k: replace(found, limit=limit, written=None))
        written.clear()
        got = P.pipeline_serving(spark, SF)
        assert [w for w in written if w == "posteriors"] == wide
        assert got.dtypes == want.dtypes
        same(got.fillna("-", ["take_group"]), want.fillna("-", ["take_group"]), ["take", "event_idx"])


def test_scores_need_no_written_posteriors(spark, found, monkeypatch):
    monkeypatch.setattr(P, "_posteriors", lambda *a, **k: replace(found, written=None))
    written, write = [], P.materialize

    def spy(df, what):
        written.append(what)
        return write(df, what)

    monkeypatch.setattr(P, "materialize", spy)
    assert "take_group" in P.pipeline_scores(spark, SF).columns and written == ["events", "truth"]


def test_rule_segments_and_events_of_whole_takes_are_those_of_shards(parts):
    _, sig, _ = parts
    same(P.rule_segments(sig), P.rule_segments(sig, limit=0), ["take", "sample_idx"])
    same(P.rule_events_of(sig), P.rule_events_of(sig, limit=0), ["take", "event_idx"])


def test_rule_events_are_one_pass_over_the_signals(spark, monkeypatch):
    written, write = [], P.materialize

    def spy(df, what):
        written.append(what)
        return write(df, what)

    for module in (P, S, G):
        monkeypatch.setattr(module, "materialize", spy)
    assert P.rule_events(spark, SF).count() > 0
    assert written == ["native", "sizes", "signals"]


def test_objectives_of_all_penalties_are_those_of_full_scores(spark):
    rng = np.random.default_rng(5)
    rows = []
    for take, n in (("a", 300), ("b", 120), ("c", 60)):
        p = rng.dirichlet(np.ones(6) * 0.4, n // 10 + 1).repeat(10, 0)[:n]
        rows += [(take, i, i / 30, *map(float, x)) for i, x in enumerate(p)]
    post = P.materialize(spark.createDataFrame(rows, "take string, sample_idx long, t double, " + ", ".join(f"p_{x} double" for x in LABELS)), "post")
    labels = [("a", 1, LABELS[i % 6], i * 0.9, (i + 1) * 0.9) for i in range(10)] + [("b", 1, LABELS[i], i * 0.5, i * 0.5 + 0.4) for i in range(6)]
    labels = P.materialize(spark.createDataFrame(labels, "take string, cycle int, label string, start_s double, end_s double"), "labels")
    got = {r["penalty"]: r["objective"] for r in P.penalty_objectives(post, post, labels).collect()}
    assert sorted(got) == list(P.PENALTIES)
    frames = post.select("take", F.col("sample_idx").alias("frame_idx"), "t")
    for penalty in (0.25, 2.0):
        scores = objective(full_scores(frames, G.decode_pelt(post, P.take_ends(post), penalty), labels))
        assert got[penalty] == pytest.approx(scores.agg(F.avg("objective")).first()[0], abs=1e-9)


def test_penalties_share_one_pass(spark, monkeypatch):
    pushed = []
    monkeypatch.setattr(P.G, "decode_pelt", lambda *a, **k: pushed.append(a))
    post = spark.createDataFrame([("a", i, i / 30, *[float(k == i // 10 % 6) for k in range(6)]) for i in range(60)], "take string, sample_idx long, t double, " + ", ".join(f"p_{x} double" for x in LABELS))
    labels = spark.createDataFrame([("a", 1, LABELS[i], i / 3, (i + 1) / 3) for i in range(6)], "take string, cycle int, label string, start_s double, end_s double")
    assert P.penalty_objectives(post, post, labels).count() == len(P.PENALTIES) and not pushed
