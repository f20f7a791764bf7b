"""Changepoints, labels and decoders against exhaustive search and hand-made cases."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from phasemill.operators import models as M
from phasemill.operators import segmentation as G
from phasemill.schemas import LABELS, RuleParams

R = RuleParams()


def exact_cost(x, bounds, pen):
    edges = [0, *bounds, len(x)]
    return sum(((x[a:b] - x[a:b].mean(0)) ** 2).sum() + pen for a, b in itertools.pairwise(edges))


def exact(x, pen, size):
    n = len(x)
    best, back = [np.inf] * (n + 1), [0] * (n + 1)
    best[0] = 0
    for t in range(size, n + 1):
        for s in range(0, t - size + 1):
            c = best[s] + ((x[s:t] - x[s:t].mean(0)) ** 2).sum() + pen
            if c < best[t] - 1e-12:
                best[t], back[t] = c, s
    return best[n]


@pytest.mark.parametrize("seed", range(20))
def test_pelt_is_exact(seed):
    rng = np.random.default_rng(seed)
    x = np.repeat(rng.normal(0, 2, (rng.integers(2, 7), 2)), rng.integers(2, 12), axis=0)
    x = x + rng.normal(0, 0.5, x.shape)
    pen = rng.choice([0.5, 1, 2, 4])
    got = G.pelt(x, pen, 3)
    assert all(b - a >= 3 for a, b in itertools.pairwise([0, *got, len(x)])) or len(x) < 3
    if len(x) >= 3:
        assert exact_cost(x, got, pen) == pytest.approx(exact(x, pen, 3))


def test_pelt_short():
    assert G.pelt(np.zeros((0, 1)), 1) == [] and G.pelt(np.zeros((4, 1)), 1) == []


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_is_exact(seed):
    rng = np.random.default_rng(seed)
    logp = np.log(rng.dirichlet(np.ones(6), 5))
    step = lambda a, b: 0.0 if a == b else -1.0 if (b - a) % 6 == 1 else -3.0
    score = lambda p: sum(logp[i, c] for i, c in enumerate(p)) + sum(step(a, b) for a, b in itertools.pairwise(p))
    best = max(score(p) for p in itertools.product(range(6), repeat=5))
    assert score(G.viterbi(logp, 0, 1, 3)) == pytest.approx(best)


# The truth table of the rules: speed, p, dp, aperture, change of aperture, label before, label.
RULES = [
    (0.1, 0.0, 0, 1.0, 0, None, "REST"), (2.5, 0.5, 0.7, 1.0, 0, "REST", "REACH"), (2.5, 0.5, -0.7, 1.0, 0, "RELEASE", "RETRACT"),
    (0.5, 0.9, 0, 0.8, -0.3, "REACH", "GRASP"), (0.1, 0.9, 0, 0.8, 0, "GRASP", "HOLD"), (0.6, 0.9, 0, 0.8, 0, "REACH", "GRASP"),
    (0.3, 0.9, 0, 1.3, 0.4, "HOLD", "RELEASE"), (0.1, 0.9, 0, 1.2, 0, "HOLD", "RELEASE"), (0.1, 0.9, 0, 1.2, 0, "REACH", "REACH"),
    (0.2, 0.45, 0, 1.0, 0, "REACH", "REACH"), (0.2, 0.45, 0, 1.0, 0, "RETRACT", "RETRACT"), (0.1, 0.9, 0, 0.8, 0, "REST", "HOLD"),
]


@pytest.mark.parametrize("case", RULES)
def test_rules(case):
    *values, previous, want = case
    assert G.rule_label(*values, previous, R) == want


def posteriors(spark, runs, noise=0.05, seed=0):
    rng, rows, i = np.random.default_rng(seed), [], 0
    for label, n in runs:
        for _ in range(n):
            p = np.full(6, 0.02)
            p[LABELS.index(label)] = 0.9
            rows.append(("a", i, i / 30, *[float(v) for v in p + rng.normal(0, noise, 6)]))
            i += 1
    schema = "take string, sample_idx long, t double, " + ", ".join(f"p_{x} double" for x in LABELS)
    return spark.createDataFrame(rows, schema), spark.createDataFrame([("a", i / 30)], "take string, t_end double")


CYCLE = [("REST", 30), ("REACH", 20), ("GRASP", 25), ("HOLD", 40), ("RELEASE", 12), ("RETRACT", 18), ("REST", 30)]


@pytest.mark.parametrize("decode", [lambda p, e: G.decode_pelt(p, e, 2.0), G.decode_argmax, lambda p, e: G.decode_grammar(p, e)])
def test_decoders(spark, decode):
    post, ends = posteriors(spark, CYCLE)
    ev = decode(post, ends).orderBy("event_idx").toPandas()
    assert ev["label"].tolist() == [x for x, _ in CYCLE]
    assert np.allclose(ev["end_s"][:-1], ev["start_s"][1:]) and ev["end_s"].iloc[-1] == pytest.approx(175 / 30)
    assert (ev["labels_in_event"] == 1).all() and ev["n_samples"].sum() == 175 and (ev["mean_confidence"] > 0.7).all()


def test_blip(spark):
    post, ends = posteriors(spark, [("REST", 40), ("HOLD", 6), ("REST", 40)], noise=0)
    labels = lambda df: [r["label"] for r in df.orderBy("event_idx").collect()]
    assert labels(G.decode_pelt(post, ends, 0.5)) == ["REST", "HOLD", "REST"]
    assert labels(G.decode_grammar(post, ends, 8, 30)) == ["REST"]


def test_chunks_agree_with_one_call(spark):
    df = spark.createDataFrame([("a", i, float((i // 40) % 2)) for i in range(600)], "take string, i long, v double")

    def starts(g: pd.DataFrame) -> np.ndarray:
        out = np.zeros(len(g), int)
        out[G.pelt(g[["v"]].to_numpy(), 0.5)] = 1
        return out

    whole = {(r["i"], r["out"]) for r in G.by_chunk(df, "i", ["v"], starts).collect()}
    assert whole == {(r["i"], r["out"]) for r in G.by_chunk(df, "i", ["v"], starts, chunk=130, halo=60).collect()}


def test_models(spark, tmp_path):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 6, 1500)
    x = rng.normal(0, 0.6, (1500, 4)) + np.eye(6)[y][:, :4] * 2 - np.eye(6)[y][:, 4:5] * 2
    sample = pd.DataFrame(x, columns=list("abcd")).assign(label=[LABELS[i] for i in y], take=rng.choice(["u", "v"], 1500))
    for kind in ("logreg", "hgb"):
        model = M.fit(sample[:1000], list("abcd"), kind)
        p = model.predict(x[1000:])
        assert np.allclose(p.sum(1), 1) and (p.argmax(1) == y[1000:]).mean() > 0.8
        M.save(model, tmp_path / kind, takes=["u", "v"])
        again, meta = M.load(tmp_path / kind)
        assert np.allclose(again.predict(x[:50]), model.predict(x[:50])) and meta["takes"] == ["u", "v"]
        (tmp_path / kind).write_bytes((tmp_path / kind).read_bytes() + b"x")
        with pytest.raises(ValueError, match="isn't the one"):
            M.load(tmp_path / kind)
    df = spark.createDataFrame(sample.drop(columns="label").assign(i=range(1500)))
    models = M.leave_one_out(sample, list("abcd"), "logreg", ["u"])
    out = M.with_posteriors(df, list("abcd"), models, ["take", "i"]).toPandas().sort_values("i")
    own = np.where((sample["take"] == "u").to_numpy()[:, None], models["u"].predict(x), models[None].predict(x))
    assert np.allclose(out[[f"p_{c}" for c in LABELS]].to_numpy(), own)
    grid = spark.createDataFrame([(1.0, 0.85712345), (2.0, 0.85712349), (0.5, 0.8)], "penalty double, objective double")
    assert M.best_setting(grid).first()["penalty"] == 2.0
    assert M.bounded_sample(df, ["i"], 10).count() == 10


def test_shifted_labels_spoil_accuracy():
    rng = np.random.default_rng(2)
    y = np.repeat(rng.integers(0, 6, 60), 25)
    x = np.eye(6)[y] + rng.normal(0, 0.3, (len(y), 6))
    frame = lambda labels: pd.DataFrame(x, columns=list("abcdef")).assign(label=[LABELS[i] for i in labels])
    good = M.fit(frame(y), list("abcdef")).predict(x).argmax(1)
    bad = M.fit(frame(np.roll(y, 200)), list("abcdef")).predict(x).argmax(1)
    assert (good == y).mean() > 0.9 > 0.5 > (bad == y).mean()


def test_segment_labels_in_order(spark):
    rows = [("a", 0, 0.1, 0.0, 0.0, 1.0, 0.0), ("a", 1, 2.5, 0.5, 0.7, 1.0, 0.0), ("a", 2, 0.2, 0.45, 0.0, 1.0, 0.0), ("a", 3, 0.1, 0.9, 0.0, 0.8, 0.0)]
    df = spark.createDataFrame(rows, "take string, segment long, mean_speed double, p_mean double, dp double, mean_aperture double, d_ap double")
    assert [r["label"] for r in G.label_segments(df, R).orderBy("segment").collect()] == ["REST", "REACH", "REACH", "HOLD"]
    assert F is not None


def long_take(spark, v):
    return spark.createDataFrame(pd.DataFrame({"take": "a", "sample_idx": np.arange(len(v)), "v": v}))


def test_changepoints_of_a_long_take_are_those_of_one_call(spark):
    # a ramp and a flat stretch, both longer than any context, over the sample number at which takes were once cut
    v = np.concatenate([np.repeat([0.0, 1.0] * 150, 200), np.linspace(0, 9, 9_000), np.full(62_500, 0.3), np.repeat([0.0, 1.0] * 5, 40)])
    assert len(v) > 2 * G.CHUNK
    got = G.changepoints(long_take(spark, v), "sample_idx", ["v"], 0.5).orderBy("sample_idx").toPandas()["segment"].to_numpy()
    want = np.zeros(len(v), int)
    want[G.pelt(v, 0.5)] = 1
    assert (got == want.cumsum()).all()


def test_pelt_fed_in_pieces():
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(0, 2, (60, 2)), 7, axis=0) + rng.normal(0, 0.3, (420, 2))
    for cuts in ([], [1, 2, 3, 4], [100, 101, 300], list(range(5, 420, 5))):
        state = G.Pelt(1.0, 3)
        for piece in np.split(x, cuts):
            state.push(piece)
        assert state.changepoints() == G.pelt(x, 1.0, 3)


def test_grammar_of_a_long_take_remembers(spark):
    # nothing speaks for a change in the flat stretch, which is longer than any context
    n = G.CHUNK + 4_000
    p = np.full((n, 6), 1 / 6)
    p[: n - 9_000] = np.where(np.arange(6) == LABELS.index("HOLD"), 0.9, 0.02)
    post = spark.createDataFrame(pd.DataFrame({"take": "a", "sample_idx": np.arange(n), "t": np.arange(n) / 30, **{f"p_{x}": p[:, i] for i, x in enumerate(LABELS)}}))
    ends = spark.createDataFrame([("a", n / 30)], "take string, t_end double")
    assert [r["label"] for r in G.decode_grammar(post, ends).orderBy("event_idx").collect()] == ["HOLD"]
