"""From raw keypoints to labelled events and scores, and the queries that run the stages over the test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasemill.operators import models as M
from phasemill.operators import segmentation as G
from phasemill.operators import signals as S
from phasemill.operators.metrics import boundary_metrics, full_scores, setting_objectives
from phasemill.operators.relational import in_segment, range_join, with_last_flag
from phasemill.operators.takes import full
from phasemill.plans.catalogue import disjoint_events, truth
from phasemill.plans.serving import serve_counted, serve_signals, signals_view, with_frame_counts, with_signal_means
from phasemill.schemas import LABELS, TUNED, RuleParams, SignalParams
from phasemill.session import materialize, table

FEATURES = S.feature_names()
FASTER = (1.5, 2.0, 3.0)  # besides 1, the take itself


def usable_frames(spark: SparkSession, d: str) -> DataFrame:
    # impossible readings would set the scale of whole takes
    raw = table(spark, d, "raw_keypoints")
    sane = F.col("x").between(-1, 2) & F.col("y").between(-1, 2)
    raw = raw.withColumn("detected", F.col("detected") & F.coalesce(sane, F.lit(False)))
    return S.build_frames(raw)


def signals(spark: SparkSession, d: str, window: int = 5) -> DataFrame:
    return S.derive_signals(usable_frames(spark, d), SignalParams(smooth_win=window))


def labelled_samples(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Samples with the hand label at their time; those without one are dropped."""
    seg = with_last_flag(labels.select("take", "label", "start_s", "end_s"), ["take"], "start_s")
    return range_join(features, seg, ["take"], "t", how="inner").drop("start_s", "end_s", "is_last")


def take_ends(sig: DataFrame) -> DataFrame:
    return sig.groupBy("take").agg(F.max("t").alias("t_end"))


def training_samples(features: DataFrame, frames: DataFrame, labels: DataFrame, window: int = 5) -> DataFrame:
    """Labelled samples of the takes as they are and of their copies performed faster: ``origin, take, sample_idx, label, *FEATURES``.

    ``origin`` is the take a copy is of. Copies go through signals and features as takes do.
    """
    columns = ["origin", "take", "sample_idx", "label", *FEATURES]
    own = labelled_samples(features, labels).withColumn("origin", F.col("take")).select(*columns)
    fast, segments = faster(frames, labels)
    origins = fast.select("take", "origin").distinct()
    copies = S.build_features(materialize(S.derive_signals(fast.drop("origin"), SignalParams(smooth_win=window)), "fast_signals"))
    return own.unionByName(labelled_samples(copies, segments).join(origins, "take").select(*columns))


def faster(frames: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Copies of the labelled takes performed faster: frames with the ``origin`` they copy, and labels."""
    fast, segments = S.time_scaled(frames.withColumn("origin", F.col("take")).join(labels.select("take").distinct(), "take", "left_semi"), labels, FASTER)
    return fast.drop("factor"), segments.select("take", "label", "start_s", "end_s")


def posteriors(features: DataFrame, training: DataFrame, kind: str = "logreg", rows: int = M.SAMPLE_ROWS, folds: int = 0) -> DataFrame:
    """Class probabilities of every sample. The classifier is fitted on a sample of at most ``rows`` of the ``training`` samples. With
    ``folds``, takes are hashed into so many and each is predicted by a model fitted without its fold, copies included, as takes trained on should."""
    sample = M.bounded_sample(training, ["take", "sample_idx"], rows).withColumn("fold", M.fold_of(F.col("origin"), folds or 1))
    models = M.fold_models(materialize(sample, "sample"), FEATURES, kind, folds)
    return M.with_posteriors(features.withColumn("fold", M.fold_of(F.col("take"), folds or 1)), FEATURES, models, ["take", "sample_idx", "t"], "fold")


def segment_posteriors(features: DataFrame, model: M.Logistic | M.Boosting) -> DataFrame:
    """Class probabilities of every sample by a stored model (:func:`models.load`)."""
    return M.with_posteriors(features, FEATURES, {None: model}, ["take", "sample_idx", "t"])


def segment_frames(frames: DataFrame, model: M.Logistic | M.Boosting, window: int = 5, decode: Callable[[DataFrame, DataFrame], DataFrame] = G.decode_pelt) -> DataFrame:
    """Events of any frames table by a stored model; nothing is fitted."""
    sig = materialize(S.derive_signals(frames, SignalParams(smooth_win=window)), "signals")
    return decode(materialize(segment_posteriors(S.build_features(sig), model), "posteriors"), take_ends(sig))


def training_keys(sizes: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """The samples to fit on, of takes and their faster copies: ``take, origin, factor, sample_idx, label``.

    Which samples a segment holds follows from the bounds of the take's grid, so they are chosen
    before any signal is derived. ``sizes`` are those of :func:`signals.sizes_of`.
    """
    own = labels.select("take", "label", "start_s", "end_s").withColumn("factor", F.lit(1.0))
    _, fast = S.time_scaled(own.select("take", F.lit(0.0).alias("t")).limit(0), labels.select("take", "label", "start_s", "end_s", F.col("take").alias("origin")), FASTER)
    seg = with_last_flag(own.withColumn("origin", F.col("take")).unionByName(fast), ["take"], "start_s").filter("end_s >= start_s")
    grids = sizes.select(F.col("take").alias("origin"), F.col("t0").alias("__t0"), F.col("t1").alias("__t1"))
    seg = seg.join(grids, "origin").withColumns({"__t0": F.col("__t0") / F.col("factor"), "__t1": F.col("__t1") / F.col("factor")})
    start, end, slack = F.col("start_s"), F.col("end_s"), 1e-3 + F.abs("end_s") * 1e-5
    last = F.floor((F.col("__t1") - F.col("__t0") + 1e-9) * S.GRID_HZ)
    lo, hi = F.greatest(F.lit(0), F.floor((start - F.col("__t0")) * S.GRID_HZ) - 1), F.least(last, F.floor((end + slack - F.col("__t0")) * S.GRID_HZ) + 1)
    at = S._each(seg.withColumns({"__a": lo, "__b": hi}).filter("__a <= __b"), F.col("__a"), F.col("__b"), "sample_idx")
    held = at.filter(in_segment(F.col("__t0") + F.col("sample_idx") / float(S.GRID_HZ), start, end, F.col("is_last")))
    return M.bounded_sample(held.select("take", "origin", "factor", "sample_idx", "label"), ["take", "sample_idx"], rows)


def sampled_features(native: DataFrame, sizes: DataFrame, keys: DataFrame, params: SignalParams, limit: int = S.LIMIT) -> DataFrame:
    """Features of the samples of :func:`training_keys`: ``origin, take, sample_idx, label, *FEATURES``. Takes and copies without any aren't derived."""
    copies = keys.select(F.col("take").alias("copy"), "origin", "factor").distinct()
    fits, large = S.parted(native.join(keys.select(F.col("origin").alias("take")).distinct(), "take", "left_semi"), sizes, limit)
    wanted: dict[str, list] = {}  # bounded as the sample is
    for r in keys.groupBy("origin", "take", "factor").agg(F.collect_set("sample_idx").alias("at")).collect():
        wanted.setdefault(r["origin"], []).append((r["take"], r["factor"], np.array(sorted(r["at"]))))
    held = native.sparkSession.sparkContext.broadcast(wanted)
    weights = S.weights_of(params)

    def run(take: str | None, c: S.Columns):
        channels, was = S.filled_take(c)
        for name, factor, at in held.value.get(take, ()):
            s = S.take_signals(channels | {"t": c["t"] / factor}, was, params, weights)
            for rows, x in S.take_features(s):
                own = at[np.searchsorted(at, rows.start) : np.searchsorted(at, rows.stop)]
                if len(own):
                    yield name, {"sample_idx": own} | {n: x[own - rows.start, i] for i, n in enumerate(FEATURES)}

    feats = S.by_whole_take(fits, "frame_idx", S.NATIVE, run, "take string, sample_idx long, " + ", ".join(f"{n} double" for n in FEATURES))
    if large is not None:
        fast = large.withColumnRenamed("take", "origin").join(copies, "origin").withColumn("t", F.col("t") / F.col("factor")).withColumnRenamed("copy", "take").select(*native.columns)
        sig = materialize(S.sharded_signals(fast, params), "fast_signals")
        feats = feats.unionByName(S.sharded_features(sig).join(keys, ["take", "sample_idx"], "left_semi").select(*feats.columns))
    return keys.select("origin", "take", "sample_idx", "label").join(feats, ["take", "sample_idx"])


def predicted_samples(native: DataFrame, sizes: DataFrame, models: dict, folds: int, params: SignalParams, served: bool = False, limit: int = S.LIMIT) -> DataFrame:
    """``take, sample_idx, t`` and the class probabilities of every sample, with all its signals if ``served``: one pass from frames to probabilities."""
    fits, large = S.parted(native.withColumn("fold", M.fold_of(F.col("take"), folds or 1)), sizes, limit)
    held, weights = native.sparkSession.sparkContext.broadcast(models), S.weights_of(params)
    probs = [f"p_{x}" for x in LABELS]
    schema = (S.SIGNALS if served else "take string, sample_idx long, t double") + ", " + ", ".join(f"{p} double" for p in probs)
    keep = [f.split()[0] for f in schema.split(", ")][1 : -len(probs)]

    def run(take: str | None, c: S.Columns):
        s, pieces = predicted_take(take, c, held, folds, params, weights)
        for rows, y in pieces:
            yield take, {k: s[k][rows] for k in keep} | {p: y[:, i] for i, p in enumerate(probs)}

    out = S.by_whole_take(fits, "frame_idx", [*S.NATIVE, "fold"], run, schema)
    if large is None:
        return out
    sig = materialize(S.sharded_signals(large, params), "signals")
    feats = S.sharded_features(sig).withColumn("fold", M.fold_of(F.col("take"), folds or 1))
    post = M.with_posteriors(feats, FEATURES, models, ["take", "sample_idx", "t"], "fold")
    return out.unionByName(sig.join(post.drop("t"), ["take", "sample_idx"]).select(*out.columns) if served else post)


def predicted_take(take: str | None, c: S.Columns, held: Broadcast, folds: int, params: SignalParams, weights: Callable) -> tuple[S.Columns, Iterator[tuple[slice, np.ndarray]]]:
    """The signals of one take, and piece by piece the class probabilities of its samples."""
    model = held.value[int(c["fold"][0])] if folds else held.value[None]
    s = S.take_signals(*S.filled_take(c), params, weights, take is not None)
    return s, ((rows, model.predict(x)) for rows, x in S.take_features(s))


@dataclass
class Predictions:
    """Frames of takes and the models that predict them.

    As a pair they are posteriors and signals, written when first asked for. :func:`events_by` and
    :func:`labelled_signals` decode a take in the pass that predicts it, so that neither is written.
    """

    native: DataFrame
    sizes: DataFrame
    models: dict
    folds: int
    params: SignalParams
    served: bool = True
    limit: int = S.LIMIT
    written: DataFrame | None = None

    def __iter__(self) -> Iterator[DataFrame]:
        if self.written is None:
            self.written = materialize(predicted_samples(self.native, self.sizes, self.models, self.folds, self.params, self.served, self.limit), "posteriors")
        return iter((self.written.select("take", "sample_idx", "t", *G.PROBS), self.written.drop(*G.PROBS)))

    def decoded(self, n: int, places: Callable[[np.ndarray], np.ndarray], kernel: Callable, schema: str) -> tuple[DataFrame, Predictions | None]:
        """What ``kernel`` yields for each take from its name, signals, ``n``-smoothed posteriors and their ``places`` of labels; and the larger takes, None if there are none."""
        folds, params, weights = self.folds, self.params, S.weights_of(self.params)
        fits, large = S.parted(self.native.withColumn("fold", M.fold_of(F.col("take"), folds or 1)), self.sizes, self.limit)
        held = self.native.sparkSession.sparkContext.broadcast(self.models)

        def run(take: str | None, c: S.Columns):
            s, pieces = predicted_take(take, c, held, folds, params, weights)
            post = G.smooth_rows(np.vstack([y for _, y in pieces]), n)
            yield from kernel(take, s, post, places(post))

        return S.by_whole_take(fits, "frame_idx", [*S.NATIVE, "fold"], run, schema), large if large is None else replace(self, native=large, served=True, written=None)


# Samples smoothed over, the decoder of a take's posteriors, and that of a table.
DECODERS = {"pelt": (5, G.pelt_places, G.decode_pelt), "argmax": (5, G.argmax_places, G.decode_argmax), "grammar": (3, G.grammar_places, G.decode_grammar)}


MEANS = ["mean_speed", "mean_aperture", "frac_missing"]


def events_by(found: Predictions | tuple[DataFrame, DataFrame], how: str = "pelt", means: bool = False) -> DataFrame:
    """Decoded events, in one pass from frames where a take fits a task. With ``means``, also those of the signals of their samples."""
    if not isinstance(found, Predictions):
        post, sig = found
        events = DECODERS[how][2](post, take_ends(sig))
        return with_signal_means(materialize(events, "events"), sig) if means else events

    def kernel(take: str | None, s: S.Columns, post: np.ndarray, labels: np.ndarray):
        rows = G.event_rows(labels, s["t"], post)
        rows["end_s"][-1] = s["t"][-1]
        if take is not None:
            yield take, rows | ({n: run_means(s[c], labels) for n, c in zip(MEANS, ("speed", "aperture", "missing"), strict=True)} if means else {})

    rows, large = found.decoded(*DECODERS[how][:2], kernel, ", ".join([G.EVENTS, *[f"{n} double" for n in MEANS if means]]))
    rows = G.with_durations(rows, *MEANS * means)
    return rows if large is None else rows.unionByName(events_by(tuple(large), how, means))


def run_means(v: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The mean of the known values in each run of equal labels, NaN if there are none."""
    first, known = G.runs_of(labels), ~np.isnan(v)
    n = np.add.reduceat(known.astype(float), first)
    return np.add.reduceat(np.where(known, v, 0.0), first) / np.where(n > 0, n, np.nan)


def labelled_signals(found: Predictions | tuple[DataFrame, DataFrame]) -> DataFrame:
    """Signals of every sample with the ``predicted_label`` of :func:`segmentation.pelt_labels`, in one pass from frames where a take fits a task."""
    if not isinstance(found, Predictions):
        post, sig = found
        decoded = G.pelt_labels(post).select("take", "sample_idx", F.col("label").alias("predicted_label"))
        return sig.join(decoded, ["take", "sample_idx"], "left")
    keep = [f.split()[0] for f in S.SIGNALS.split(", ")][1:]

    def kernel(take: str | None, s: S.Columns, post: np.ndarray, labels: np.ndarray):
        place = labels if take is not None else np.full(len(labels), -1)
        for i in range(0, len(place), S.PIECE):
            yield take, {k: s[k][i : i + S.PIECE] for k in keep} | {"place": place[i : i + S.PIECE]}

    rows, large = found.decoded(*DECODERS["pelt"][:2], kernel, S.SIGNALS + ", place long")
    label = F.get(F.array(*[F.lit(x) for x in LABELS]), F.col("place").cast("int"))  # NULL where there is none
    rows = rows.withColumn("predicted_label", label).drop("place")
    return rows if large is None else rows.unionByName(labelled_signals(tuple(large)))


def _posteriors(spark: SparkSession, d: str, kind: str = "logreg", rows: int = M.SAMPLE_ROWS, folds: int = 0, served: bool = True) -> Predictions:
    """Posteriors and signals of the takes (of the signals only the times unless ``served``). What a model is fitted on are samples of
    takes and of their faster copies; with ``folds`` each take is predicted by a model fitted without its fold, copies included."""
    params = SignalParams(smooth_win=5)
    labels = materialize(truth(spark, d), "truth")
    native = materialize(S.native_channels(usable_frames(spark, d)), "native")
    sizes = materialize(S.sizes_of(native), "sizes")
    keys = materialize(training_keys(sizes, labels, rows), "keys")
    sample = sampled_features(native, sizes, keys, params).withColumn("fold", M.fold_of(F.col("origin"), folds or 1))
    models = M.fold_models(materialize(sample, "sample"), FEATURES, kind, folds)
    return Predictions(native, sizes, models, folds, params, served)


RULE_COLUMNS = ["sample_idx", "t", *S.BASE, "missing"]


def rule_channels(sig: DataFrame) -> DataFrame:
    """Signals with the gaps of what the rules read filled; takes without any value are left out."""
    last = sig.groupBy("take").agg(F.max("sample_idx").alias("last_idx"))
    return S.filled_by_index(sig.join(last, "take"), ["speed", "aperture", "p"]).filter("speed_full IS NOT NULL")


def rule_take(c: S.Columns, r: RuleParams) -> S.Columns | None:
    """The channels, changepoints (1 where a segment starts) and gap-filled signals that the rules read, of one take; None without any speed."""
    out = {f"{n}_full": full(c[n], c["sample_idx"]) for n in ("speed", "aperture", "p")}
    if np.isnan(out["speed_full"]).all():
        return None
    out |= {"c0": np.sqrt(np.maximum(out["speed_full"], 0.0)) / r.speed_scale, "c1": out["aperture_full"] / r.ap_scale}
    state = G.Pelt(r.pen, rule_size(r))
    state.push(np.column_stack([out["c0"], out["c1"]]))
    return {"sample_idx": c["sample_idx"], "t": c["t"], "missing": c["missing"]} | out | {"starts": state.result()}


def rule_size(r: RuleParams) -> int:
    return max(2, round(r.min_size_s * 30))


def rule_segments(sig: DataFrame, r: RuleParams = TUNED, limit: int = S.LIMIT) -> DataFrame:
    """Samples with gap-filled signals, channels ``c0, c1`` and the ``segment`` between changepoints of both."""
    fits, large = S.parted(sig, sig.groupBy("take").agg(F.count(F.lit(1)).alias("size")), limit)
    columns = ["speed_full", "aperture_full", "p_full", "c0", "c1"]

    def run(take: str | None, c: S.Columns):
        if (found := rule_take(c, r)) is not None:
            yield take, found | {"segment": np.cumsum(found["starts"])}

    schema = "take string, sample_idx long, t double, missing boolean, " + ", ".join(f"{c} double" for c in columns) + ", segment long"
    out = S.by_whole_take(fits.filter("take IS NOT NULL"), "sample_idx", RULE_COLUMNS, run, schema)
    if large is None:
        return out
    return out.unionByName(G.changepoints(G.scaled_channels(rule_channels(large), r), "sample_idx", ["c0", "c1"], r.pen, rule_size(r)).select(out.columns))


def rule_events(spark: SparkSession, d: str) -> DataFrame:
    """Changepoints of speed and aperture, each segment labelled by rules; neighbours of one label merged, with the features of the merged event."""
    return rule_events_of(materialize(signals(spark, d), "signals"))


def rule_events_of(sig: DataFrame, r: RuleParams = TUNED, limit: int = S.LIMIT) -> DataFrame:
    fits, large = S.parted(sig, sig.groupBy("take").agg(F.count(F.lit(1)).alias("size")), limit)
    stats = ["mean_speed", "mean_aperture", "frac_missing"]

    def run(take: str | None, c: S.Columns):
        if (found := rule_take(c, r)) is not None:
            labels = G.rule_places(found, r)
            rows = G.event_rows(labels, c["t"], np.ones((len(labels), len(LABELS))))
            first = G.runs_of(labels)
            yield take, rows | {n: np.add.reduceat(found[v].astype(float), first) / rows["n_samples"] for n, v in zip(stats, ("speed_full", "aperture_full", "missing"), strict=True)}

    found = S.by_whole_take(fits, "sample_idx", RULE_COLUMNS, run, G.EVENTS + ", " + ", ".join(f"{n} double" for n in stats))
    out = G.with_ends(found, take_ends(fits), *stats).drop("mean_confidence")
    return out if large is None else out.unionByName(_sharded_rule_events(large, r))


def _sharded_rule_events(sig: DataFrame, r: RuleParams) -> DataFrame:
    filled = rule_channels(sig)
    segs = materialize(G.changepoints(G.scaled_channels(filled, r), "sample_idx", ["c0", "c1"], r.pen, rule_size(r)), "segments")
    labels = G.label_segments(G.segment_features(segs), r).select("take", "segment", "label")
    one = [F.lit(1.0).alias(f"p_{x}") for x in LABELS]
    found = materialize(G.events_of(segs.join(labels, ["take", "segment"]).select("*", *one), take_ends(sig)).drop("mean_confidence"), "events")
    spans = with_last_flag(found.select("take", F.col("event_idx").alias("segment"), "start_s", "end_s"), ["take"], "segment")
    held = range_join(filled, spans, ["take"], "t", relative=False, how="inner").drop("start_s", "end_s", "is_last")
    stats = G.segment_features(held).select("take", F.col("segment").alias("event_idx"), "mean_speed", "mean_aperture", "frac_missing")
    return found.join(stats, ["take", "event_idx"], "left")


def _decoded(how: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: events_by(_posteriors(spark, d, served=False), how)


pelt_events, argmax_events, grammar_events = _decoded("pelt"), _decoded("argmax"), _decoded("grammar")


def lr_probs(spark: SparkSession, d: str) -> DataFrame:
    return next(iter(_posteriors(spark, d, served=False)))


def boosted_probs(spark: SparkSession, d: str) -> DataFrame:
    return next(iter(_posteriors(spark, d, "hgb", 20_000, served=False)))


def pipeline_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores of the decoded events against the hand labels, per take and scope; no take is scored by a model fitted on it."""
    ev = materialize(events_by(_posteriors(spark, d, folds=M.FOLDS)), "events")
    groups = table(spark, d, "takes").select("take", "take_group")
    frames = S.build_frames(table(spark, d, "raw_keypoints"))
    labels = materialize(truth(spark, d), "truth")
    seen = labels.join(ev.select("take").distinct(), "take", "left_semi")
    return full_scores(frames.join(seen.select("take").distinct(), "take", "left_semi"), ev, seen).drop("take_group").join(groups, "take", "left")


def pipeline_serving(spark: SparkSession, d: str) -> DataFrame:
    """The serving table of events, with their frames and mean signals; no take is decoded by a model fitted on it."""
    ev = materialize(events_by(_posteriors(spark, d, folds=M.FOLDS), means=True), "events").withColumn("model_version", F.lit("logreg"))
    groups = table(spark, d, "takes").select("take", "take_group").distinct()
    return serve_counted(with_frame_counts(ev, S.build_frames(table(spark, d, "raw_keypoints"))).join(groups, "take", "left"), F.col("take_group"))


def serving_signals(spark: SparkSession, d: str) -> DataFrame:
    """The serving table of samples: signals, decoded label and hand label; no take is decoded by a model fitted on it."""
    return serve_signals(labelled_signals(_posteriors(spark, d, folds=M.FOLDS)), truth(spark, d))


def tableau_signals(spark: SparkSession, d: str) -> DataFrame:
    """The view of signals over the 30 Hz samples; ``v_tableau_signals`` is the part that its SQL can make of frames."""
    return signals_view(serving_signals(spark, d), table(spark, d, "takes").select("take", "take_group").distinct())


PENALTIES = (0.25, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 8.0)


def penalty_grid(spark: SparkSession, d: str) -> DataFrame:
    """The best changepoint penalty by the mean over takes of half boundary F1, half frame accuracy, on posteriors out of fold."""
    post, sig = _posteriors(spark, d, folds=M.FOLDS)
    labels = materialize(truth(spark, d).join(sig.select("take").distinct(), "take", "left_semi"), "truth")
    return M.best_setting(penalty_objectives(post, sig, labels))


def penalty_objectives(post: DataFrame, sig: DataFrame, labels: DataFrame) -> DataFrame:
    """The mean objective of every penalty; takes without labels count for none, so they aren't decoded."""
    ends = take_ends(sig)
    held = labels.select("take").distinct()
    events = materialize(G.decode_penalties(post.join(held, "take", "left_semi"), ends, PENALTIES), "events")
    scored = setting_objectives(sig.select("take", "t").join(held, "take", "left_semi"), events, labels, "penalty")
    return materialize(scored.groupBy("penalty").agg(F.avg("objective").alias("objective")).select("objective", "penalty"), "objective")


def chance_baselines(spark: SparkSession, d: str) -> DataFrame:
    out = boundary_metrics(disjoint_events(spark, d), truth(spark, d))
    return out.select("take", "scope", *[c for c in out.columns if c.startswith("chance_")])


QUERIES = {f.__name__: f for f in (rule_events, lr_probs, boosted_probs, pipeline_scores, pipeline_serving, serving_signals, tableau_signals, penalty_grid, chance_baselines)}
QUERIES |= {"pelt_events": pelt_events, "argmax_events": argmax_events, "grammar_events": grammar_events}
ORACLES: dict[str, str] = {}
