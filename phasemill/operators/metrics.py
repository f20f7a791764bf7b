"""Scores of detected against hand-labelled phases. Never pooled across takes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasemill.operators.reach import neighbours
from phasemill.operators.relational import in_intervals, range_join, with_last_flag
from phasemill.schemas import BOUNDARY_TOLERANCE_S, EPS, LABELS
from phasemill.session import materialize

DRAWS = 1000


def match_count_error(pred: np.ndarray, true: np.ndarray, tol: float) -> tuple[int, float]:
    """Most pairs within ``tol`` (1e-9 allowed), and the least total error of so many.

    Sorted times can be paired in order, so a table over prefixes suffices: skip either side or pair.
    """
    p, t = np.sort(np.asarray(pred, float)), np.sort(np.asarray(true, float))
    count, error = np.zeros(len(t) + 1, int), np.zeros(len(t) + 1)
    for x in p:
        c, e = count.copy(), error.copy()
        for j, y in enumerate(t, 1):
            options = [(count[j], -error[j]), (c[j - 1], -e[j - 1])]
            if abs(x - y) <= tol + EPS:
                options.append((count[j - 1] + 1, -(error[j - 1] + abs(x - y))))
            most = max(options)
            c[j], e[j] = most[0], -most[1]
        count, error = c, e
    return int(count[-1]), float(error[-1])


SMALL = 4096


def greedy_counts(pred: np.ndarray, true: np.ndarray, tol: float) -> np.ndarray:
    """Most pairs of each row of sorted ``pred`` with sorted ``true``: the first free one in reach is taken, for all rows at once."""
    near, far = true - (tol + EPS), true + (tol + EPS)
    if pred.shape[1] * len(true) <= SMALL:  # the same counts, without a search per row
        first, beyond = (pred[:, :, None] < near).sum(1).T, (pred[:, :, None] <= far).sum(1).T
    else:
        first, beyond = (np.stack([np.searchsorted(p, at, side) for p in pred], 1) for at, side in ((near, "left"), (far, "right")))
    used, found = np.zeros(len(pred), int), np.zeros(len(pred), int)
    for a, z in zip(first, beyond, strict=True):
        used = np.maximum(used, a)
        hit = used < z
        found += hit
        used += hit
    return found


BLOCK = 1 << 21  # numbers held at once


def chance_hits(n_pred: int, true: np.ndarray, t0: float, t1: float, tol: float, part: int = 0, parts: int = 1) -> tuple[int, int]:
    """Pairs that evenly spaced boundaries make (in the first part), and those of a part of the 1,000 seeded uniform sets, all together.

    Each set is drawn by the one stream of random numbers, of which a part skips what others draw.
    """
    lo, hi = DRAWS * part // parts, DRAWS * (part + 1) // parts
    if n_pred == 0 or len(true) == 0:
        return 0, 0
    even = int(greedy_counts(np.linspace(t0, t1, n_pred + 2)[1:-1][None, :], true, tol)[0]) if part == 0 else 0
    rng, hits = np.random.default_rng(0), 0
    rng.bit_generator.advance(lo * n_pred)  # a double takes one step
    step = max(1, BLOCK // max(n_pred, len(true)))
    for a in range(lo, hi, step):
        drawn = np.sort(rng.uniform(t0, t1, (min(step, hi - a), n_pred)), axis=1)
        hits += int(greedy_counts(drawn, true, tol).sum())
    return even, hits


def boundaries(segments: DataFrame, cycle: bool = False) -> DataFrame:
    """The start of every segment but a take's first: ``take, b`` and the cycle of the segment that starts there."""
    first = segments.groupBy("take").agg(F.min("start_s").alias("__first"))
    cols = ["take", F.col("start_s").alias("b"), *(["cycle"] if cycle else [])]
    return segments.join(first, "take").filter(F.col("start_s") > F.col("__first")).select(*cols)


def matched(pred: DataFrame, true: DataFrame, tol: float = BOUNDARY_TOLERANCE_S) -> DataFrame:
    """``take, scope, n_matched, total_error`` of boundaries ``take, scope, b``.

    Where neighbouring boundaries lie further apart than the tolerance no pair can cross, so each
    group is cut there into small independent problems; only their results are added up.
    """
    both = pred.select("take", "scope", "b", F.lit(0).alias("side")).unionByName(true.select("take", "scope", "b", F.lit(1).alias("side")))
    w = Window.partitionBy("take", "scope").orderBy("b", "side")
    apart = F.when(F.col("b") - F.lag("b").over(w) <= tol + EPS, 0).otherwise(1)
    parts = both.withColumn("__new", apart).withColumn("part", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    pick = lambda s: F.sort_array(F.collect_list(F.when(F.col("side") == s, F.col("b"))))
    parts = parts.groupBy("take", "scope", "part").agg(pick(0).alias("p"), pick(1).alias("t")).filter((F.size("p") > 0) & (F.size("t") > 0))

    def run(batches):
        for g in batches:
            pairs = [match_count_error(p, t, tol) for p, t in zip(g["p"], g["t"], strict=True)]
            yield pd.DataFrame({"take": g["take"], "scope": g["scope"], "n": [c for c, _ in pairs], "e": [e for _, e in pairs]})

    counted = parts.select("take", "scope", "p", "t").mapInPandas(run, "take string, scope string, n long, e double")
    return counted.groupBy("take", "scope").agg(F.sum("n").alias("n_matched"), F.sum("e").alias("total_error"))


def boundary_metrics(events: DataFrame, truth: DataFrame, tol: float = BOUNDARY_TOLERANCE_S) -> DataFrame:
    """Boundary scores per take and scope (``all``, ``cycleN``), with chance baselines over the whole take.

    A true boundary belongs to the cycle of the segment after it, a predicted one to the cycle whose
    span holds it. No matches: error NULL; no predictions: precision NULL.
    """
    cycles = truth.groupBy("take", "cycle").agg(F.min("start_s").alias("a"), F.max("end_s").alias("z"))
    scope = F.concat(F.lit("cycle"), F.col("cycle").cast("string")).alias("scope")
    tb, pb = boundaries(truth, cycle=True), boundaries(events)
    true = tb.select("take", F.lit("all").alias("scope"), "b").unionByName(tb.select("take", scope, "b"))
    in_cycle = in_cycles(pb, cycles, "b").select("take", scope, "b")
    pred = pb.select("take", F.lit("all").alias("scope"), "b").unionByName(in_cycle)
    spans = truth.groupBy("take").agg(F.min("start_s").alias("t0"), F.max_by("end_s", "start_s").alias("t1"))
    scopes = spans.select("take", F.lit("all").alias("scope")).unionByName(cycles.select("take", scope)).join(spans, "take")
    n_true = true.groupBy("take", "scope").agg(F.sort_array(F.collect_list("b")).alias("bounds"))
    n_pred = pred.groupBy("take", "scope").agg(F.count(F.lit(1)).alias("n_pred"))
    rows = scopes.join(n_true, ["take", "scope"], "left").join(n_pred, ["take", "scope"], "left").join(matched(pred, true, tol), ["take", "scope"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    rows = rows.select("take", "scope", "t0", "t1", F.coalesce("bounds", F.array().cast("array<double>")).alias("bounds"), zero("n_pred").alias("n_pred"), zero("n_matched").alias("n_matched"), "total_error")
    # the sets of large scopes are spread over tasks; which task draws which changes nothing
    parts = F.least(F.lit(20), F.floor((F.col("n_pred") + F.size("bounds")) / 2000) + 1).cast("int")
    rows = materialize(rows, "bounds")
    drawn = rows.select("take", "scope", "t0", "t1", "bounds", "n_pred", parts.alias("parts")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).repartition("take", "scope", "part")

    def run(batches):
        for g in batches:
            each = [chance_hits(int(r.n_pred), np.asarray(r.bounds), r.t0, r.t1, tol, int(r.part), int(r.parts)) for r in g.itertuples()]
            yield pd.DataFrame({"take": g["take"], "scope": g["scope"], "even": [e for e, _ in each], "random": [h for _, h in each]})

    hits = drawn.mapInPandas(run, "take string, scope string, even long, random long").groupBy("take", "scope").agg(F.sum("even").alias("even"), (F.sum("random") / DRAWS).alias("random"))
    out = rows.join(hits, ["take", "scope"]).withColumn("n_true", F.size("bounds").cast("long"))
    none = F.col("n_pred") == 0
    chance = [c for n, h in (("uniform", "even"), ("random", "random")) for c in (F.when(none, 0.0).otherwise(F.try_divide(h, "n_true")).alias(f"chance_{n}_recall"), F.try_divide(h, "n_pred").alias(f"chance_{n}_precision"))]
    return out.select("take", "scope", "n_true", "n_pred", "n_matched", F.try_divide("n_matched", "n_true").alias("recall"), F.try_divide("n_matched", "n_pred").alias("precision"), F.when(F.col("n_matched") > 0, F.col("total_error") / F.col("n_matched")).alias("mae_matched_s"), (F.col("n_true") - F.col("n_matched")).alias("missed"), (F.col("n_pred") - F.col("n_matched")).alias("false_boundaries"), *chance)


def in_cycles(points: DataFrame, cycles: DataFrame, point: str, slack: float = 0.0) -> DataFrame:
    """Points with the ``cycle`` of their take that holds them, by time cells; cycles (``a`` to ``z``) are half open, longer by ``slack``."""
    spans = cycles.select("take", "cycle", F.col("a").alias("start_s"), (F.col("z") + slack).alias("end_s"), F.lit(False).alias("is_last"))
    return range_join(points, spans, ["take"], point, how="inner").drop("start_s", "end_s", "is_last")


def label_frames(frames: DataFrame, events: DataFrame, truth: DataFrame, out_of_frame: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``take, frame_idx, t, *keep, predicted_label, true_label, out_of_frame``; segments of a take must not overlap."""
    points = frames.select("take", "frame_idx", "t", *keep).filter(F.col("t").isNotNull())
    for name, segments in (("predicted_label", events), ("true_label", truth)):
        seg = with_last_flag(segments.select("take", "label", "start_s", "end_s"), ["take"], "start_s")
        points = range_join(points, seg, ["take"], "t").withColumnRenamed("label", name).drop("start_s", "end_s", "is_last")
    if out_of_frame is None:
        return points.withColumn("out_of_frame", F.lit(False))
    return in_intervals(points, out_of_frame, ["take"], "t", "out_of_frame")


def frame_metrics(labelled: DataFrame, by: list[str]) -> DataFrame:
    """Frame accuracy overall and per label, balanced, and the majority baseline, per ``by``. Frames unlabelled on a side are counted apart."""
    ok = F.col("predicted_label").isNotNull() & F.col("true_label").isNotNull()
    hit = F.when(ok, (F.col("predicted_label") == F.col("true_label")).cast("int"))
    per = []
    for x in LABELS:
        is_label = ok & (F.col("true_label") == x)
        per += [F.avg(F.when(is_label, hit)).alias(f"acc_{x}"), F.count_if(is_label).alias(f"n_{x}")]
    # all labels in one aggregation: a pivot would take two more
    rows = labelled.groupBy(*by).agg(F.count_if(ok).alias("n_frames"), F.count_if(~ok).alias("n_unlabelled"), F.avg(hit).alias("frame_accuracy"), *per)
    accs = F.filter(F.array(*[f"acc_{x}" for x in LABELS]), lambda v: v.isNotNull())
    balanced = F.try_divide(F.aggregate(accs, F.lit(0.0), lambda a, v: a + v), F.size(accs))
    return rows.withColumn("balanced_accuracy", balanced).withColumn("majority_baseline", F.try_divide(F.greatest(*[f"n_{x}" for x in LABELS]), F.col("n_frames")))


def scoped(labelled: DataFrame, truth: DataFrame) -> DataFrame:
    """Frames once per scope: ``all`` and ``cycleN`` without the out-of-frame ones, ``out_of_frame`` with those only. Cycles share their border frame."""
    cycles = truth.groupBy("take", "cycle").agg(F.min("start_s").alias("a"), F.max("end_s").alias("z"))
    inside = labelled.filter(~F.col("out_of_frame"))
    cyc = in_cycles(inside, cycles, "t", EPS).withColumn("scope", F.concat(F.lit("cycle"), F.col("cycle").cast("string"))).drop("cycle")
    parts = [inside.withColumn("scope", F.lit("all")), labelled.filter("out_of_frame").withColumn("scope", F.lit("out_of_frame")), cyc]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def tolerant_accuracy(scoped_frames: DataFrame, truth: DataFrame, tol: float = BOUNDARY_TOLERANCE_S) -> DataFrame:
    """Accuracy where a frame within ``tol`` of a true boundary of its scope may have the label of either side."""
    b = neighbours(truth, ["take"], F.floor(F.col("start_s") / 600), ["start_s"], {"before": ("label", -1)}).filter(F.col("before").isNotNull()).select("take", "cycle", F.col("start_s").alias("b"), "before", F.col("label").alias("after"))
    b = b.select("take", F.explode(F.array(F.lit("all"), F.concat(F.lit("cycle"), F.col("cycle").cast("string")))).alias("scope"), "b", "before", "after")
    cell = lambda c: F.floor(c / 10.0)
    b = b.withColumn("cell", F.explode(F.sequence(cell(F.col("b") - tol - EPS), cell(F.col("b") + tol + EPS))))
    frames = scoped_frames.filter(F.col("scope") != "out_of_frame").withColumn("cell", cell(F.col("t")))
    near = frames.join(b, ["take", "scope", "cell"]).filter((F.abs(F.col("t") - F.col("b")) <= tol + EPS) & ((F.col("predicted_label") == F.col("before")) | (F.col("predicted_label") == F.col("after")))).select("take", "scope", "frame_idx").distinct().withColumn("near", F.lit(True))
    judged = frames.join(near, ["take", "scope", "frame_idx"], "left")
    ok = F.col("predicted_label").isNotNull() & F.col("true_label").isNotNull()
    right = (F.col("predicted_label") == F.col("true_label")) | F.coalesce("near", F.lit(False))
    return judged.groupBy("take", "scope").agg(F.avg(F.when(ok, right.cast("int"))).alias("tolerant_accuracy"))


def full_scores(frames: DataFrame, events: DataFrame, truth: DataFrame, groups: Column | None = None, out_of_frame: DataFrame | None = None, tol: float = BOUNDARY_TOLERANCE_S) -> DataFrame:
    """All scores per take and scope, in the column order of the serving table. Frames are labelled once and written."""
    events, truth = materialize(events.select("take", "label", "start_s", "end_s"), "events"), materialize(truth, "truth")
    rows = scoped(materialize(label_frames(frames, events, truth, out_of_frame), "labelled"), truth)
    out = frame_metrics(rows, ["take", "scope"]).join(boundary_metrics(events, truth, tol), ["take", "scope"], "full").join(tolerant_accuracy(rows, truth, tol), ["take", "scope"], "left")
    group = groups if groups is not None else F.lit(None).cast("string")
    # Names and order of the table's columns.
    names = ["n_true", "n_pred", "n_matched", "recall", "precision", "mae_matched_s", "missed", "false_boundaries", "chance_uniform_recall", "chance_uniform_precision", "chance_random_recall", "chance_random_precision"]
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_frames", "n_unlabelled")]
    labels = [x for lab in LABELS for x in (F.col(f"acc_{lab}"), F.coalesce(F.col(f"n_{lab}"), F.lit(0)).cast("long").alias(f"n_{lab}"))]
    return out.select("take", group.alias("take_group"), F.lit(tol).alias("tolerance_s"), "scope", *[F.col(n).cast("double").alias(n) for n in names], *zero, "frame_accuracy", *labels, "balanced_accuracy", "majority_baseline", "tolerant_accuracy")


def confusion(pairs: DataFrame, true: str = "true_label", pred: str = "predicted_label") -> DataFrame:
    """Confusion matrix with every label as row and column, zeros filled in."""
    counts = pairs.groupBy(F.col(true).alias("true_label")).pivot(pred, LABELS).count()
    # one row per label
    rows = pairs.sparkSession.createDataFrame([(x,) for x in LABELS], "true_label string")
    return rows.join(counts, "true_label", "left").fillna(0)


def objective(scores: DataFrame) -> DataFrame:
    """Half boundary F1, half frame accuracy, of scope ``all``."""
    f1 = F.coalesce(F.try_divide(2 * F.col("recall") * F.col("precision"), F.col("recall") + F.col("precision")), F.lit(0.0))
    return scores.filter("scope = 'all'").select("take", (0.5 * f1 + 0.5 * F.col("frame_accuracy")).alias("objective"))


def setting_objectives(frames: DataFrame, events: DataFrame, truth: DataFrame, setting: str, tol: float = BOUNDARY_TOLERANCE_S) -> DataFrame:
    """``(setting, take, objective)``: :func:`objective` of the events of each ``setting``, for takes with labels, without the scores it doesn't need."""
    of = F.concat_ws("|", F.col(setting).cast("string"), F.col("take"))
    settings = events.select(setting).distinct()
    events, truth = events.select(setting, "take", "label", "start_s", "end_s"), truth.select("take", "label", "start_s", "end_s")
    pred, true = (boundaries(x.withColumn("take", of)).select("take", F.lit("all").alias("scope"), "b") for x in (events, truth.crossJoin(settings)))
    counts = pred.withColumn("p", F.lit(1)).unionByName(true.withColumn("p", F.lit(0))).groupBy("take").agg(F.sum("p").alias("n_pred"), F.sum(1 - F.col("p")).alias("n_true"))
    hits = counts.join(matched(pred, true, tol).select("take", "n_matched"), "take", "left").withColumn("n_matched", F.coalesce("n_matched", F.lit(0)))
    hits = hits.select(F.col("take").alias("__of"), F.try_divide("n_matched", "n_true").alias("recall"), F.try_divide("n_matched", "n_pred").alias("precision"))
    seg = with_last_flag(truth, ["take"], "start_s")
    points = range_join(frames.filter(F.col("t").isNotNull()).select("take", "t"), seg, ["take"], "t", how="inner").select("take", "t", F.col("label").alias("true_label"))
    own = with_last_flag(events, [setting, "take"], "start_s")
    accuracy = range_join(points, own, ["take"], "t", how="inner").groupBy(setting, "take").agg(F.avg((F.col("label") == F.col("true_label")).cast("int")).alias("frame_accuracy"))
    f1 = F.coalesce(F.try_divide(2 * F.col("recall") * F.col("precision"), F.col("recall") + F.col("precision")), F.lit(0.0))
    return accuracy.withColumn("__of", of).join(hits, "__of", "left").select(setting, "take", (0.5 * f1 + 0.5 * F.col("frame_accuracy")).alias("objective"))
