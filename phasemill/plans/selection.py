"""Choosing settings: a seeded random search over the rule parameters, and nested selection of classifier and penalty."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasemill.operators import models as M
from phasemill.operators import segmentation as G
from phasemill.operators import signals as S
from phasemill.operators.metrics import full_scores, match_count_error, objective
from phasemill.plans import pipeline as P
from phasemill.schemas import BOUNDARY_TOLERANCE_S, EPS, LABELS, RuleParams, SignalParams
from phasemill.session import materialize

TRIALS, SEED = 800, 20251002
# The space searched: choices, or bounds of a uniform draw, of its logarithm for the penalty.
SPACE = {
    "smooth_win": [5, 7, 9, 11], "pen": ("log", 0.3, 30.0), "ap_scale": [0.3, 0.5, 0.8], "still_thr": (0.15, 0.8), "moving_thr": (0.6, 2.0), "p_home": (0.15, 0.35), "p_far": (0.45, 0.75),
    "ap_closed": (0.8, 1.0), "ap_delta": (0.05, 0.25), "dp_min": (0.02, 0.15),
}


def drawn_settings(trials: int = TRIALS, seed: int = SEED) -> list[tuple[int, RuleParams]]:
    """Smoothing window and rule parameters of each trial; trial 0 has the defaults."""
    rng = np.random.default_rng(seed)

    def draw(space: list | tuple) -> float:
        if isinstance(space, list):
            return rng.choice(space).item()
        return float(np.exp(rng.uniform(*np.log(space[1:])))) if space[0] == "log" else float(rng.uniform(*space))

    out = [(SignalParams().smooth_win, RuleParams())]
    for _ in range(trials):
        values = {k: draw(v) for k, v in SPACE.items()}
        out.append((values.pop("smooth_win"), RuleParams(**values)))
    return out


def segment_by_rules(s: pd.DataFrame, r: RuleParams, t_end: float) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Starts, ends and labels of the events of one take's samples at hand, neighbours of one label merged."""
    speed, ap, p, t = (s[c].to_numpy(float) for c in ("speed_full", "aperture_full", "p_full", "t"))
    if not len(t):
        return np.zeros(0), np.zeros(0), []
    channels = np.column_stack([np.sqrt(np.maximum(speed, 0)) / r.speed_scale, ap / r.ap_scale])
    edges = [0, *G.pelt(channels, r.pen, max(2, round(r.min_size_s * S.GRID_HZ))), len(t)]
    starts, labels, before = [], [], None
    for a, z in zip(edges, edges[1:], strict=False):
        turn = lambda v, a=a, z=z: float(np.median(v[max(a, z - 3) : z]) - np.median(v[a : min(z, a + 3)]))
        before = G.rule_label(speed[a:z].mean(), p[a:z].mean(), turn(p), ap[a:z].mean(), turn(ap), before, r)
        if not labels or labels[-1] != before:
            starts.append(t[a])
            labels.append(before)
    return np.array(starts), np.array([*starts[1:], t_end]), labels


def labels_at(times: np.ndarray, starts: np.ndarray, ends: np.ndarray, labels: Sequence[str]) -> np.ndarray:
    """The place of each time's label in :data:`LABELS`, -1 without one; the last segment holds its end."""
    if not len(starts):
        return np.full(len(times), -1)
    at = np.searchsorted(starts, times, "right") - 1
    held = (at >= 0) & ((times < ends[at]) | ((at == len(starts) - 1) & (np.abs(times - ends[at]) <= EPS + 1e-5 * np.abs(ends[at]))))
    return np.where(held, np.array([LABELS.index(x) for x in labels])[at], -1)


def take_objective(s: pd.DataFrame, frames: np.ndarray, truth: pd.DataFrame, r: RuleParams) -> float:
    """Half boundary F1, half frame accuracy, of one take by one setting."""
    truth = truth.sort_values("start_s")
    starts, ends, labels = segment_by_rules(s, r, float(frames.max()))
    true = truth["start_s"].to_numpy(float)
    n, m = len(starts) - 1, len(true) - 1
    hits = match_count_error(starts[1:], true[1:], BOUNDARY_TOLERANCE_S)[0] if n > 0 and m > 0 else 0
    mine, theirs = labels_at(frames, starts, ends, labels), labels_at(frames, true, truth["end_s"].to_numpy(float), list(truth["label"]))
    both = (mine >= 0) & (theirs >= 0)
    return 0.5 * (2 * hits / (n + m) if hits else 0.0) + 0.5 * (float((mine == theirs)[both].mean()) if both.any() else 0.0)


def search_rules(frames: DataFrame, truth: DataFrame, settings: Sequence[tuple[int, RuleParams]], per_task: int = 50) -> DataFrame:
    """``trial, smooth_win, objective, n_takes, *parameters`` of each setting, over the takes of ``truth``.

    Signals are derived once per smoothing window. A task has one take and ``per_task`` of the settings;
    so the takes tuned on must each fit a task, as the few that are kept for tuning do.
    """
    takes = truth.select("take").distinct()
    kept = materialize(frames.join(takes, "take", "left_semi"), "tuned")
    shots = kept.filter("t IS NOT NULL").select("take", F.lit(None).cast("long").alias("sample_idx"), "t", *[F.lit(None).cast("double").alias(c) for c in ("speed_full", "aperture_full", "p_full")])
    parts, firsts = [], set()
    for window in sorted({w for w, _ in settings}):
        trials = [i for i, (w, _) in enumerate(settings) if w == window]
        groups = [trials[i : i + per_task] for i in range(0, len(trials), per_task)]
        firsts |= {g[0] for g in groups}
        rows = P.rule_channels(materialize(S.derive_signals(kept, SignalParams(smooth_win=window)), "signals")).select(*shots.columns).unionByName(shots)
        parts.append(rows.withColumn("trials", F.explode(F.array(*[F.array(*[F.lit(i) for i in g]) for g in groups]))))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)

    def run(key: tuple, rows: pd.DataFrame, labels: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or labels.empty:
            return pd.DataFrame({"trial": [], "take": [], "objective": []})
        samples, shot = rows[rows["sample_idx"].notna()].sort_values("sample_idx"), rows.loc[rows["sample_idx"].isna(), "t"].to_numpy(float)
        trials = list(rows["trials"].iloc[0])
        return pd.DataFrame({"trial": trials, "take": key[0], "objective": [take_objective(samples, shot, labels, settings[i][1]) for i in trials]})

    every = every.withColumn("first", F.col("trials")[0])
    firsts = F.explode(F.array(*[F.lit(g) for g in sorted(firsts)]))
    labels = truth.select("take", "label", "start_s", "end_s").withColumn("first", firsts)
    scored = every.groupBy("take", "first").cogroup(labels.groupBy("take", "first")).applyInPandas(run, "trial int, take string, objective double")
    names = [f.name for f in dataclasses.fields(RuleParams)]
    table = frames.sparkSession.createDataFrame([(i, w, *[float(getattr(r, n)) for n in names]) for i, (w, r) in enumerate(settings)], "trial int, smooth_win int, " + ", ".join(f"{n} double" for n in names))
    return scored.groupBy("trial").agg(F.avg("objective").alias("objective"), F.count(F.lit(1)).alias("n_takes")).join(table, "trial").select("trial", "smooth_win", "objective", "n_takes", *names)


PELT_PENALTIES, SWITCH_PENALTIES = (0.5, 1.0, 2.0, 4.0, 8.0), (2.0, 4.0, 8.0)
DECODERS: dict[str, tuple[Sequence[float], Callable]] = {
    "pelt": (PELT_PENALTIES, lambda post, ends, p: G.decode_pelt(post, ends, p)),
    "grammar": (SWITCH_PENALTIES, lambda post, ends, p: G.decode_grammar(post, ends, p, 3 * p)),
}


def nested_selection(features: DataFrame, training: DataFrame, frames: DataFrame, truth: DataFrame, kinds: Sequence[str] = ("logreg", "hgb"), decoder: str = "pelt", penalties: Sequence[float] | None = None, folds: int = M.FOLDS) -> tuple[DataFrame, DataFrame]:
    """``(events, chosen)``: events of every take by a classifier, penalty and model that were all chosen and fitted without it.

    Takes are hashed into folds. Per fold, every pair of classifier and penalty is scored on the other
    folds' takes, each predicted without its own fold; the best pair, fitted on all the other folds,
    decodes the fold held out. ``training`` has the origin of faster copies, which stay with it.
    ``chosen`` lists every pair tried: ``fold, kind, penalty, objective, chosen``.
    """
    tried, decode = DECODERS[decoder]
    # hashed otherwise than the inner folds, so that each of these has takes left
    outer = lambda take: F.pmod(F.xxhash64(F.lit("outer fold"), F.col(take)), F.lit(folds)).cast("int")
    of = outer("take")
    ends, events, chosen = materialize(P.take_ends(features), "ends"), None, []
    for fold in range(folds):
        rest, held = features.filter(of != fold), features.filter(of == fold)
        own = materialize(training.filter(outer("origin") != fold), "training")
        inner_truth = materialize(truth.filter(of != fold), "truth")
        grid = []
        for kind in kinds:
            post = materialize(P.posteriors(rest, own, kind, folds=folds), "inner")
            for penalty in penalties or tried:
                scores = full_scores(frames.filter(of != fold), materialize(decode(post, ends, penalty), "events"), inner_truth)
                grid.append((fold, kind, float(penalty), float(objective(scores).agg(F.avg("objective")).first()[0] or 0.0)))
        best = max(grid, key=lambda g: (round(g[3], 6), g[2]))
        chosen += [(*g, g is best) for g in grid]
        found = materialize(decode(materialize(P.posteriors(held, own, best[1]), "outer"), ends, best[2]), "events")
        events = found if events is None else events.unionByName(found)
    return events, features.sparkSession.createDataFrame(chosen, "fold int, kind string, penalty double, objective double, chosen boolean")
