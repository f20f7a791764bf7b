"""Segments of a signal or of class probabilities: changepoints, rules, decoders."""

from __future__ import annotations

import itertools
import operator
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasemill.operators.reach import bounded_reach, running_sum
from phasemill.operators.relational import SHARD, absorb_short_runs, islands, row_argmax
from phasemill.operators.takes import LIMIT, Columns, by_whole_take, parted
from phasemill.schemas import LABELS, PROTOCOL, RuleParams
from phasemill.session import known, materialize

CHUNK, HALO = 1 << 16, 1 << 10


class Pelt:
    """Internal changepoints of least total squared deviation plus ``penalty`` per segment, of samples fed in pieces.

    Exact dynamic programming with pruning: a last changepoint that even without a penalty costs
    more than the optimum at t can't be best again, once a segment of ``min_size`` fits behind t.
    ``min_size`` samples are one step, since none of them can be a changepoint for another. Several
    penalties share a pass; a candidate stays as long as one of them keeps it.
    Kept are the running sums at the candidates, and one number per sample and penalty.
    """

    def __init__(self, penalty: float | Sequence[float], min_size: int = 3) -> None:
        self.penalty, self.min_size, self.n, self.back = np.atleast_1d(np.asarray(penalty, float)), min_size, 0, []

    def push(self, x: np.ndarray) -> None:
        x = np.asarray(x, float).reshape(len(x), -1 if len(x) else 1)
        if not len(x):
            return
        p, k, n, size = len(self.penalty), x.shape[1], self.n, self.min_size
        if n == 0:
            self.s1, self.s2 = np.zeros((1, k)), np.zeros(1)
            # rows: the optimum for each penalty, running sum of squares, place, running sums; a column per candidate
            self.pool, self.m = np.zeros((p + 2 + k, 64)), 1
            self.pool[:p, 0] = -self.penalty
        rows = np.empty((p + 2 + k, len(x)))
        rows[:p], rows[p + 1] = np.inf, np.arange(n + 1, n + len(x) + 1)
        rows[p] = np.cumsum(np.concatenate([self.s2, (x * x).sum(1)]))[1:]
        rows[p + 2 :] = np.cumsum(np.vstack([self.s1, x]), 0)[1:].T
        back, pool, m, pen = np.zeros((p, len(x)), np.int64), self.pool, self.m, self.penalty[:, None]
        i = max(size - n - 1, 0)
        while i < len(x):
            j = min(i + size, len(x))
            at, new = pool[:, :m], rows[:, i:j]
            length = new[p + 1][:, None] - at[p + 1]
            off = new[p + 2 :].T[:, :, None] - at[p + 2 :]
            off *= off
            cost = at[:p, None] + ((new[p][:, None] - at[p]) - off.sum(1) / length)
            young = length < size
            cost[:, young] = np.inf
            best = cost.argmin(2)
            back[:, i:j] = at[p + 1][best]
            new[:p] = np.take_along_axis(cost, best[:, :, None], 2)[:, :, 0] + pen
            keep = (cost[:, 0] <= new[:p, :1]).any(0) | young[0]
            left = int(keep.sum())
            if left < m:
                pool[:, :left] = at[:, keep]
                m = left
            if m + j - i > pool.shape[1]:
                pool = np.hstack([pool, np.zeros_like(pool)])
            pool[:, m : m + j - i] = new
            m += j - i
            i = j
        self.pool, self.m, self.s1, self.s2 = pool, m, rows[p + 2 :, -1:].T.copy(), rows[p, -1:].copy()
        self.back.append(back)
        self.n += len(x)

    def changepoints(self, which: int = 0) -> list[int]:
        if self.n < 2 * self.min_size:
            return []
        back, out, t = np.concatenate([b[which] for b in self.back]), [], self.n
        while back[t - 1] > 0:
            t = int(back[t - 1])
            out.append(t)
        return out[::-1]

    def result(self) -> np.ndarray:
        """Samples that start a segment, the first one's aside: 1 for those of the first penalty, 2 of the second, 4 of the third and so on, added up."""
        out = np.zeros(self.n, np.int64)
        for i in range(len(self.penalty)):
            out[self.changepoints(i)] += 1 << i
        return out


def pelt(x: np.ndarray, penalty: float, min_size: int = 3) -> list[int]:
    """:class:`Pelt` of samples at hand."""
    state = Pelt(penalty, min_size)
    state.push(x)
    return state.changepoints()


class Viterbi:
    """Best path through log probabilities (samples x labels) fed in pieces: no cost to stay, ``following`` to the next phase of the protocol, else ``other``.

    Kept are the scores of the last sample and six bytes per sample.
    """

    def __init__(self, stay: float = 0.0, following: float = 4.0, other: float = 12.0) -> None:
        k = len(LABELS)
        self.move, self.score, self.back = np.full((k, k), -float(other)), None, []
        for i, a in enumerate(LABELS):
            self.move[i, i], self.move[i, LABELS.index(PROTOCOL[a])] = -stay, -float(following)

    def push(self, logp: np.ndarray) -> None:
        back, every = np.zeros(logp.shape, np.int8), np.arange(len(LABELS))
        for t in range(len(logp)):
            if self.score is None:
                self.score = logp[0].copy()
                continue
            arrive = self.score[:, None] + self.move
            back[t] = arrive.argmax(0)
            self.score = arrive[back[t], every] + logp[t]
        self.back.append(back)

    def result(self) -> np.ndarray:
        back = np.concatenate(self.back)
        path = np.empty(len(back), np.int8)
        path[-1] = self.score.argmax()
        for t in range(len(back) - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
        return path


def viterbi(logp: np.ndarray, stay: float = 0.0, following: float = 4.0, other: float = 12.0) -> np.ndarray:
    """:class:`Viterbi` of samples at hand."""
    state = Viterbi(stay, following, other)
    state.push(logp)
    return state.result()


# The rules of the labeller, of which the first whose tests all hold decides: tests of a
# segment's features, labels of the segment before that are kept (or turned), and the label otherwise.
_MOVES = {"REACH": "REACH", "RETRACT": "RETRACT"}
RULES = [
    ([("speed", ">", "moving_thr"), ("dp", "<", "zero")], {}, "RETRACT"),
    ([("speed", ">", "moving_thr")], {}, "REACH"),
    ([("p", "<", "p_home"), ("speed", "<", "still_thr")], {}, "REST"),
    ([("p", "<", "p_home"), ("-dp", ">", "dp_min")], {}, "RETRACT"),
    ([("p", "<", "p_home"), ("dp", ">", "dp_min")], {}, "REACH"),
    ([("p", "<", "p_home")], {}, "REST"),
    ([("p", "<=", "p_far"), ("-dp", ">", "dp_min")], _MOVES, "RETRACT"),
    ([("p", "<=", "p_far")], _MOVES, "REACH"),
    ([("d_ap", ">", "ap_delta")], {}, "RELEASE"),
    ([("-d_ap", ">", "ap_delta")], {}, "GRASP"),
    ([("aperture", "<", "ap_closed"), ("speed", "<", "still_thr")], {}, "HOLD"),
    ([("aperture", "<", "ap_closed")], {}, "GRASP"),
    ([], {"HOLD": "RELEASE", "RELEASE": "RELEASE"}, "REACH"),
]
_HOLDS = {"<": operator.lt, "<=": operator.le, ">": operator.gt}


def _threshold(name: str, r: RuleParams) -> float:
    return 0.0 if name == "zero" else getattr(r, name)


def rule_label(speed: float, p: float, dp: float, aperture: float, d_ap: float, previous: str | None, r: RuleParams) -> str:
    """:data:`RULES` for one segment at hand."""
    values = {"speed": speed, "p": p, "dp": dp, "-dp": -dp, "aperture": aperture, "d_ap": d_ap, "-d_ap": -d_ap}
    for tests, kept, label in RULES:
        if all(_HOLDS[op](values[v], _threshold(limit, r)) for v, op, limit in tests):
            return kept.get(previous, label)
    raise AssertionError("the last rule has no tests")


def rule_maps(r: RuleParams) -> Column:
    """What :data:`RULES` make of each state before: an array of places in :data:`LABELS` from 1, the first for no label before. Unknown values pass no test."""
    names = {"speed": "mean_speed", "p": "p_mean", "dp": "dp", "aperture": "mean_aperture", "d_ap": "d_ap"}
    value = lambda v: -known(F.col(names[v[1:]])) if v[0] == "-" else known(F.col(names[v]))
    place = lambda x: F.lit(LABELS.index(x) + 1)
    out = F.lit(None)
    for tests, kept, label in reversed(RULES):
        each = F.array(*[place(kept.get(before, label)) for before in (None, *LABELS)])
        out = F.when(reduce(lambda a, b: a & b, [_HOLDS[op](value(v), F.lit(_threshold(limit, r))) for v, op, limit in tests]), each).otherwise(out) if tests else each
    return out


def by_chunk(df: DataFrame, order: str, columns: Sequence[str], kernel: Callable[[pd.DataFrame], np.ndarray], chunk: int = CHUNK, halo: int = HALO) -> DataFrame:
    """``(take, order, out)`` with ``out`` one integer per row from a sequential ``kernel``.

    For kernels whose reach is bounded only; PELT and Viterbi, whose isn't, go through :func:`by_take`.
    A take of up to ``chunk`` samples is one call and so exact. A longer one is cut into chunks that
    are given ``halo`` samples of their neighbours on both sides, whose results are dropped; so no
    call sees more than ``chunk + 2 * halo`` rows, and a decision there depends on at least ``halo``
    samples around it. ``order`` numbers the samples from 0.
    """
    at = F.col(order)
    owners = F.sequence(F.floor(F.greatest(at - halo, F.lit(0)) / chunk), F.floor((at + halo) / chunk))
    rows = df.select("take", order, *columns).withColumn("__chunk", F.explode(owners))

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(order, kind="stable")
        own = (g[order] // chunk == key[1]).to_numpy()
        return g[["take", order]].assign(out=np.asarray(kernel(g), np.int64))[own]

    return rows.groupBy("take", "__chunk").applyInPandas(run, f"take string, {order} long, out long")


def by_take(df: DataFrame, order: str, columns: Sequence[str], start: Callable[[], Pelt | Viterbi], prepare: Callable[[np.ndarray], np.ndarray] = np.asarray) -> DataFrame:
    """``(take, order, out)`` with ``out`` one integer per row from the sequential state ``start`` makes for each take.

    A take is one pass over its sorted rows at every size, so results don't depend on where it is cut:
    the sort spills, and the state goes from batch to batch. What a task holds of a take is its order
    and back pointers, under 20 bytes a sample. Rows of a NULL take are left out.
    """
    rows = df.filter(F.col("take").isNotNull()).select("take", order, *columns).repartition("take").sortWithinPartitions("take", order)

    def ended(take: str, at: list[np.ndarray], state: Pelt | Viterbi) -> Iterator[pd.DataFrame]:
        whole, out = np.concatenate(at), np.asarray(state.result(), np.int64)
        for i in range(0, len(whole), CHUNK):
            yield pd.DataFrame({"take": take, order: whole[i : i + CHUNK], "out": out[i : i + CHUNK]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        take, at, state = None, [], None
        for b in batches:
            who = b["take"].to_numpy()
            edges = [0, *(np.flatnonzero(who[1:] != who[:-1]) + 1), len(b)]
            index, values = b[order].to_numpy(np.int64), b[list(columns)].to_numpy(float)
            for i, j in itertools.pairwise(edges):
                if i == j:
                    continue
                if state is None or who[i] != take:
                    if state is not None:
                        yield from ended(take, at, state)
                    take, at, state = who[i], [], start()
                at.append(index[i:j])
                state.push(prepare(values[i:j]))
        if state is not None:
            yield from ended(take, at, state)

    return rows.mapInPandas(run, f"take string, {order} long, out long")


def changepoints(df: DataFrame, order: str, columns: Sequence[str], penalty: float, min_size: int = 3) -> DataFrame:
    """Adds to each sample ``segment``, the number of its segment within the take, by :func:`pelt`."""
    marked = materialize(by_take(df, order, columns, lambda: Pelt(penalty, min_size)), "changepoints")  # the kernel runs once, not once per pass below
    numbered = running_sum(marked.withColumn(SHARD, F.floor(F.col(order) / CHUNK)), ["take"], SHARD, [order], "out", "segment")
    return df.join(numbered.select("take", order, "segment"), ["take", order])


def scaled_channels(signals: DataFrame, r: RuleParams) -> DataFrame:
    """The two channels of the rule segmentation from gap-filled signals: root of speed, and aperture, on fixed scales."""
    return signals.withColumns({"c0": F.sqrt(F.greatest("speed_full", F.lit(0.0))) / r.speed_scale, "c1": F.col("aperture_full") / r.ap_scale})


def segment_features(df: DataFrame, segment: str = "segment") -> DataFrame:
    """Per segment: start, samples, means, and changes of p and aperture from its first to its last three samples (medians)."""
    w = Window.partitionBy("take", segment).orderBy("sample_idx")
    back = Window.partitionBy("take", segment).orderBy(F.col("sample_idx").desc())
    rows = df.withColumn("__h", F.row_number().over(w)).withColumn("__t", F.row_number().over(back))
    edge = lambda c, r: F.percentile(F.when(F.col(r) <= 3, F.col(c)), 0.5)
    return rows.groupBy("take", segment).agg(
        F.min("sample_idx").alias("first"), F.min("t").alias("start_s"), F.count(F.lit(1)).alias("n_samples"),
        F.avg("speed_full").alias("mean_speed"), F.avg("aperture_full").alias("mean_aperture"), F.avg("p_full").alias("p_mean"),
        (edge("p_full", "__t") - edge("p_full", "__h")).alias("dp"), (edge("aperture_full", "__t") - edge("aperture_full", "__h")).alias("d_ap"),
        F.avg(F.col("missing").cast("double")).alias("frac_missing"),
    )


def rule_places(found: Columns, r: RuleParams) -> np.ndarray:
    """The place of each sample's label by :data:`RULES`, of one take with ``starts`` of segments and the gap-filled signals."""
    first = np.concatenate([[0], np.flatnonzero(found["starts"][1:]) + 1])
    n = np.diff(np.append(first, len(found["starts"])))
    mean = lambda c: np.add.reduceat(found[c], first) / n
    few = np.minimum(n, 3)

    def middle(c: str, start: np.ndarray) -> np.ndarray:
        # the median of one to three values
        rows = start[:, None] + np.minimum(np.arange(3), few[:, None] - 1)
        v = np.where(np.arange(3) < few[:, None], found[c][rows], np.inf)
        v.sort(1)
        at = np.arange(len(n))
        return (v[at, (few - 1) // 2] + v[at, few // 2]) / 2

    change = lambda c: middle(c, first + n - few) - middle(c, first)
    values = zip(mean("speed_full"), mean("p_full"), change("p_full"), mean("aperture_full"), change("aperture_full"), strict=True)
    out, previous = np.empty(len(n), np.int64), None
    for i, v in enumerate(values):
        previous = rule_label(*v, previous, r)
        out[i] = LABELS.index(previous)
    return np.repeat(out, n)


def label_segments(features: DataFrame, r: RuleParams, shard_width: int = 256) -> DataFrame:
    """Adds ``label`` to segments in order, by :data:`RULES` and the label before.

    A segment maps each label before it to its own. Maps compose: each run of ``shard_width`` segments
    is reduced to its map, these are followed through the take, one row per shard, and then each
    shard is followed from the label it starts with. ``segment`` is an integer that orders the take.
    """
    follow = lambda maps, start: F.aggregate(maps, start, lambda s, m: F.element_at(m, s + 1))
    # every state on the way, the first one aside
    path = lambda maps, start: F.slice(F.aggregate(maps, F.array(start), lambda s, m: F.concat(s, F.array(F.element_at(m, F.element_at(s, -1) + 1)))), 2, 1 << 30)
    in_order = lambda s: F.transform(F.array_sort(F.collect_list(s)), lambda x: x["m"])
    rows = features.select("take", "segment", F.floor(F.col("segment") / shard_width).alias("__shard"), rule_maps(r).alias("m"))
    shards = rows.groupBy("take", "__shard").agg(F.array_sort(F.collect_list("segment")).alias("segments"), in_order(F.struct("segment", "m")).alias("maps"))
    shards = materialize(shards, "rules")
    whole = F.transform(F.sequence(F.lit(0), F.lit(len(LABELS))), lambda s: follow(F.col("maps"), s))
    takes = shards.select("take", "__shard", whole.alias("m")).groupBy("take").agg(F.array_sort(F.collect_list("__shard")).alias("at"), in_order(F.struct(F.col("__shard"), "m")).alias("maps"))
    starts = takes.select("take", F.explode(F.arrays_zip("at", F.slice(F.concat(F.array(F.lit(0)), path(F.col("maps"), F.lit(0))), F.lit(1), F.size("at")).alias("start"))).alias("z")).select("take", F.col("z.at").alias("__shard"), F.col("z.start").alias("start"))
    labels = shards.join(starts, ["take", "__shard"]).select("take", F.explode(F.arrays_zip("segments", path(F.col("maps"), F.col("start")).alias("states"))).alias("z"))
    labels = labels.select("take", F.col("z.segments").alias("segment"), F.element_at(F.array(*[F.lit(x) for x in LABELS]), F.col("z.states")).alias("label"))
    return features.join(labels, ["take", "segment"])


def smoothed_posteriors(post: DataFrame, n: int) -> DataFrame:
    """Centred mean of n samples of each ``p_<LABEL>``, truncated at the ends of a take."""
    cols = [f"p_{x}" for x in LABELS]

    def rolled(part: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy("sample_idx").rowsBetween(-(n // 2), n // 2)
        return part.withColumns({f"__{c}": F.avg(c).over(w) for c in cols}).drop(*cols).withColumnsRenamed({f"__{c}": c for c in cols})

    return bounded_reach(post.withColumn(SHARD, F.floor(F.col("sample_idx") / 4096)), ["take"], SHARD, ["sample_idx"], n // 2, rolled).drop(SHARD)


def events_of(labelled: DataFrame, ends: DataFrame) -> DataFrame:
    """Events of samples with ``label`` and the posteriors: ``take, event_idx, label, start_s, end_s, duration_s, n_samples, mean_confidence, labels_in_event``."""
    chosen = F.sum(F.element_at(F.create_map(*[v for x in LABELS for v in (F.lit(x), F.col(f"p_{x}"))]), F.col("label")))
    runs = islands(labelled, ["take"], "sample_idx", "label", F.floor(F.col("sample_idx") / 4096), {"confidence": chosen})
    times = labelled.select("take", F.col("sample_idx").alias("first"), F.col("t").alias("start_s"))
    runs = runs.join(times, ["take", "first"]).join(ends, "take").withColumn("end_s", F.lead("start_s").over(Window.partitionBy("take").orderBy("island")))
    runs = runs.withColumn("end_s", F.coalesce("end_s", "t_end"))
    return runs.select("take", F.col("island").cast("long").alias("event_idx"), "label", "start_s", "end_s", (F.col("end_s") - F.col("start_s")).alias("duration_s"), F.col("n").alias("n_samples"), (F.col("confidence") / F.col("n")).alias("mean_confidence"), F.col("labels_in_island").alias("labels_in_event"))


def _most_likely() -> Column:
    return row_argmax([f"p_{x}" for x in LABELS], LABELS)


PROBS = [f"p_{x}" for x in LABELS]
EVENTS = "take string, event_idx long, label string, start_s double, end_s double, n_samples long, mean_confidence double"


def smooth_rows(p: np.ndarray, n: int) -> np.ndarray:
    """:func:`smoothed_posteriors` of one take."""
    half, rows = n // 2, len(p)
    padded = np.vstack([np.zeros((half, p.shape[1])), p, np.zeros((half, p.shape[1]))])
    at = np.arange(rows)
    return sum(padded[k : k + rows] for k in range(2 * half + 1)) / (np.minimum(at + half, rows - 1) - np.maximum(at - half, 0) + 1.0)[:, None]


def runs_of(labels: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.concatenate([[True], labels[1:] != labels[:-1]]))


def segment_labels(s: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each row the column of the greatest mean in its segment; ``starts`` are 1 at the segments' first rows, the first one's aside."""
    first = np.concatenate([[0], np.flatnonzero(starts[1:]) + 1])
    n = np.diff(np.append(first, len(s)))
    return np.repeat((np.add.reduceat(s, first) / n[:, None]).argmax(1), n)


def long_runs(labels: np.ndarray, least: int) -> np.ndarray:
    """:func:`relational.absorb_short_runs` of one take's labels."""
    first = runs_of(labels)
    n = np.diff(np.append(first, len(labels)))
    kept = np.where((n >= least) | (np.arange(len(n)) == 0), np.arange(len(n)), 0)
    return np.repeat(labels[first][np.maximum.accumulate(kept)], n)


def event_rows(labels: np.ndarray, t: np.ndarray, s: np.ndarray) -> Columns:
    """:func:`events_of` of one take; the last event's end is left open."""
    first = runs_of(labels)
    n = np.diff(np.append(first, len(labels)))
    chosen = np.add.reduceat(s[np.arange(len(s)), labels], first)
    return {"event_idx": np.arange(len(first)), "label": np.array(LABELS, object)[labels[first]], "start_s": t[first], "end_s": np.append(t[first[1:]], np.nan), "n_samples": n, "mean_confidence": chosen / n}


def with_ends(events: DataFrame, ends: DataFrame, *keep: str) -> DataFrame:
    return with_durations(events.join(ends, "take").withColumn("end_s", F.coalesce("end_s", "t_end")), *keep)


def with_durations(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select("take", *keep, "event_idx", "label", "start_s", "end_s", (F.col("end_s") - F.col("start_s")).alias("duration_s"), "n_samples", "mean_confidence", F.lit(1).cast("long").alias("labels_in_event"))


def _decoded(post: DataFrame, ends: DataFrame, n: int, decode: Callable[[np.ndarray], np.ndarray], sharded: Callable[[DataFrame], DataFrame], limit: int) -> DataFrame:
    """Events by ``decode``, from a take's ``n``-smoothed posteriors to places of labels; ``sharded`` decodes takes of more than ``limit`` samples."""
    fits, large = parted(post, post.groupBy("take").agg(F.count(F.lit(1)).alias("size")), limit)

    def run(take: str | None, c: Columns) -> Iterator[tuple[str | None, Columns]]:
        s = smooth_rows(np.column_stack([c[p] for p in PROBS]), n)
        yield take, event_rows(decode(s), c["t"], s)

    out = with_ends(by_whole_take(fits, "sample_idx", ["t", *PROBS], run, EVENTS), ends)
    return out if large is None else out.unionByName(sharded(large))


def pelt_places(s: np.ndarray, penalty: float = 1.0, min_size: int = 3) -> np.ndarray:
    """The place of each row's label by :func:`decode_pelt`, of one take's smoothed posteriors."""
    state = Pelt(penalty, min_size)
    state.push(s)
    return segment_labels(s, state.result())


def argmax_places(s: np.ndarray, least: int = 6) -> np.ndarray:
    return long_runs(s.argmax(1), least)


def grammar_places(s: np.ndarray, following: float = 4.0, other: float = 12.0) -> np.ndarray:
    return viterbi(_clipped_log(s), 0.0, following, other)


def _clipped_log(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-4, None))


def decode_argmax(post: DataFrame, ends: DataFrame, least: int = 6, limit: int = LIMIT) -> DataFrame:
    """Likeliest label of the 5-smoothed posteriors; runs under ``least`` samples join the run before."""

    def sharded(large: DataFrame) -> DataFrame:
        s = smoothed_posteriors(large, 5).withColumn("label", _most_likely())
        runs = absorb_short_runs(islands(s, ["take"], "sample_idx", "label", F.floor(F.col("sample_idx") / 4096)), ["take"], "island", "label", "n", least)
        spread = runs.withColumn("sample_idx", F.explode(F.sequence("first", "last"))).select("take", "sample_idx", "absorbed")
        return events_of(s.drop("label").join(spread, ["take", "sample_idx"]).withColumnRenamed("absorbed", "label"), ends)

    return _decoded(post, ends, 5, lambda s: argmax_places(s, least), sharded, limit)


def pelt_labels(post: DataFrame, penalty: float = 1.0, min_size: int = 3, limit: int = LIMIT) -> DataFrame:
    """Samples with their 5-smoothed posteriors, ``segment`` by their changepoints, and ``label``, that of the segment's greatest mean probability."""
    fits, large = parted(post, post.groupBy("take").agg(F.count(F.lit(1)).alias("size")), limit)

    def run(take: str | None, c: Columns) -> Iterator[tuple[str | None, Columns]]:
        s = smooth_rows(np.column_stack([c[p] for p in PROBS]), 5)
        state = Pelt(penalty, min_size)
        state.push(s)
        starts = state.result()
        yield take, {"segment": np.cumsum(starts), "sample_idx": c["sample_idx"], "t": c["t"]} | {p: s[:, i] for i, p in enumerate(PROBS)} | {"label": np.array(LABELS, object)[segment_labels(s, starts)]}

    schema = "take string, segment long, sample_idx long, t double, " + ", ".join(f"{p} double" for p in PROBS) + ", label string"
    out = by_whole_take(fits.filter("take IS NOT NULL"), "sample_idx", ["sample_idx", "t", *PROBS], run, schema)
    return out if large is None else out.unionByName(_sharded_pelt(large, penalty, min_size))


def _sharded_pelt(post: DataFrame, penalty: float, min_size: int) -> DataFrame:
    s = changepoints(smoothed_posteriors(post, 5), "sample_idx", PROBS, penalty, min_size)
    label = s.groupBy("take", "segment").agg(*[F.avg(p).alias(p) for p in PROBS]).select("take", "segment", _most_likely().alias("label"))
    return s.join(label, ["take", "segment"])


def decode_pelt(post: DataFrame, ends: DataFrame, penalty: float = 1.0, min_size: int = 3, limit: int = LIMIT) -> DataFrame:
    """Changepoints of the 5-smoothed posteriors; each segment has the label of the greatest mean probability."""
    return _decoded(post, ends, 5, lambda s: pelt_places(s, penalty, min_size), lambda large: events_of(_sharded_pelt(large, penalty, min_size), ends), limit)


def decode_penalties(post: DataFrame, ends: DataFrame, penalties: Sequence[float], min_size: int = 3, limit: int = LIMIT) -> DataFrame:
    """:func:`decode_pelt` by each of up to 62 penalties, told by the column ``penalty``; a take is one pass for all."""
    fits, large = parted(post, post.groupBy("take").agg(F.count(F.lit(1)).alias("size")), limit)

    def run(take: str | None, c: Columns) -> Iterator[tuple[str | None, Columns]]:
        s = smooth_rows(np.column_stack([c[p] for p in PROBS]), 5)
        state = Pelt(penalties, min_size)
        state.push(s)
        found = state.result()
        for i, penalty in enumerate(penalties):
            rows = event_rows(segment_labels(s, found >> i & 1), c["t"], s)
            yield take, {"penalty": np.full(len(rows["label"]), float(penalty))} | rows

    out = with_ends(by_whole_take(fits, "sample_idx", ["t", *PROBS], run, EVENTS.replace("take string", "take string, penalty double")), ends, "penalty")
    for penalty in penalties if large is not None else ():
        out = out.unionByName(events_of(_sharded_pelt(large, penalty, min_size), ends).withColumn("penalty", F.lit(float(penalty))))
    return out


def decode_grammar(post: DataFrame, ends: DataFrame, following: float = 4.0, other: float = 12.0, limit: int = LIMIT) -> DataFrame:
    """Viterbi path over the log of the 3-smoothed posteriors, clipped at 1e-4."""
    start = lambda: Viterbi(0.0, following, other)

    def sharded(large: DataFrame) -> DataFrame:
        s = smoothed_posteriors(large, 3)
        path = by_take(s, "sample_idx", PROBS, start, _clipped_log)
        return events_of(s.join(path.withColumn("label", F.element_at(F.array(*[F.lit(x) for x in LABELS]), (F.col("out") + 1).cast("int"))).drop("out"), ["take", "sample_idx"]), ends)

    return _decoded(post, ends, 3, lambda s: grammar_places(s, following, other), sharded, limit)
