"""Repeated consecutive events: runs collapsed by agglomeration of neighbours."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasemill.session import materialize


def bigram_dice(a: str, b: str) -> float:
    """Dice coefficient of the two labels' sets of character pairs; 1 for equal labels."""
    if a == b:
        return 1.0
    x, y = ({s[i : i + 2] for i in range(len(s) - 1)} for s in (a, b))
    return 2 * len(x & y) / (len(x) + len(y)) if x and y else 0.0


def similar(a: str, b: str, min_similarity: float) -> float:
    """Similarity of two labels; only equality is looked at where nothing less would do."""
    return 1.0 if a == b else bigram_dice(a, b) if min_similarity < 1 else 0.0


def agglomerate(group: np.ndarray, label: list, start: np.ndarray, end: np.ndarray, min_similarity: float, max_gap: int, tail: list | None = None) -> np.ndarray:
    """First node of the run each node belongs to.

    Nodes come sorted by group, start, end, label. They form a linked list; a priority queue holds
    the neighbouring runs that may merge, the most similar first, then the least gap, then the first.
    A pair may merge if both lie in one group, the labels that touch (of the left run's last event and
    of the right run's first) are similar enough, and the right run starts at most ``max_gap`` after
    the left run's latest end. ``tail`` are the last labels of nodes that are runs already. Runs only
    grow and the labels at a border stay, so a pair that may merge may still do so later: the outcome
    is the same wherever the events are cut into shards.
    """
    n = len(label)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    first, reach, alive, version = list(range(n)), end.tolist(), [True] * n, [0] * n
    begin, of, last = start.tolist(), group.tolist(), list(label if tail is None else tail)
    heap: list[tuple[float, int, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = nxt[i]
        if j >= n or of[i] != of[j]:
            return
        gap = begin[j] - reach[i]
        if gap <= max_gap:
            s = similar(last[i], label[j], min_similarity)
            if s >= min_similarity:
                heapq.heappush(heap, (-s, gap, i, j, version[i], version[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, _, i, j, vi, vj = heapq.heappop(heap)
        if not (alive[i] and alive[j]) or version[i] != vi or version[j] != vj or nxt[i] != j:
            continue
        # j's run joins i's; what was queued for either is stale from now on
        alive[j] = False
        reach[i], last[i] = max(reach[i], reach[j]), last[j]
        version[i] += 1
        first[j] = i
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        offer(i)
        if prv[i] >= 0:
            offer(prv[i])
    out = np.arange(n)
    head = -1
    for i in range(n):
        if alive[i]:
            head = i
        out[i] = head
    return out


def _merged(batch: pa.Table, keys: Sequence[str], min_similarity: float, max_gap: int) -> pa.Table:
    """Runs of whole groups (rows equal in ``keys``), with what the stitching needs to know of each.

    With columns ``idx`` and ``last`` the rows are runs of shards, some left out: only rows that
    follow each other without one between them are neighbours.
    """
    n = batch.num_rows
    changed = np.zeros(n, bool)
    changed[0] = True
    for k in keys:
        codes = batch[k].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        changed[1:] |= codes[1:] != codes[:-1]
    if "idx" in batch.column_names:
        idx, last, shard = batch["idx"].to_numpy(), batch["last"].to_numpy(), batch["shard"].to_numpy()
        within = (shard[1:] == shard[:-1]) & (idx[1:] == idx[:-1] + 1)
        across = (shard[1:] != shard[:-1]) & last[:-1] & (idx[1:] == 0)
        changed[1:] |= ~(within | across)
    group = np.cumsum(changed)
    start, end = batch["start"].to_numpy(), batch["end"].to_numpy()
    label, tail = batch["label"].to_pylist(), batch["tail"].to_pylist()
    head = agglomerate(group, label, start, end, min_similarity, max_gap, tail)
    heads = np.flatnonzero(head == np.arange(n))
    # prefix: the runs that one reaching in from before might still join, as far as labels allow
    opened = np.flatnonzero(changed)
    apart = np.array([similar(x, y, min_similarity) < min_similarity for x, y in zip(tail, label[1:], strict=False)], bool)
    breaks = np.cumsum(np.append(False, apart))
    prefix = breaks == np.repeat(breaks[opened], np.diff(np.append(opened, n)))
    of = group[heads]
    first_head = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    position = np.arange(len(heads)) - np.repeat(first_head, np.diff(np.append(first_head, len(heads))))
    out = {c: batch[c].take(pa.array(heads)) for c in dict.fromkeys([*keys, "shard", "label", "start"])}
    sums = {c: np.add.reduceat(batch[c].to_numpy(), heads) for c in ("n_events", "n_frames")}
    ends = np.append(heads[1:], n) - 1
    return pa.table({**out, "tail": batch["tail"].take(pa.array(ends)), "end": np.maximum.reduceat(end, heads), **sums, "idx": position, "prefix": prefix[heads], "last": np.append(of[1:] != of[:-1], True)})


def _by_group(keys: Sequence[str], min_similarity: float, max_gap: int):
    """A ``mapInArrow`` function over partitions sorted by ``keys``: groups may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def key(t: pa.Table, i: int) -> tuple:
            return tuple(t[k][i].as_py() for k in keys)

        for b in batches:
            if not b.num_rows:
                continue
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            tail, cut = key(held, held.num_rows - 1), 0
            lo, hi = 0, held.num_rows - 1
            while lo < hi:  # first row of the last group
                mid = (lo + hi) // 2
                lo, hi = (lo, mid) if key(held, mid) == tail else (mid + 1, hi)
            cut = lo
            if cut:
                yield from _merged(held.slice(0, cut), keys, min_similarity, max_gap).to_batches()
                held = held.slice(cut)
        if held is not None:
            yield from _merged(held, keys, min_similarity, max_gap).to_batches()

    return run


def collapse_runs(df: DataFrame, entity: dict[str, Column], label: Column, start: Column, end: Column, frames: Column | None = None, min_similarity: float = 1.0, max_gap: int = 250, shard_width: int = 600_000) -> DataFrame:
    """Each run of consecutive events as one: ``(*entity, label, start, n_events, duration, n_frames)``.

    Adjacent agglomeration: per entity and time shard the events, in order of start, end and label,
    form a linked list whose most similar neighbours are merged through a priority queue until none
    meets ``min_similarity`` (1: equal labels; below: Dice coefficient of character pairs of the two
    labels that touch; a run is named by its first event) and ``max_gap``, the time from the latest
    end of the left run to the start of the right one. The runs that can go on across a shard's edge,
    its last and those at its beginning that earlier events reach and labels allow, are then
    agglomerated per entity, the others are final. The outcome doesn't depend on ``shard_width``.

    Rows with a NULL label, start or end are left out. Rows equal in entity, label, start and end
    count once, with the largest ``frames`` (NULL counts 0). A NULL entity is an entity of its own;
    an empty table gives none. Labels are compared as given: trim and fold them before.
    """
    keys = [f"k{i}" for i in range(len(entity))]
    rows = df.select(*[c.alias(k) for k, c in zip(keys, entity.values(), strict=True)], label.cast("string").alias("label"), start.cast("long").alias("start"), end.cast("long").alias("end"), F.coalesce(frames.cast("long") if frames is not None else F.lit(0), F.lit(0)).cast("long").alias("n_frames"))
    rows = rows.filter(F.col("label").isNotNull() & F.col("start").isNotNull() & F.col("end").isNotNull()).withColumn("shard", F.floor(F.col("start") / shard_width))
    # one shuffle; the removal of repeats and the sort reuse its partitioning
    rows = rows.repartition(*keys, "shard").groupBy(*keys, "shard", "label", "start", "end").agg(F.max("n_frames").alias("n_frames")).withColumns({"n_events": F.lit(1).cast("long"), "tail": F.col("label")})
    columns = [*keys, "shard", "label", "start", "tail", "end", "n_events", "n_frames"]
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", idx bigint, prefix boolean, last boolean"
    rows = rows.select(*columns).sortWithinPartitions(*keys, "shard", "start", "end", "label")
    # written: three passes below read the runs, and none should merge them again
    local = materialize(rows.mapInArrow(_by_group([*keys, "shard"], min_similarity, max_gap), schema), "runs")
    # how far the events of all earlier shards of an entity reach
    per = local.groupBy(*keys, "shard").agg(F.max("end").alias("reach"))
    w = Window.partitionBy(*keys).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("reach", F.max("reach").over(w)).select(*[F.col(k).alias(f"p{k}") for k in keys], F.col("shard").alias("pshard"), "reach")
    seen = local.join(per, [F.col(k).eqNullSafe(F.col(f"p{k}")) for k in keys] + [F.col("shard") == F.col("pshard")])
    open_ = F.col("last") | (F.col("prefix") & F.coalesce(F.col("start") - F.col("reach") <= max_gap, F.lit(False)))
    edge = seen.filter(open_).select(*columns, "idx", "last").repartition(*keys).sortWithinPartitions(*keys, "shard", "idx")
    stitched = edge.mapInArrow(_by_group(keys, min_similarity, max_gap), schema).select(*columns)
    runs = seen.filter(~open_).select(*columns).unionByName(stitched)
    return runs.select(*[F.col(k).alias(n) for k, n in zip(keys, entity, strict=True)], "label", "start", "n_events", (F.col("end") - F.col("start")).alias("duration"), "n_frames")
