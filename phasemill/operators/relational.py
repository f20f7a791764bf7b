"""Relational building blocks of the motion pipeline: pivots, islands, interval lookups, transforms of ordered rows.

Entities (takes) may be of any size. Steps that look a bounded number of rows aside run in shards of
an entity (:mod:`phasemill.operators.reach`); steps that carry state along an entity first reduce its
rows to one per run and shard.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phasemill.operators.reach import bounded_reach, running_sum
from phasemill.schemas import EPS, LABELS

SHARD = "__shard"


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in any float column becomes NULL; other columns are untouched."""
    return df.select(*[F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`") for f in df.schema.fields])


def conditional_pivot(df: DataFrame, keys: Sequence[str], ident: str, ids: Sequence, values: dict[str, str], extra: Sequence[Column] = ()) -> DataFrame:
    """Tall to wide: per key the maximum of ``values[prefix]`` for each id, named ``prefix`` with ``{}`` filled by the id.

    One hash aggregation with map-side combine; ids not listed are filtered before it, in the scan.
    An id without rows gives NULL, repeated rows change nothing.
    """
    cells = [F.max(F.when(F.col(ident) == i, F.col(c))).alias(name.format(i)) for i in ids for name, c in values.items()]
    return df.filter(F.col(ident).isin(list(ids))).groupBy(*keys).agg(*cells, *extra)


def islands(df: DataFrame, entity: Sequence[str], order: str, label: str, shard: Column, extra: dict[str, Column] | None = None) -> DataFrame:
    """Runs of equal labels per entity: ``(*entity, island, label, first, last, n, labels_in_island, next_first, *extra)``.

    ``extra`` are aggregates of partial results that merge by sum. Runs are cut at shards, reduced to
    one row each, and joined again where a run goes on across a cut; so an entity's task sees one
    row per run and shard. ``order`` must be unique within an entity. NULL labels form runs too.
    """
    extra = extra or {}
    w = Window.partitionBy(*entity, SHARD).orderBy(order)
    same = F.col(label).eqNullSafe(F.lag(label).over(w)) & (F.row_number().over(w) > 1)
    rows = df.withColumn(SHARD, shard).withColumn("__new", F.when(same, 0).otherwise(1)).withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = rows.groupBy(*entity, SHARD, "__run").agg(F.min_by(label, order).alias("label"), F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"), F.countDistinct(label).alias("labels_in_island"), *[c.alias(k) for k, c in extra.items()])
    v = Window.partitionBy(*entity).orderBy("first")
    joined = F.col("label").eqNullSafe(F.lag("label").over(v)) & (F.row_number().over(v) > 1)
    pieces = pieces.withColumn("__new", F.when(joined, 0).otherwise(1)).withColumn("island", F.sum("__new").over(v.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    whole = pieces.groupBy(*entity, "island").agg(F.min_by("label", "first").alias("label"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"), F.max("labels_in_island").alias("labels_in_island"), *[F.sum(k).alias(k) for k in extra])
    return whole.withColumn("next_first", F.lead("first").over(Window.partitionBy(*entity).orderBy("island")))


def with_last_flag(segments: DataFrame, entity: Sequence[str], by: str) -> DataFrame:
    """Adds ``is_last``: whether the row has its entity's greatest ``by``."""
    last = segments.groupBy(*entity).agg(F.max(by).alias("__most"))
    return segments.join(last, list(entity)).withColumn("is_last", F.col(by) == F.col("__most")).drop("__most")


def in_segment(point: Column, start: Column, end: Column, is_last: Column, relative: bool = True) -> Column:
    """Half-open membership, the end of the last segment included.

    ``relative``: the label rule, whose end counts within ``1e-9 + 1e-5 * |end|``; otherwise the event
    rule, with an absolute 1e-9.
    """
    at_end = F.abs(point - end) <= F.lit(EPS) + F.lit(1e-5) * F.abs(end) if relative else point <= end + F.lit(EPS)
    return (point >= start) & ((point < end) | (is_last & at_end))


def range_join(points: DataFrame, segments: DataFrame, entity: Sequence[str], point: str, relative: bool = True, how: str = "left", cell: float = 10.0) -> DataFrame:
    """Points with the segment that holds them; segments carry ``start_s``, ``end_s``, ``is_last``.

    An equi join on entity and time cell with the interval as residual condition: a point lies in
    one cell, a segment is repeated for each cell it touches, so a hot entity spreads over its cells
    and no pair from another cell is formed. Overlapping segments give a row each.
    """
    left = points.withColumn("__cell", F.floor(F.col(point) / cell))
    start, end = F.col("start_s"), F.col("end_s")
    touched = F.sequence(F.floor(start / cell), F.floor((end + 1e-3 + F.abs(end) * 1e-5) / cell))
    right = segments.filter(end >= start).withColumn("__cell", F.explode(touched)).withColumnsRenamed({k: f"__e{i}" for i, k in enumerate(entity)})
    on = [F.col(k) == F.col(f"__e{i}") for i, k in enumerate(entity)] + [left["__cell"] == right["__cell"], in_segment(F.col(point), start, end, F.col("is_last"), relative)]
    return left.join(right, on, how).drop("__cell", *[f"__e{i}" for i in range(len(entity))])


def in_intervals(points: DataFrame, intervals: DataFrame, entity: Sequence[str], point: str, flag: str, cell: float = 10.0) -> DataFrame:
    """Adds ``flag``: whether an interval of the entity holds the point, both bounds lowered by 1e-9.

    Intervals are cut into the cells they touch and merged there, so that a point meets one of them
    at most and one left join answers.
    """
    spans = intervals.select(*entity, (F.col("start_s") - EPS).alias("__a"), (F.col("end_s") - EPS).alias("__b")).filter(F.col("__b") >= F.col("__a")).withColumn("__cell", F.explode(F.sequence(F.floor(F.col("__a") / cell), F.floor(F.col("__b") / cell))))
    w = Window.partitionBy(*entity, "__cell").orderBy("__a", "__b")
    reached = F.max("__b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("__new", F.when(F.col("__a") <= reached, 0).otherwise(1)).withColumn("__n", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy(*entity, "__cell", "__n").agg(F.min("__a").alias("__a"), F.max("__b").alias("__b"))
    spans = spans.withColumnsRenamed({k: f"__e{i}" for i, k in enumerate(entity)}).withColumnRenamed("__cell", "__c2")
    keyed = points.withColumn("__cell", F.floor(F.col(point) / cell))
    on = [F.col(k) == F.col(f"__e{i}") for i, k in enumerate(entity)] + [F.col("__cell") == F.col("__c2"), F.col(point) >= F.col("__a"), F.col(point) < F.col("__b")]
    return keyed.join(spans, on, "left").withColumn(flag, F.col("__a").isNotNull()).select(*points.columns, flag)


def asof_label(points: DataFrame, segments: DataFrame, entity: Sequence[str], point: str, shard_width: float = 600.0) -> DataFrame:
    """The label of the last segment that starts at or before the point, NULL once it has ended.

    For contiguous segments the same as :func:`range_join`, in one sorted pass and without repeating
    rows where segments overlap: both tables are united and the last segment is carried on, within
    time shards of the entity, and from shard to shard by one row each.
    """
    shard = F.floor(F.col("__t") / shard_width).alias(SHARD)
    seg = segments.select(*entity, F.col("start_s").alias("__t"), F.lit(0).alias("__k"), F.struct("start_s", "end_s", "label", "is_last").alias("__seg")).select("*", shard)
    kind = seg.schema["__seg"].dataType
    pts = points.withColumns({"__t": F.col(point), "__k": F.lit(1), "__seg": F.lit(None).cast(kind)}).select("*", shard)
    both = pts.unionByName(seg, allowMissingColumns=True)
    w = Window.partitionBy(*entity, SHARD).orderBy("__t", "__k", F.col("__seg.end_s")).rowsBetween(Window.unboundedPreceding, 0)
    # the last segment of a shard is its greatest by start and end
    last = both.groupBy(*entity, SHARD).agg(F.max("__seg").alias("__last"))
    v = Window.partitionBy(*entity).orderBy(SHARD).rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("__carried", F.last("__last", ignorenulls=True).over(v)).drop("__last")
    both = both.withColumn("__own", F.last("__seg", ignorenulls=True).over(w)).filter("__k = 1").join(carried, [*entity, SHARD], "left").withColumn("__at", F.coalesce("__own", "__carried"))
    holds = in_segment(F.col(point), F.col("__at.start_s"), F.col("__at.end_s"), F.col("__at.is_last"))
    return both.withColumn("label_at", F.when(holds, F.col("__at.label"))).drop("__t", "__k", "__seg", "__own", "__carried", "__at", SHARD)


def positioned(df: DataFrame, entity: Sequence[str], order: Sequence, name: str = "position", shard: Column | None = None) -> DataFrame:
    """Row number within the entity from 0, to match tables keyed by a time whose last bit may differ.

    ``shard`` cuts entities too large for a task, in the order of ``order``; rows are then counted
    within shards and over whole shards before.
    """
    if shard is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*entity).orderBy(*order)) - 1)
    rows = running_sum(df.withColumns({SHARD: F.coalesce(shard.cast("long"), F.lit(-(1 << 62))), "__one": F.lit(1)}), entity, SHARD, order, "__one", name)
    return rows.withColumn(name, (F.col(name) - 1).cast("int")).drop("__one", SHARD)


def strictly_increasing(df: DataFrame, entity: Sequence[str], order: str, time: str, name: str, shard: Column) -> DataFrame:
    """Times made strictly increasing: each at least one more than the one before.

    In closed form: with i the row's number, the running maximum of (time - i), plus i. The running
    maximum and the numbers are taken per shard and carried on by one row per shard.
    """
    rows = df.withColumn(SHARD, shard)
    w = Window.partitionBy(*entity, SHARD).orderBy(order)
    rows = rows.withColumn("__i", F.row_number().over(w))
    per = rows.groupBy(*entity, SHARD).agg(F.count(F.lit(1)).alias("__n"), F.max(F.col(time) - F.col("__i")).alias("__most"))
    v = Window.partitionBy(*entity).orderBy(SHARD).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("__base", F.coalesce(F.sum("__n").over(v), F.lit(0)))
    per = per.withColumn("__before", F.max(F.col("__most") - F.col("__base")).over(v)).select(*entity, SHARD, "__base", "__before")
    rows = rows.join(per, [*entity, SHARD]).withColumn("__i", F.col("__i") + F.col("__base"))
    running = F.max(F.col(time) - F.col("__i")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(name, F.greatest(running, F.col("__before")) + F.col("__i")).drop(SHARD, "__i", "__base", "__before")


def absorb_short_runs(runs: DataFrame, entity: Sequence[str], order: str, label: str, length: str, least: int) -> DataFrame:
    """Runs shorter than ``least`` take the label of the last run before them that isn't; the first run stays. Adds ``absorbed``."""
    w = Window.partitionBy(*entity).orderBy(order)
    keeps = (F.col(length) >= least) | (F.row_number().over(w) == 1)
    return runs.withColumn("__kept", F.when(keeps, F.col(label))).withColumn("absorbed", F.last("__kept", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__kept")


def fill_short_gaps(df: DataFrame, entity: Sequence[str], order: str, time: str, values: Sequence[str], shard: Column) -> DataFrame:
    """Runs of one or two NULLs with values on both sides are filled linearly in time: adds ``<value>_filled`` and ``<value>_was_gap``.

    Such a run needs no search: its neighbours are one or two rows away. All values are filled in one
    pass over the rows.
    """

    def filled(part: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(order)
        near = {f"__{n}{j}": F.lag(c, k).over(w) if k > 0 else F.lead(c, -k).over(w) for n, c in [("t", time), *[(f"v{i}_", v) for i, v in enumerate(values)]] for j, k in enumerate((2, 1, -1, -2))}
        part, out = part.withColumns(near), {}
        for i, value in enumerate(values):
            v = [F.col(f"__v{i}_{j}") for j in range(4)]
            # a run of one, and either row of a run of two: nearest values before and after
            cases = [(1, 2, F.lit(True)), (0, 2, v[1].isNull()), (1, 3, v[2].isNull())]
            line = lambda a, b, v=v: v[a] + (v[b] - v[a]) * (F.col(time) - F.col(f"__t{a}")) / F.nullif(F.col(f"__t{b}") - F.col(f"__t{a}"), F.lit(0))
            guess = F.coalesce(*[F.when(v[a].isNotNull() & v[b].isNotNull() & c, line(a, b)) for a, b, c in cases])
            out |= {f"{value}_filled": F.coalesce(F.col(value), guess), f"{value}_was_gap": F.col(value).isNull() & guess.isNotNull()}
        return part.withColumns(out).drop(*near)

    return bounded_reach(df.withColumn(SHARD, shard), entity, SHARD, [order], 2, filled).drop(SHARD)


def dropout_runs(df: DataFrame, entity: Sequence[str], index: str, lost: Column, shard_width: int = 4096) -> DataFrame:
    """Runs of lost rows: ``(*entity, first, last, n)`` for each run of consecutive indexes where ``lost`` holds."""
    rows = df.filter(lost).select(*entity, index).withColumn(SHARD, F.floor(F.col(index) / shard_width)).distinct()
    w = Window.partitionBy(*entity, SHARD).orderBy(index)
    runs = rows.withColumn("__g", F.col(index) - F.row_number().over(w)).groupBy(*entity, SHARD, "__g").agg(F.min(index).alias("first"), F.max(index).alias("last"))
    v = Window.partitionBy(*entity).orderBy("first")
    runs = runs.withColumn("__new", F.when(F.col("first") == F.lag("last").over(v) + 1, 0).otherwise(1)).withColumn("__g", F.sum("__new").over(v.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*entity, "__g").agg(F.min("first").alias("first"), F.max("last").alias("last")).withColumn("n", F.col("last") - F.col("first") + 1).drop("__g")


def dropout_report(runs: DataFrame, entity: Sequence[str], sustained: int = 3) -> DataFrame:
    """Per entity the lost rows, those in runs of at least ``sustained``, and the runs as text."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("n") >= sustained, F.struct("first", "last")))), lambda r: F.concat(r["first"].cast("string"), F.lit("-"), r["last"].cast("string"))), "; ")
    return runs.groupBy(*entity).agg(F.sum("n").alias("n_lost"), F.coalesce(F.sum(F.when(F.col("n") >= sustained, F.col("n"))), F.lit(0)).alias("n_sustained"), text.alias("sustained_runs"))


def row_argmax(columns: Sequence[str], names: Sequence[str]) -> Column:
    """Name of the first greatest of several columns; NULL if all are."""
    most = F.greatest(*columns)
    return reduce(lambda e, x: e.when(F.col(x[0]) == most, F.lit(x[1])), list(zip(columns, names, strict=True))[1:], F.when(F.col(columns[0]) == most, F.lit(names[0])))


def label_order(c: Column) -> Column:
    return reduce(lambda e, x: e.when(c == x[1], F.lit(x[0] + 1)), list(enumerate(LABELS))[1:], F.when(c == LABELS[0], F.lit(1)))


def lookup(mapping: dict, c: Column) -> Column:
    """A literal dimension map applied to a column."""
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[c]


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Adds ``weight`` = rows / (classes * rows of the class), so that every class weighs the same."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("__c"))
    every = Window.partitionBy(F.lit(1))  # one row per class
    weights = per.select(label, (F.sum("__c").over(every) / (F.count(F.lit(1)).over(every) * F.col("__c"))).alias("weight"))
    return df.join(weights, label)


def replace_version(history: DataFrame, fresh: DataFrame, version: str) -> DataFrame:
    """A history table with the rows of the fresh versions replaced."""
    kept = history.join(fresh.select(version).distinct(), version, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)
