"""Overlapping and gapped intervals: continuous periods per entity and the gaps between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasemill.operators.reach import bounded_reach
from phasemill.session import materialize


def _coalesced(df: DataFrame, by: Sequence[str], join_gap: int) -> DataFrame:
    """Merge the intervals ``__s``, ``__e`` inside each group of ``by``; adds no shuffle if already grouped so."""
    w = Window.partitionBy(*by).orderBy("__s", "__e")
    reached = F.max("__e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(F.col("__s") - reached < join_gap, 0).otherwise(1)
    numbered = df.withColumn("__opened", opened).withColumn("__period", F.sum("__opened").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "__period").agg(F.min("__s").alias("__s"), F.max("__e").alias("__e")).drop("__period")


def continuous_periods(df: DataFrame, entity: dict[str, Column], start: Column, end: Column, join_gap: int = 1, shard_width: int = 600_000, points: bool = False) -> DataFrame:
    """Merge each entity's intervals into continuous periods: ``(*entity, start, end)``.

    Two levels, so that no task ever gathers an entity. An interval belongs to the time shard of its
    start; what of it lies beyond is clipped off and carried on as the running maximum of ends, one
    number per shard however far it reaches. Intervals are merged inside each shard. A merged piece
    that starts within ``join_gap`` of the coverage carried into its shard goes on with that; these
    pieces, as one per shard, and the last piece of each shard are stitched per entity, so the
    stitching sees two rows per shard with intervals at most. All other pieces are final.

    ``start`` and ``end`` are integers of one unit. Intervals less than ``join_gap`` apart belong to
    one period (1: those that overlap or touch). Rows with a NULL bound or ``end < start`` are left
    out, those of no length as well unless ``points``. A NULL entity is an entity of its own;
    repeated rows change nothing; an empty table gives none. Columns beyond those named are not
    read, so clashing names do no harm.
    """
    keys = list(entity)
    rows = df.select(*[c.alias(f"__k{i}") for i, c in enumerate(entity.values())], start.cast("long").alias("__s"), end.cast("long").alias("__e"))
    ks = [f"__k{i}" for i in range(len(keys))]
    rows = rows.filter(F.col("__e") >= F.col("__s") if points else F.col("__e") > F.col("__s")).withColumn("__shard", F.floor(F.col("__s") / shard_width))
    pieces = materialize(_coalesced(rows.repartition(*ks, "__shard"), [*ks, "__shard"], join_gap), "pieces")
    inner, edge = _parted(pieces, ks, join_gap)
    periods = inner.unionByName(_coalesced(edge, ks, join_gap))
    return periods.select(*[F.col(k).alias(name) for k, name in zip(ks, keys, strict=True)], F.col("__s").alias("start"), F.col("__e").alias("end"))


def _parted(pieces: DataFrame, ks: Sequence[str], join_gap: int) -> tuple[DataFrame, DataFrame]:
    """Pieces that are final, and those to stitch: of each shard its last, and as one row those that coverage from before reaches."""
    shards = pieces.groupBy(*ks, "__shard").agg(F.max("__e").alias("__own"))
    before = F.max("__own").over(Window.partitionBy(*ks).orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.withColumn("__before", before).withColumnsRenamed({k: f"__m{k}" for k in ks}).withColumnRenamed("__shard", "__at")
    seen = pieces.join(shards, [F.col(k).eqNullSafe(F.col(f"__m{k}")) for k in ks] + [F.col("__shard") == F.col("__at")])
    seen = seen.withColumns({"__joined": F.coalesce(F.col("__s") - F.col("__before") < join_gap, F.lit(False)), "__last": F.col("__e") == F.col("__own")})
    joined = seen.filter("__joined").groupBy(*ks, "__shard").agg(F.min("__s").alias("__s"), F.max("__e").alias("__e"))
    span = [*ks, "__s", "__e"]
    return seen.filter("NOT __joined AND NOT __last").select(*span), joined.select(*span).unionByName(seen.filter("NOT __joined AND __last").select(*span))


def gaps_between(periods: DataFrame, entity: Sequence[str], max_gap: int | None = None, shard_width: int = 600_000) -> DataFrame:
    """The uncovered stretches between successive periods of an entity: ``(*entity, start, end)``.

    ``periods`` are disjoint, as :func:`continuous_periods` gives them. The successor of a period is
    looked up inside its time shard, and over the chain of edge periods for the last of a shard.
    Gaps longer than ``max_gap`` (pauses) are left out.
    """
    sharded = periods.withColumn("__shard", F.floor(F.col("start") / shard_width))

    def successor(df: DataFrame, by: list[str]) -> DataFrame:
        return df.withColumn("__next", F.lead("start").over(Window.partitionBy(*by).orderBy("start")))

    both = bounded_reach(sharded, entity, "__shard", ["start"], 1, successor).filter(F.col("__next").isNotNull())
    if max_gap is not None:
        both = both.filter(F.col("__next") - F.col("end") <= max_gap)
    return both.select(*entity, F.col("end").alias("start"), F.col("__next").alias("end"))


def periods_and_gaps(df: DataFrame, entity: dict[str, Column], start: Column, end: Column, join_gap: int = 1, max_gap: int | None = None, shard_width: int = 600_000, points: bool = False) -> DataFrame:
    """``(*entity, kind, start, end)`` with kind ``period`` or ``gap``; see the two parts. Periods are computed once and written."""
    periods = materialize(continuous_periods(df, entity, start, end, join_gap, shard_width, points), "periods")
    gaps = gaps_between(periods, list(entity), max_gap, shard_width)
    columns = [*entity, "kind", "start", "end"]
    return periods.withColumn("kind", F.lit("period")).select(*columns).unionByName(gaps.withColumn("kind", F.lit("gap")).select(*columns))
