"""Pairing records of two tables by nearest time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest_in_time(left: DataFrame, right: DataFrame, entity: Sequence[str], left_time: Column, right_time: Column, tolerance: int, left_cols: Sequence[str] = (), right_value: str | None = None, shard_width: int = 120_000) -> DataFrame:
    """Each left record with the nearest right one in time: ``(*entity, *left_cols, left_time, right_time, right_value)``.

    Both tables are united, sorted per entity and time, and the last and the next right record are
    carried onto the left rows; the nearer within ``tolerance`` is kept. Of equally near ones the
    earlier counts, of right records of one time the one with the least ``right_value``. Left rows
    without partner give no row. Times are integers.

    An entity is never one task: rows are cut into time shards, and a right record within
    ``tolerance`` of a shard's edge is also sent to the neighbouring shard, so each shard decides its
    left rows alone. Right records are reduced to one per time before they are united. Left rows
    equal in all columns given count once; rows with a NULL entity or time have no partner; empty
    tables give none. Other columns aren't read, so clashing names do no harm.
    """
    if tolerance >= shard_width:
        raise ValueError("shard_width must exceed tolerance")
    ks = [f"__k{i}" for i in range(len(entity))]
    keys = [F.col(e).alias(k) for e, k in zip(entity, ks, strict=True)]
    cols = [f"__c{i}" for i in range(len(left_cols))]
    known = lambda df: df.filter(" AND ".join([f"{k} IS NOT NULL" for k in ks] + ["__t IS NOT NULL"]))
    ls = known(left.select(*keys, left_time.cast("long").alias("__t"), *[F.col(c).alias(n) for c, n in zip(left_cols, cols, strict=True)]).distinct())
    value = F.col(right_value) if right_value else F.lit(None).cast("long")
    rs = known(right.select(*keys, right_time.cast("long").alias("__t"), value.alias("__v")))
    # a right record is wanted in the shard of its time and in those that its tolerance reaches into
    shards = F.sequence(F.floor((F.col("__t") - tolerance) / shard_width), F.floor((F.col("__t") + tolerance) / shard_width))
    rs = rs.withColumn("__shard", F.explode(shards)).groupBy(*ks, "__shard", "__t").agg(F.min("__v").alias("__v"))
    ls = ls.withColumn("__shard", F.floor(F.col("__t") / shard_width))
    types = dict(ls.dtypes)
    empty = [F.lit(None).cast(types[c]).alias(c) for c in cols]
    both = rs.select(*ks, "__shard", "__t", F.lit(0).alias("__left"), F.struct("__t", "__v").alias("__r"), *empty).unionByName(ls.select(*ks, "__shard", "__t", F.lit(1).alias("__left"), F.lit(None).cast(rs.select(F.struct("__t", "__v")).schema[0].dataType).alias("__r"), *cols))
    by = [*ks, "__shard"]
    # the right record of a left row's own time comes before it going forward, and its distance 0 wins
    forward = Window.partitionBy(*by).orderBy("__t", "__left").rowsBetween(Window.unboundedPreceding, 0)
    backward = Window.partitionBy(*by).orderBy(F.col("__t").desc(), "__left").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("__last", F.last("__r", ignorenulls=True).over(forward)).withColumn("__next", F.last("__r", ignorenulls=True).over(backward))
    before, after = F.col("__t") - F.col("__last.__t"), F.col("__next.__t") - F.col("__t")
    nearer = F.when(F.coalesce(before <= after, F.col("__next").isNull()), F.col("__last")).otherwise(F.col("__next"))
    chosen = carried.filter(F.col("__left") == 1).withColumn("__best", nearer).filter(F.abs(F.col("__best.__t") - F.col("__t")) <= tolerance)
    return chosen.select(*[F.col(k).alias(e) for k, e in zip(ks, entity, strict=True)], *[F.col(n).alias(c) for n, c in zip(cols, left_cols, strict=True)], F.col("__t").alias("left_time"), F.col("__best.__t").alias("right_time"), F.col("__best.__v").alias("right_value"))
