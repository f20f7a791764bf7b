"""Exact medians of groups of any size, without gathering a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phasemill.session import materialize

BINS = 4096


def _by_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which NULL keys meet; keeps the left keys."""
    renamed = right.withColumnsRenamed({k: f"__j{i}" for i, k in enumerate(keys)})
    return left.join(renamed, [F.col(k).eqNullSafe(F.col(f"__j{i}")) for i, k in enumerate(keys)]).drop(*[f"__j{i}" for i in range(len(keys))])


def exact_medians(parts: DataFrame, keys: Sequence[str], values: str, limit: int = 1_000_000) -> DataFrame:
    """``(*keys, n, median)``: the exact median of each group, see :func:`exact_quantiles`."""
    return exact_quantiles(parts, keys, values, 0.5, limit).withColumnRenamed("quantile", "median")


def exact_quantiles(parts: DataFrame, keys: Sequence[str], values: str, q: float, limit: int = 1_000_000) -> DataFrame:
    """``(*keys, n, quantile)``: the exact q-quantile of each group, linear between the two ranks it lies between.

    ``parts`` has several rows per group, each with an array of doubles of bounded length. Groups of
    at most ``limit`` values are sorted in one task. For larger ones the range that holds these
    ranks is narrowed first, round by round, through histograms of ``BINS`` bins that are combined
    before the shuffle, until at most ``limit`` values or one value is left. Only the number of
    groups still too large comes to the driver. Groups without values get no row.
    """
    def ranks(n):
        # rounded, since 0.9 * (n - 1) may fall short of a whole rank
        place = F.round((n - 1) * F.lit(float(q)), 9)
        low = F.floor(place)
        return low, F.least(low + 1, n - 1), place - low

    x = parts.select(*keys, F.col(values).alias("__v")).filter(F.size("__v") > 0)
    bounds = x.groupBy(*keys).agg(F.sum(F.size("__v")).cast("long").alias("n"), F.min(F.array_min("__v")).alias("lo"), F.max(F.array_max("__v")).alias("hi"))
    bounds = materialize(bounds.withColumns({"below": F.lit(0).cast("long"), "held": F.col("n")}), "median-bounds")
    open_ = (F.col("held") > limit) & (F.col("lo") < F.col("hi"))
    while bounds.filter(open_).count() > 0:
        width = F.col("hi") / BINS - F.col("lo") / BINS
        wide = _by_key(x, bounds.filter(open_), keys).withColumn("__v", F.explode(F.filter("__v", lambda v: (v >= F.col("lo")) & (v <= F.col("hi")))))
        # the top value has a bin of its own, so that every round parts at least two values
        place = F.when(F.col("__v") == F.col("hi"), BINS).when(width > 0, F.least(F.floor((F.col("__v") - F.col("lo")) / width), F.lit(BINS - 1))).otherwise(0)
        bins = wide.groupBy(*keys, place.alias("__bin")).agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.first("n").alias("n"), F.first("below").alias("below"))
        w = Window.partitionBy(*keys).orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)
        bins = bins.withColumn("__upto", F.sum("__c").over(w) + F.col("below"))
        low, high, _ = ranks(F.col("n"))
        kept = bins.filter((F.col("__upto") > low) & (F.col("__upto") - F.col("__c") <= high))
        kept = kept.groupBy(*keys).agg(F.first("n").alias("n"), F.min("__lo").alias("lo"), F.max("__hi").alias("hi"), F.min(F.col("__upto") - F.col("__c")).alias("below"), F.sum("__c").alias("held"))
        bounds = materialize(bounds.filter(~open_).unionByName(kept.select(bounds.columns)), "median-bounds")
    # repeats of one value collapse before the shuffle; where lo = hi that is one row
    narrow = _by_key(x, bounds, keys)
    one = narrow.filter(F.col("lo") == F.col("hi")).groupBy(*keys).agg(F.first("n").alias("n"), F.first("lo").alias("quantile"))
    inside = F.when((F.col("lo") == F.array_min("__v")) & (F.col("hi") == F.array_max("__v")), F.col("__v")).otherwise(F.filter("__v", lambda v: (v >= F.col("lo")) & (v <= F.col("hi"))))
    sorted_ = narrow.filter(F.col("lo") < F.col("hi")).groupBy(*keys).agg(F.first("n").alias("n"), F.first("below").alias("below"), F.sort_array(F.flatten(F.collect_list(inside))).alias("__s"))
    at = lambda rank: F.element_at("__s", (rank - F.col("below") + 1).cast("int"))
    low, high, part = ranks(F.col("n"))
    between = F.when(part == 0.5, (at(low) + at(high)) / 2).when(part == 0, at(low)).otherwise(at(low) + (at(high) - at(low)) * part)
    many = sorted_.select(*keys, "n", between.alias("quantile"))
    return one.unionByName(many)
