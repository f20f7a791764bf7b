"""Window functions of bounded reach over entities too large for one task.

A plain ``Window.partitionBy(entity)`` gathers every row of a hot entity in one task. Here the
entity's ordered rows are cut into shards; the expressions are evaluated inside each shard, and only
the rows next to a shard's edges are evaluated again over the chain of all edge rows of the entity.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

POSITION, SIZE = "__reach_pos", "__reach_n"


def edge_split(df: DataFrame, entity: Sequence[str], shard: str, order: Sequence, reach: int, compute: Callable[[DataFrame, list[str]], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``(inner, edge)``: together every row of ``df`` once, with the columns ``compute`` adds.

    ``compute(df, partition_columns)`` may add window expressions that look at most ``reach`` rows
    back and ahead in ``order``, which must be a total order whose rows of one shard are contiguous.
    The rows among the outer ``reach`` of a shard get their values from the chain of the outer
    ``2 * reach`` rows of all shards: there every row that such an expression can see is present and
    in place, also across shards of a few rows. ``inner`` keeps the shard partitioning; ``edge`` has
    at most ``2 * reach`` rows per shard.
    """
    by = [*entity, shard]
    ranked = df.withColumn(POSITION, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    ranked = ranked.withColumn(SIZE, F.count(F.lit(1)).over(Window.partitionBy(*by)))
    p, n = F.col(POSITION), F.col(SIZE)
    inner = compute(ranked, by).filter((p > reach) & (p <= n - reach))
    edge = compute(ranked.filter((p <= 2 * reach) | (p > n - 2 * reach)), list(entity)).filter((p <= reach) | (p > n - reach))
    return inner.drop(POSITION, SIZE), edge.drop(POSITION, SIZE)


def bounded_reach(df: DataFrame, entity: Sequence[str], shard: str, order: Sequence, reach: int, compute: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
    """The union of :func:`edge_split`'s two parts."""
    inner, edge = edge_split(df, entity, shard, order, reach, compute)
    return inner.unionByName(edge)


def running_sum(df: DataFrame, entity: Sequence[str], shard: str, order: Sequence, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the entity's rows up to each one, by sums within shards and over whole shards before.

    Entities must not be NULL. ``order`` is a total order in which shards follow each other.
    """
    inside = F.sum(value).over(Window.partitionBy(*entity, shard).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    before = F.sum("__whole").over(Window.partitionBy(*entity).orderBy(shard).rowsBetween(Window.unboundedPreceding, -1))
    shards = df.groupBy(*entity, shard).agg(F.sum(value).alias("__whole")).withColumn("__before", F.coalesce(before, F.lit(0))).drop("__whole")
    return df.withColumn("__inside", inside).join(shards, [*entity, shard]).withColumn(name, F.col("__inside") + F.col("__before")).drop("__inside", "__before")


def running_max(df: DataFrame, entity: Sequence[str], shard: str, order: Sequence, value: str, name: str) -> DataFrame:
    """Adds the greatest ``value`` of the entity's rows before each one, NULL for the first; by shards as :func:`running_sum`."""
    before = Window.partitionBy(*entity, shard).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    over = F.max("__whole").over(Window.partitionBy(*entity).orderBy(shard).rowsBetween(Window.unboundedPreceding, -1))
    shards = df.groupBy(*entity, shard).agg(F.max(value).alias("__whole")).withColumn("__before", over).drop("__whole")
    return df.withColumn("__inside", F.max(value).over(before)).join(shards, [*entity, shard]).withColumn(name, F.greatest("__inside", "__before")).drop("__inside", "__before")


def neighbours(df: DataFrame, entity: Sequence[str], shard, order: Sequence, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """Adds ``name`` for each ``name: (column, offset)``: the value so many rows ahead (back if negative) within the entity, cut into shards by the column ``shard``."""

    def looked(part: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order)
        return part.withColumns({n: F.lead(c, k).over(w) if k > 0 else F.lag(c, -k).over(w) for n, (c, k) in columns.items()})

    return bounded_reach(df.withColumn("__near_shard", shard), entity, "__near_shard", order, max(abs(k) for _, k in columns.values()), looked).drop("__near_shard")
