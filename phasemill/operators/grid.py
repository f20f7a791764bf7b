"""Irregular readings onto a regular grid, by distributing increments over grid cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasemill.operators.reach import bounded_reach
from phasemill.session import known

COUNTER, GAUGE = "counter", "gauge"


def reading_spans(df: DataFrame, entity: Sequence[str], time: str, value: str, kind: str = COUNTER, shard_width: int = 120_000) -> DataFrame:
    """Consecutive readings as spans: ``(*entity, t0, v0, t1, v1, increment, reset)``.

    A counter that falls was reset: its increment is then the new reading, what it counted since the
    reset. A gauge has no resets; its increment is the signed difference. The last reading of an
    entity has a span with NULL ``t1``. Readings of one time are ordered by value, repeated ones
    count once. Rows with a missing time or value (NULL or NaN) are left out.
    """
    rows = df.select(*entity, F.col(time).cast("long").alias("t0"), known(F.col(value).cast("double")).alias("v0"))
    rows = rows.filter(F.col("t0").isNotNull() & F.col("v0").isNotNull()).withColumn("__shard", F.floor(F.col("t0") / shard_width))
    # one shuffle by shard; the removal of repeats and the shard windows below reuse its partitioning
    rows = rows.repartition(*entity, "__shard").groupBy(*entity, "__shard", "t0", "v0").agg(F.lit(1).alias("__one")).drop("__one")

    def following(part: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy("t0", "v0")
        return part.withColumns({"t1": F.lead("t0").over(w), "v1": F.lead("v0").over(w)})

    spans = bounded_reach(rows, entity, "__shard", ["t0", "v0"], 1, following)
    fell = F.col("v1") < F.col("v0") if kind == COUNTER else F.lit(False)
    return spans.withColumn("reset", F.coalesce(fell, F.lit(False))).withColumn("increment", F.when(F.col("reset"), F.col("v1")).otherwise(F.col("v1") - F.col("v0"))).drop("__shard")


def regular_grid(df: DataFrame, entity: Sequence[str], time: str, value: str, cell: int, kind: str = COUNTER, fill_cells: int = 2, mark_cells: int | None = None, shard_width: int = 120_000) -> DataFrame:
    """A regular series per entity: ``(*entity, slot, how, n_readings, increment, value, n_resets)``.

    Cell k covers times from ``cell * k`` up to but not including ``cell * (k + 1)``. The increment
    between two consecutive readings is distributed over the cells between them in proportion to
    the time each cell overlaps. ``how`` is

    * ``present``: the cell has readings; ``value`` is their mean;
    * ``filled``: one of at most ``fill_cells`` cells in a row without readings; ``value`` is what the
      distributed increments amount to at the middle of the cell (for a gauge the linear
      interpolation, for a counter the same from the last reading on, after a reset from 0);
    * ``marked``: one of more such cells, up to ``mark_cells`` in a row: uncovered, ``value`` and
      ``increment`` are NULL, and the increment over the stretch is given to no cell.

    Longer stretches (pauses) get no rows. The cells of such stretches that hold a reading at the
    edge are present and get no share of the uncovered increment. ``increment`` of a present cell is
    the sum of its shares; a reading pair of one time gives its whole increment to its cell. A NULL
    entity is an entity of its own, an empty table gives none; see :func:`reading_spans` for missing
    values and repeats.
    """
    spans = reading_spans(df, entity, time, value, kind, shard_width)
    spans = spans.withColumns({"k0": F.floor(F.col("t0") / cell), "k1": F.floor(F.col("t1") / cell)}).withColumn("__absent", F.coalesce(F.col("k1") - F.col("k0") - 1, F.lit(0)))
    absent, length = F.col("__absent"), F.col("t1") - F.col("t0")
    base = F.when(F.col("reset"), 0.0).otherwise(F.col("v0"))
    covered = absent <= fill_cells

    def share(slot: Column) -> Column:
        overlap = F.least(F.col("t1"), (slot + 1) * cell) - F.greatest(F.col("t0"), slot * cell)
        return F.when(~covered, F.lit(None).cast("double")).when(length == 0, F.col("increment")).otherwise(F.col("increment") * overlap / F.nullif(length, F.lit(0)))

    between = spans.filter(absent >= 1)
    if mark_cells is not None:
        between = between.filter(absent <= mark_cells)
    between = between.withColumn("slot", F.explode(F.sequence(F.col("k0") + 1, F.col("k1") - 1)))
    middle = F.col("slot") * cell + cell / 2
    holes = between.select(
        *entity, "slot",
        F.when(covered, "filled").otherwise("marked").alias("how"),
        F.lit(0).cast("long").alias("n_readings"),
        share(F.col("slot")).alias("increment"),
        F.when(covered, base + F.col("increment") * (middle - F.col("t0")) / F.nullif(length, F.lit(0))).alias("value"),
        F.lit(0).cast("long").alias("n_resets"),
    )
    # a span's two ends lie in present cells: its first cell holds its reading, its last one only a share
    ends = spans.withColumn("__end", F.explode(F.array(
        F.struct(F.col("k0").alias("slot"), F.col("v0").alias("v"), F.when(F.col("t1").isNotNull(), share(F.col("k0"))).alias("inc"), F.lit(0).alias("r")),
        F.struct(F.when(F.col("k1") > F.col("k0"), F.col("k1")).alias("slot"), F.lit(None).cast("double").alias("v"), share(F.col("k1")).alias("inc"), F.lit(0).alias("r")),
        F.struct(F.when(F.col("reset"), F.col("k1")).alias("slot"), F.lit(None).cast("double").alias("v"), F.lit(None).cast("double").alias("inc"), F.lit(1).alias("r")),
    )))
    ends = ends.filter(F.col("__end.slot").isNotNull())
    present = ends.groupBy(*entity, F.col("__end.slot").alias("slot")).agg(F.count("__end.v").alias("n_readings"), F.sum("__end.inc").alias("increment"), F.avg("__end.v").alias("value"), F.sum("__end.r").cast("long").alias("n_resets")).withColumn("how", F.lit("present"))
    columns = [*entity, "slot", "how", "n_readings", "increment", "value", "n_resets"]
    return present.select(*columns).unionByName(holes.select(*columns))
