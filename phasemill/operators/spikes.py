"""Implausible readings: spikes, stuck values and physically impossible ones, per series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasemill.operators.quantiles import exact_medians
from phasemill.operators.reach import edge_split
from phasemill.session import known, materialize

IMPOSSIBLE, FROZEN, SPIKE = "impossible", "frozen", "spike"


def implausible_readings(df: DataFrame, source: Sequence[str], order: str, time: str, fields: dict[str, tuple[float, float]], only: dict[str, Column] | None = None, k: float = 12.0, spike_rows: int = 3, frozen_rows: int = 10, max_step: int = 100, shard_width: int = 4096, median_limit: int = 1_000_000) -> DataFrame:
    """Flag readings per series (``source`` and field): ``(*source, order, field, kind, deviation, scale)``.

    * ``impossible``: outside the field's physical bounds ``fields[name] = (low, high)``, infinities
      included. These leave the series before the other two tests.
    * ``frozen``: one of ``frozen_rows`` or more successive readings of exactly one value (run length).
    * ``spike``: a Hampel test. The location is the rolling median of the reading and its two
      anchors, the readings next before and after a run of 1 to ``spike_rows``; the scale is the
      median absolute deviation of the series' successive changes, its normal behaviour. Every
      reading of the run must deviate to the same side by more than ``k`` scales, and every step from
      anchor to anchor take at most ``max_step``. A median of three anchored so stays exact for runs
      of several readings and for a spike beside a lasting shift, where a wide window's does not;
      the wide form is :func:`hampel`.

    ``order`` is an integer position within the source (unique per source after removal of repeats;
    of rows that share it, the lower time and values come first). Missing values (NULL, NaN) are no
    readings; a field listed in ``only`` counts only where that condition holds. A NULL time makes a
    step that is too long. NULL sources form one source. Repeated rows count once; an empty table
    gives none. No task gathers a source: readings are cut into shards of ``shard_width`` positions,
    see :func:`phasemill.operators.reach.edge_split`, and the scale is an exact distributed median.
    """
    names = list(fields)
    only = only or {}
    value = {n: F.when(only[n], known(F.col(n).cast("double"))) if n in only else known(F.col(n).cast("double")) for n in names}
    rows = df.select(*source, F.col(order).alias("__o"), F.col(time).cast("long").alias("__t"), *[value[n].alias(f"__f{i}") for i, n in enumerate(names)])
    outside = [(F.col(f"__f{i}") < lo) | (F.col(f"__f{i}") > hi) for i, (lo, hi) in enumerate(fields.values())]
    wrong = F.filter(F.array(*[F.when(c, F.lit(n)) for c, n in zip(outside, names, strict=True)]), lambda x: x.isNotNull())
    impossible = rows.filter(reduce(lambda a, b: a | b, outside)).select(*source, "__o", F.explode(wrong).alias("field")).distinct()
    impossible = impossible.select(*source, F.col("__o").alias(order), "field", F.lit(IMPOSSIBLE).alias("kind"), F.lit(None).cast("double").alias("deviation"), F.lit(None).cast("double").alias("scale"))

    rows = rows.filter(F.col("__o").isNotNull()).withColumn("__shard", F.floor(F.col("__o") / shard_width))
    keys = [*source, "__shard", "__o", "__t", *[f"__f{i}" for i in range(len(names))]]
    rows = rows.repartition(*source, "__shard").groupBy(*keys).agg(F.lit(1).alias("__one"))
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.when(~c, F.col(f"__f{i}")).alias("v")) for i, (n, c) in enumerate(zip(names, outside, strict=True))])
    series = rows.select(*source, "__shard", "__o", "__t", F.explode(F.filter(pairs, lambda x: x["v"].isNotNull())).alias("__r"))
    series = series.select(*source, F.col("__r.field").alias("field"), "__shard", "__o", "__t", F.col("__r.v").alias("__v"))

    def measured(part: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy("__o", "__t", "__v")
        ahead = {f"__v{m}": F.lead("__v", m).over(w) for m in range(1, spike_rows + 1)} | {f"__t{m}": F.lead("__t", m).over(w) for m in range(1, spike_rows + 1)}
        part = part.withColumns({"__b": F.lag("__v").over(w), "__bt": F.lag("__t").over(w)} | ahead)
        times = [F.col("__bt"), F.col("__t"), *[F.col(f"__t{m}") for m in range(1, spike_rows + 1)]]
        steps = [y - x <= max_step for x, y in zip(times, times[1:], strict=False)]
        run = [F.col("__v"), *[F.col(f"__v{m}") for m in range(1, spike_rows)]]
        margins = {}
        for m in range(1, spike_rows + 1):
            after = F.col(f"__v{m}")
            least, most = (run[0], run[0]) if m == 1 else (F.least(*run[:m]), F.greatest(*run[:m]))
            # how far the whole run lies beyond the median of anchor, reading, anchor
            margin = F.greatest(least - F.greatest(F.col("__b"), after), F.least(F.col("__b"), after) - most)
            whole = reduce(lambda a, b: a & b, steps[: m + 1]) & F.col("__b").isNotNull() & after.isNotNull()
            margins[f"__m{m}"] = F.when(whole & (margin > 0), margin)
        same = F.when(F.col("__v") == F.col("__b"), 1).otherwise(0)
        part = part.withColumns(margins | {"__same": same, "__change": F.abs(F.col("__v") - F.col("__b"))})
        in_run = [F.col("__m1"), *[F.lag(f"__m{m}", j).over(w) if j else F.col(f"__m{m}") for m in range(2, spike_rows + 1) for j in range(m)]]
        part = part.withColumns({"__dev": F.greatest(*in_run) if len(in_run) > 1 else in_run[0], "__block": F.sum("__same").over(w.rowsBetween(-(frozen_rows - 2), 0)) == frozen_rows - 1})
        return part.withColumn("__frozen", F.max("__block").over(w.rowsBetween(0, frozen_rows - 1)))

    reach = max(frozen_rows - 1, spike_rows + 1)
    packed = []
    for part in edge_split(series, [*source, "field"], "__shard", ["__o", "__t", "__v"], reach, measured):
        flags = F.when(F.col("__dev").isNotNull() | F.col("__frozen"), F.struct(F.col("__o").alias("o"), F.col("__dev").alias("dev"), F.col("__frozen").alias("frozen")))
        packed.append(part.groupBy(*source, "field", "__shard").agg(F.collect_list("__change").alias("changes"), F.collect_list(flags).alias("flags")))
    # one narrow row per series and shard: read for the scales and again for the candidates
    parts = materialize(packed[0].unionByName(packed[1]), "spikes")
    scales = exact_medians(parts, [*source, "field"], "changes", median_limit).select(*[F.col(c).alias(f"__s{i}") for i, c in enumerate([*source, "field"])], F.col("median").alias("scale"))
    same_series = [F.col(c).eqNullSafe(F.col(f"__s{i}")) for i, c in enumerate([*source, "field"])]
    judged = parts.filter(F.size("flags") > 0).join(scales, same_series, "left").select(*source, "field", "scale", F.explode("flags").alias("__f"))
    frozen = judged.filter("__f.frozen").select(*source, F.col("__f.o").alias(order), "field", F.lit(FROZEN).alias("kind"), F.lit(None).cast("double").alias("deviation"), "scale")
    spikes = judged.filter(F.col("__f.dev") > k * F.col("scale")).select(*source, F.col("__f.o").alias(order), "field", F.lit(SPIKE).alias("kind"), F.col("__f.dev").alias("deviation"), "scale")
    return impossible.unionByName(frozen).unionByName(spikes)


def hampel(df: DataFrame, source: Sequence[str], order: Sequence[str], value: str, radius: int = 5, k: float = 3.0, shard: str | None = None) -> DataFrame:
    """The classical Hampel filter: adds ``rolling_median``, ``rolling_mad`` and ``outlier``.

    Window of ``radius`` readings to either side, truncated at the ends of a source; MAD is the
    median of the absolute deviations from the window's own median; a reading is an outlier if it
    deviates by more than ``k * 1.4826 * MAD``. Missing values take part in no window and are no
    outliers. ``shard`` names an integer column whose shards are contiguous in ``order`` (a total
    order); without it every source is one task.
    """

    def rolled(part: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-radius, radius)
        part = part.withColumn("__win", F.sort_array(F.collect_list(known(F.col(value).cast("double"))).over(w)))
        mid = lambda a: F.when(F.size(a) > 0, (F.element_at(a, F.floor((F.size(a) + 1) / 2).cast("int")) + F.element_at(a, F.floor(F.size(a) / 2 + 1).cast("int"))) / 2)
        part = part.withColumn("rolling_median", mid(F.col("__win")))
        part = part.withColumn("__win", F.sort_array(F.transform("__win", lambda v: F.abs(v - F.col("rolling_median")))))
        part = part.withColumn("rolling_mad", mid(F.col("__win"))).drop("__win")
        return part.withColumn("outlier", F.coalesce(F.abs(known(F.col(value).cast("double")) - F.col("rolling_median")) > k * 1.4826 * F.col("rolling_mad"), F.lit(False)))

    if shard is None:
        return rolled(df, list(source))
    inner, edge = edge_split(df, source, shard, order, radius, rolled)
    return inner.unionByName(edge)
