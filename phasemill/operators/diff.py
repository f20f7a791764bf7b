"""Differences between two copies of a table, by content-defined chunks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phasemill.session import known

SOURCE, COPY = "s", "c"


def _plain(kind: T.DataType, c: Column) -> Column:
    """The value that counts in a comparison: strings without outer blanks, NaN as NULL."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return known(c.try_cast("double"))
    if isinstance(kind, T.StringType):
        return F.trim(c.cast("string"))
    return c.try_cast(kind)


def copy_differences(source: DataFrame, copy: DataFrame, key: Sequence[str], block: Column, ignore: Sequence[str] = (), tolerance: float = 1e-6, shards: int | None = None, mean_chunk_bits: int = 4) -> DataFrame:
    """Rows missing on either side and fields that differ: ``(*key, field, kind)``.

    Content-defined chunking. ``block`` is an expression of the key that puts neighbouring keys
    together. Rows of both copies are shuffled once, by a hash of their block (64 bits, so that the
    number of blocks grows with the data; ``shards`` folds it to so many), and sorted by key in it.
    A chunk ends where a hash rolled over the last four keys has its low ``mean_chunk_bits`` at zero,
    never between rows of one key, so an inserted or lost row moves the cuts beside it only. Chunks
    are compared by a 128-bit fingerprint of their rows: those that the other side's block has as
    well are dropped, and only rows of the others are compared by key and field by field. Copies of
    a key share their block, so all of this happens where the one shuffle has brought the rows, in
    windows that spill.

    kind is ``missing_in_copy`` or ``missing_in_source`` (field ``*``) or ``differs``. Doubles differ
    by more than ``tolerance``, strings are compared without outer blanks, NULL and NaN are equal
    and differ from any value, NULL keys equal NULL keys. Rows repeated exactly (``ignore`` aside)
    count once. Of several different rows of one key those that the other side has as well cancel;
    if one row is left on either side their fields are compared, else rows left in the source give
    one ``missing_in_copy`` and rows left in the copy one ``missing_in_source`` for the key. Only
    columns that both copies have are compared. Empty copies are allowed: all rows of the other side
    are missing.
    """
    types = {f.name: f.dataType for f in source.schema.fields}
    fields = [n for n in source.columns if n in copy.columns and n not in key and n not in ignore]
    ks, vs = [f"k{i}" for i in range(len(key))], [f"v{i}" for i in range(len(fields))]
    spread = F.xxhash64(block) if shards is None else F.pmod(F.xxhash64(block), F.lit(shards))

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(spread.alias("shard"), F.lit(tag).alias("side"), *[F.col(k).alias(c) for c, k in zip(ks, key, strict=True)], *[_plain(types[n], F.col(n)).alias(v) for v, n in zip(vs, fields, strict=True)])

    # the only shuffle
    rows = side(source, SOURCE).unionByName(side(copy, COPY)).repartition("shard")
    rows = rows.groupBy("shard", "side", *ks, *vs).agg(F.lit(1).alias("one")).drop("one")
    # what fingerprints see: rounding within a tenth of the tolerance, so that copies of other precision still match
    seen = [F.round(F.col(v), 7) + F.lit(0.0) if isinstance(types[n], (T.DoubleType, T.FloatType)) and tolerance >= 1e-6 else F.col(v) for v, n in zip(vs, fields, strict=True)]
    nulls = F.concat(*[F.when(F.col(v).isNull(), "0").otherwise("1") for v in vs]) if fields else F.lit("")
    rows = rows.withColumns({"kh": F.xxhash64(*ks), "f1": F.xxhash64(F.lit(1), *ks, nulls, *seen), "f2": F.xxhash64(F.lit(2), *ks, nulls, *seen)})
    w = Window.partitionBy("shard", "side").orderBy(*ks, "f1", "f2")
    rolled = reduce(lambda x, y: x.bitwiseXOR(y), [F.shiftrightunsigned(F.coalesce(F.lag("kh", j).over(w), F.lit(0).cast("long")), 11 * j) for j in (1, 2, 3)], F.col("kh"))
    # the row with the cut ends its chunk
    ends = (rolled.bitwiseAND((1 << mean_chunk_bits) - 1) == 0) & ~F.lead("kh").over(w).eqNullSafe(F.col("kh"))
    rows = rows.withColumn("cut", F.when(ends, 1).otherwise(0))
    rows = rows.withColumn("chunk", F.coalesce(F.sum("cut").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    c = Window.partitionBy("shard", "side", "chunk")
    rows = rows.withColumns({"p1": F.bit_xor("f1").over(c), "p2": F.bit_xor("f2").over(c), "n": F.count(F.lit(1)).over(c)})
    same = Window.partitionBy("shard", "p1", "p2", "n")
    lone = rows.withColumns({"lo": F.min("side").over(same), "hi": F.max("side").over(same)}).filter("lo = hi")

    row = F.struct(F.lit(1).alias("here"), *vs)
    left = lone.groupBy("shard", *ks, "f1", "f2").agg(F.min("side").alias("side"), F.max("side").alias("hi"), F.first(row).alias("row")).filter("side = hi")
    of = lambda tag: F.when(F.col("side") == tag, F.col("row"))
    pairs = left.groupBy("shard", *ks).agg(F.count(of(SOURCE)).alias("na"), F.count(of(COPY)).alias("nb"), F.first(of(SOURCE), ignorenulls=True).alias("ra"), F.first(of(COPY), ignorenulls=True).alias("rb"))

    def differs(i: int, n: str) -> Column:
        x, y = F.col(f"ra.v{i}"), F.col(f"rb.v{i}")
        if isinstance(types[n], (T.DoubleType, T.FloatType)):
            apart = F.coalesce((x != y) & ~(F.abs(x - y) <= tolerance), F.lit(False))
            return (x.isNull() != y.isNull()) | apart
        return ~x.eqNullSafe(y)

    entry = "array<struct<field:string,kind:string>>"
    one = lambda field, kind: F.struct(F.lit(field).alias("field"), F.lit(kind).alias("kind"))
    some = lambda parts: F.filter(F.array(*parts), lambda x: x.isNotNull()).cast(entry)
    fielded = some([F.when(differs(i, n), one(n, "differs")) for i, n in enumerate(fields)]) if fields else F.array().cast(entry)
    lost = some([F.when(F.col("na") > 0, one("*", "missing_in_copy")), F.when(F.col("nb") > 0, one("*", "missing_in_source"))])
    found = F.when((F.col("na") == 1) & (F.col("nb") == 1), fielded).otherwise(lost)
    return pairs.select(*[F.col(k).alias(n) for k, n in zip(ks, key, strict=True)], F.explode(found).alias("__d")).select(*key, "__d.field", "__d.kind")
