"""Keyed comparison of a table with its expected state, as check results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECK_COLUMNS = ["check", "status", "detail"]


def differs(a: Column, b: Column, tolerance: float | None) -> Column:
    """Whether two values differ: exactly, or by more than a tolerance; NULL equals NULL, NaN equals NaN."""
    if tolerance is None:
        return ~a.eqNullSafe(b)
    x, y = a.cast("double"), b.cast("double")
    apart = F.when(F.isnan(x) | F.isnan(y), ~x.eqNullSafe(y)).otherwise(F.abs(x - y) > tolerance)
    return (x.isNull() != y.isNull()) | F.coalesce(apart & ~x.eqNullSafe(y), F.lit(False))


def parity_counts(expected: DataFrame, actual: DataFrame, key: Sequence[str], tolerances: dict[str, float] | None = None, skip: Sequence[str] = ()) -> DataFrame:
    """One row: ``n_expected, n_missing, n_extra`` and ``diff_<column>`` for each column of ``expected``.

    Names are compared without regard to case. A full join on the key (NULL keys meet), so rows beyond
    the expected are counted as well. Columns that ``actual`` lacks count as differing on every row.
    """
    tol = {k.lower(): v for k, v in (tolerances or {}).items()}
    have = {c.lower(): c for c in actual.columns}
    skipped = {s.lower() for s in skip} | {k.lower() for k in key}
    columns = [c for c in expected.columns if c.lower() not in skipped]
    e = expected.select(*[F.col(k).alias(f"ek{i}") for i, k in enumerate(key)], *[F.col(c).alias(f"e_{c}") for c in columns], F.lit(1).alias("__e"))
    a = actual.select(*[F.col(have[k.lower()]).alias(f"ak{i}") for i, k in enumerate(key)], *[(F.col(have[c.lower()]) if c.lower() in have else F.lit(None)).alias(f"a_{c}") for c in columns], F.lit(1).alias("__a"))
    both = e.join(a, [F.col(f"ek{i}").eqNullSafe(F.col(f"ak{i}")) for i in range(len(key))], "full")
    met = F.col("__e").isNotNull() & F.col("__a").isNotNull()
    diffs = [F.count_if(met & (differs(F.col(f"e_{c}"), F.col(f"a_{c}"), tol.get(c.lower())) if c.lower() in have else F.lit(True))).alias(f"diff_{c.lower()}") for c in columns]
    return both.agg(F.count("__e").alias("n_expected"), F.count_if(F.col("__a").isNull()).alias("n_missing"), F.count_if(F.col("__e").isNull()).alias("n_extra"), *diffs)


def parity_check(name: str, expected: DataFrame, actual: DataFrame, key: Sequence[str], tolerances: dict[str, float] | None = None, skip: Sequence[str] = (), allow_extra: bool = False) -> DataFrame:
    """``check, status, detail`` of one table."""
    counts = parity_counts(expected, actual, key, tolerances, skip)
    diffs = [c for c in counts.columns if c.startswith("diff_")]
    bad = F.array_join(F.filter(F.array(*[F.when(F.col(c) > 0, F.concat(F.lit(c[5:] + " "), F.col(c).cast("string"))) for c in diffs]), lambda x: x.isNotNull()), ", ") if diffs else F.lit("")
    ok = (F.col("n_missing") == 0) & (bad == "") & (F.lit(allow_extra) | (F.col("n_extra") == 0))
    detail = F.concat(F.col("n_expected").cast("string"), F.lit(" rows, missing "), F.col("n_missing").cast("string"), F.lit(", extra "), F.col("n_extra").cast("string"), F.when(bad == "", "").otherwise(F.concat(F.lit(", differ: "), bad)))
    return counts.select(F.lit(name).alias("check"), F.when(ok, "PASS").otherwise("FAIL").alias("status"), detail.alias("detail"))


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows, with multiplicity, of one table that the other lacks; columns in the order of ``a``."""
    b = b.select(*a.columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def normalised(df: DataFrame) -> DataFrame:
    """An export as a table again: names in lower case, columns of nothing but 'true' and 'false' in any case as booleans.

    Whether a text column is such a one is told from all its rows; NULL and empty texts become NULL.
    """
    low = df.toDF(*[c.lower() for c in df.columns])
    texts = [n for n, kind in low.dtypes if kind == "string"]
    if not texts:
        return low
    word = lambda c: F.lower(F.trim(F.col(f"`{c}`")))
    seen = low.agg(*[F.bool_and(word(c).isin("true", "false") | (word(c) == "")).alias(c) for c in texts]).first()
    return low.withColumns({c: word(c).try_cast("boolean") for c in texts if seen[c]})


def table_checks(expected: dict[str, DataFrame], actual: dict[str, DataFrame], plan: dict[str, tuple[Sequence[str], float, bool]]) -> DataFrame:
    """A check per table of ``plan``, which gives its key, the tolerance of its doubles and whether rows beyond the expected are allowed."""
    parts = []
    for name, (key, tolerance, extra) in plan.items():
        doubles = {n: tolerance for n, kind in expected[name].dtypes if kind in ("double", "float")}
        parts.append(parity_check(name, expected[name], actual[name], key, doubles, allow_extra=extra))
    return reduce(DataFrame.unionByName, parts)
