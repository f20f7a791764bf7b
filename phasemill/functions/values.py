"""Column functions for missing values and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def missing(c: Column) -> Column:
    """True where a double is NULL or NaN."""
    return c.isNull() | F.isnan(c)


def known(c: Column) -> Column:
    """A double with NaN turned into NULL."""
    return F.when(~F.isnan(c), c)


def ms_of(seconds: Column) -> Column:
    """Milliseconds of a time in seconds, half up; NULL for a missing or non-finite time."""
    s = seconds.cast("double")
    return F.when(F.abs(s) < F.lit(9.0e12), F.floor(s * 1000 + 0.5)).cast("long")
