"""Aggregate expressions with engine-independent results.

``exact_avg`` averages a DECIMAL(p, s) column by summing its unscaled
integers (exact, and a plain LongType sum in the partial aggregate) and
dividing once in double precision, so the result is the correctly rounded
double of the true mean, bit for bit the same in any IEEE engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_avg(c: Column | str, scale: int = 2) -> Column:
    if isinstance(c, str):                       # one JVM call for a column name
        x, k = "`" + c.replace("`", "``") + "`", 10 ** scale
        return F.expr(f"CASE WHEN count({x}) > 0 THEN CAST(sum(CAST({x} * {k} AS BIGINT)) "
                      f"AS DOUBLE) / CAST(count({x}) * {k} AS DOUBLE) END")
    c = _col(c)
    units = (c * F.lit(10 ** scale)).cast(T.LongType())
    n = F.count(c)
    return F.when(n > 0, F.sum(units).cast(T.DoubleType())
                  / (n * F.lit(10 ** scale)).cast(T.DoubleType()))


def ratio(num: Column, den: Column, scale: float = 1.0) -> Column:
    """scale * num / den as one double division; NULL when den is 0."""
    return F.when(den != 0, (num * F.lit(scale)).cast(T.DoubleType())
                  / den.cast(T.DoubleType()))
