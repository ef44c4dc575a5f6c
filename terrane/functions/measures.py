"""Aggregate measures, each an aggregate Column with a fixed output type.

Sums and averages are computed over decimals so results do not depend on the
summation order (partitioning, AQE coalescing, engine): ``exact_avg`` sums an
exact decimal, then divides once in double precision.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .scalars import ColumnOrName, col


def _exact(c: ColumnOrName, scale: int | None) -> Column:
    x = col(c)
    return x if scale is None else x.cast(DecimalType(28, scale))


def rows() -> Column:
    """``COUNT(*)`` as bigint."""
    return F.count(F.lit(1))


def exact_sum(c: ColumnOrName, scale: int | None = None) -> Column:
    """Exact SUM; ``scale`` casts a double measure to decimal first."""
    return F.sum(_exact(c, scale))


def exact_avg(c: ColumnOrName, scale: int | None = None) -> Column:
    """AVG as ``sum(exact) / count`` in double; NULLs skipped."""
    x = _exact(c, scale)
    return F.sum(x).cast("double") / F.count(x)


def avg_ratio(num: ColumnOrName, den: ColumnOrName, scale: int = 6) -> Column:
    """``AVG(num / NULLIF(den, 0))``, each ratio kept exactly to ``scale`` decimals."""
    from .scalars import safe_ratio
    return exact_avg(safe_ratio(num, den), scale)


def median(c: ColumnOrName) -> Column:
    """Exact interpolated median in double precision."""
    return F.median(col(c).cast("double"))


def count_if(pred: Column) -> Column:
    """``COUNT(CASE WHEN pred THEN 1 END)`` as bigint."""
    return F.count(F.when(pred, F.lit(1)))


def count_distinct(c: ColumnOrName) -> Column:
    return F.count_distinct(col(c))


def flag_sum(c: ColumnOrName) -> Column:
    """Sum of a 0/1 flag as bigint."""
    return F.sum(col(c).cast("bigint"))
