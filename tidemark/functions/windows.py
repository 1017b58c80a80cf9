"""Window and null rules that all feature operators share.

NULL is the only missing value: NaN becomes NULL at the scan. Division by zero gives NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

Name = str | Column


def col(c: Name) -> Column:
    return F.col(c) if isinstance(c, str) else c


def by(*keys: str, order: str = "date") -> WindowSpec:
    """Rows of a series in time order."""
    return Window.partitionBy(*keys).orderBy(order)


def lag(c: Name, w: WindowSpec, k: int = 1) -> Column:
    return F.lag(col(c), k).over(w)


def roll(function, c: Name, w: WindowSpec, n: int, least: int | None = None) -> Column:
    """function over the last n rows, NULL until `least` (n if not given) values are known."""
    frame = w.rowsBetween(1 - n, 0)
    return F.when(F.count(col(c)).over(frame) >= (n if least is None else least), function(col(c)).over(frame))


def ffill(c: Name, w: WindowSpec) -> Column:
    return F.last(col(c), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def bfill(c: Name, *keys: str, order: str = "date") -> Column:
    """The next known value: a running frame over the reversed order, which is linear in the rows."""
    return F.last(col(c), ignorenulls=True).over(Window.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0))


def change(new: Name, old: Name) -> Column:
    """new / old - 1."""
    return F.try_divide(col(new), col(old)) - 1


def ratio(a: Name, b: Name) -> Column:
    return F.try_divide(col(a), col(b))


def known(*cs: Name) -> Column:
    return reduce(Column.__and__, [col(c).isNotNull() for c in cs])


def most(*cs: Name) -> Column:
    """greatest, NULL if any input is."""
    return F.when(known(*cs), F.greatest(*[col(c) for c in cs]))


def least(*cs: Name) -> Column:
    """least, NULL if any input is."""
    return F.when(known(*cs), F.least(*[col(c) for c in cs]))


def clip(c: Name, low: float | None = None, high: float | None = None) -> Column:
    out = col(c)
    if low is not None:
        out = F.when(out < low, F.lit(low)).otherwise(out)
    return F.when(out > high, F.lit(high)).otherwise(out) if high is not None else out


def flag(condition: Column) -> Column:
    """1 where true, else 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def mean_of(*cs: Name) -> Column:
    """Mean of the known values of a row."""
    total = reduce(Column.__add__, [F.coalesce(col(c), F.lit(0.0)) for c in cs])
    return F.try_divide(total, reduce(Column.__add__, [col(c).isNotNull().cast("int") for c in cs]))


def zscore(c: Name, w: WindowSpec, n: int, least_rows: int = 10) -> Column:
    """Distance from the window's mean in sample deviations, of which 1e-8 at least count; 0 in a constant window, where the rest is rounding."""
    deviation = roll(F.stddev_samp, c, w, n, least_rows)
    still = roll(F.min, c, w, n, least_rows) == roll(F.max, c, w, n, least_rows)
    return F.when(still & col(c).isNotNull(), 0.0).otherwise((col(c) - roll(F.avg, c, w, n, least_rows)) / clip(deviation, 1e-8))


def rank_pct(c: Name, *keys: str) -> Column:
    """Share of the group's known values up to this one; ties share their mean rank; NULL stays NULL."""
    c = col(c)
    order = Window.partitionBy(*keys).orderBy(c.asc_nulls_last())
    ties = F.count(c).over(Window.partitionBy(*keys, c))
    return F.when(c.isNotNull(), (F.rank().over(order) + (ties - 1) / 2) / F.count(c).over(Window.partitionBy(*keys)))
