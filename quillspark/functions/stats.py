"""Small statistics as columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(a: Column, b: Column) -> Column:
    """Null where the divisor is null or zero."""
    return F.try_divide(a, F.nullif(b, F.lit(0.0)))


def percent(a: Column, b: Column, digits: int = 2) -> Column:
    """100 a / b, 0 where b is 0."""
    return F.round(F.coalesce(safe_ratio(a.cast("double"), b.cast("double")), F.lit(0.0)) * 100, digits)


def null0(c: Column) -> Column:
    """The family of measures that takes null for 0."""
    return F.coalesce(c, F.lit(0.0))


def row_sum(names: Iterable[str]) -> Column:
    return reduce(lambda a, b: a + b, [null0(F.col(n)) for n in names])


def row_positive(names: Iterable[str], floor: float = 0.0) -> Column:
    return reduce(lambda a, b: a + b, [(null0(F.col(n)) > floor).cast("long") for n in names])


def rate(c: Column, digits: int = 2) -> Column:
    """The share of rows for which `c` holds, in percent."""
    return F.round(F.avg(F.when(c, 1.0).otherwise(0.0)) * 100, digits)


def r6(c: Column) -> Column:
    return F.round(c, 6)


def axis_maximum(c: Column) -> Column:
    """The smallest of 1, 2, 2.5, 5, 10 times a power of ten that is `c` or more; 1 where c is not positive."""
    power = F.pow(F.lit(10.0), F.floor(F.log10(c)))
    x = c / power
    step = F.when(x <= 1, 1.0).when(x <= 2, 2.0).when(x <= 2.5, 2.5).when(x <= 5, 5.0).otherwise(10.0)
    return F.when(c > 0, step * power).otherwise(F.lit(1.0))


def mean(name: str) -> Column:
    """The mean from a sum rounded to 6 digits: it doesn't depend on the order in which doubles were added."""
    return F.try_divide(F.round(F.sum(name), 6), F.count(name))
