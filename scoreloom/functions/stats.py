"""Aggregate expressions that stay defined under ANSI arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_corr(a: Column, b: Column) -> Column:
    """Pairwise-complete Pearson correlation; NULL instead of an error on a constant side."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def safe_skewness(c: Column) -> Column:
    """Population skewness, 0 for two values or fewer."""
    return F.when(F.count(c) > 2, F.skewness(c)).otherwise(0.0)


def safe_kurtosis(c: Column) -> Column:
    """Excess kurtosis, 0 for three values or fewer."""
    return F.when(F.count(c) > 3, F.kurtosis(c)).otherwise(0.0)


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole.cast("double"))


def entropy_from_counts(n: Column) -> Column:
    """Natural-log entropy of a set of counts as one plain aggregate: ln N - sum(n ln n) / N."""
    total = F.sum(n).cast("double")
    weighted = F.sum(n.cast("double") * F.ln(n.cast("double")))
    return F.when(F.count(n) > 1, F.ln(total) - weighted / total).otherwise(0.0)
