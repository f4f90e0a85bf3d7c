"""Row-wise expressions.  Each returns a ``Column``; nothing here triggers a job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDINAL_PATTERN = "^ord_[0-9]+$"
MISSING_TOKEN = "__NA__"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_finite(c: str | Column) -> Column:
    value = _col(c).cast("double")
    return F.isnan(value) | (F.abs(value) == float("inf"))


def nan_to_null(c: str | Column) -> Column:
    return F.when(~F.isnan(_col(c)), _col(c))


def finite_or_zero(c: str | Column) -> Column:
    """Infinity, NaN and NULL all become zero."""
    value = _col(c).cast("double")
    return F.when(not_finite(value), 0.0).otherwise(F.coalesce(value, F.lit(0.0)))


def null_to_zero(c: str | Column) -> Column:
    return F.coalesce(_col(c).cast("double"), F.lit(0.0))


def sanitize_score(c: str | Column, low: float = 1e-6, high: float = 1 - 1e-6) -> Column:
    """NaN and NULL become one half, then the score is clipped into ``[low, high]``."""
    value = _col(c).cast("double")
    filled = F.when(value.isNull() | F.isnan(value), 0.5).otherwise(value)
    return F.greatest(F.least(filled, F.lit(high)), F.lit(low))


def ordinal_number(c: str | Column) -> Column:
    """``ord_12`` -> 12.0, anything unparsable -> NULL."""
    return F.substring(_col(c), 5, 2147483647).try_cast("double")


def category_text(c: str | Column) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(MISSING_TOKEN))


def missing_flag(c: str | Column) -> Column:
    return _col(c).isNull().cast("double")


def bin_index(c: str | Column, edges: Sequence[float]) -> Column:
    """Right-closed bin number with the lowest edge included; NULL falls into bin 0."""
    value = _col(c).cast("double")
    above = [F.when(value > F.lit(float(e)), 1).otherwise(0) for e in list(edges)[1:-1]]
    return reduce(lambda a, b: a + b, above, F.lit(0))


def width_edges(low: float, high: float, bins: int = 10) -> list[float]:
    step = (high - low) / bins
    return [low + i * step for i in range(bins)] + [high]


def mask_shape(c: str | Column) -> Column:
    """Letters become ``A`` and digits ``9``, so equal formats collapse to one text."""
    letters = F.regexp_replace(_col(c), "[A-Za-z]", "A")
    return F.regexp_replace(letters, "[0-9]", "9")


def hash_bucket(c: str | Column, buckets: int) -> Column:
    """Stable bucket number from the first 32 bits of the text's md5."""
    head = F.substring(F.md5(category_text(c)), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(buckets))


def row_mean(cols: Iterable[str]) -> Column:
    present = F.filter(F.array(*[_col(c).cast("double") for c in cols]), lambda x: x.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.size(present))


def row_std(cols: Iterable[str]) -> Column:
    """Sample standard deviation across columns, NULLs skipped, NULL below two values."""
    cols = list(cols)
    present = F.filter(F.array(*[_col(c).cast("double") for c in cols]), lambda x: x.isNotNull())
    mean = row_mean(cols)
    squares = F.aggregate(present, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.when(F.size(present) > 1, F.sqrt(squares / (F.size(present) - 1)))


def row_max(cols: Iterable[str]) -> Column:
    return F.greatest(*[_col(c).cast("double") for c in cols])


def row_min(cols: Iterable[str]) -> Column:
    return F.least(*[_col(c).cast("double") for c in cols])


def datetime_parts(c: str) -> dict[str, Column]:
    ts = F.col(c)
    return {
        f"{c}__year": F.year(ts),
        f"{c}__month": F.month(ts),
        f"{c}__day": F.dayofmonth(ts),
        f"{c}__dayofweek": F.weekday(ts),
        f"{c}__hour": F.hour(ts),
        f"{c}__quarter": F.quarter(ts),
        f"{c}__is_weekend": (F.weekday(ts) >= 5).cast("int"),
    }


def datetime_cycles(c: str) -> dict[str, Column]:
    """Sine and cosine of month, day and hour on their own circles."""
    ts = F.col(c)
    parts = {"month": (F.month(ts), 12), "day": (F.dayofmonth(ts), 31), "hour": (F.hour(ts), 24)}
    out: dict[str, Column] = {}
    for name, (value, period) in parts.items():
        angle = value * F.lit(2 * pi / period)
        out[f"{c}__{name}_sin"] = F.sin(angle)
        out[f"{c}__{name}_cos"] = F.cos(angle)
    return out
