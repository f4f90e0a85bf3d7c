"""Bounded, repeatable samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOW = 20


def share(per_label: int, n: int) -> int:
    """Largest of 2^63 hash places that is kept, so that ``per_label`` of ``n`` rows are expected at any size."""
    return min(1 << 63, (per_label << 63) // n) - 1


def bounded_sample(rows: DataFrame, label: Column, key: Column, per_label: int, seed: int = 0) -> DataFrame:
    """About ``per_label`` rows of each label, all where there are fewer; chosen by a hash of ``key``.

    The count per label covers all rows.  A label is a short code or grade, so there are few; the share kept of each is
    passed as a literal map.
    """
    labelled = rows.withColumn("_label", label.cast("string")).filter("_label is not null")
    counts = {r["_label"]: r["count"] for r in labelled.groupBy("_label").count().collect()}
    if not counts:
        return rows.limit(0)
    shares = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, share(per_label, n))))
    hashed = F.xxhash64(key, F.lit(seed))
    # The low bits come first and the others split their steps.
    low = F.shiftleft(hashed.bitwiseAND(F.lit((1 << _LOW) - 1)), 63 - _LOW)
    spot = low.bitwiseOR(F.shiftrightunsigned(hashed, _LOW).bitwiseAND(F.lit((1 << (63 - _LOW)) - 1)))
    return labelled.filter(spot <= shares[F.col("_label")]).drop("_label")
