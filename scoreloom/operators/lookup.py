"""Joining a fitted per-key table back onto rows, safe under skew.

A fitted table is materialised first, so its size is known.  Below the session's broadcast
threshold the rows are never shuffled.  Above it, the few keys that hold more than one in
``HOT_SHARE`` rows (fewer than ``HOT_SHARE`` of them can exist) are broadcast, and their rows are
spread over salts so the shuffle join of the remaining keys stays even.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.session import broadcast_limit, estimated_bytes, materialize

HOT_SHARE = 1000
SALTS = 1024


def lookup(
    df: DataFrame, table: DataFrame, on: Sequence[str], rows: str, size: int | None = None, again: bool = False
) -> DataFrame:
    """Left join ``table`` (one row per key, ``rows`` = how many rows hold that key).

    ``size`` is the table's known size in bytes when Catalyst's estimate of its plan would be loose.  With ``again`` the
    rows may be read twice, as is cheap for a scan: then rows of hot or missing keys are not shuffled at all.
    """
    on = list(on)
    size = estimated_bytes(table) if size is None else size
    if size <= broadcast_limit(df.sparkSession):
        return df.join(F.broadcast(table.drop(rows)), on, "left")
    values = [c for c in table.columns if c not in on and c != rows]
    table = materialize(table, "lookup")
    total = table.agg(F.sum(rows)).first()[0] or 0
    is_hot = F.col(rows) * HOT_SHARE > F.lit(total)
    hot = table.where(is_hot).select(*on, *[F.col(v).alias(f"__hot_{v}") for v in values], F.lit(True).alias("__hot"))
    cold = table.where(~is_hot).select(*on, F.lit(0).alias("__salt"), *[F.col(v).alias(f"__cold_{v}") for v in values])
    unmatched = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    if again:
        marked = df.join(F.broadcast(hot), on, "left")
        own, known = [F.col(f"`{c}`") for c in df.columns], F.coalesce(F.col("__hot"), F.lit(False)) | unmatched
        settled = marked.where(known).select(*own, *[F.col(f"__hot_{v}").alias(v) for v in values])
        rest = marked.where(~known).select(*own).join(cold.drop("__salt"), on, "left")
        return settled.unionByName(rest.select(*own, *[F.col(f"__cold_{v}").alias(v) for v in values]))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SALTS)).cast("int") + 1
    marked = df.join(F.broadcast(hot), on, "left").withColumn(
        "__salt", F.when(F.coalesce(F.col("__hot"), F.lit(False)) | unmatched, spread).otherwise(F.lit(0))
    )
    joined = marked.join(cold, [*on, "__salt"], "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.coalesce(F.col(f"__hot_{v}"), F.col(f"__cold_{v}")).alias(v) for v in values],
    )
