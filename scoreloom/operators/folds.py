"""Deterministic, exactly balanced fold numbers from a hash of the row key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Leading md5 digits used as bucket: 4,096 buckets.  Positions do not depend on it; take 4 from about 10^11 rows on.
DIGITS = 3


def hash_positions(
    df: DataFrame, id_col: str, seed: int, label: str | None = None, digits: int | None = None
) -> DataFrame:
    """Add ``__at`` (1-based position in hash order) and ``__size`` per class.

    The bucket is a prefix of the hash that defines the order, so bucket order agrees with row
    order and each window sees one bucket.  The offsets are at most classes x 16**digits rows.
    """
    digits = digits or DIGITS
    groups = [label] if label else []
    stamp = F.md5(F.concat_ws("-", F.col(id_col).cast("string"), F.lit(str(seed))))
    keyed = df.withColumn("__bucket", F.conv(F.substring(stamp, 1, digits), 16, 10).cast("int"))
    counts = keyed.groupBy(*groups, "__bucket").agg(F.count("*").alias("__n"))
    whole = Window.partitionBy(*(groups or [F.lit(0)]))
    earlier = whole.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *groups,
        "__bucket",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__n").over(whole).alias("__size"),
    )
    inside = Window.partitionBy(*groups, "__bucket").orderBy("__key", id_col)
    return (
        # the hash is taken again behind the shuffle, which then carries no 32 characters of it per row
        keyed.repartition(*groups, "__bucket").withColumn("__key", stamp).withColumn("__row", F.row_number().over(inside))
        .join(F.broadcast(offsets), [*groups, "__bucket"])
        .withColumn("__at", F.col("__before") + F.col("__row"))
        .drop("__key", "__bucket", "__before", "__row")
        .select(*df.columns, "__at", "__size")
    )


def assign_folds(
    df: DataFrame, id_col: str, k: int = 5, seed: int = 42, label: str | None = None, out: str = "fold",
    digits: int | None = None,
) -> DataFrame:
    """Fold numbers 0..k-1; every class is spread evenly when ``label`` is given."""
    placed = hash_positions(df, id_col, seed, label, digits)
    fold = F.pmod(F.col("__at") - 1, F.lit(k)).cast("int")
    return placed.withColumn(out, fold).drop("__at", "__size")


def safe_folds(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Stratified folds, or plain folds when no class has ``k`` members."""
    largest = df.groupBy(label).count().agg(F.max("count")).first()[0] or 0
    return assign_folds(df, id_col, k, seed, label if largest >= k else None, out)


def assign_holdout(
    df: DataFrame, id_col: str, share: float = 0.2, seed: int = 42, label: str | None = None,
    out: str = "is_valid", digits: int | None = None,
) -> DataFrame:
    """Mark ``ceil(share * class size)`` rows of each class as validation rows."""
    placed = hash_positions(df, id_col, seed, label, digits)
    chosen = F.col("__at") <= F.ceil(F.col("__size") * F.lit(share))
    return placed.withColumn(out, chosen.cast("int")).drop("__at", "__size")
