"""Ranking quality of scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.operators.ordering import in_ranges
from scoreloom.session import one_row


def auc_by(
    df: DataFrame, score: str, label: str, groups: Sequence[str] = (), out: str = "auc", ranges: int | None = None
) -> DataFrame:
    """Exact ROC AUC per group, tied scores counting one half; NULL when a class is absent.

    Scores collapse to (positives, negatives) per distinct value before the shuffle, so a score
    shared by a third of all rows is one row.  Ranges of ordered scores then each yield three
    numbers, and only those cross to the final step.
    """
    groups = list(groups)
    usable = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    return _auc_from_counts(
        usable.groupBy(*groups, score).agg(
            F.sum(F.col(label).cast("bigint")).alias("__pos"), F.count("*").alias("__n")
        ),
        score,
        groups,
        out,
        ranges,
    )


def auc_by_weighted(
    counts: DataFrame, score: str, positives: str, rows: str, groups: Sequence[str] = (), out: str = "auc",
    ranges: int | None = None,
) -> DataFrame:
    """Same as :func:`auc_by` for rows that already carry ``positives`` and ``rows`` counts."""
    groups = list(groups)
    return _auc_from_counts(
        counts.where(F.col(score).isNotNull())
        .groupBy(*groups, score)
        .agg(F.sum(positives).alias("__pos"), F.sum(rows).alias("__n")),
        score,
        groups,
        out,
        ranges,
    )


def _auc_from_counts(counts: DataFrame, score: str, groups: list[str], out: str, ranges: int | None) -> DataFrame:
    ordered = in_ranges(counts, [*groups, score], ranges)
    pos = F.col("__pos").cast("double")
    neg = (F.col("__n") - F.col("__pos")).cast("double")
    before_here = (
        Window.partitionBy(*groups, "__range").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = ordered.select(
        *groups, "__range", pos.alias("p"), neg.alias("q"),
        F.coalesce(F.sum(neg).over(before_here), F.lit(0.0)).alias("below"),
    )
    blocks = local.groupBy(*groups, "__range").agg(
        F.sum("p").alias("p"),
        F.sum("q").alias("q"),
        F.sum(F.col("p") * (F.col("below") + F.col("q") / 2)).alias("wins"),
    )
    # one row per score range from here on
    earlier = (
        Window.partitionBy(*(groups or [F.lit(0)])).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = blocks.withColumn("earlier", F.coalesce(F.sum("q").over(earlier), F.lit(0.0)))
    result = F.try_divide(F.sum(F.col("wins") + F.col("p") * F.col("earlier")), F.sum("p") * F.sum("q"))
    return carried.groupBy(*groups).agg(result.alias(out))


def column_auc(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """AUC of every numeric column used directly as a score: (column, auc)."""
    long = df.select(label, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [label], list(columns), "column", "score"
    )
    return auc_by(long, "score", label, ["column"])


def cv_mean_auc(df: DataFrame, score: str, label: str, fold: str, groups: Sequence[str] = ()) -> DataFrame:
    """Mean of the per-fold AUCs, which is not the pooled out-of-fold AUC."""
    per_fold = auc_by(df, score, label, [*groups, fold])
    return per_fold.groupBy(*groups).agg(F.avg("auc").alias("cv_auc"), F.count("auc").alias("folds"))


def score_stats(df: DataFrame, score: str, groups: Sequence[str] = ()) -> DataFrame:
    distinct = df.groupBy(*groups, score).agg(F.count("*").alias("n"))
    rows = F.when(F.col(score).isNotNull(), F.col("n"))
    unique = distinct.groupBy(*groups).agg(
        F.count(score).alias("n_unique"), F.coalesce(F.sum(rows), F.lit(0)).alias("n_scored")
    )
    moments = df.groupBy(*groups).agg(
        F.avg(score).alias("mean"),
        F.stddev_samp(score).alias("std"),
        F.min(score).alias("min"),
        F.max(score).alias("max"),
    )
    if groups:
        return moments.join(unique, list(groups))
    counts = one_row(unique)
    return moments.select("*", *[counts.getField(f).alias(f) for f in ("n_unique", "n_scored")])
