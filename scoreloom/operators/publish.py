"""Building, validating and writing prediction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.scalar import not_finite, sanitize_score
from scoreloom.operators.metrics import score_stats
from scoreloom.session import one_row


def require_unique(df: DataFrame, key: str) -> None:
    """A left join on a repeated key would multiply rows: fail first."""
    repeated = df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1).limit(1).collect()
    if repeated:
        raise ValueError(f"{key} repeats, for example {repeated[0][key]!r}")


def publish(template: DataFrame, predictions: DataFrame, id_col: str, score: str, out: str) -> DataFrame:
    """Template rows in template order with sanitised scores; ids without a score get one half."""
    scored = predictions.select(id_col, sanitize_score(score).alias("__score"))
    joined = template.select("pos", id_col).join(scored, id_col, "left")
    return joined.select("pos", id_col, F.coalesce("__score", F.lit(0.5)).alias(out))


def require_same_length(template: DataFrame, predictions: DataFrame) -> None:
    wanted, got = template.count(), predictions.count()
    if wanted != got:
        raise ValueError(f"{got} predictions for {wanted} template rows")


def write_ordered(published: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV in ``pos`` order: a range-partitioned sort, one file only when demanded."""
    ordered = published.orderBy("pos").drop("pos")
    (ordered.coalesce(1) if single_file else ordered).write.mode("overwrite").option("header", True).csv(path)


def id_mismatches(submission: DataFrame, template: DataFrame, id_col: str) -> DataFrame:
    """(n_mismatch): positions whose ids differ or that exist on one side only."""
    a = submission.select("pos", F.col(id_col).alias("__a"), F.lit(1).alias("__in_a"))
    b = template.select("pos", F.col(id_col).alias("__b"), F.lit(1).alias("__in_b"))
    same = F.col("__in_a").isNotNull() & F.col("__in_b").isNotNull() & F.col("__a").eqNullSafe(F.col("__b"))
    return a.join(b, "pos", "full").agg(F.count_if(~same).alias("n_mismatch"))


def validate(
    submission: DataFrame, template: DataFrame, strict: bool = False, test: DataFrame | None = None
) -> DataFrame:
    """One-row report (valid, errors, warnings, stats).

    Shape, columns, row count and missing values are errors; range and constant scores are
    warnings, or errors together with id order and infinities when ``strict``.  ``pos`` is
    bookkeeping and not part of the compared columns.
    """
    sub_cols = [c for c in submission.columns if c != "pos"]
    tpl_cols = [c for c in template.columns if c != "pos"]
    id_col = tpl_cols[0]
    score = sub_cols[1] if len(sub_cols) > 1 else sub_cols[0]
    p = F.col(f"`{score}`").cast("double")
    any_null = F.lit(False)
    for c in sub_cols:
        any_null = any_null | F.col(f"`{c}`").isNull()
    scores = submission.select(p.alias("p"))
    stats = one_row(score_stats(scores, "p").select("mean", "std", "min", "max", "n_unique"))
    facts = submission.agg(
        F.count("*").alias("n_sub"),
        F.count_if(any_null | F.isnan(p)).alias("n_null"),
        F.count_if(not_finite(p)).alias("n_inf"),
    ).select(
        "*",
        template.agg(F.count("*")).scalar().alias("n_tpl"),
        *[stats.getField(f).alias(f) for f in ("mean", "std", "min", "max", "n_unique")],
    )
    if strict:
        facts = facts.withColumn("n_mismatch", id_mismatches(submission, template, id_col).scalar())
        if test is not None:
            facts = facts.withColumn("n_test_mismatch", id_mismatches(submission, test, id_col).scalar())
    same_columns = F.lit(sub_cols == tpl_cols)
    same_width = F.lit(len(sub_cols) == len(tpl_cols))
    shape = ~((F.col("n_sub") == F.col("n_tpl")) & same_width)
    errors = [
        F.when(shape, F.lit("shape mismatch")),
        F.when(~same_columns, F.lit("column mismatch")),
        F.when(F.col("n_sub") != F.col("n_tpl"), F.lit("row count mismatch")),
        F.when(F.col("n_null") > 0, F.lit("missing values")),
    ]
    soft = [
        F.when((F.col("min") < 0) | (F.col("max") > 1), F.lit("outside [0,1]")),
        F.when(F.col("n_unique") == 1, F.lit("constant predictions")),
    ]
    if strict:
        errors += [
            F.when(F.col("n_inf") > 0, F.lit("infinite values")),
            F.when(F.col("n_mismatch") > 0, F.lit("id mismatch with template")),
            *([F.when(F.col("n_test_mismatch") > 0, F.lit("id mismatch with test"))] if test is not None else []),
            *soft,
        ]
        soft = []
    warnings = F.array_compact(F.array(*soft)) if soft else F.array().cast("array<string>")
    return facts.select(F.array_compact(F.array(*errors)).alias("errors"), warnings.alias("warnings"),
                        F.struct("mean", "std", "min", "max", "n_unique").alias("stats")).select(
        (F.size("errors") == 0).alias("valid"), "errors", "warnings", "stats"
    )
