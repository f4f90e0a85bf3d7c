"""A table of runs: append, late scores, best-N selection, daily quota."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEDGER_SCHEMA = (
    "id bigint, ts timestamp, model string, ensemble_type string, cv_score double, "
    "public_score double, file string, notes string"
)


def add_run(ledger: DataFrame, **run: object) -> DataFrame:
    """The new row alone, numbered after the last run and stamped now; append it to the ledger table."""
    last = ledger.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last"))
    fields = {f.name: f.dataType for f in ledger.schema.fields}
    values = {
        name: F.lit(run.get(name)).cast(kind) for name, kind in fields.items() if name not in ("id", "ts")
    }
    values["id"] = (F.col("last") + 1).cast(fields["id"])
    values["ts"] = F.current_timestamp().cast(fields["ts"])
    return last.select(*[values[name].alias(name) for name in fields])


def newest(ledger: DataFrame, k: int) -> DataFrame:
    """The ``k`` latest runs numbered from 0 (newest first); only ``k`` rows reach the window."""
    latest = ledger.orderBy(F.desc("id")).limit(k).select("id")
    return latest.select("id", (F.row_number().over(Window.orderBy(F.desc("id"))) - 1).alias("age"))


def update_scores(ledger: DataFrame, scores: Sequence[float]) -> DataFrame:
    """Late public scores, first score to the newest run.  ``scores`` is a short argument list."""
    scores = [float(s) for s in scores]
    if not scores:
        return ledger
    by_age = F.array(*[F.lit(s) for s in scores])
    late = newest(ledger, len(scores)).select("id", F.get(by_age, F.col("age").cast("int")).alias("__late"))
    return (
        ledger.join(F.broadcast(late), "id", "left")
        .withColumn("public_score", F.coalesce("__late", "public_score"))
        .drop("__late")
        .select(*ledger.columns)
    )


def best_runs(ledger: DataFrame, n: int = 2) -> DataFrame:
    """Top ``n`` by public score if any run has one, else by CV score; missing scores never win."""
    has_public = ledger.agg(F.count("public_score") > 0).scalar()
    scored = ledger.withColumns(
        {
            "score": F.when(has_public, F.col("public_score")).otherwise(F.col("cv_score")),
            "score_type": F.when(has_public, F.lit("public_score")).otherwise(F.lit("cv_score")),
        }
    )
    return scored.where(F.col("score").isNotNull()).orderBy(F.desc("score"), "id").limit(n)


def select_final(ledger: DataFrame, n: int = 2) -> DataFrame:
    order = Window.orderBy(F.desc("score"), "id")
    return best_runs(ledger, n).select(
        F.row_number().over(order).alias("rank"),
        F.col("id").alias("submission_id"),
        "score",
        "score_type",
        "model",
        "ensemble_type",
        "file",
    )


def over_quota(ledger: DataFrame, per_day: int = 5) -> DataFrame:
    """(day, n) of days with more than ``per_day`` runs."""
    return (
        ledger.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n")).where(F.col("n") > per_day)
    )


def best_params(trials: DataFrame, params: str = "params", score: str = "score") -> DataFrame:
    """Best earlier parameters per model, the earliest trial on a tie."""
    best = F.max_by(F.col(params), F.struct(F.col(score), F.col("trial") * -1))
    return trials.where(F.col(score).isNotNull()).groupBy("model").agg(
        F.max(score).alias("best_score"), best.alias("best_params")
    )
