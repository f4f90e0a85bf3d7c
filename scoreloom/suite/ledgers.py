"""Run ledger: every order is taken as one run."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.operators import ledger
from scoreloom.suite import fixtures as fx
from scoreloom.suite.registry import query

RUNS = """runs AS (SELECT o_orderkey AS id, o_orderdate AS ts, o_orderpriority AS model, o_orderstatus AS ensemble_type,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 500000 END AS cv_score,
  CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 510000 END AS public_score,
  'run_' || o_orderkey AS file, CAST(NULL AS VARCHAR) AS notes FROM orders)"""


def _runs(spark, sf):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"), F.col("o_orderpriority").alias("model"),
        status.alias("ensemble_type"), F.when(status != "P", price / 500000).alias("cv_score"),
        F.when(status == "F", price / 510000).alias("public_score"),
        F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")).alias("file"),
        F.lit(None).cast("string").alias("notes"),
    )


@query(
    "ledger_add",
    f"""WITH {RUNS} SELECT max(id) + 1 AS id, 'blend' AS model, CAST(NULL AS VARCHAR) AS ensemble_type, 0.81 AS cv_score,
        CAST(NULL AS DOUBLE) AS public_score, 'sub.csv' AS file, CAST(NULL AS VARCHAR) AS notes FROM runs""".replace(
        "0.81", "CAST(0.81 AS DOUBLE)"
    ),
)
def ledger_add_query(spark, sf):
    return ledger.add_run(_runs(spark, sf), model="blend", cv_score=0.81, file="sub.csv").drop("ts")


@query(
    "ledger_update",
    f"""WITH {RUNS}, late AS (SELECT id, row_number() OVER (ORDER BY id DESC) AS k FROM runs)
        SELECT runs.id, CASE k WHEN 1 THEN 0.9 WHEN 2 THEN 0.8 WHEN 3 THEN 0.7 ELSE public_score END AS public_score
        FROM runs JOIN late ON runs.id = late.id""",
)
def ledger_update_query(spark, sf):
    return ledger.update_scores(_runs(spark, sf), [0.9, 0.8, 0.7]).select("id", "public_score")


@query(
    "ledger_best",
    f"""WITH {RUNS} SELECT *, cv_score AS score, 'cv_score' AS score_type FROM
        (SELECT * REPLACE (CAST(NULL AS DOUBLE) AS public_score) FROM runs) WHERE cv_score IS NOT NULL
        ORDER BY cv_score DESC, id LIMIT 5""",
)
def ledger_best_query(spark, sf):
    """No public score yet: the CV score decides."""
    private = _runs(spark, sf).withColumn("public_score", F.lit(None).cast("double"))
    return ledger.best_runs(private, 5)


@query(
    "ledger_select",
    f"""WITH {RUNS} SELECT CAST(row_number() OVER (ORDER BY public_score DESC, id) AS INTEGER) AS rank, id AS submission_id,
        public_score AS score, 'public_score' AS score_type, model, ensemble_type, file FROM runs
        WHERE public_score IS NOT NULL ORDER BY public_score DESC, id LIMIT 2""",
)
def ledger_select_query(spark, sf):
    return ledger.select_final(_runs(spark, sf), 2)


@query(
    "ledger_quota",
    "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 5",
)
def ledger_quota_query(spark, sf):
    return ledger.over_quota(_runs(spark, sf), 5)


@query(
    "best_params",
    """WITH t AS (SELECT o_orderpriority AS model, '{"depth": ' || (o_custkey % 10) || '}' AS params,
         o_totalprice / 500000 AS score, o_orderkey AS trial FROM orders)
       SELECT model, score AS best_score, params AS best_params FROM
         (SELECT *, row_number() OVER (PARTITION BY model ORDER BY score DESC, trial) AS k FROM t) WHERE k = 1""",
)
def best_params_query(spark, sf):
    """Every order is one trial of its priority class."""
    depth = F.concat(F.lit('{"depth": '), (F.col("o_custkey") % 10).cast("string"), F.lit("}"))
    trials = fx.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("model"), depth.alias("params"), (F.col("o_totalprice") / 500000).alias("score"),
        F.col("o_orderkey").alias("trial"),
    )
    return ledger.best_params(trials)
