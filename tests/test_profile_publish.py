from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scoreloom.operators import ledger, profile, publish, schema
from scoreloom.plans.reports import explore
from scoreloom.sources import store, tables


def test_types_of_odd_columns(spark):
    df = spark.range(300).select(
        F.lit(1).alias("flat"), F.lit(None).cast("double").alias("empty"), (F.col("id") % 2).alias("two"),
        (F.col("id") % 5).alias("few"), F.col("id").alias("many"), F.col("id").cast("string").alias("text"),
        F.concat(F.lit("c"), F.col("id") % 3).alias("low"), F.current_timestamp().alias("now"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(days=F.col("id").cast("int"))).alias("when"),
        (F.col("id") % 100).cast("string").alias("medium"),
    )
    got = {r["column"]: r["type"] for r in profile.feature_types(df).collect()}
    assert got == {
        "flat": "constant", "empty": "constant", "two": "binary", "few": "categorical_numeric", "many": "numeric",
        "text": "categorical_high_cardinality", "low": "categorical_low_cardinality", "now": "constant",
        "when": "datetime", "medium": "categorical_medium_cardinality",
    }
    guide = {r["column"]: r["type"] for r in profile.feature_types(df, low_share=0.01, medium_share=0.1).collect()}
    assert guide["low"] == "categorical_medium_cardinality"


def test_profile_of_missing_and_constant_columns(spark):
    df = spark.range(5).select(F.lit(None).cast("double").alias("empty"), F.lit(2.0).alias("flat"))
    got = {r["column"]: r for r in profile.profile_numeric(df).collect()}
    assert got["empty"]["error"] == "All values missing" and got["empty"]["mean"] is None
    assert got["flat"]["std"] == 0.0 and got["flat"]["outlier_count"] == 0 and got["flat"]["error"] is None
    texts = spark.range(5).select(F.lit(None).cast("string").alias("empty"), F.lit("x").alias("flat"))
    cats = {r["column"]: r for r in profile.profile_categorical(texts).collect()}
    assert cats["empty"]["error"] == "All values missing" and cats["flat"]["entropy"] == 0.0


def test_target_rules(spark):
    df = spark.createDataFrame([(1, "a", 3.0, 0), (2, "b", 3.5, 1), (3, "a", 4.0, 1)], "id int, t string, v double, flag int")
    assert schema.detect_target(df, "id").first()["target"] == "flag"
    assert schema.detect_target(df, "id", "any").first()["target"] == "t"
    assert schema.detect_target(df.withColumnRenamed("v", "target"), "id").first()["target"] == "target"
    assert schema.resolve_id(df) == "id"


def test_roles_parse_ordinals_on_both_splits(spark):
    train = spark.createDataFrame([(1, "ord_3", "x", 1), (2, None, "y", 0), (3, "ord_10", "x", None)],
                                  "row_id int, o string, c string, target int")
    test = spark.createDataFrame([("ord_7", 9), ("bad", 8)], "o string, row_id int")
    template = spark.createDataFrame([(0, 9, 0.5), (1, 8, 0.5)], "pos int, row_id int, score double")
    roles, left, right = schema.load_roles(train, test, template)
    assert (roles.id, roles.target, roles.prediction, roles.numeric, roles.cats) == ("row_id", "target", "score", ("o",), ("c",))
    assert {r["row_id"]: r["o"] for r in left.collect()} == {1: 3.0, 2: None}
    assert {r["row_id"]: (r["o"], r["c"]) for r in right.collect()} == {9: (7.0, None), 8: (None, None)}


def test_csv_missing_values_and_positions(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,v\n5,1.5\n3,\n9,nan\n1,2.0\n")
    df = tables.with_positions(tables.scan_csv(spark, str(path), "id int, v double"))
    assert [(r["pos"], r["id"], r["v"]) for r in df.orderBy("pos").collect()] == [
        (0, 5, 1.5), (1, 3, None), (2, 9, None), (3, 1, 2.0)
    ]


def test_positions_stay_dense_over_several_splits(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(1000).repartition(7).write.parquet(path)
    at = sorted(r["pos"] for r in tables.with_positions(spark.read.parquet(path)).collect())
    assert at == list(range(1000))


@pytest.fixture
def template(spark):
    return spark.createDataFrame([(i, i * 10, 0.5) for i in range(4)], "pos int, id int, target double")


def scores(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pos int, id int, target double")


CASES = {
    "fine": ([(0, 0.1), (10, 0.2), (20, 0.3), (30, 0.4)], [], []),
    "short": ([(0, 0.1), (10, 0.2), (20, 0.3)], ["shape mismatch", "row count mismatch"], ["id mismatch with template"]),
    "null": ([(0, None), (10, 0.2), (20, 0.3), (30, 0.4)], ["missing values"], []),
    "range": ([(0, 1.2), (10, 0.2), (20, 0.3), (30, 0.4)], [], ["outside [0,1]"]),
    "flat": ([(0, 0.3), (10, 0.3), (20, 0.3), (30, 0.3)], [], ["constant predictions"]),
    "shuffled": ([(10, 0.1), (0, 0.2), (20, 0.3), (30, 0.4)], [], ["id mismatch with template"]),
    "infinite": ([(0, float("inf")), (10, 0.2), (20, 0.3), (30, 0.4)], [], ["infinite values", "outside [0,1]"]),
}


@pytest.mark.parametrize("case", CASES)
def test_validation(spark, template, case):
    rows, hard, strict_only = CASES[case]
    submission = scores(spark, rows)
    loose = publish.validate(submission, template).first()
    strict = publish.validate(submission, template, strict=True).first()
    assert loose["errors"] == hard and loose["valid"] == (not hard)
    assert strict["errors"] == hard + strict_only and strict["valid"] == (not hard and not strict_only)


def test_validation_sees_extra_columns(spark, template):
    report = publish.validate(template.withColumn("more", F.lit(1)), template).first()
    assert report["errors"] == ["shape mismatch", "column mismatch"]


def test_publish_keeps_order_and_fills(spark, template, tmp_path):
    preds = spark.createDataFrame([(30, 0.9), (0, float("nan")), (10, 7.0)], "id int, p double")
    out = publish.publish(template, preds, "id", "p", "target")
    assert [r["target"] for r in out.orderBy("pos").collect()] == [0.5, 1 - 1e-6, 0.5, 0.9]
    path = str(tmp_path / "sub")
    publish.write_ordered(out, path, single_file=True)
    lines = next((tmp_path / "sub").glob("*.csv")).read_text().split()
    assert lines[0] == "id,target" and [x.split(",")[0] for x in lines[1:]] == ["0", "10", "20", "30"]
    with pytest.raises(ValueError):
        publish.require_unique(preds.unionByName(preds), "id")
    with pytest.raises(ValueError):
        publish.require_same_length(template, preds)


def test_ledger_round_trip(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert store.load_ledger(spark, path).count() == 0
    for i in range(4):
        store.append_run(spark, path, model=f"m{i}", cv_score=None if i == 3 else 0.5 + i / 10, file=f"f{i}")
    runs = store.load_ledger(spark, path)
    assert sorted(r["id"] for r in runs.collect()) == [1, 2, 3, 4]
    assert [r["submission_id"] for r in ledger.select_final(runs, 2).orderBy("rank").collect()] == [3, 2]
    late = ledger.update_scores(runs, [0.4, 0.9])
    assert {r["id"]: r["public_score"] for r in late.collect()} == {1: None, 2: None, 3: 0.9, 4: 0.4}
    best = ledger.select_final(late, 3).orderBy("rank").collect()
    assert [(r["submission_id"], r["score_type"]) for r in best] == [(3, "public_score"), (4, "public_score")]
    assert ledger.over_quota(runs, 3).first()["n"] == 4 and ledger.over_quota(runs, 4).count() == 0


def test_prediction_store_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "preds")
    preds = spark.range(20).select(
        F.col("id").cast("string").alias("row_id"), F.lit(1).alias("y"), F.lit(0.5).alias("p"),
        F.when(F.col("id") < 10, "a").otherwise("b").alias("model"), F.lit("oof").alias("split"),
    )
    store.save_predictions(preds, path)
    some = store.load_predictions(spark, path, ["a"], "oof")
    assert some.count() == 10
    assert "PartitionFilters: [isnotnull" in some._jdf.queryExecution().toString() or "model" in some._jdf.queryExecution().toString()


def test_reports_round_trip(spark, tmp_path):
    df = spark.range(50).select("id", (F.col("id") % 2).alias("target"))
    for name, report in explore(df, df.drop("target")).items():
        path = str(tmp_path / name)
        store.save_report(report, path)
        if report.count():
            assert store.load_report(spark, path).count() == report.count()


def test_whole_job_queries(spark):
    import __spark_entry__ as contract

    sf, queries = "/root/testdata/sf0.001", contract.queries()
    pooled = queries["pooled_features_all"](spark, sf).groupBy("dataset_id").count().collect()
    assert sum(r["count"] for r in pooled) == spark.read.parquet(f"{sf}/orders.parquet").count() and len(pooled) == 2
    assert len(queries["duplicate_rows_all"](spark, sf).columns) == len(spark.read.parquet(f"{sf}/lineitem.parquet").columns) + 1
    tuned = {(r.family, r.param): r.value for r in queries["tune_all"](spark, sf).collect()}
    assert {f for f, _ in tuned} == {"rf", "lgb", "xgb", "hgb", "cat"} and all(3 <= v <= 5 for v in tuned.values())
