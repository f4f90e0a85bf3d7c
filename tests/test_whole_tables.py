"""Nothing is cut, doubled or misplaced: wide tables, wide text columns, row positions over several files, restarts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from scoreloom.operators import ensemble, features, models, profile
from scoreloom.plans import scoring
from scoreloom.sources import store, tables


def test_positions_follow_files_not_split_sizes(spark, tmp_path):
    sizes, first = (10, 400_000, 1_000), 0
    (tmp_path / "in").mkdir()
    for part, n in enumerate(sizes):
        (tmp_path / "in" / f"part-{part}.csv").write_text("id\n" + "".join(f"{first + i}\n" for i in range(n)))
        first += n
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        df = tables.with_positions(tables.scan_csv(spark, str(tmp_path / "in"), "id long"))
        assert df.columns == ["id", "pos"]
        assert df.where("pos = id").count() == first == df.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_every_column_is_transformed(spark):
    df = spark.range(20).select("id", *[(F.rand(i) + i).alias(f"c{i}") for i in range(60)])
    names = [f"c{i}" for i in range(60)]
    stats = features.column_stats(df, names)
    for make, suffix in ((features.log_features, "__log"), (features.sqrt_features, "__sqrt"), (features.zscore, "__zscore")):
        assert [c for c in make(df, stats).columns if c.endswith(suffix)] == [n + suffix for n in names]
    ranked = features.rank_features(df, names, key="id")
    assert sum(c.endswith("__rank") for c in ranked.columns) == 60


def test_baseline_keeps_wide_text_columns(spark):
    rows = spark.range(900).select(
        "id", (F.col("id") % 7).cast("double").alias("x"), F.concat(F.lit("w"), F.col("id") % 300).alias("wide"),
        F.concat(F.lit("n"), F.col("id") % 3).alias("narrow"), (F.col("id") % 300 < 150).cast("int").alias("target"),
    ).cache()
    test = rows.drop("target").where("id < 50")
    template = test.select(F.col("id").alias("pos"), "id", F.lit(0.0).alias("target"))
    done = scoring.baseline(rows, test, template, {"iterations": 5}, seeds=1)
    assert done.notes == {"indexed": ("narrow",), "encoded": ("wide",)}
    scored = done.published.join(rows.select("id", F.col("target").alias("y")), "id")
    auc = scored.agg(F.avg(F.when(F.col("y") == 1, F.col("target"))) - F.avg(F.when(F.col("y") == 0, F.col("target")))).first()[0]
    assert auc is None or auc > 0.3


def test_both_zeros_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (None,)], "v double")
    assert profile.n_unique(df, ["v"]).first()["n_unique"] == 2


def test_saving_again_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "preds")
    one = spark.createDataFrame([("a", "oof", 1, 1, 0.5), ("a", "test", 2, None, 0.4)], "model string, split string, row_id long, y int, p double")
    store.save_predictions(one, path)
    store.save_predictions(one.withColumn("model", F.lit("b")), path)
    store.save_predictions(one, path)
    assert store.load_predictions(spark, path).groupBy("model").count().collect() and store.load_predictions(spark, path).count() == 4


def test_blends_do_not_round(spark):
    rows = [("a", i, 1, 0.1 + i * 1e-14) for i in range(5)] + [("b", i, 1, 0.3) for i in range(5)] + [("c", 0, 1, None)]
    preds = spark.createDataFrame(rows, "model string, row_id int, y int, p double").repartition(4)
    got = {r.row_id: r.p for r in ensemble.blend_mean(preds).collect()}
    assert got == {i: (0.1 + i * 1e-14 + 0.3) / 2 for i in range(5)}
    weighted = {r.row_id: r.p for r in ensemble.blend_weighted(preds, {"a": 3, "b": 1}).collect()}
    assert weighted == {i: (0.75 * (0.1 + i * 1e-14) + 0.25 * 0.3) / 1.0 for i in range(5)}


def test_weight_grid_is_the_simplex():
    grid = ensemble.simplex_grid(3, 0.25)
    assert grid == sorted(grid) and len(grid) == len(set(grid)) == 15 and all(sum(g) == 1 for g in grid)
    assert len(ensemble.simplex_grid(12, 0.25)) == 1365 and ensemble.simplex_grid(1, 0.5) == [(1.0,)]


def test_ridge_scales_by_the_population_deviation(spark):
    draw = np.random.RandomState(5)
    x, n, alpha = draw.randn(40, 2) * [1, 9] + [3, -2], 40, 25.0
    y = (x[:, 0] + draw.randn(n) > 3).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), float(x[i, 0]), float(x[i, 1])) for i in range(n)], "id int, y int, a double, b double")
    cols = models.Columns("id", "y", ("a", "b"))
    got = [r.p for r in models.score(models.fit("ridge", df, cols, {"alpha": alpha}), df, cols).orderBy("id").collect()]
    z = (x - x.mean(0)) / x.std(0)
    beta = np.linalg.solve(z.T @ z + alpha * np.eye(2), z.T @ (y - y.mean()))
    assert np.allclose(got, z @ beta + y.mean(), atol=1e-6)


def test_means_of_models_take_one_scan(spark):
    df = spark.range(60).select("id", (F.col("id") % 9).cast("double").alias("a"), (F.col("id") % 2).cast("int").alias("y"))
    cols = models.Columns("id", "y", ("a",))
    fits = [models.fit("rf", df, cols, {"n_estimators": 3, "max_depth": 2}, s) for s in (1, 2)]
    both = models.mean_score(fits, df, cols)
    parts = [models.score(m, df, cols).withColumnRenamed("p", f"p{i}") for i, m in enumerate(fits)]
    joined = both.join(parts[0], "id").join(parts[1], "id")
    assert joined.where("abs(p - (p0 + p1) / 2) > 1e-12").count() == 0 and joined.count() == 60
    assert both._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
