"""Global order, ranks, quantiles and AUC against brute force on small fixtures."""

from __future__ import annotations

import random
from math import isclose

import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoreloom.operators import metrics, ordering
from scoreloom.operators.encode import label_codes
from scoreloom.operators.folds import assign_folds, assign_holdout, hash_positions, safe_folds


def skewed(spark, n=900):
    """A third of all rows share one value; some are missing."""
    rng = random.Random(1)
    rows = []
    for i in range(n):
        v = 0.5 if i % 3 == 0 else rng.random() if i % 7 else None
        rows.append((i, "ab"[i % 2], v, int(rng.random() < 0.4)))
    return spark.createDataFrame(rows, "id int, g string, v double, y int")


def brute_auc(pairs):
    pos = [p for p, y in pairs if y]
    neg = [p for p, y in pairs if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg)) if pos and neg else None


@pytest.mark.parametrize("ranges", [None, 5])
def test_rank_fraction_equals_pandas(spark, ranges):
    df = skewed(spark)
    got = ordering.with_rank_fraction(df, "v", "r", ["g"], ranges).toPandas().sort_values("id")
    want = df.toPandas().sort_values("id")
    want["r"] = want.groupby("g")["v"].rank(pct=True)
    pd.testing.assert_series_equal(got["r"].reset_index(drop=True), want["r"].reset_index(drop=True))


def test_rank_fraction_by_shuffle_keeps_every_row(spark, no_broadcast):
    df = skewed(spark)
    got = ordering.with_rank_fraction(df, "v", "r", ["g"], 4).toPandas().sort_values("id")
    want = df.toPandas().sort_values("id")
    assert len(got) == len(want)
    want["r"] = want.groupby("g")["v"].rank(pct=True)
    pd.testing.assert_series_equal(got["r"].reset_index(drop=True), want["r"].reset_index(drop=True))


@pytest.mark.parametrize("ranges", [None, 4])
def test_rank_columns_in_long_form(spark, no_broadcast, ranges):
    df = skewed(spark).withColumn("w", F.col("id") % 10)
    got = ordering.with_rank_fractions(df, ["v", "w"], "__rank", "id", ranges).toPandas().sort_values("id")
    want = df.toPandas().sort_values("id")
    for c in ("v", "w"):
        pd.testing.assert_series_equal(
            got[f"{c}__rank"].reset_index(drop=True), want[c].rank(pct=True).reset_index(drop=True), check_names=False
        )


def test_tie_rank_mini_table(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (5.0,)], "v double")
    got = sorted(r["r"] for r in ordering.with_rank_fraction(df, "v", "r").collect())
    assert got == [0.25, 0.625, 0.625, 1.0]


@pytest.mark.parametrize("accuracy", [10_000, 100, 20])
def test_quantiles_equal_pandas(spark, accuracy):
    df = skewed(spark).withColumn("w", F.col("id") * 1.5).withColumn("empty", F.lit(None).cast("double"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = ordering.exact_quantiles(df, ["v", "w", "empty"], probs, accuracy, 4)
    pdf = df.toPandas()
    for c in ("v", "w"):
        assert got[c] == pytest.approx(pdf[c].quantile(probs).tolist(), abs=1e-12)
    assert got["empty"] == [None] * len(probs)


def test_median_mini_table(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "v double")
    assert ordering.exact_quantiles(df, ["v"], [0.5]) == {"v": [2.5]}


@pytest.mark.parametrize("ranges", [None, 6])
def test_auc_equals_brute_force(spark, ranges):
    df = skewed(spark)
    got = {r["g"]: r["auc"] for r in metrics.auc_by(df, "v", "y", ["g"], ranges=ranges).collect()}
    pdf = df.toPandas().dropna()
    for g, part in pdf.groupby("g"):
        assert isclose(got[g], brute_auc(list(zip(part["v"], part["y"]))), abs_tol=1e-12)


def test_auc_mini_tables(spark):
    tied = spark.createDataFrame([(0, 1.0), (1, 2.0), (0, 2.0), (1, 5.0)], "y int, p double")
    assert metrics.auc_by(tied, "p", "y").first()["auc"] == 0.875
    one_class = spark.createDataFrame([(1, 1.0), (1, 2.0)], "y int, p double")
    assert metrics.auc_by(one_class, "p", "y").first()["auc"] is None


@pytest.mark.parametrize("ranges", [None, 7])
def test_forward_fill_across_ranges(spark, ranges):
    """One timestamp holds a third of the rows; gaps reach over range borders."""
    rng = random.Random(2)
    rows = [(i, 50 if i % 3 == 0 else i, float(i) if rng.random() < 0.05 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, ts int, v double")
    got = ordering.forward_fill(df, "v", ["ts", "id"], "f", ranges).toPandas().sort_values(["ts", "id"])
    want = df.toPandas().sort_values(["ts", "id"])["v"].ffill()
    pd.testing.assert_series_equal(got["f"].reset_index(drop=True), want.reset_index(drop=True), check_names=False)


def test_label_codes_are_alphabetical_over_both_splits(spark):
    a = spark.createDataFrame([("b",), ("d",), (None,)], "c string")
    b = spark.createDataFrame([("a",), ("b",)], "c string")
    got = {r["value"]: r["code"] for r in label_codes([a, b], "c", 3).collect()}
    assert got == {v: i for i, v in enumerate(sorted(["a", "b", "d", "__NA__"]))}


@pytest.mark.parametrize("digits", [1, 3, 4])
def test_folds_are_balanced_and_independent_of_buckets(spark, digits):
    df = skewed(spark).select("id", "y")
    folded = assign_folds(df, "id", 5, 42, "y", digits=digits)
    sizes = folded.groupBy("y", "fold").count().toPandas()
    for _, part in sizes.groupby("y"):
        assert part["count"].max() - part["count"].min() <= 1
    base = {r["id"]: r["fold"] for r in assign_folds(df, "id", 5, 42, "y", digits=2).collect()}
    assert {r["id"]: r["fold"] for r in folded.collect()} == base


def test_folds_fall_back_when_no_class_is_large_enough(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1)], "id int, y int")
    assert sorted(r["fold"] for r in safe_folds(df, "id", "y", 4).collect()) == [0, 1, 2, 3]


def test_holdout_takes_the_ceiling_of_each_class(spark):
    df = spark.createDataFrame([(i, int(i < 7)) for i in range(20)], "id int, y int")
    taken = assign_holdout(df, "id", 0.2, 1, "y").groupBy("y").agg(F.sum("is_valid").alias("n")).collect()
    assert {r["y"]: r["n"] for r in taken} == {1: 2, 0: 3}


def test_hash_positions_number_every_row_once(spark):
    df = spark.range(300)
    at = sorted(r["__at"] for r in hash_positions(df, "id", 3, None, 1).collect())
    assert at == list(range(1, 301))
