from __future__ import annotations

import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from scoreloom.functions.scalar import bin_index, hash_bucket, sanitize_score, width_edges
from scoreloom.functions.stats import safe_corr
from scoreloom.operators import encode, features
from scoreloom.operators.folds import assign_folds
from scoreloom.operators.lookup import lookup
from scoreloom.session import materialize


def test_smoothed_encoding_mini_table(spark):
    df = spark.createDataFrame([("0", 1), ("0", 0), ("0", 1), ("1", 0)], "c string, y int")
    enc = encode.fit_encoding(df, ["c"], "y")
    assert enc.prior == 0.5
    got = {r["c"]: r["c__te"] for r in encode.apply_encoding(df, enc).collect()}
    assert got["0"] == pytest.approx(7 / 13) and got["1"] == pytest.approx(5 / 11)
    unseen = encode.apply_encoding(spark.createDataFrame([("9",)], "c string"), enc).first()
    assert unseen["c__te"] == 0.5


def test_out_of_fold_encoding_mini_table(spark):
    df = spark.createDataFrame([("a", 0, 1), ("b", 0, 0), ("b", 1, 1)], "c string, fold int, y int")
    enc = encode.fit_encoding(df.unionByName(spark.createDataFrame([("z", 1, 0)], df.schema)), ["c"], "y", "fold")
    got = {(r["c"], r["fold"]): r["c__te"] for r in encode.apply_oof_encoding(df, enc, "fold").collect()}
    assert got[("a", 0)] == 0.5
    assert got[("b", 0)] == pytest.approx(6 / 11)
    assert got[("b", 1)] == pytest.approx(5 / 11)


def test_own_label_moves_own_encoding_only_through_the_prior(spark):
    rows = [(i, "abc"[i % 3], i % 2) for i in range(60)]
    flipped = [(i, c, 1 - y if i == 7 else y) for i, c, y in rows]
    values = []
    for data in (rows, flipped):
        df = assign_folds(spark.createDataFrame(data, "id int, c string, y int"), "id", 5, 42)
        enc = encode.fit_encoding(df, ["c"], "y", "fold")
        row = encode.apply_oof_encoding(df, enc, "fold").where("id = 7").first()
        rest = enc.by_fold.where((F.col("value") == row["c"]) & (F.col("fold") == row["fold"])).first()
        n = rest["n"] - rest["fold_n"]
        values.append((row["c__te"] * (n + 10) - 10 * enc.prior, n))
    assert values[0] == pytest.approx(values[1])


def test_fold_prior_uses_other_folds_only(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 0, 1), ("b", 1, 0), ("b", 1, 1)], "c string, fold int, y int")
    enc = encode.fit_encoding(df, ["c"], "y", "fold", fold_prior=True)
    got = {(r["c"], r["fold"]): r["c__te"] for r in encode.apply_oof_encoding(df, enc, "fold").collect()}
    assert got[("a", 0)] == pytest.approx(0.5) and got[("b", 1)] == pytest.approx(1.0)


def test_missing_category_is_its_own_level_or_the_prior(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 0), ("a", 0)], "c string, y int")
    own = encode.apply_encoding(df, encode.fit_encoding(df, ["c"], "y")).where("c is null").first()["c__te"]
    prior = encode.apply_encoding(df, encode.fit_encoding(df, ["c"], "y", null_level="prior")).where("c is null")
    assert own == pytest.approx(7 / 12) and prior.first()["c__te"] == 0.5


def test_encoding_by_shuffle_equals_broadcast(spark):
    """A third of the rows hold one category; the shuffle path spreads them and loses none."""
    rows = [(i, "hot" if i % 3 == 0 else f"c{i % 211}" if i % 5 else None, int(i % 4 == 0)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, c string, y int")
    enc = encode.fit_encoding(df, ["c"], "y")
    small = {r["id"]: (r["c__te"], r["c__freq"]) for r in
             encode.apply_frequency(encode.apply_encoding(df, enc), enc).collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = {r["id"]: (r["c__te"], r["c__freq"]) for r in
                 encode.apply_frequency(encode.apply_encoding(df, enc), enc).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(large) == 3000 and large == small


def test_lookup_with_missing_keys_by_shuffle(spark, no_broadcast):
    df = spark.createDataFrame([(i, None if i % 2 else i % 4) for i in range(40)], "id int, k int")
    table = materialize(spark.createDataFrame([(0, 10, "zero"), (2, 10, None)], "k int, n bigint, v string"))
    got = lookup(df, table, ["k"], "n").collect()
    assert len(got) == 40
    assert {(r["k"], r["v"]) for r in got} == {(None, None), (0, "zero"), (2, None)}


def test_impute_median_and_smallest_mode(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (None, "b"), (4.0, "a"), (None, None)], "v double, c string")
    fill = encode.fit_impute(df, ["v"], ["c"])
    assert fill == {"v": 2.0, "c": "a"}
    assert encode.apply_impute(df, fill).where("v is null or c is null").count() == 0


def test_one_hot_refuses_wide_columns(spark):
    with pytest.raises(ValueError):
        encode.one_hot(spark.range(30).select(F.col("id").cast("string").alias("c")), "c", 20)


def test_sanitise_mini_table(spark):
    values = [float("nan"), float("inf"), float("-inf"), 2.0, -1.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p double")
    got = [r["s"] for r in df.select("i", sanitize_score("p").alias("s")).orderBy("i").collect()]
    assert got == [0.5, 1 - 1e-6, 1e-6, 1 - 1e-6, 1e-6, 0.5]


def test_bins_are_right_closed_with_lowest_included(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 1.5, 2.0, 9.0, -1.0, None)], "v double")
    got = [r["b"] for r in df.select(bin_index("v", [0.0, 1.0, 2.0, 3.0]).alias("b")).collect()]
    assert got == [0, 0, 1, 1, 2, 0, 0]
    assert width_edges(0.0, 1.0)[-1] == 1.0 and len(width_edges(0.0, 1.0)) == 11


def test_hash_bucket_is_stable(spark):
    df = spark.createDataFrame([("x",), (None,)], "c string")
    assert all(0 <= r["b"] < 16 for r in df.select(hash_bucket("c", 16).alias("b")).collect())


def test_correlation_with_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "a double, b double")
    assert df.agg(safe_corr(F.col("a"), F.col("b")).alias("c")).first()["c"] is None


def test_pair_schemes():
    assert features.triangle_pairs(["a", "b", "c"], 1, 3) == [("a", "b"), ("a", "c")]
    assert features.neighbour_pairs(["a", "b", "c", "d"], 2) == [
        ("a", "b"), ("a", "c"), ("b", "c"), ("b", "d"), ("c", "d")
    ]


def test_row_aggregates_skip_missing(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    first, second = features.row_aggregates(df, ["a", "b", "c"]).collect()
    assert (first["__row_mean"], first["__row_max"], first["__row_min"]) == (2.0, 3.0, 1.0)
    assert first["__row_std"] == pytest.approx(2**0.5)
    assert second["__row_mean"] is None and second["__row_std"] is None


def test_sparse_one_hot_names_no_level_in_the_schema(spark):
    """The driver's schema and a row's vector stay small for any number of levels."""
    rows = [(i, None if i % 500 == 0 else f"v{i % 3000:04d}") for i in range(6000)]
    df = spark.createDataFrame(rows, "id int, c string").repartition(3)
    (first, second), size = encode.one_hot_sparse([df.where("id < 3100"), df.where("id >= 3100")], "c", "v")
    levels = sorted({c or "__NA__" for _, c in rows})
    assert size == len(levels) and len(first.schema.json()) < 2000
    assert first.schema["v"].metadata["ml_attr"] == {"num_attrs": size}
    got = {r["id"]: (r["v"], r["at"]) for r in first.unionByName(second).select("id", "v", encode.unit_place("v").alias("at")).collect()}
    for i, c in rows:
        place = levels.index(c or "__NA__")
        assert got[i] == (SparseVector(size, [place], [1.0]), place)
