"""What crosses the shuffle: as few rows and bytes a row as the job needs, with the same results."""

from __future__ import annotations

import contextlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from scoreloom.operators import ensemble as ens
from scoreloom.operators import folds
from scoreloom.operators.lookup import lookup
from scoreloom.sources.store import save_predictions
from scoreloom.suite import fixtures as fx
from scoreloom.suite.models import _docs


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture
def preds(spark):
    rows = [(f"r{i}", i * 7 % 3 % 2, m, None if (i + j) % 11 == 0 else float(i * (j + 3) % 17)) for i in range(200) for j, m in enumerate("abc")]
    return spark.createDataFrame(rows, "row_id string, y int, model string, p double").repartition(5)


def test_matrix_and_blends_take_one_shuffle_of_numbers(preds):
    for df in (ens.pred_matrix(preds, "abc"), ens.blend_mean(preds, models="abc"), ens.blend_weighted(preds, {"a": 2, "c": 1})):
        assert plan(df).count("Exchange hashpartitioning") == 1
        assert "collect_list" not in plan(df)


def test_board_equals_brute_force_with_missing_scores(spark, preds, no_broadcast):
    rows = preds.collect()
    scores = {m: {r["row_id"]: r["p"] for r in rows if r["model"] == m and r["p"] is not None} for m in "abc"}
    y = {r["row_id"]: r["y"] for r in rows}

    def auc(p):
        pos, neg = (np.array([v for k, v in p.items() if y[k] == side]) for side in (1, 0))
        return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))

    def ranks(p):
        v = np.array(list(p.values()))
        return {k: ((v < x).sum() + ((v == x).sum() + 1) / 2) / len(v) for k, x in p.items()}

    ranked = {m: ranks(s) for m, s in scores.items()}

    def blend(members):
        return {k: float(np.mean([ranked[m][k] for m in members if k in ranked[m]])) for k in y if any(k in ranked[m] for m in members)}

    want = {m: auc(s) for m, s in scores.items()}
    top = sorted(want, key=lambda m: (-want[m], m))[:2]
    want |= {"blend_all": auc(blend("abc")), "blend_top2": auc(blend(sorted(top)))}
    got = {r["candidate"]: r["auc"] for r in ens.candidates(preds, ["a", "b", "c"]).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_rows_of_hot_keys_are_not_shuffled(spark, no_broadcast):
    rows = [(i, None if i % 10 == 0 else "hot" if i % 3 else f"k{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, k string")
    table = df.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("v"))
    once, again = (lookup(df, table.where("k != 'k3'"), ["k"], "n", 1 << 40, again=a) for a in (False, True))
    assert sorted(once.collect(), key=str) == sorted(again.collect(), key=str)
    assert "__salt" not in plan(again) and "Union" in plan(again)


def test_folds_take_the_hash_behind_the_shuffle(spark):
    text = plan(folds.assign_folds(spark.range(100), "id", 3, 42))
    shuffled = text[text.index("Exchange hashpartitioning(__bucket"):].splitlines()[1]
    assert "__key" not in shuffled


SF = "/root/testdata/sf0.001"


def test_scores_are_stored_packed_and_the_session_is_left_as_it_was(spark, preds, tmp_path):
    name, path = "spark.sql.maxConcurrentOutputFileWriters", str(tmp_path / "store")
    before = spark.conf.get(name)
    stored = preds.withColumn("split", F.when(F.col("y") == 1, "oof").otherwise("test"))
    save_predictions(stored, path)
    assert spark.conf.get(name) == before
    files = list((tmp_path / "store").rglob("*.parquet"))
    assert files and all("zstd" in f.name for f in files)
    back = spark.read.parquet(path).select(*stored.columns)
    assert sorted(back.collect(), key=str) == sorted(stored.collect(), key=str)


def test_folds_are_assigned_once_for_the_encoding(spark):
    assert "Window" not in plan(contract.queries()["target_encode_nulls"](spark, SF))


def test_texts_are_read_once_for_all_fits(spark):
    train, test, _ = _docs(spark, SF)
    assert "regexp_replace" not in plan(train) + plan(test)
    want, texts, _ = fx.doc_splits(spark, SF)
    assert train.columns == want.columns and test.columns == texts.columns
    assert sorted(train.collect(), key=str) == sorted(want.collect(), key=str)
