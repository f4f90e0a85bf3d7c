"""Encodings of many columns at once, permutation importance in one shuffle, and the jobs' stores, policies and stages."""

from __future__ import annotations

from argparse import Namespace

import pytest
from pyspark.sql import functions as F

from scoreloom.__main__ import run
from scoreloom.operators import encode, models
from scoreloom.operators.folds import assign_folds
from scoreloom.operators.metrics import auc_by
from scoreloom.operators.models import FORESTS
from scoreloom.operators.search import POLICY
from scoreloom.plans import scoring
from scoreloom.session import materialize
from scoreloom.sources.store import load_model, load_predictions, load_trials

CATS = ["hot", "wide", "gaps"]


def table(spark, n=1200):
    df = spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, "top").otherwise((F.col("id") % 11).cast("string")).alias("hot"),
        (F.col("id") % 400).cast("string").alias("wide"), F.when(F.col("id") % 5 > 0, (F.col("id") % 4).cast("string")).alias("gaps"),
        (F.pmod(F.xxhash64("id"), F.lit(10)) < 4).cast("int").alias("y"),
    )
    return materialize(assign_folds(df, "id", 4, 42, "y"), "test")


@pytest.mark.parametrize("fold_prior", [False, True])
@pytest.mark.parametrize("shuffled", [False, True])
def test_encodings_at_once_equal_those_one_by_one(spark, request, shuffled, fold_prior):
    if shuffled:
        request.getfixturevalue("no_broadcast")
    df = table(spark)
    enc = encode.fit_encoding(df, CATS, "y", "fold", fold_prior=fold_prior)
    for fold in (None, "fold"):
        slow = encode.apply_oof_encoding(df, enc, fold) if fold else encode.apply_encoding(df, enc)
        slow = encode.apply_frequency(slow, enc)
        fast = encode.apply_encodings(df, enc, "id", fold)
        assert fast.columns[: len(df.columns)] == df.columns and set(fast.columns) == set(slow.columns)
        names = sorted(fast.columns)
        key = lambda r: r["id"]
        for a, b in zip(sorted(fast.select(names).collect(), key=key), sorted(slow.select(names).collect(), key=key)):
            assert a.asDict() == pytest.approx(b.asDict(), abs=1e-12) if None not in a else a == b
    unseen = spark.createDataFrame([(1, "new", "3", None)], "id long, hot string, wide string, gaps string")
    row = encode.apply_encodings(unseen, enc, "id", frequency=False).first()
    assert row["hot__te"] == enc.prior and "hot__freq" not in row.asDict()
    with pytest.raises(ValueError):
        encode.apply_encodings(df, encode.fit_encoding(df, CATS, "y"), "id", "fold")


def test_many_columns_move_the_rows_once(spark, no_broadcast):
    df = table(spark, 200)
    wide = df.select("id", "y", "fold", *[F.concat(F.lit(f"{i}"), "wide").alias(f"c{i}") for i in range(30)])
    wide = materialize(wide, "wide")
    enc = encode.fit_encoding(wide, [f"c{i}" for i in range(30)], "y", "fold")
    out = encode.apply_encodings(wide, enc, "id", "fold")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 3 and out.count() == 200


def test_permutation_importance_equals_a_loop(spark):
    u = lambda s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1000)) / 1000
    df = spark.range(600).select("id", *[u(i).alias(f"v{i}") for i in range(5)])
    df = materialize(df.withColumn("y", (F.col("v0") + 0.3 * F.col("v1") > 0.7).cast("int")), "test")
    cols = models.Columns("id", "y", tuple(f"v{i}" for i in range(5)))
    model = models.fit("rf", models.prepare_matrix(df, cols), cols, {"n_estimators": 5, "max_depth": 4})
    base = models.prepare_matrix(df, cols)
    whole = auc_by(models.score(model, base, cols, ["y"]), "p", "y").first()["auc"]
    want = {}
    for c in cols.numeric:
        donor = models._numbered(base.select("id", c), "id", 43).select("__at", F.col(c).alias("__donor"))
        mixed = models._numbered(base, "id", 42).join(donor, "__at").withColumn(c, F.col("__donor")).drop("__donor", "__at")
        want[c] = whole - auc_by(models.score(model, mixed, cols, ["y"]), "p", "y").first()["auc"]
    for at_once in (2, 25):
        got = {r["column"]: r["drop"] for r in models.permutation_importance(model, df, cols, at_once=at_once).collect()}
        assert got == pytest.approx(want, abs=1e-12)
    assert want["v0"] > 0.1


DEFAULTS = dict.fromkeys(["train", "test", "template", "submission", "target", "out"]) | {"strict": False, "single_file": False}
TINY = {"iterations": 3, "max_iter": 3, "n_estimators": 3, "depth": 2, "max_depth": 2, "num_leaves": 4}


@pytest.fixture
def files(tmp_path):
    rows = [f"{i},{i % 13 / 3},{'ab'[i % 2]},w{i // 2},{int(i % 4 < 2)}" for i in range(90)]
    (tmp_path / "train.csv").write_text("id,v,c,w,target\n" + "\n".join(rows) + "\n")
    (tmp_path / "test.csv").write_text("id,v,c,w\n100,1.5,a,w1\n101,,b,new\n")
    (tmp_path / "sample.csv").write_text("id,target\n101,0.5\n100,0.5\n")
    return tmp_path


def inputs(spark, files):
    from scoreloom.__main__ import read, read_template

    return read(spark, f"{files}/train.csv"), read(spark, f"{files}/test.csv"), read_template(spark, f"{files}/sample.csv")


def test_full_and_meta_stages_of_the_command_line(spark, files, monkeypatch):
    from scoreloom import __main__ as cli

    small = {f: {**TINY} for f in ("lgb", "cat")}
    monkeypatch.setitem(cli.JOBS, "meta", lambda *t, **o: scoring.meta(*t, overrides=small, fast_run=True, seeds=(1,), **o))
    monkeypatch.setitem(cli.JOBS, "full", lambda *t, **o: {
        "safety": scoring.safety(*t, TINY), "compete": scoring.compete(*t, overrides=small, fast_run=True, seeds=(1,), **o)})
    paths = {"train": f"{files}/train.csv", "test": f"{files}/test.csv", "template": f"{files}/sample.csv"}
    call = lambda **given: run(spark, Namespace(**{**DEFAULTS, **paths, **given}))
    assert call(job="meta", out=f"{files}/m", families=["lgb", "cat"]) == 0
    board = {r["candidate"] for r in spark.read.json(f"{files}/m/board").collect()}
    assert board == {"lgb", "cat"}
    assert call(job="full", out=f"{files}/f", families=["lgb", "cat"]) == 0
    assert spark.read.option("header", True).csv(f"{files}/f/safety/predictions").count() == 2
    assert "blend_all" in {r["candidate"] for r in spark.read.json(f"{files}/f/compete/board").collect()}


def test_tuning_keeps_its_trials(spark, files):
    store = f"{files}/store"
    for _ in range(2):
        best, trials = scoring.tune(*inputs(spark, files), families=("rf",), tune_trials=2, k=2, store=store, overrides={"n_estimators": 3, "max_depth": 2})
    assert set(best) == {"rf"} and trials.count() == 2 and load_trials(spark, f"{store}/trials").count() == 4


def test_ensemble_job_tunes_and_stores(spark, files, monkeypatch):
    store = f"{files}/store"
    monkeypatch.setattr(scoring, "draw_params", lambda family, n: [{**TINY, "max_depth": d + 1} for d in range(n)])
    done = scoring.train_and_ensemble(
        *inputs(spark, files), specs={"rf": dict(TINY), "logistic": {"max_iter": 5}}, k=2, tune_trials=2, store=store
    )
    assert done.published.count() == 2
    trials = load_trials(spark, f"{store}/trials")
    assert {r["model"] for r in trials.collect()} == {"rf", "logistic"} and trials.count() == 4
    kept = load_predictions(spark, f"{store}/predictions")
    assert {r["model"] for r in kept.where("split = 'test'").collect()} == {
        "rf", "logistic", "weighted_ensemble", "rank_average", "simple_average"}
    assert kept.where("split = 'oof'").count() == 180
    for name in ("rf", "logistic"):
        assert load_model(f"{store}/models/{name}").stages


def test_size_policy_decides_parameters(spark, files):
    data = scoring.prepare(*inputs(spark, files))
    chosen = scoring.tuned_params(data, "lgb", 0)
    rules = POLICY["lgb"]
    assert chosen == {**rules["base"], **rules["tiny"], **(rules.get("wide", {}) if len(data.roles.features) / 90 > 0.05 else {})}
    assert scoring.tuned_params(data, "ridge", 0) == {} and FORESTS == ("rf", "et")


def test_sparse_one_hot_of_ten_thousand_levels(spark, no_broadcast):
    n = 20_000
    value = F.when(F.col("id") % 3 == 0, "top").when(F.col("id") % 4999 > 0, F.concat(F.lit("k"), (F.col("id") % 10_000).cast("string")))
    rows = materialize(spark.range(n).select("id", value.alias("c")), "test")
    (train, test), size = encode.one_hot_sparse([rows.where("id % 2 = 0"), rows.where("id % 2 = 1")], "c")
    levels = sorted({"__NA__" if r["c"] is None else r["c"] for r in rows.collect()})
    assert size == len(levels) > 6000
    place = {v: i for i, v in enumerate(levels)}
    for part in (train, test):
        assert part.columns == ["id", "c", "c__onehot"]
        for r in part.collect():
            v = r["c__onehot"]
            assert v.size == size and list(v.indices) == [place["__NA__" if r["c"] is None else r["c"]]] and list(v.values) == [1.0]
