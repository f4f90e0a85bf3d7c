"""Ordered target statistics against a plain loop, on skewed and very wide columns."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from scoreloom.operators import models
from scoreloom.operators.folds import assign_folds
from scoreloom.operators.ordered import apply_totals, fit_ordered, ordered_rates

COLUMNS = ("hot", "wide")


def rows(n: int) -> list[tuple]:
    """A third of all rows share one category; the other column has a level for every two rows; some labels are missing."""
    return [
        (i, "a" if i % 3 == 0 else f"b{i % 7}" if i % 5 else None, f"w{i // 2}", None if i % 97 == 0 else int((i * 7919) % 11 < 4), i % 3)
        for i in range(n)
    ]


def loop(data: list[tuple], column: int, folds: list[int] | None, seed: int = 42) -> dict[int, list[float]]:
    skip = [*(folds or []), None]
    known = [r for r in data if r[3] is not None]
    prior = {f: sum(r[3] for r in known if r[4] != f or f is None) / sum(1 for r in known if r[4] != f or f is None) for f in skip}
    value = lambda r: "__NA__" if r[column] is None else r[column]
    seen, total = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for r in known:
        for f in skip:
            if f is None or r[4] != f:
                total[value(r), f][0] += 1
                total[value(r), f][1] += r[3]
    out = {}
    for r in sorted(data, key=lambda r: (hashlib.md5(f"{r[0]}-{seed}".encode()).hexdigest(), r[0])):
        use = [total if f is not None and r[4] == f else seen for f in skip]
        out[r[0]] = [(u[value(r), f][1] + prior[f]) / (u[value(r), f][0] + 1) for u, f in zip(use, skip)]
        if r[3] is not None:
            for f in skip:
                if f is None or r[4] != f:
                    seen[value(r), f][0] += 1
                    seen[value(r), f][1] += r[3]
    return out


@pytest.mark.parametrize("fold", [None, "fold"])
@pytest.mark.parametrize("hot_share", [1000, 5])
def test_equals_a_loop(spark, no_broadcast, fold, hot_share):
    data = rows(1500)
    df = spark.createDataFrame(data, "id long, hot string, wide string, y int, fold int").repartition(7)
    enc = fit_ordered(df, COLUMNS, "y", fold)
    got = {r["id"]: r for r in ordered_rates(df, enc, "y", "id", fold, hot_share=hot_share, parts=16).collect()}
    assert len(got) == len(data)
    for at, c in enumerate(COLUMNS, 1):
        want = loop(data, at, [0, 1, 2] if fold else None)
        for i, rates in want.items():
            assert got[i][f"{c}__ots"] == pytest.approx(rates, abs=1e-12)
    assert enc.pick() == (3 if fold else 0) and (fold is None or enc.pick(1) == 1)


def test_unseen_rows_read_the_totals(spark):
    data = rows(300)
    df = spark.createDataFrame(data, "id long, hot string, wide string, y int, fold int")
    enc = fit_ordered(df, COLUMNS, "y")
    test = spark.createDataFrame([(1, "a", "new"), (2, None, "w3")], "id long, hot string, wide string")
    got = {r["id"]: r for r in apply_totals(test, enc, "id").collect()}
    known = [r for r in data if r[3] is not None]
    prior = sum(r[3] for r in known) / len(known)
    for i, at, v in ((1, 1, "a"), (2, 1, None), (1, 2, "new"), (2, 2, "w3")):
        own = [r[3] for r in known if r[at] == v]
        assert got[i][f"{COLUMNS[at - 1]}__ots"] == pytest.approx([(sum(own) + prior) / (len(own) + 1)])


def test_a_hundred_thousand_levels_reach_the_category_family(spark):
    """Levels carry the label, so that a fit that reads them must rank well where numbers alone say nothing."""
    n = 200_000
    level = F.concat(F.lit("k"), F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("string"))
    df = spark.range(n).select(
        F.col("id"), level.alias("level"), (F.pmod(F.xxhash64(level), F.lit(10)) < 3).cast("int").alias("y"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)).cast("double").alias("noise"),
    )
    cats = models.indexable(df, ["level"])
    assert cats == ()
    cols = models.Columns("id", "y", ("noise",), cats, wide=("level",))
    preds = models.oof_scores("cat", df, cols, df.limit(50), 2, (42, 7), {"iterations": 3, "depth": 3})
    oof = preds.where("split = 'oof'")
    assert oof.count() == n and preds.where("split = 'test'").count() == 50
    from scoreloom.operators.metrics import auc_by

    assert auc_by(oof, "p", "y").first()["auc"] > 0.7


def test_fold_places_follow_the_fold_numbers(spark):
    df = assign_folds(spark.range(40).select("id", (F.col("id") % 2).cast("int").alias("y"), F.lit("x").alias("c")), "id", 4, 1, "y")
    enc = fit_ordered(df, ["c"], "y", "fold")
    assert enc.folds == (0, 1, 2, 3) and [enc.pick(f) for f in range(4)] == [0, 1, 2, 3] and enc.pick() == 4


@pytest.mark.parametrize("columns", [2, 30])
def test_rows_go_from_category_to_category_once(spark, no_broadcast, columns):
    """One shuffle of the rows a column and no lookup of totals; wide rows stay out of the chain and get the same rates."""
    data = rows(600)
    df = spark.createDataFrame(data, "id long, hot string, wide string, y int, fold int")
    df = df.withColumns({f"x{i}": F.lit(i) for i in range(columns)})
    enc = fit_ordered(df, COLUMNS, "y", "fold")
    out = ordered_rates(df, enc, "y", "id", "fold", hot_share=5, parts=4)
    assert out.columns == [*df.columns, "hot__ots", "wide__ots"]
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in text and text.count("Exchange hashpartitioning") <= (2 if columns == 2 else 4)
    got = {r["id"]: r for r in out.collect()}
    for at, c in enumerate(COLUMNS, 1):
        for i, rates in loop(data, at, [0, 1, 2]).items():
            assert got[i][f"{c}__ots"] == pytest.approx(rates, abs=1e-12)
