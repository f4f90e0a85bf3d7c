"""Targets of any two values and date columns inside a job."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scoreloom.operators.schema import load_roles
from scoreloom.plans.prepare import prepare


@pytest.mark.parametrize(("low", "high"), [("No", "Yes"), (1, 2), (-1, 1), (0, 1), (0.0, 1.0), (False, True)])
def test_two_valued_targets_become_zero_and_one(spark, low, high):
    train = spark.createDataFrame([(i, float(i % 5), high if i % 3 else low) for i in range(30)], ["id", "v", "target"])
    test, template = train.drop("target"), train.select("id", F.lit(0.0).alias("target"))
    roles, ready, _ = load_roles(train, test, template)
    assert roles.target == "target"
    assert all(r["target"] == int(bool(r["id"] % 3)) for r in ready.collect())


def test_dates_become_numbers(spark):
    train = spark.range(40).select("id", F.expr("timestamp'2024-01-31 05:00:00' + make_interval(0, 0, 0, id)").alias("at"),
                                   F.concat(F.lit("c"), F.col("id") % 2).alias("c"), (F.col("id") % 2).cast("int").alias("target"))
    template = train.select(F.col("id").alias("pos"), "id", F.lit(0.0).alias("target"))
    data = prepare(train, train.drop("target"), template)
    assert "at" not in data.roles.cats and data.roles.cats == ("c",)
    added = [c for c in data.roles.numeric if c.startswith("at")]
    assert added and set(added) <= set(data.train.columns) and set(added) <= set(data.test.columns)
