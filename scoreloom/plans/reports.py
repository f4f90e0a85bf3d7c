"""Exploration and profile reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.operators.profile import (
    describe_numeric,
    feature_types,
    is_numeric,
    missing_summary,
    numeric_columns,
    profile_categorical,
    profile_numeric,
    table_shape,
    target_balance,
    target_corr,
    top_categories,
    type_counts,
)
from scoreloom.operators.schema import detect_target, resolve_id


def explore(train: DataFrame, test: DataFrame | None = None, target: str | None = None) -> dict[str, DataFrame]:
    """The named report tables of one exploration; the target rule is the one scoring jobs use."""
    target = target or detect_target(train, resolve_id(train)).first()["target"]
    types = feature_types(train, target)
    numeric = numeric_columns(train, [target] if target else [])
    report = {
        "shape": table_shape(train),
        "types": types,
        "type_counts": type_counts(types),
        "missing": missing_summary(train),
        "describe": describe_numeric(train, numeric),
    }
    if target:
        report["target"] = target_balance(train, target)
        if is_numeric(train.schema[target].dataType):
            report["corr"] = target_corr(train, numeric, target)
    if test is not None:
        report["test_shape"] = table_shape(test)
        report["test_missing"] = missing_summary(test)
    return report


def explore_columns(train: DataFrame, target: str) -> DataFrame:
    """One row per feature: type, cardinality, missingness, moments and target correlation."""
    numeric = numeric_columns(train, [target])
    types = feature_types(train, target)
    described = describe_numeric(train, numeric)
    corr = target_corr(train, numeric, target)
    # every side has one row per column of the table
    return types.join(described, "column", "left").join(corr, "column", "left")


def profile(train: DataFrame, target: str | None = None) -> dict[str, DataFrame]:
    """Numeric profiles, categorical profiles and top categories of everything but the target."""
    target = target or detect_target(train, resolve_id(train)).first()["target"]
    numeric = [f.name for f in train.schema.fields if is_numeric(f.dataType) and f.name != target]
    others = [f.name for f in train.schema.fields if not is_numeric(f.dataType) and f.name != target]
    report = {}
    if numeric:
        report["numeric"] = profile_numeric(train, numeric)
    if others:
        report["categorical"] = profile_categorical(train, others)
        report["top_categories"] = top_categories(train, others)
    return report


def profile_long(report: dict[str, DataFrame]) -> DataFrame:
    """Every profile figure as (column, measure, value)."""
    parts = []
    for kind in ("numeric", "categorical"):
        if kind not in report:
            continue
        table = report[kind]
        measures = [c for c in table.columns if c not in ("column", "type", "error")]
        wide = table.select("column", *[F.col(m).cast("double").alias(m) for m in measures])
        parts.append(wide.unpivot(["column"], measures, "measure", "value"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
