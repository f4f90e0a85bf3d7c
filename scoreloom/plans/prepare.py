"""From three tables to encoded, key-aligned train and test tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from scoreloom.operators.encode import (
    apply_codes,
    apply_encodings,
    apply_impute,
    fit_encoding,
    fit_impute,
    label_codes,
)
from scoreloom.operators.features import add_datetime_parts, missing_flags, missing_rates
from scoreloom.operators.folds import safe_folds
from scoreloom.operators.publish import require_unique
from scoreloom.operators.schema import id_like_columns, load_roles
from scoreloom.roles import Roles
from scoreloom.session import materialize


@dataclass(frozen=True)
class Prepared:
    roles: Roles
    train: DataFrame
    test: DataFrame
    template: DataFrame


def expand_dates(roles: Roles, train: DataFrame, test: DataFrame) -> tuple[Roles, DataFrame, DataFrame]:
    """Date and time columns become calendar numbers in both splits instead of text categories."""
    dates = [c for c in roles.cats if isinstance(train.schema[c].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    if not dates:
        return roles, train, test
    left, right = add_datetime_parts(train, dates), add_datetime_parts(test, dates)
    added = [c for c in left.columns if c not in train.columns]
    cats = tuple(c for c in roles.cats if c not in dates)
    return Roles(roles.id, roles.target, roles.prediction, (*roles.numeric, *added), cats), left, right


def prepare(
    train: DataFrame, test: DataFrame, template: DataFrame, frequency: bool = True, folds: int = 5, seed: int = 42
) -> Prepared:
    """Resolve roles, number encoding folds, add ``__te`` and ``__freq`` columns to both splits.

    Encoded tables are written once: every later fit scans stored columns instead of repeating the
    joins.
    """
    roles, labelled, unlabelled = expand_dates(*load_roles(train, test, template))
    require_unique(labelled, roles.id)
    if not roles.cats:
        return Prepared(roles, materialize(labelled, "train"), materialize(unlabelled, "test"), template)
    folded = materialize(safe_folds(labelled, roles.id, roles.target, folds, seed, "__fold"), "train_folds")
    enc = fit_encoding(folded, roles.cats, roles.target, "__fold")
    left = apply_encodings(folded, enc, roles.id, "__fold", frequency)
    right = apply_encodings(unlabelled, enc, roles.id, frequency=frequency)
    added = [f"{c}__te" for c in roles.cats] + [f"{c}__freq" for c in roles.cats if frequency]
    return Prepared(
        roles.with_numeric(*added), materialize(left.drop("__fold"), "train"), materialize(right, "test"), template
    )


def prepare_raw(train: DataFrame, test: DataFrame, template: DataFrame) -> Prepared:
    """Roles and ordinals only, for models that read raw features."""
    roles, labelled, unlabelled = expand_dates(*load_roles(train, test, template))
    require_unique(labelled, roles.id)
    return Prepared(roles, materialize(labelled, "train"), materialize(unlabelled, "test"), template)


def encode_columns(data: Prepared, cats: Sequence[str], folds: int = 5, seed: int = 42) -> Prepared:
    """``data`` with target and frequency encodings of some text columns as further numeric features."""
    if not cats:
        return data
    roles = data.roles
    folded = materialize(safe_folds(data.train, roles.id, roles.target, folds, seed, "__fold"), "wide_folds")
    enc = fit_encoding(folded, cats, roles.target, "__fold")
    left = apply_encodings(folded, enc, roles.id, "__fold").drop("__fold")
    right = apply_encodings(data.test, enc, roles.id)
    added = [f"{c}__{kind}" for kind in ("te", "freq") for c in cats]
    return Prepared(
        roles.with_numeric(*added), materialize(left, "train"), materialize(right, "test"), data.template
    )


def prepare_coded(train: DataFrame, test: DataFrame, template: DataFrame) -> Prepared:
    """Label codes over both splits and train-fitted imputation; id-like text columns are left out."""
    data = prepare_raw(train, test, template)
    roles, left, right = data.roles, data.train, data.test
    dropped = id_like_columns(left, skip=[roles.id])
    cats = [c for c in roles.cats if c not in dropped]
    for c in cats:
        codes = label_codes([left, right], c)
        left = apply_codes(left, c, codes, f"{c}__code")
        right = apply_codes(right, c, codes, f"{c}__code")
    numeric = roles.numeric + tuple(f"{c}__code" for c in cats)
    fill = fit_impute(left, roles.numeric, [])
    coded = Roles(roles.id, roles.target, roles.prediction, numeric, tuple(cats))
    return Prepared(
        coded, materialize(apply_impute(left, fill), "train"), materialize(apply_impute(right, fill), "test"), template
    )


def flag_missing(data: Prepared, above: float = 0.05, suffix: str = "__is_missing", numeric_only: bool = False,
                 limit: int | None = None) -> Prepared:
    """Missing flags decided on train and added to both splits."""
    columns = list(data.roles.numeric if numeric_only else data.roles.features)[:limit]
    if not columns:
        return data
    rates = missing_rates(data.train, columns)
    names = [f"{c}{suffix}" for c, rate in rates.items() if rate > above]
    return Prepared(
        data.roles.with_numeric(*names),
        missing_flags(data.train, rates, above, suffix),
        missing_flags(data.test, rates, above, suffix),
        data.template,
    )
