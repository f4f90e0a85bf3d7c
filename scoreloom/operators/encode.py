"""Category encodings fitted on train and applied to any split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.functions.scalar import category_text
from scoreloom.operators.lookup import lookup
from scoreloom.operators.ordering import dense_codes, exact_quantiles
from scoreloom.operators.profile import value_counts
from scoreloom.session import fits_broadcast, materialize


@dataclass(frozen=True)
class Encoding:
    """Fitted per-category statistics.

    ``totals`` holds (column, value, n, pos); ``by_fold`` the same per fold, or ``None``.
    """

    columns: tuple[str, ...]
    prior: float
    smoothing: float
    totals: DataFrame
    by_fold: DataFrame | None
    fold_priors: dict[int, float] | None


def fit_encoding(
    df: DataFrame, cats: Sequence[str], target: str, fold: str | None = None, smoothing: float = 10.0,
    null_level: str = "own", fold_prior: bool = False,
) -> Encoding:
    """Count rows and positives per (column, category[, fold]) in one shuffle for all columns.

    A missing category is its own level (``null_level="own"``) or encodes to the prior.  The prior
    is the mean over all rows; ``fold_prior`` takes it from the other folds instead.
    """
    texts = [(category_text(F.col(f"`{c}`")) if null_level == "own" else F.col(f"`{c}`").cast("string")).alias(c)
             for c in cats]
    keys = [target] + ([fold] if fold else [])
    long = df.select(*keys, *texts).unpivot(keys, list(cats), "column", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value", *([fold] if fold else [])).agg(
        F.count("*").alias("n"), F.sum(F.col(target).cast("double")).alias("pos")
    )
    if fold:
        whole = Window.partitionBy("column", "value")  # one row per fold
        counts = counts.withColumnsRenamed({"n": "fold_n", "pos": "fold_pos"}).withColumns(
            {"n": F.sum("fold_n").over(whole), "pos": F.sum("fold_pos").over(whole)}
        )
    base = materialize(counts, "categories")
    priors = df.groupBy(*([fold] if fold else [])).agg(
        F.count(target).alias("n"), F.sum(F.col(target).cast("double")).alias("pos")
    ).collect()
    n, pos = sum(r["n"] for r in priors), sum(r["pos"] or 0.0 for r in priors)
    outside = None
    if fold and fold_prior:
        outside = {r[fold]: (pos - r["pos"]) / (n - r["n"]) for r in priors if n > r["n"]}
    totals, by_fold = base, None
    if fold:
        totals = base.groupBy("column", "value").agg(F.first("n").alias("n"), F.first("pos").alias("pos"))
        by_fold = base
    return Encoding(tuple(cats), pos / n if n else float("nan"), smoothing, totals, by_fold, outside)


def _smoothed(pos: Column, n: Column, prior: Column, smoothing: float) -> Column:
    return (pos + smoothing * prior) / (n + smoothing)


def _category(df: DataFrame, c: str) -> DataFrame:
    return df.withColumn("__value", category_text(F.col(f"`{c}`")))


def _for_column(table: DataFrame, c: str) -> DataFrame:
    return table.where(F.col("column") == c).drop("column").withColumnRenamed("value", "__value")


def apply_encoding(df: DataFrame, enc: Encoding) -> DataFrame:
    """Add ``<c>__te`` from all training rows; an unseen category gets the prior."""
    for c in enc.columns:
        te = _smoothed(F.col("pos"), F.col("n"), F.lit(enc.prior), enc.smoothing)
        table = _for_column(enc.totals, c).select("__value", "n", te.alias("__te"))
        df = lookup(_category(df, c), table, ["__value"], "n")
        df = df.withColumn(f"{c}__te", F.coalesce("__te", F.lit(enc.prior))).drop("__te", "__value")
    return df


def apply_oof_encoding(df: DataFrame, enc: Encoding, fold: str) -> DataFrame:
    """Add ``<c>__te`` to training rows, each row's own fold left out.

    The complement is total minus own fold, so there is no scan per fold and no self join; a
    category seen in one fold only has an empty complement and falls back to the prior by itself.
    """
    if enc.by_fold is None:
        raise ValueError("fit_encoding needs fold= for out-of-fold encoding")
    prior = _fold_prior(enc, fold)
    for c in enc.columns:
        rest_n, rest_pos = F.col("n") - F.col("fold_n"), F.col("pos") - F.col("fold_pos")
        te = _smoothed(rest_pos, rest_n, prior, enc.smoothing)
        table = _for_column(enc.by_fold, c).select("__value", fold, "fold_n", te.alias("__te"))
        df = lookup(_category(df, c), table, ["__value", fold], "fold_n")
        df = df.withColumn(f"{c}__te", F.coalesce("__te", F.lit(enc.prior))).drop("__te", "__value")
    return df


def apply_frequency(df: DataFrame, enc: Encoding) -> DataFrame:
    """Add ``<c>__freq``, the raw training count; unseen categories get 0."""
    for c in enc.columns:
        table = _for_column(enc.totals, c).select("__value", "n", F.col("n").cast("double").alias("__freq"))
        df = lookup(_category(df, c), table, ["__value"], "n")
        df = df.withColumn(f"{c}__freq", F.coalesce("__freq", F.lit(0.0))).drop("__freq", "__value")
    return df


def apply_encodings(
    df: DataFrame, enc: Encoding, key: str, fold: str | None = None, frequency: bool = True
) -> DataFrame:
    """``<c>__te`` and ``<c>__freq`` of every fitted column from one lookup of the fitted table.

    With ``fold`` the rows are the fitted ones and their own fold is left out (as in ``apply_oof_encoding``), without it
    they are any others.  A table small enough to be broadcast is joined column by column, which moves no rows.  Beyond
    that, all cells of all columns are looked up as one long table and come back by ``key``, which must be unique: the wide
    rows are shuffled once, for two columns or two hundred.
    """
    if fold is not None and enc.by_fold is None:
        raise ValueError("fit_encoding needs fold= for out-of-fold encoding")
    prior = F.lit(enc.prior) if fold is None else _fold_prior(enc, fold)
    if fold is None:
        source, on, rows = enc.totals, ["column", "value"], "n"
        pos, n = F.col("pos"), F.col("n")
    else:
        source, on, rows = enc.by_fold, ["column", "value", fold], "fold_n"
        pos, n = F.col("pos") - F.col("fold_pos"), F.col("n") - F.col("fold_n")
    table = source.select(*on, F.col(rows).alias("__rows"), _smoothed(pos, n, prior, enc.smoothing).alias("te"), F.col("n").cast("double").alias("freq"))
    if fits_broadcast(source):
        given = df.columns
        for c in enc.columns:
            part = _for_column(table, c).withColumnsRenamed({"te": "__te", "freq": "__freq"})
            df = lookup(_category(df, c), part, ["__value", *on[2:]], "__rows")
            df = _encoded(df, c, F.col("__te"), F.col("__freq"), enc, frequency).drop("__te", "__freq", "__value")
        return df.select(*[f"`{c}`" for c in given], *[f"`{c}`" for c in df.columns if c not in given])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), category_text(F.col(f"`{c}`")).alias("value")) for c in enc.columns])
    long = df.select(F.col(key).alias("__key"), *on[2:], F.inline(cells))
    found = lookup(long, table, on, "__rows").where(F.col("te").isNotNull())
    packed = found.groupBy("__key").agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("te", "freq")))).alias("__codes"))
    joined = df.join(packed.withColumnRenamed("__key", key), key, "left").select(*[f"`{c}`" for c in df.columns], "__codes")
    for c in enc.columns:
        code = F.col("__codes")[c]
        joined = _encoded(joined, c, code["te"], code["freq"], enc, frequency)
    return joined.drop("__codes")


def _encoded(df: DataFrame, c: str, te: Column, freq: Column, enc: Encoding, frequency: bool) -> DataFrame:
    df = df.withColumn(f"{c}__te", F.coalesce(te, F.lit(enc.prior)))
    return df.withColumn(f"{c}__freq", F.coalesce(freq, F.lit(0.0))) if frequency else df


def _fold_prior(enc: Encoding, fold: str) -> Column:
    if enc.fold_priors is None:
        return F.lit(enc.prior)
    pairs = [item for k, v in enc.fold_priors.items() for item in (F.lit(k), F.lit(v))]
    return F.coalesce(F.create_map(*pairs)[F.col(fold)], F.lit(enc.prior))


def label_codes(splits: Sequence[DataFrame], column: str, ranges: int | None = None) -> DataFrame:
    """(value, n, code): alphabetical codes over the values of every split."""
    domain = None
    for df in splits:
        part = df.select(category_text(F.col(f"`{column}`")).alias("value"))
        domain = part if domain is None else domain.unionByName(part)
    return materialize(dense_codes(domain, "value", ranges=ranges)[0], "codes")


def apply_codes(df: DataFrame, column: str, codes: DataFrame, out: str) -> DataFrame:
    table = codes.select(F.col("value").alias("__value"), "n", F.col("code").alias(out))
    return lookup(_category(df, column), table, ["__value"], "n").drop("__value")


def one_hot(df: DataFrame, column: str, max_levels: int = 20) -> DataFrame:
    """One 0/1 column per level of a low-cardinality column (more levels are an error)."""
    levels = [
        r["value"] for r in value_counts(df, [column]).select("value").orderBy("value").limit(max_levels + 1).collect()
    ]
    if len(levels) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} levels; use target or hash encoding")
    text = F.col(f"`{column}`").cast("string")
    return df.withColumns({f"{column}__{v}": F.coalesce(text == v, F.lit(False)).cast("int") for v in levels})


def one_hot_sparse(
    splits: Sequence[DataFrame], column: str, out: str | None = None, ranges: int | None = None
) -> tuple[list[DataFrame], int]:
    """Every split with a sparse 0/1 vector of a column's levels, and the number of levels over all splits.

    For any number of levels: a level's place is its alphabetical code, looked up by a join that is safe under skew, and a
    vector holds one entry.  A missing value is a level of its own.
    """
    codes = label_codes(splits, column, ranges)
    size = codes.count()
    out = out or f"{column}__onehot"
    coded = [apply_codes(df, column, codes, "__code") for df in splits]
    return [df.withColumn(out, unit_vector(F.col("__code"), size)).withMetadata(out, {"ml_attr": {"num_attrs": size}}).drop("__code")
            for df in coded], size


def unit_vector(place: Column, size: int) -> Column:
    """A sparse vector of ``size`` entries with a one at ``place``.

    ``OneHotEncoder`` gives the same vectors, but puts a name for each entry into the schema on the driver.
    """
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), F.array(place.cast("int")).alias("indices"),
        F.array(F.lit(1.0)).alias("values"),
    )
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))["v"]


def unit_place(vector: str) -> Column:
    """The place of a sparse vector's first entry, without making the vector dense."""
    return F.get_json_object(F.to_json(F.struct(F.col(vector).alias("v"))), "$.v.indices[0]").cast("int")


def fit_impute(df: DataFrame, numeric: Sequence[str], others: Sequence[str]) -> dict[str, object]:
    """Median per numeric column and smallest most frequent value per other column."""
    fill: dict[str, object] = {c: q[0] for c, q in exact_quantiles(df, numeric, [0.5]).items()}
    if others:
        modes = value_counts(df, others).groupBy("column").agg(
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")
        )
        fill.update({r["column"]: r["mode"] for r in modes.collect()})
    return fill


def apply_impute(df: DataFrame, fill: dict[str, object]) -> DataFrame:
    known = {c: v for c, v in fill.items() if v is not None}
    out = {}
    for c, v in known.items():
        kind = "double" if isinstance(v, float) else "string"
        out[c] = F.coalesce(F.col(f"`{c}`").cast(kind), F.lit(v))
    return df.withColumns(out) if out else df
