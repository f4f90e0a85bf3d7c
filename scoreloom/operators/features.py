"""Feature engineering: statistics are fitted once on train, then every split gets the same projection."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.scalar import (
    bin_index,
    datetime_cycles,
    datetime_parts,
    missing_flag,
    row_max,
    row_mean,
    row_min,
    row_std,
    width_edges,
)
from scoreloom.operators.lookup import lookup
from scoreloom.operators.ordering import exact_quantiles, with_rank_fractions
from scoreloom.session import materialize


def _col(c: str) -> Column:
    return F.col(f"`{c}`").cast("double")


def column_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, dict[str, float | None]]:
    """missing rate, mean, both standard deviations, min and max per column: one aggregate, one row."""
    measures: dict[str, Callable[[str], Column]] = {
        "missing": lambda c: F.avg(F.col(f"`{c}`").isNull().cast("double")),
        "mean": lambda c: F.avg(_col(c)),
        "std": lambda c: F.stddev_samp(_col(c)),
        "std_pop": lambda c: F.stddev_pop(_col(c)),
        "min": lambda c: F.min(_col(c)),
        "max": lambda c: F.max(_col(c)),
    }
    if not columns:
        return {}
    row = df.agg(
        *[make(c).alias(f"{name}|{i}") for name, make in measures.items() for i, c in enumerate(columns)]
    ).first()
    return {c: {name: row[f"{name}|{i}"] for name in measures} for i, c in enumerate(columns)}


def missing_rates(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    row = df.agg(
        *[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"r{i}") for i, c in enumerate(columns)]
    ).first()
    return {c: row[f"r{i}"] or 0.0 for i, c in enumerate(columns)}


def missing_flags(
    df: DataFrame, rates: dict[str, float], above: float = 0.05, suffix: str = "__is_missing"
) -> DataFrame:
    """Flag columns whose training missing rate exceeds ``above``."""
    flags = {f"{c}{suffix}": missing_flag(F.col(f"`{c}`")) for c, rate in rates.items() if rate > above}
    return df.withColumns(flags) if flags else df


def log_features(df: DataFrame, stats: dict[str, dict], limit: int | None = None) -> DataFrame:
    """``log1p`` of columns whose training minimum is not negative."""
    use = [c for c in list(stats)[:limit] if stats[c]["min"] is not None and stats[c]["min"] >= 0]
    return df.withColumns({f"{c}__log": F.when(_col(c) > -1, F.log1p(_col(c))) for c in use}) if use else df


def sqrt_features(df: DataFrame, stats: dict[str, dict], limit: int | None = None) -> DataFrame:
    use = [c for c in list(stats)[:limit] if stats[c]["min"] is not None and stats[c]["min"] >= 0]
    return df.withColumns({f"{c}__sqrt": F.when(_col(c) >= 0, F.sqrt(_col(c))) for c in use}) if use else df


def triangle_pairs(columns: Sequence[str], rows: int, cols: int) -> list[tuple[str, str]]:
    """Pairs (i, j) with i < ``rows``, j < ``cols`` and i < j."""
    return [(columns[i], columns[j]) for i, j in combinations(range(min(cols, len(columns))), 2) if i < rows]


def neighbour_pairs(columns: Sequence[str], reach: int = 2) -> list[tuple[str, str]]:
    """Each column with the next ``reach`` columns."""
    return [(a, b) for (i, a), (j, b) in combinations(enumerate(columns), 2) if j - i <= reach]


def interactions(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.withColumns({f"{a}__x__{b}": _col(a) * _col(b) for a, b in pairs}) if pairs else df


def differences(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.withColumns({f"{a}__minus__{b}": _col(a) - _col(b) for a, b in pairs}) if pairs else df


def ratios(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.withColumns({f"{a}__over__{b}": F.try_divide(_col(a), _col(b)) for a, b in pairs}) if pairs else df


def row_aggregates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, sample std, max and min across columns, missing values skipped."""
    columns = list(columns)
    return df.withColumns(
        {
            "__row_mean": row_mean(columns),
            "__row_std": row_std(columns),
            "__row_max": row_max(columns),
            "__row_min": row_min(columns),
        }
    )


def zscore(df: DataFrame, stats: dict[str, dict], limit: int | None = None, suffix: str = "__zscore",
           ddof: int = 1) -> DataFrame:
    """Standard score with training mean and deviation; constant columns are left out."""
    spread = "std" if ddof else "std_pop"
    use = [c for c in list(stats)[:limit] if stats[c][spread]]
    out = {f"{c}{suffix}": (_col(c) - F.lit(stats[c]["mean"])) / F.lit(stats[c][spread]) for c in use}
    return df.withColumns(out) if out else df


def standard_scale(df: DataFrame, stats: dict[str, dict]) -> DataFrame:
    """Population-deviation scaling; a constant column becomes 0."""
    return df.withColumns(
        {c: (_col(c) - F.lit(s["mean"])) / F.lit(s["std_pop"] or 1.0) for c, s in stats.items()}
    )


def minmax_scale(df: DataFrame, stats: dict[str, dict]) -> DataFrame:
    out = {}
    for c, s in stats.items():
        width = (s["max"] - s["min"]) if s["max"] is not None else 0.0
        out[c] = (_col(c) - F.lit(s["min"])) / F.lit(width or 1.0)
    return df.withColumns(out)


def rank_features(
    df: DataFrame, columns: Sequence[str], limit: int | None = None, key: str | None = None, ranges: int | None = None
) -> DataFrame:
    """``<c>__rank``: tie-averaged rank over the non-null count of this split."""
    return with_rank_fractions(df, list(columns)[:limit], "__rank", key, ranges)


def quantile_edges(df: DataFrame, columns: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Distinct quantile edges per column."""
    quantiles = exact_quantiles(df, columns, [i / bins for i in range(bins + 1)])
    return {c: list(dict.fromkeys(v for v in q if v is not None)) for c, q in quantiles.items()}


def equal_width_edges(stats: dict[str, dict], bins: int = 10) -> dict[str, list[float]]:
    return {c: width_edges(s["min"], s["max"], bins) for c, s in stats.items() if s["min"] is not None}


def bin_features(df: DataFrame, edges: dict[str, list[float]], suffix: str = "__bin10") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": bin_index(F.col(f"`{c}`"), e) for c, e in edges.items()}) if edges else df


def add_datetime_parts(df: DataFrame, columns: Sequence[str], cyclical: bool = False) -> DataFrame:
    for c in columns:
        df = df.withColumns(datetime_cycles(c) if cyclical else datetime_parts(c))
    return df


def group_features(df: DataFrame, key: str, values: Sequence[str], like: DataFrame | None = None) -> DataFrame:
    """Mean and deviation-from-mean of each value inside the row's category.

    Means come from a map-side-combined aggregate and a skew-safe lookup, so a category that holds
    a third of the rows never has to fit in one window.
    """
    base = like if like is not None else df
    table = materialize(
        base.groupBy(key).agg(F.count("*").alias("__n"), *[F.avg(_col(v)).alias(f"{v}__mean_by_{key}") for v in values]),
        "group_means",
    )
    joined = lookup(df, table, [key], "__n")
    return joined.withColumns({f"{v}__dev_by_{key}": _col(v) - F.col(f"{v}__mean_by_{key}") for v in values})


def pool(datasets: Sequence[DataFrame], id_column: str = "__dataset_id") -> DataFrame:
    """Stack tables whose columns may differ, numbered in order."""
    pooled = None
    for i, df in enumerate(datasets):
        part = df.withColumn(id_column, F.lit(i))
        pooled = part if pooled is None else pooled.unionByName(part, allowMissingColumns=True)
    return pooled


def pooled_stats(pooled: DataFrame, columns: Sequence[str]) -> dict[str, dict[str, float | None]]:
    stats = column_stats(pooled, columns)
    quantiles = exact_quantiles(pooled, columns, [0.25, 0.5, 0.75])
    return {
        c: {"mean": s["mean"], "std": s["std"], "q25": q[0], "median": q[1], "q75": q[2]}
        for (c, s), q in zip(stats.items(), (quantiles[c] for c in stats))
    }


def pooled_features(df: DataFrame, stats: dict[str, dict]) -> DataFrame:
    """Deviation from the pooled mean and pooled standard score."""
    out = {}
    for c, s in stats.items():
        if c in df.columns and s["mean"] is not None:
            out[f"{c}__dev_from_global_mean"] = _col(c) - F.lit(s["mean"])
            if s["std"]:
                out[f"{c}__global_zscore"] = (_col(c) - F.lit(s["mean"])) / F.lit(s["std"])
    return df.withColumns(out) if out else df
