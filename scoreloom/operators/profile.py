"""Table profiling: shape, missingness, cardinality, distributions, target association."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.functions.scalar import mask_shape
from scoreloom.functions.stats import entropy_from_counts, percent, safe_corr, safe_kurtosis, safe_skewness
from scoreloom.operators.distinct import majority_shares, native_counts, single_valued, spread
from scoreloom.operators.gram import gram_corr_pairs
from scoreloom.operators.ordering import exact_quantiles
from scoreloom.session import one_row

PAIRS_PER_PASS = 300


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in skip]


def text_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]


def _as_text(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """A row per cell.  Adding zero makes the two floating zeros one value."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    texts = [
        (F.col(f"`{c}`") + F.lit(0.0).cast(df.schema[c].dataType) if c in floating else F.col(f"`{c}`")).cast("string").alias(c)
        for c in columns
    ]
    return df.select(*keep, *texts).unpivot(list(keep), list(columns), "column", "value")


def value_counts(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """(groups, column, value, n) without missing values, one shuffle for all columns of a type."""
    return native_counts(df, columns, groups).where(F.col("value").isNotNull())


def n_unique(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact distinct non-null values per column, columns without any value included as 0."""
    counts = native_counts(df, list(columns or df.columns))
    return counts.groupBy("column").agg(F.count("value").alias("n_unique"))


def column_facts(df: DataFrame, columns: Sequence[str], *extra: Column) -> DataFrame:
    """(column, n_rows, n_missing, n_unique, extra...) from one shuffle for all columns of a type.

    ``extra`` are aggregates over the (value, n) rows of a column, its missing group included.
    """
    return native_counts(df, columns).groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
        F.count("value").alias("n_unique"),
        *extra,
    )


def _one_row_to_long(row: DataFrame, columns: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Turn one wide aggregate row named ``<measure>|<position>`` into a row per column."""
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{m}|{i}`").alias(m) for m in measures])
        for i, c in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*entries)))


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_missing, n_rows, pct_missing) from one map-side aggregate."""
    columns = list(columns or df.columns)
    wide = df.agg(
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n_missing|{i}") for i, c in enumerate(columns)],
        *[F.count("*").alias(f"n_rows|{i}") for i in range(len(columns))],
    )
    long = _one_row_to_long(wide, columns, ["n_missing", "n_rows"])
    return long.withColumn("pct_missing", F.round(percent(F.col("n_missing"), F.col("n_rows")), 2))


def missing_summary(df: DataFrame) -> DataFrame:
    return missing_counts(df).where(F.col("n_missing") > 0)


def table_shape(df: DataFrame) -> DataFrame:
    """(column, dtype, position, n_rows, n_columns)."""
    layout = df.sparkSession.createDataFrame(
        [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)], "position int, column string, dtype string"
    )
    return layout.withColumns(
        {"n_rows": df.agg(F.count("*")).scalar(), "n_columns": F.lit(len(df.columns))}
    )


def head_rows(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    return df.orderBy(*order).limit(n)


def feature_types(
    df: DataFrame,
    target: str | None = None,
    numeric_levels: int = 20,
    numeric_share: float = 0.05,
    low_share: float = 0.05,
    medium_share: float = 0.5,
    exact: bool = True,
) -> DataFrame:
    """Type of every column but the target, from cardinality, row count and declared type.

    Without ``exact``, sketches decide every column that is clear of the thresholds: the types are the same, ``n_unique``
    of such columns is an estimate, and their cells are not moved.
    """
    columns = [c for c in df.columns if c != target]
    kinds = {
        f.name: "number" if is_numeric(f.dataType) else "time" if isinstance(
            f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)
        ) else "text"
        for f in df.schema.fields
    }
    dtypes = dict(df.dtypes)
    declared = df.sparkSession.createDataFrame(
        [(c, kinds[c], dtypes[c]) for c in columns], "column string, kind string, dtype string"
    )
    if exact:
        facts = column_facts(df, columns)
    else:
        def cuts(c: str, rows: int) -> list[float]:
            return [2, numeric_levels, numeric_share * rows] if kinds[c] == "number" else [2, low_share * rows, medium_share * rows]

        found = spread(df, columns, cuts)
        facts = df.sparkSession.createDataFrame(
            [(c, s.rows, s.rows - s.present, s.distinct) for c, s in found.items()],
            "column string, n_rows long, n_missing long, n_unique long",
        )
    facts = facts.join(F.broadcast(declared), "column")
    facts = facts.withColumn("pct_missing", F.round(percent(F.col("n_missing"), F.col("n_rows")), 2))
    unique, share = F.col("n_unique"), F.try_divide(F.col("n_unique").cast("double"), F.col("n_rows").cast("double"))
    kind = (
        F.when(unique <= 1, "constant")
        .when(unique == 2, "binary")
        .when((F.col("kind") == "number") & (unique < numeric_levels) & (share < numeric_share), "categorical_numeric")
        .when(F.col("kind") == "number", "numeric")
        .when(F.col("kind") == "time", "datetime")
        .when(share < low_share, "categorical_low_cardinality")
        .when(share < medium_share, "categorical_medium_cardinality")
        .otherwise("categorical_high_cardinality")
    )
    return facts.select("column", kind.alias("type"), "n_unique", "n_missing", "pct_missing", "dtype")


def type_counts(types: DataFrame) -> DataFrame:
    return types.groupBy("type").agg(F.count("*").alias("n"))


def target_balance(df: DataFrame, target: str) -> DataFrame:
    """(value, n, class_balance, n_classes, n_missing), one row per class."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    present = counts.where(F.col(target).isNotNull())
    overall = one_row(counts.agg(
        F.round(
            F.try_divide(
                F.min(F.when(F.col(target).isNotNull(), F.col("n"))).cast("double"),
                F.max(F.when(F.col(target).isNotNull(), F.col("n"))).cast("double"),
            ),
            4,
        ).alias("class_balance"),
        F.count(target).alias("n_classes"),
        F.coalesce(F.sum(F.when(F.col(target).isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
    ))
    return present.select(
        F.col(target).cast("string").alias("value"), "n",
        *[overall.getField(f).alias(f) for f in ("class_balance", "n_classes", "n_missing")],
    )


def _literal_rows(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """A per-column report (as many rows as the table has columns)."""
    return df.sparkSession.createDataFrame(rows, schema)


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per numeric column."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    table = _literal_rows(
        df, [(c, *quartiles[c]) for c in columns], "column string, q25 double, median double, q75 double"
    )
    return _moments(df, columns).join(F.broadcast(table), "column").select(
        "column", "count", "mean", "std", "min", "q25", "median", "q75", "max"
    )


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    measures: dict[str, object] = {
        "count": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
        "skewness": safe_skewness,
        "kurtosis": safe_kurtosis,
        "missing": lambda c: F.count_if(c.isNull()),
        "zeros_pct": lambda c: percent(F.count_if(c == 0), F.count(c)),
        "negative_pct": lambda c: percent(F.count_if(c < 0), F.count(c)),
    }
    wide = df.agg(
        *[
            measure(F.col(f"`{c}`").cast("double")).alias(f"{name}|{i}")
            for name, measure in measures.items()
            for i, c in enumerate(columns)
        ]
    )
    return _one_row_to_long(wide, columns, list(measures))


def outlier_counts(df: DataFrame, quartiles: dict[str, list[float | None]]) -> DataFrame:
    """Rows outside Q1 - 1.5 IQR .. Q3 + 1.5 IQR; ``quartiles`` maps a column to (q25, ..., q75)."""
    columns = list(quartiles)

    def outside(c: str) -> Column:
        low, high = quartiles[c][0], quartiles[c][-1]
        if low is None:
            return F.lit(False)
        fence = 1.5 * (high - low)
        value = F.col(f"`{c}`").cast("double")
        return (value < F.lit(low - fence)) | (value > F.lit(high + fence))

    wide = df.agg(*[F.count_if(outside(c)).alias(f"outlier_count|{i}") for i, c in enumerate(columns)])
    return _one_row_to_long(wide, columns, ["outlier_count"])


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Sixteen-field profile; a column without any value carries only ``error``."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    table = _literal_rows(
        df,
        [(c, *q, None if q[0] is None else q[2] - q[0]) for c, q in quartiles.items()],
        "column string, q25 double, median double, q75 double, iqr double",
    )
    outliers = outlier_counts(df, quartiles)
    joined = _moments(df, columns).join(F.broadcast(table), "column").join(F.broadcast(outliers), "column")
    filled = F.col("count") > 0
    return joined.select(
        "column",
        F.lit("numeric").alias("type"),
        "count",
        "missing",
        "mean",
        "std",
        "min",
        "max",
        "median",
        F.when(filled, F.col("skewness")).alias("skewness"),
        F.when(filled, F.col("kurtosis")).alias("kurtosis"),
        "q25",
        "q75",
        "iqr",
        "zeros_pct",
        "negative_pct",
        F.when(filled, F.col("outlier_count")).alias("outlier_count"),
        F.when(~filled, "All values missing").alias("error"),
    )


def profile_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, missing, n_unique, entropy in nats, share of the most common value."""
    columns = list(columns or text_columns(df))
    seen = F.when(F.col("value").isNotNull(), F.col("n"))
    facts = column_facts(
        df, columns, entropy_from_counts(seen).alias("entropy"), percent(F.max(seen), F.sum(seen)).alias("most_common_pct")
    )
    filled = F.col("n_unique") > 0
    return facts.select(
        "column",
        F.lit("categorical").alias("type"),
        (F.col("n_rows") - F.col("n_missing")).alias("count"),
        F.col("n_missing").alias("missing"),
        "n_unique",
        F.when(filled, F.col("entropy")).alias("entropy"),
        "most_common_pct",
        F.when(~filled, "All values missing").alias("error"),
    )


def top_categories(df: DataFrame, columns: Sequence[str] | None = None, k: int = 50) -> DataFrame:
    """The ``k`` most frequent values of each column; each task keeps only ``k`` before the shuffle."""
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    ranked = value_counts(df, list(columns or text_columns(df))).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k)


def target_corr(df: DataFrame, columns: Sequence[str], target: str, zero_fill: bool = False) -> DataFrame:
    """(column, corr) with the target; ``zero_fill`` gives the absolute zero-filled variant."""
    y = F.col(target).cast("double")

    def one(c: str) -> Column:
        x = F.col(f"`{c}`").cast("double")
        if zero_fill:
            return F.coalesce(F.abs(safe_corr(F.coalesce(x, F.lit(0.0)), y)), F.lit(0.0))
        return safe_corr(x, y)

    wide = df.agg(*[one(c).alias(f"corr|{i}") for i, c in enumerate(columns)])
    return _one_row_to_long(wide, columns, ["corr"])


def top_corr(corr: DataFrame, k: int = 10) -> DataFrame:
    """Strongest ``k`` positive and ``k`` negative correlations with their side and rank."""
    sides = []
    for side, keep in (("positive", F.col("corr") > 0), ("negative", F.col("corr") < 0)):
        best = corr.where(keep).orderBy(F.desc(F.abs("corr")), "column").limit(k)
        order = Window.orderBy(F.desc(F.abs("corr")), "column")
        sides.append(best.select("column", "corr", F.lit(side).alias("side"), F.row_number().over(order).alias("rank")))
    return sides[0].unionByName(sides[1])


def top_features(df: DataFrame, columns: Sequence[str], target: str, k: int = 8) -> list[str]:
    """Names of the ``k`` columns with the largest zero-filled absolute target correlation."""
    ranked = target_corr(df, columns, target, zero_fill=True).orderBy(F.desc("corr"), "column").limit(k)
    return [r["column"] for r in ranked.collect()]


def corr_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, corr) absolute pairwise correlations of the upper triangle, from one scan.

    Up to ``PAIRS_PER_PASS`` pairs are aggregate expressions; more come from blocked Gram matrices.
    """
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string, a_idx int, b_idx int, corr double")
    if len(pairs) > PAIRS_PER_PASS:
        return gram_corr_pairs(df, columns)
    spot = {c: i for i, c in enumerate(columns)}
    wide = df.agg(
        *[
            F.abs(safe_corr(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double"))).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(spot[a]).alias("a_idx"),
                F.lit(spot[b]).alias("b_idx"), F.col(f"p{i}").alias("corr"),
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(F.inline(rows))


def cat_target_assoc(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, value, n, rate): class balance inside each category."""
    long = _as_text(df, columns, [target]).where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(
        F.count("*").alias("n"), F.avg(F.col(target).cast("double")).alias("rate")
    )


def red_flags(
    df: DataFrame, columns: Sequence[str], target: str, rare_share: float = 0.01, many_levels: int = 1000,
    minority_share: float = 0.01,
) -> DataFrame:
    """(column, flag, n): rare categories, too many levels, extreme imbalance."""
    counts = value_counts(df, columns)
    per_column = counts.groupBy("column").agg(F.sum("n").alias("rows"), F.count("*").alias("levels"))
    rare = (
        counts.join(F.broadcast(per_column), "column")
        .where(F.col("n") < F.col("rows") * rare_share)
        .groupBy("column")
        .agg(F.lit("rare_categories").alias("flag"), F.count("*").alias("n"))
    )
    wide = per_column.where(F.col("levels") > many_levels).select(
        "column", F.lit("high_cardinality").alias("flag"), F.col("levels").alias("n")
    )
    classes = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count("*").alias("n"))
    imbalance = classes.agg(F.min("n").alias("low"), F.sum("n").alias("rows")).where(
        F.col("low") < F.col("rows") * minority_share
    ).select(F.lit(target).alias("column"), F.lit("extreme_imbalance").alias("flag"), F.col("low").alias("n"))
    return rare.unionByName(wide).unionByName(imbalance)


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def format_masks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mask, n): how many values share each letter/digit shape."""
    long = _as_text(df, columns).where(F.col("value").isNotNull())
    return long.groupBy("column", mask_shape("value").alias("mask")).agg(F.count("*").alias("n"))


def top_value_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_unique, top_share): share of the most frequent value among all rows."""
    return native_counts(df, list(columns or df.columns)).groupBy("column").agg(
        F.count("value").alias("n_unique"),
        F.try_divide(
            F.coalesce(F.max(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).cast("double"),
            F.sum("n").cast("double"),
        ).alias("top_share"),
    )


def quasi_constant_columns(df: DataFrame, share: float = 0.99, skip: Sequence[str] = ()) -> list[str]:
    """Constant columns and those whose top value covers more than ``share`` of the rows."""
    columns = [c for c in df.columns if c not in skip]
    if not columns:
        return []
    names = set(single_valued(df, columns))
    rest = [c for c in columns if c not in names]
    if share >= 0.5:
        names |= {c for c, top in majority_shares(df, rest, share).items() if top is not None}
    else:
        names |= {r["column"] for r in top_value_share(df, rest).where(F.col("top_share") > share).collect()}
    return [c for c in columns if c in names]


def dataset_summary(df: DataFrame, numeric: Sequence[str], cats: Sequence[str], target: str,
                    groups: Sequence[str] = ()) -> DataFrame:
    """Rows, features, mean missing rate, class balance, feature ratio and size class."""
    features = [*numeric, *cats]
    rate = sum((F.avg(F.col(f"`{c}`").isNull().cast("double")) for c in features[1:]),
               F.avg(F.col(f"`{features[0]}`").isNull().cast("double"))) / len(features)
    ones, zeros = F.count_if(F.col(target) == 1), F.count_if(F.col(target) == 0)
    facts = df.groupBy(*groups).agg(
        F.count("*").alias("n_samples"),
        rate.alias("missing_pct"),
        F.try_divide(F.least(ones, zeros).cast("double"), F.greatest(ones, zeros).cast("double")).alias("class_balance"),
    )
    n = F.col("n_samples")
    size = F.when(n < 1000, "tiny").when(n < 5000, "small").when(n < 20000, "medium").otherwise("large")
    return facts.select(
        *groups,
        "n_samples",
        F.lit(len(features)).cast("bigint").alias("n_features"),
        F.lit(len(numeric)).cast("bigint").alias("n_numeric"),
        F.lit(len(cats)).cast("bigint").alias("n_categorical"),
        "missing_pct",
        "class_balance",
        F.try_divide(F.lit(float(len(features))), n.cast("double")).alias("ratio"),
        size.alias("size_category"),
    )


def compare_splits(train: DataFrame, test: DataFrame, target: str | None = None) -> DataFrame:
    """Types and missingness of each column in both splits, side by side."""
    left = feature_types(train, target).select(
        "column", F.col("type").alias("train_type"), F.col("n_unique").alias("train_unique"),
        F.col("n_missing").alias("train_missing"),
    )
    right = feature_types(test, target).select(
        "column", F.col("type").alias("test_type"), F.col("n_unique").alias("test_unique"),
        F.col("n_missing").alias("test_missing"),
    )
    return left.join(right, "column", "full")


def compare_datasets(datasets: dict[str, DataFrame], target: str) -> DataFrame:
    """Per column: in how many datasets it appears and with how many distinct types."""
    reports = None
    for name, df in datasets.items():
        one = feature_types(df, target).withColumn("dataset", F.lit(name))
        reports = one if reports is None else reports.unionByName(one)
    return reports.groupBy("column").agg(
        F.count("*").alias("n_datasets"),
        F.count_distinct("type").alias("n_types"),
        F.sum("n_missing").alias("n_missing"),
        F.avg(F.col("n_unique").cast("double")).alias("mean_unique"),
    )


def leakage_flags(corr: DataFrame, auc: DataFrame, corr_above: float = 0.95, auc_above: float = 0.99) -> DataFrame:
    """Columns that alone almost reproduce the target."""
    strength = F.greatest(F.col("auc"), 1 - F.col("auc"))
    return (
        corr.join(auc, "column")
        .withColumn("single_auc", strength)
        .where((F.abs("corr") > corr_above) | (F.col("single_auc") > auc_above))
        .select("column", "corr", "single_auc")
    )
