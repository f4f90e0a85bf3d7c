"""Resolving and applying column roles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.functions.scalar import ORDINAL_PATTERN, category_text, finite_or_zero, ordinal_number
from scoreloom.operators.distinct import spread
from scoreloom.operators.profile import is_numeric, numeric_columns, text_columns
from scoreloom.roles import Roles
from scoreloom.session import one_row


def resolve_id(df: DataFrame, template: DataFrame | None = None) -> str:
    for name in ("row_id", "id"):
        if name in df.columns:
            return name
    source = template if template is not None else df
    return next(c for c in source.columns if c != "pos")


def _exactly_two(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, is_binary): min and max differ and no third value exists.

    Two cheap aggregates instead of a distinct count: bounds first, then a test for anything else.
    """
    columns = list(columns)
    bounds = df.agg(
        *[F.min(f"`{c}`").alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(f"`{c}`").alias(f"hi{i}") for i, c in enumerate(columns)],
    )
    limits = one_row(bounds)
    wide = df.agg(
        *[
            F.bool_and(
                (F.col(f"`{c}`") == limits.getField(f"lo{i}")) | (F.col(f"`{c}`") == limits.getField(f"hi{i}"))
            ).alias(f"b{i}")
            for i, c in enumerate(columns)
        ],
        *[(F.min(f"`{c}`") != F.max(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                 F.coalesce(F.col(f"b{i}") & F.col(f"d{i}"), F.lit(False)).alias("is_binary"))
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def binary_columns(df: DataFrame, mode: str = "numeric", skip: Sequence[str] = ()) -> DataFrame:
    """Columns with exactly two distinct values, in schema order.

    ``numeric`` looks at numbers and booleans only, ``scalar`` adds text, ``any`` looks at all.
    """
    def admitted(t: T.DataType) -> bool:
        if mode == "numeric":
            return is_numeric(t)
        return mode == "any" or is_numeric(t) or isinstance(t, T.StringType)

    columns = [f.name for f in df.schema.fields if f.name not in skip and admitted(f.dataType)]
    return _exactly_two(df, columns).where("is_binary").select("position", "column")


def detect_target(df: DataFrame, id_col: str | None, mode: str = "numeric") -> DataFrame:
    """One row naming the target: a column called ``target``, else the first binary column."""
    if mode == "numeric" and "target" in df.columns:
        return df.sparkSession.createDataFrame([("target",)], "target string")
    skip = [id_col] if id_col and mode == "numeric" else []
    found = binary_columns(df, mode, skip)
    return found.agg(F.min_by("column", "position").alias("target"))


def prediction_column(template: DataFrame, target: str | None) -> str:
    """Second template column (``pos`` is bookkeeping), else the target."""
    columns = [c for c in template.columns if c != "pos"]
    return columns[1] if len(columns) > 1 else (target or columns[0])


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull())


def ordinal_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Text columns whose every value looks like ``ord_<number>`` (and at least one exists)."""
    if not columns:
        return []
    row = df.agg(
        *[F.bool_and(F.col(f"`{c}`").rlike(ORDINAL_PATTERN)).alias(f"o{i}") for i, c in enumerate(columns)]
    ).first()
    return [c for i, c in enumerate(columns) if row[f"o{i}"]]


def parse_ordinals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: ordinal_number(F.col(f"`{c}`")) for c in columns}) if columns else df


def _is_zero_one(df: DataFrame, target: str) -> bool:
    """Whether the target holds 0 and 1 alone; a target of two other values is mapped to them, the larger one being 1."""
    levels = [r[0] for r in df.select(target).distinct().limit(3).collect()]
    return len(levels) != 2 or {str(v).removesuffix(".0") for v in levels} in ({"0", "1"}, {"False", "True"})


def load_roles(
    train: DataFrame, test: DataFrame, template: DataFrame
) -> tuple[Roles, DataFrame, DataFrame]:
    """Resolve roles once, drop rows without a target, parse ordinals on both splits."""
    id_col = resolve_id(train, template)
    target = detect_target(train, id_col).first()["target"]
    labelled = drop_null_target(train, target)
    if not _is_zero_one(labelled, target):
        labelled = binarize_target(labelled, target, target)
    features = [c for c in train.columns if c not in (id_col, target)]
    texts = [c for c in features if not is_numeric(train.schema[c].dataType)]
    ordinals = ordinal_columns(labelled, [c for c in texts if isinstance(train.schema[c].dataType, T.StringType)])
    numeric = tuple(c for c in features if c in ordinals or is_numeric(train.schema[c].dataType))
    cats = tuple(c for c in texts if c not in ordinals)
    roles = Roles(id_col, target, prediction_column(template, target), numeric, cats)
    ready = parse_ordinals(labelled, ordinals).select(id_col, F.col(target).cast("int").alias(target), *features)
    aligned = parse_ordinals(align_columns(test, train, [id_col, *features]), ordinals)
    return roles, ready, aligned


def align_columns(df: DataFrame, like: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Select ``columns`` in order with the types of ``like``; absent ones become NULL."""
    return df.select(
        *[
            (F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(like.schema[c].dataType).alias(c)
            for c in columns
        ]
    )


def project_features(df: DataFrame, roles: Roles) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in (roles.id, roles.target)])


def split_types(df: DataFrame, skip: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, text) column names from the schema alone."""
    return numeric_columns(df, skip), text_columns(df, skip)


def drop_cats(df: DataFrame, cats: Sequence[str]) -> DataFrame:
    return df.drop(*cats)


def cat_frame(df: DataFrame, cats: Sequence[str]) -> DataFrame:
    return df.withColumns({c: category_text(F.col(f"`{c}`")) for c in cats})


def numeric_only(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *numeric_columns(df, keep))


def clean_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: finite_or_zero(F.col(f"`{c}`")) for c in columns})


def id_like_columns(df: DataFrame, share: float = 0.9, skip: Sequence[str] = ()) -> list[str]:
    """Text columns whose distinct values exceed ``share`` of the rows."""
    columns = text_columns(df, skip)
    if not columns:
        return []
    found = spread(df, columns, lambda _, rows: [rows * share])
    return [c for c in columns if found[c].distinct > found[c].rows * share]


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """(class, n, weight) with weight n_rows / (n_classes * n_class)."""
    counts = df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("class")).agg(F.count("*").alias("n"))
    overall = one_row(counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes")))
    weight = overall.getField("rows").cast("double") / (overall.getField("classes") * F.col("n"))
    return counts.select("class", "n", weight.alias("weight"))


def binarize_target(df: DataFrame, target: str, out: str) -> DataFrame:
    """Map a two-valued target to 0/1, the larger value being 1."""
    top = df.agg(F.max(target)).scalar()
    return df.withColumn(out, F.when(F.col(target).isNotNull(), (F.col(target) == top).cast("int")))
