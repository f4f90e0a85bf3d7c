"""Readers: declared or once-inferred schema, missing values as NULL, stable row positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.functions.scalar import nan_to_null
from scoreloom.session import materialize


def nulls_for_nans(df: DataFrame) -> DataFrame:
    """Floating NaN means missing in the inputs, so it becomes NULL right after reading."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in floats}) if floats else df


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nulls_for_nans(spark.read.parquet(path))


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header.  Without ``schema`` the types are inferred by one extra pass: keep the result's
    schema and hand it to later reads."""
    reader = spark.read.option("header", True).option("nanValue", "nan").option("enforceSchema", False)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nulls_for_nans(reader.csv(path))


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def with_positions(df: DataFrame, out: str = "pos") -> DataFrame:
    """Dense 0-based row positions by file name, place in the file and row, for templates whose row order is contractual.

    ``df`` must be a plain scan of files.  Spark deals splits out by size, so the numbers it gives rows only order the rows
    inside a split.  The stamped rows are stored, as another scan may be split in another way.  One row per split holds where
    the split begins; that table is stored too, so that the join knows its size.
    """
    if not df.inputFiles():
        return df.withColumn(out, F.lit(0).cast("bigint"))
    stamped = materialize(df.select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__at"),
    ), "stamped")
    splits = stamped.groupBy("__file", "__block").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(
        splits.select("__file", "__block", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")), "splits"
    )
    place = (F.col("__start") + F.col("__at") - F.col("__first")).alias(out)
    return stamped.join(starts, ["__file", "__block"]).select(*df.columns, place)
