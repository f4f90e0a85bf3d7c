"""Sinks and their readers: predictions, reports, trials, ledger, fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators.ledger import LEDGER_SCHEMA, add_run

PREDICTION_SCHEMA = "row_id string, y int, p double, model string, split string"
#: Files that a task writes at once, and the bytes each may hold back; more folders than that in one task are sorted.
OPEN_FILES = 16
ROW_GROUP = 16 << 20
TRIAL_SCHEMA = "model string, trial int, params string, score double"


def save_predictions(preds: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Partitioned by model and split, so reading one family opens only its folders.

    Only the folders of the models and splits in ``preds`` are replaced: saving a family again leaves one copy.  A task keeps
    up to ``OPEN_FILES`` folders' files open, so that its rows need not be sorted, and spilled, by folder.
    """
    conf, name = preds.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name, None)
    conf.set(name, str(OPEN_FILES))
    try:
        writer = preds.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        writer = writer.option("compression", "zstd").option("parquet.block.size", ROW_GROUP)
        writer.partitionBy("model", "split").parquet(path)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def load_predictions(
    spark: SparkSession, path: str, models: Sequence[str] | None = None, split: str | None = None
) -> DataFrame:
    preds = spark.read.parquet(path)
    if models is not None:
        preds = preds.where(F.col("model").isin(list(models)))
    return preds.where(F.col("split") == split) if split is not None else preds


def save_report(report: DataFrame, path: str, kind: str = "json") -> None:
    """Exploration, profile, validation and selection reports."""
    report.write.mode("overwrite").format(kind).save(path)


def load_report(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return spark.read.format(kind).load(path)


def append_trials(trials: DataFrame, path: str) -> None:
    trials.write.mode("append").parquet(path)


def load_trials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRIAL_SCHEMA).parquet(path)


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The run table, empty when nothing has been written yet."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def append_run(spark: SparkSession, path: str, **run: object) -> None:
    add_run(load_ledger(spark, path), **run).write.mode("append").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
