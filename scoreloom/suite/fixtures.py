"""Feature tables derived from the test tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators.folds import assign_folds
from scoreloom.sources.tables import scan_parquet

SPLIT_DATE = "1999-01-01"
LINE_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
DOC_NUMERIC = ("n_chars", "alpha", "digits", "n_words")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf}/{name}.parquet")


def line_id():
    """The shortest key that is unique at every size."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return F.concat_ws("-", *[F.col(k).cast("string") for k in keys], cents.cast("string"))


LINE_ID_SQL = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT))"
)


def line(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        line_id().alias("id"), *LINE_NUMERIC, "l_returnflag", "l_shipdate",
        (F.col("l_linestatus") == "F").cast("int").alias("target"),
    )


LINE = f"""line AS (
  SELECT {LINE_ID_SQL} AS id, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_shipdate,
         CAST(l_linestatus = 'F' AS INTEGER) AS target
  FROM lineitem)"""


def nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with missing values put in every kind of column."""
    return table(spark, sf, "lineitem").select(
        line_id().alias("id"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice",
        "l_discount",
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_linenumber") != 1, F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_discount") < 0.1, (F.col("l_linestatus") == "F").cast("int")).alias("target"),
    )


NULLS = f"""nulls AS (
  SELECT {LINE_ID_SQL} AS id,
         CASE WHEN l_linenumber <> 7 THEN l_quantity END AS l_quantity, l_extendedprice, l_discount,
         CASE WHEN l_tax <> 0 THEN l_tax END AS l_tax,
         CASE WHEN l_linenumber <> 1 THEN l_returnflag END AS l_returnflag,
         CASE WHEN l_discount < 0.1 THEN CAST(l_linestatus = 'F' AS INTEGER) END AS target
  FROM lineitem)"""


def orders(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    joined = table(spark, sf, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        F.col("o_orderkey").alias("row_id"), "o_totalprice", "c_acctbal", "c_mktsegment", "n_name",
        F.concat(F.lit("ord_"), F.substring("o_orderpriority", 1, 1)).alias("priority"), "o_orderdate",
        (F.col("o_orderstatus") == "F").cast("int").alias("target"),
    )


ORD = """ord AS (
  SELECT o_orderkey AS row_id, o_totalprice, c_acctbal, c_mktsegment, n_name,
         'ord_' || substr(o_orderpriority, 1, 1) AS priority, o_orderdate,
         CAST(o_orderstatus = 'F' AS INTEGER) AS target
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def order_splits(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, test, template): later orders are the unlabelled ones."""
    everything = orders(spark, sf)
    later = F.col("o_orderdate") >= F.lit(SPLIT_DATE).cast("timestamp_ntz")
    test = everything.where(later).drop("target")
    template = test.select(F.col("row_id").alias("pos"), "row_id", F.lit(0.5).alias("target"))
    return everything.where(~later), test, template


TRAIN = f"train AS (SELECT * FROM ord WHERE o_orderdate < TIMESTAMP '{SPLIT_DATE}')"
TEST = f"test AS (SELECT * EXCLUDE (target) FROM ord WHERE o_orderdate >= TIMESTAMP '{SPLIT_DATE}')"


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with text statistics; texts are reduced to numbers before the join, run by run of characters."""
    texts = table(spark, sf, "documents").select(
        "doc_id", "lang", "source", "n_chars",
        F.try_divide(
            F.length(F.regexp_replace("text", "[^A-Za-z]+", "")).cast("double"), F.col("n_chars").cast("double")
        ).alias("alpha"),
        F.length(F.regexp_replace("text", "[^0-9]+", "")).cast("bigint").alias("digits"),
        (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1).cast("bigint").alias("n_words"),
    )
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("target"))
    return texts.join(labels, "doc_id")


DOCS = """docs AS (
  SELECT documents.doc_id, lang, source, n_chars,
         CASE WHEN n_chars <> 0 THEN CAST(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS DOUBLE) / n_chars END
           AS alpha,
         CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS BIGINT) AS digits,
         CAST(length(text) - length(replace(text, ' ', '')) + 1 AS BIGINT) AS n_words, quality AS target
  FROM documents JOIN labels ON documents.doc_id = labels.doc_id)"""


def doc_splits(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labelled documents as train, all documents as test (features only)."""
    train = docs(spark, sf).withColumnRenamed("doc_id", "row_id")
    texts = table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_id"), "lang", "source", "n_chars",
        F.try_divide(
            F.length(F.regexp_replace("text", "[^A-Za-z]+", "")).cast("double"), F.col("n_chars").cast("double")
        ).alias("alpha"),
        F.length(F.regexp_replace("text", "[^0-9]+", "")).cast("bigint").alias("digits"),
        (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1).cast("bigint").alias("n_words"),
    )
    template = texts.select(F.col("row_id").alias("pos"), "row_id", F.lit(0.5).alias("target"))
    return train, texts, template


MODELS = ("m1", "m2", "m3", "m4")


def prediction_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Scores from fixed formulas: discrete, heavily tied and nearly continuous ones."""
    return table(spark, sf, "lineitem").select(
        line_id().alias("row_id"),
        (F.col("l_linestatus") == "F").cast("int").alias("y"),
        (F.col("l_quantity") / 50).alias("m1"),
        (F.col("l_discount") * 10).alias("m2"),
        (F.col("l_tax") * 12.5).alias("m3"),
        (F.col("l_extendedprice") / 200000).alias("m4"),
        F.when(F.col("l_shipdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz"), "oof").otherwise("test").alias("split"),
    )


def predictions(spark: SparkSession, sf: str, models: tuple[str, ...] = MODELS) -> DataFrame:
    """(model, split, row_id, y, p)."""
    wide = prediction_wide(spark, sf).select("split", "row_id", "y", *models)
    return wide.unpivot(["split", "row_id", "y"], list(models), "model", "p")


def prediction_folds(spark: SparkSession, sf: str) -> DataFrame:
    """(row_id, fold) of the out-of-fold part."""
    rows = prediction_wide(spark, sf).where(F.col("split") == "oof").select("row_id", "y")
    return assign_folds(rows, "row_id", 5, 42, "y").select("row_id", "fold")


WIDE = f"""wide AS (
  SELECT {LINE_ID_SQL} AS row_id, CAST(l_linestatus = 'F' AS INTEGER) AS y,
         l_quantity / 50 AS m1, l_discount * 10 AS m2, l_tax * 12.5 AS m3, l_extendedprice / 200000 AS m4,
         CASE WHEN l_shipdate < TIMESTAMP '{SPLIT_DATE}' THEN 'oof' ELSE 'test' END AS split
  FROM lineitem)"""


def pred_sql(models: tuple[str, ...] = MODELS, split: str | None = None) -> str:
    """The WITH clause of the long prediction table."""
    keep = f" WHERE split = '{split}'" if split else ""
    parts = " UNION ALL ".join(f"SELECT split, row_id, y, '{m}' AS model, {m} AS p FROM wide{keep}" for m in models)
    return f"WITH {WIDE}, preds AS ({parts})"


FOLD = "CAST((row_number() OVER (PARTITION BY {label} ORDER BY md5(concat_ws('-', {id}, '42')), {id}) - 1) % {k} AS INTEGER)"


def fold_sql(id_col: str, label: str | None, k: int = 5) -> str:
    return FOLD.format(id=id_col, label=label or "1", k=k)


def rank_sql(p: str, groups: tuple[str, ...] = ()) -> str:
    """Tie-averaged rank over row count."""
    by = "PARTITION BY " + ", ".join(groups) if groups else ""
    also = ", ".join([*groups, p])
    return (
        f"(rank() OVER ({by} ORDER BY {p}) + (count(*) OVER (PARTITION BY {also}) - 1) / 2.0)"
        f" / count(*) OVER ({by})"
    )


def auc_sql(source: str, p: str = "p", y: str = "y", groups: tuple[str, ...] = ("model",), out: str = "auc") -> str:
    """Rank-sum AUC per group of a table expression."""
    by = "PARTITION BY " + ", ".join(groups) if groups else ""
    keys = "".join(f"{g}, " for g in groups)
    also = ", ".join([*groups, p])
    tail = f"GROUP BY {', '.join(groups)}" if groups else ""
    return (
        f"SELECT {keys}(sum(r * yy) - sum(yy) * (sum(yy) + 1) / 2) / nullif(sum(yy) * (count(*) - sum(yy)), 0) AS {out}"
        f" FROM (SELECT {keys}CAST({y} AS DOUBLE) AS yy, rank() OVER ({by} ORDER BY {p})"
        f" + (count(*) OVER (PARTITION BY {also}) - 1) / 2.0 AS r FROM {source} WHERE {p} IS NOT NULL) {tail}"
    )
