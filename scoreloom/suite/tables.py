"""Scans, roles, joins on keys, publishing and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.functions import scalar
from scoreloom.operators import publish as pub
from scoreloom.operators import schema
from scoreloom.operators.features import missing_rates
from scoreloom.session import stage_path
from scoreloom.sources.store import load_predictions, save_predictions
from scoreloom.sources.tables import scan_csv
from scoreloom.suite import fixtures as fx
from scoreloom.suite.registry import query, rounded

ORDER_SCHEMA = "o_orderkey bigint, o_totalprice double, o_orderstatus string, o_flag int"


@query(
    "scan_csv",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
              CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS o_orderstatus,
              CAST(o_orderstatus = 'F' AS INTEGER) AS o_flag FROM orders""",
)
def scan_csv_query(spark, sf):
    """Orders written as CSV with blanks and ``nan`` texts, read back with a declared schema."""
    status = F.col("o_orderstatus")
    path = stage_path(spark, "orders_csv")
    fx.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status == "P", "nan").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(status != "O", status).alias("o_orderstatus"),
        (status == "F").cast("int").alias("o_flag"),
    ).write.option("header", True).csv(path)
    return scan_csv(spark, path, ORDER_SCHEMA)


@query(
    "load_roles",
    f"""WITH {fx.ORD}, {fx.TRAIN}, {fx.TEST}
        SELECT 'row_id' AS "column", 'id' AS role, count(row_id) AS n_train FROM train
        UNION ALL SELECT 'target', 'target', count(target) FROM train
        UNION ALL SELECT 'o_totalprice', 'numeric', count(o_totalprice) FROM train
        UNION ALL SELECT 'c_acctbal', 'numeric', count(c_acctbal) FROM train
        UNION ALL SELECT 'priority', 'numeric', count(priority) FROM train
        UNION ALL SELECT 'c_mktsegment', 'cat', count(c_mktsegment) FROM train
        UNION ALL SELECT 'n_name', 'cat', count(n_name) FROM train""",
)
def load_roles_query(spark, sf):
    train, test, template = fx.order_splits(spark, sf)
    roles, ready, _ = schema.load_roles(train.drop("o_orderdate"), test.drop("o_orderdate"), template)
    parts = {roles.id: "id", roles.target: "target", **dict.fromkeys(roles.numeric, "numeric"),
             **dict.fromkeys(roles.cats, "cat")}
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(r).alias("role"), F.col(f"n{i}").alias("n_train"))
        for i, (c, r) in enumerate(parts.items())
    ]
    counts = ready.agg(*[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(parts)])
    return counts.select(F.inline(F.array(*entries)))


@query(
    "align_columns",
    f"""WITH {fx.ORD}, {fx.TEST} SELECT row_id, o_totalprice, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment, n_name
        FROM test""",
)
def align_columns_query(spark, sf):
    train, test, _ = fx.order_splits(spark, sf)
    columns = ["row_id", "o_totalprice", "c_acctbal", "c_mktsegment", "n_name"]
    return schema.align_columns(test.select("n_name", "c_mktsegment", "o_totalprice", "row_id"), train, columns)


@query("pred_store", f"{fx.pred_sql()} SELECT row_id, y, model, split, p FROM preds WHERE model = 'm2' AND split = 'oof'")
def pred_store_query(spark, sf):
    path = stage_path(spark, "store")
    save_predictions(fx.predictions(spark, sf), path)
    return load_predictions(spark, path, ["m2"], "oof")


TEMPLATE = "template AS (SELECT o_orderkey AS pos, o_orderkey AS id, 0.5 AS target FROM orders)"
SCORED = "scored AS (SELECT o_orderkey AS id, o_totalprice / 300000 AS p FROM orders WHERE o_orderstatus <> 'P')"


def _template(spark, sf):
    return fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pos"), F.col("o_orderkey").alias("id"), F.lit(0.5).alias("target")
    )


def _scored(spark, sf):
    return fx.table(spark, sf, "orders").where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 300000).alias("p")
    )


@query(
    "publish",
    f"""WITH {TEMPLATE}, {SCORED} SELECT pos, template.id,
        CASE WHEN p IS NULL THEN 0.5 ELSE greatest(least(p, 1 - 1e-6), 1e-6) END AS target
        FROM template LEFT JOIN scored ON template.id = scored.id""",
)
def publish_query(spark, sf):
    return pub.publish(_template(spark, sf), _scored(spark, sf), "id", "p", "target")


@query(
    "detect_target",
    "SELECT 'flag' AS target, count(*) AS n_rows FROM lineitem HAVING count(DISTINCT l_linestatus) = 2"
    " AND count(DISTINCT l_quantity) <> 2 AND count(DISTINCT l_linenumber) <> 2",
)
def detect_target_query(spark, sf):
    rows = fx.table(spark, sf, "lineitem").select(
        "l_linestatus", "l_linenumber", "l_quantity", (F.col("l_linestatus") == "F").cast("int").alias("flag")
    )
    return schema.detect_target(rows, "l_linenumber").withColumn("n_rows", rows.agg(F.count("*")).scalar())


@query(
    "detect_target_any",
    """SELECT 'l_linestatus' AS target, count(*) AS n_rows FROM lineitem
       HAVING count(DISTINCT l_linestatus) = 2 AND count(DISTINCT l_returnflag) <> 2""",
)
def detect_target_any_query(spark, sf):
    rows = fx.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return schema.detect_target(rows, None, "any").withColumn("n_rows", rows.agg(F.count("*")).scalar())


@query("drop_null_target", f"WITH {fx.NULLS} SELECT * FROM nulls WHERE target IS NOT NULL")
def drop_null_target_query(spark, sf):
    return schema.drop_null_target(fx.nulls(spark, sf), "target")


@query("project_features", f"WITH {fx.ORD} SELECT o_totalprice, c_acctbal, c_mktsegment, n_name, priority FROM ord")
def project_features_query(spark, sf):
    train = fx.orders(spark, sf).drop("o_orderdate")
    return schema.project_features(train, schema.Roles("row_id", "target", "target"))


@query("numeric_only", f"WITH {fx.NULLS} SELECT id, l_quantity, l_extendedprice, l_discount, l_tax, target FROM nulls")
def numeric_only_query(spark, sf):
    return schema.numeric_only(fx.nulls(spark, sf), ["id"])


@query("drop_cats", f"WITH {fx.ORD} SELECT row_id, o_totalprice, c_acctbal, o_orderdate, target FROM ord")
def drop_cats_query(spark, sf):
    train = fx.orders(spark, sf)
    _, cats = schema.split_types(train, ["row_id", "target"])
    return schema.drop_cats(train, cats)


@query(
    "ordinal_parse",
    f"""WITH {fx.ORD} SELECT row_id, n_name, TRY_CAST(substr(priority, 5) AS DOUBLE) AS priority FROM ord""",
)
def ordinal_parse_query(spark, sf):
    train = fx.orders(spark, sf).select("row_id", "n_name", "priority")
    return schema.parse_ordinals(train, schema.ordinal_columns(train, ["n_name", "priority"]))


@query("cat_frame", f"WITH {fx.NULLS} SELECT id, coalesce(l_returnflag, '__NA__') AS l_returnflag FROM nulls")
def cat_frame_query(spark, sf):
    return schema.cat_frame(fx.nulls(spark, sf).select("id", "l_returnflag"), ["l_returnflag"])


@query("drop_id_like", f"WITH {fx.LINE} SELECT l_quantity, l_returnflag FROM line")
def drop_id_like_query(spark, sf):
    rows = fx.line(spark, sf).select("id", "l_quantity", "l_returnflag")
    return rows.drop(*schema.id_like_columns(rows))


@query(
    "inf_null_zero",
    f"""WITH {fx.NULLS} SELECT id, coalesce(l_quantity, 0.0) AS l_quantity,
        CASE WHEN l_discount = 0 THEN 0.0 ELSE l_extendedprice / l_discount END AS ratio FROM nulls""",
)
def inf_null_zero_query(spark, sf):
    rows = fx.nulls(spark, sf).select(
        "id", "l_quantity",
        F.when(F.col("l_discount") == 0, F.lit(float("inf")))
        .otherwise(F.try_divide("l_extendedprice", "l_discount")).alias("ratio"),
    )
    return schema.clean_numeric(rows, ["l_quantity", "ratio"])


@query("null_to_zero", f"WITH {fx.NULLS} SELECT id, coalesce(l_tax, 0.0) AS l_tax FROM nulls")
def null_to_zero_query(spark, sf):
    return fx.nulls(spark, sf).select("id", scalar.null_to_zero("l_tax").alias("l_tax"))


@query(
    "sanitize_scores",
    f"""WITH {fx.NULLS} SELECT id, CASE WHEN l_tax IS NULL THEN 0.5 WHEN l_quantity IS NULL THEN 1 - 1e-6
          ELSE greatest(least(l_extendedprice / 50000 - 0.5, 1 - 1e-6), 1e-6) END AS p FROM nulls""",
)
def sanitize_scores_query(spark, sf):
    raw = (
        F.when(F.col("l_tax").isNull(), F.lit(float("nan")))
        .when(F.col("l_quantity").isNull(), F.lit(float("inf")))
        .otherwise(F.col("l_extendedprice") / 50000 - 0.5)
    )
    return fx.nulls(spark, sf).select("id", scalar.sanitize_score(raw).alias("p"))


@query(
    "class_weights",
    f"""WITH {fx.NULLS}, counts AS (SELECT target AS class, count(*) AS n FROM nulls WHERE target IS NOT NULL GROUP BY 1)
        SELECT class, n, round((SELECT sum(n) FROM counts) / (2.0 * n), 6) AS weight FROM counts""",
)
def class_weights_query(spark, sf):
    return rounded(schema.class_weights(fx.nulls(spark, sf), "target"), "weight")


@query(
    "binarize_target",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderstatus = 'O' AS INTEGER) END AS y"
    " FROM orders",
)
def binarize_target_query(spark, sf):
    status = F.col("o_orderstatus")
    rows = fx.table(spark, sf, "orders").select("o_orderkey", F.when(status != "P", status).alias("status"))
    return schema.binarize_target(rows, "status", "y").drop("status")


@query(
    "validate_ids",
    f"""WITH a AS (SELECT o_orderkey AS pos, CASE WHEN o_orderstatus = 'P' THEN o_orderkey + 1 ELSE o_orderkey END AS id
                   FROM orders), {TEMPLATE}
        SELECT count(*) AS n_mismatch FROM a FULL JOIN template ON a.pos = template.pos
        WHERE a.id IS DISTINCT FROM template.id""",
)
def validate_ids_query(spark, sf):
    """Every part-shipped order carries its neighbour's id."""
    moved = fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pos"),
        (F.col("o_orderkey") + (F.col("o_orderstatus") == "P").cast("int")).alias("id"),
    )
    return pub.id_mismatches(moved, _template(spark, sf), "id")


def _report(df):
    return df.select(
        "valid", F.concat_ws("; ", "errors").alias("errors"), F.concat_ws("; ", "warnings").alias("warnings"),
        *[F.round(F.col(f"stats.{s}"), 6).alias(s) for s in ("mean", "std", "min", "max")],
        F.col("stats.n_unique").alias("n_unique"),
    )


STATS_SQL = """round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS std, round(min(p), 6) AS min,
               round(max(p), 6) AS max, count(DISTINCT p) AS n_unique"""


@query(
    "validate",
    f"""SELECT count(*) = (SELECT count(*) FROM orders) AS valid, '' AS errors, 'outside [0,1]' AS warnings, {STATS_SQL}
        FROM (SELECT o_totalprice / 300000 AS p FROM orders)""",
)
def validate_query(spark, sf):
    scores = fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pos"), F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 300000).alias("target")
    )
    return _report(pub.validate(scores, _template(spark, sf)))


@query(
    "validate_strict",
    f"""SELECT false AS valid, 'shape mismatch; row count mismatch; missing values; id mismatch with template; '
               || 'id mismatch with test; outside [0,1]' AS errors, '' AS warnings, {STATS_SQL}
        FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 300000 END AS p
              FROM orders WHERE o_orderstatus <> 'P')""",
)
def validate_strict_query(spark, sf):
    rows = fx.table(spark, sf, "orders").where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("pos"), F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") / 300000).alias("target"),
    )
    template = _template(spark, sf)
    return _report(pub.validate(rows, template, strict=True, test=template.select("pos", "id")))


@query(
    "missing_rates",
    f"""WITH {fx.NULLS} SELECT round(avg(CAST(l_quantity IS NULL AS DOUBLE)), 6) AS l_quantity,
        round(avg(CAST(l_tax IS NULL AS DOUBLE)), 6) AS l_tax,
        round(avg(CAST(l_returnflag IS NULL AS DOUBLE)), 6) AS l_returnflag FROM nulls""",
)
def missing_rates_query(spark, sf):
    rates = missing_rates(fx.nulls(spark, sf), ["l_quantity", "l_tax", "l_returnflag"])
    return spark.createDataFrame([tuple(round(v, 6) for v in rates.values())], ", ".join(f"{c} double" for c in rates))
