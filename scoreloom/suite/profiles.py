"""Profiling, encodings' statistics and target association."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.operators import metrics, profile
from scoreloom.operators.features import pool, pooled_stats
from scoreloom.operators.search import param_gates, param_policy, POLICY, SIZE_LIMITS, WIDE_RATIO
from scoreloom.plans import reports
from scoreloom.suite import fixtures as fx
from scoreloom.suite.registry import query, rounded

NULL_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "target")
NULL_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _each(columns, template, source="nulls"):
    return " UNION ALL ".join(template.format(c=c) + f" FROM {source}" for c in columns)


@query(
    "table_shape",
    """SELECT "column", dtype, position, n_rows, 6 AS n_columns FROM (VALUES ('o_orderkey', 'bigint', 0),
       ('o_custkey', 'bigint', 1), ('o_orderstatus', 'string', 2), ('o_totalprice', 'double', 3),
       ('o_orderdate', 'timestamp_ntz', 4), ('o_orderpriority', 'string', 5)) AS t("column", dtype, position)
       CROSS JOIN (SELECT count(*) AS n_rows FROM orders)""",
)
def table_shape_query(spark, sf):
    return profile.table_shape(fx.table(spark, sf, "orders"))


@query("head_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 3")
def head_rows_query(spark, sf):
    return profile.head_rows(fx.table(spark, sf, "orders"), ["o_orderkey"])


@query("n_unique", f"WITH {fx.NULLS} " + _each(NULL_COLUMNS, "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique"))
def n_unique_query(spark, sf):
    return profile.n_unique(fx.nulls(spark, sf), NULL_COLUMNS)


MISSING = (
    "SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_missing, count(*) AS n_rows,"
    " round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2) AS pct_missing"
)


@query(
    "missing_summary",
    f"WITH {fx.NULLS}, m AS ({_each(('id', *NULL_COLUMNS), MISSING)}) SELECT * FROM m WHERE n_missing > 0",
)
def missing_summary_query(spark, sf):
    return profile.missing_summary(fx.nulls(spark, sf))


def type_sql(kinds: dict[str, tuple[str, str]], source: str) -> str:
    """Feature types of ``{column: (kind, dtype)}``."""
    facts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{k}' AS kind, '{d}' AS dtype, count(DISTINCT {c}) AS u, count(*) AS n,"
        f" count(*) - count({c}) AS miss FROM {source}"
        for c, (k, d) in kinds.items()
    )
    return (
        "SELECT \"column\", CASE WHEN u <= 1 THEN 'constant' WHEN u = 2 THEN 'binary'"
        " WHEN kind = 'number' AND u < 20 AND u / n < 0.05 THEN 'categorical_numeric'"
        " WHEN kind = 'number' THEN 'numeric' WHEN kind = 'time' THEN 'datetime'"
        " WHEN u / n < 0.05 THEN 'categorical_low_cardinality' WHEN u / n < 0.5 THEN 'categorical_medium_cardinality'"
        " ELSE 'categorical_high_cardinality' END AS type, u AS n_unique, miss AS n_missing,"
        f" round(miss * 100.0 / n, 2) AS pct_missing, dtype FROM ({facts})"
    )


NULL_KINDS = {
    "id": ("text", "string"), "l_quantity": ("number", "double"), "l_extendedprice": ("number", "double"),
    "l_discount": ("number", "double"), "l_tax": ("number", "double"), "l_returnflag": ("text", "string"),
}
ORD_KINDS = {
    "o_totalprice": ("number", "double"), "c_acctbal": ("number", "double"), "c_mktsegment": ("text", "string"),
    "n_name": ("text", "string"), "priority": ("text", "string"), "o_orderdate": ("time", "timestamp_ntz"),
    "row_id": ("number", "bigint"),
}


@query("feature_types", f"WITH {fx.NULLS} " + type_sql(NULL_KINDS, "nulls"))
def feature_types_query(spark, sf):
    return profile.feature_types(fx.nulls(spark, sf), "target")


@query("feature_types_orders", f"WITH {fx.ORD} " + type_sql(ORD_KINDS, "ord"))
def feature_types_orders_query(spark, sf):
    return profile.feature_types(fx.orders(spark, sf), "target")


@query(
    "column_types",
    f"""WITH {fx.NULLS}, {fx.ORD} SELECT 'lines' AS source, "column", type FROM ({type_sql(NULL_KINDS, 'nulls')})
        UNION ALL SELECT 'orders', "column", type FROM ({type_sql(ORD_KINDS, 'ord')})""",
)
def column_types_query(spark, sf):
    """Types alone: sketches decide the columns that are clear of the thresholds."""
    out = None
    for name, rows in (("lines", fx.nulls(spark, sf)), ("orders", fx.orders(spark, sf))):
        part = profile.feature_types(rows, "target", exact=False).select(F.lit(name).alias("source"), "column", "type")
        out = part if out is None else out.unionByName(part)
    return out


@query("type_counts", f"WITH {fx.ORD} SELECT type, count(*) AS n FROM ({type_sql(ORD_KINDS, 'ord')}) GROUP BY type")
def type_counts_query(spark, sf):
    return profile.type_counts(profile.feature_types(fx.orders(spark, sf), "target"))


@query(
    "target_balance",
    f"""WITH {fx.NULLS}, c AS (SELECT target, count(*) AS n FROM nulls GROUP BY target)
        SELECT CAST(target AS VARCHAR) AS value, n,
          (SELECT round(min(n) / max(n), 4) FROM c WHERE target IS NOT NULL) AS class_balance,
          (SELECT count(target) FROM c) AS n_classes,
          CAST((SELECT coalesce(sum(n), 0) FROM c WHERE target IS NULL) AS BIGINT) AS n_missing
        FROM c WHERE target IS NOT NULL""",
)
def target_balance_query(spark, sf):
    return profile.target_balance(fx.nulls(spark, sf), "target")


DESCRIBE = (
    "SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,"
    " round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS median,"
    " round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max"
)


@query("describe_numeric", f"WITH {fx.NULLS} " + _each(NULL_NUMERIC, DESCRIBE))
def describe_numeric_query(spark, sf):
    described = profile.describe_numeric(fx.nulls(spark, sf), NULL_NUMERIC)
    return rounded(described, "mean", "std", "min", "q25", "median", "q75", "max", places=4)


def moment_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", 'numeric' AS type, count({c}) AS count, count(*) - count({c}) AS missing,"
        f" round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,"
        f" round(max({c}), 4) AS max, round(quantile_cont({c}, 0.5), 4) AS median,"
        f" round(avg(power(({c} - mu) / sd, 3)), 5) AS skewness, round(kurtosis_pop({c}), 5) AS kurtosis,"
        f" round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.75), 4) AS q75,"
        f" round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 4) AS iqr,"
        f" round(count(*) FILTER (WHERE {c} = 0) * 100.0 / count({c}), 4) AS zeros_pct,"
        f" round(count(*) FILTER (WHERE {c} < 0) * 100.0 / count({c}), 4) AS negative_pct,"
        f" count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outlier_count, CAST(NULL AS VARCHAR) AS error"
        f" FROM nulls, (SELECT avg({c}) AS mu, stddev_pop({c}) AS sd,"
        f" quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo,"
        f" quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM nulls)"
    )


@query("profile_numeric", f"WITH {fx.NULLS} " + " UNION ALL ".join(moment_sql(c) for c in NULL_NUMERIC))
def profile_numeric_query(spark, sf):
    found = profile.profile_numeric(fx.nulls(spark, sf), NULL_NUMERIC)
    moments = ["mean", "std", "min", "max", "median", "q25", "q75", "iqr", "zeros_pct", "negative_pct"]
    found = rounded(found, *moments, places=4)
    return rounded(found, "skewness", "kurtosis", places=5)


ORDER_OUTLIERS = (
    "SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))"
    " AS outlier_count FROM v, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM v)"
)


@query(
    "outlier_count",
    "WITH v AS (SELECT o_totalprice, o_totalprice * o_totalprice * o_totalprice AS cubed FROM orders) "
    + " UNION ALL ".join(ORDER_OUTLIERS.format(c=c) for c in ("o_totalprice", "cubed")),
)
def outlier_count_query(spark, sf):
    price = F.col("o_totalprice")
    rows = fx.table(spark, sf, "orders").select("o_totalprice", (price * price * price).alias("cubed"))
    return profile.outlier_counts(rows, profile.exact_quantiles(rows, ["o_totalprice", "cubed"], [0.25, 0.75]))


def categorical_sql(c: str, source: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", 'categorical' AS type, CAST(sum(n) AS BIGINT) AS count,"
        f" (SELECT count(*) - count({c}) FROM {source}) AS missing, count(*) AS n_unique,"
        f" round(-sum(n / t * ln(n / t)), 6) AS entropy, round(max(n) * 100.0 / sum(n), 6) AS most_common_pct,"
        f" CAST(NULL AS VARCHAR) AS error FROM (SELECT {c}, count(*) AS n, sum(count(*)) OVER () AS t FROM {source}"
        f" WHERE {c} IS NOT NULL GROUP BY {c})"
    )


@query(
    "profile_categorical",
    f"WITH {fx.ORD} " + " UNION ALL ".join(categorical_sql(c, "ord") for c in ("c_mktsegment", "n_name", "priority")),
)
def profile_categorical_query(spark, sf):
    found = profile.profile_categorical(fx.orders(spark, sf), ["c_mktsegment", "n_name", "priority"])
    return rounded(found, "entropy", "most_common_pct")


@query(
    "top_categories",
    f"""WITH {fx.ORD}, c AS (SELECT 'n_name' AS "column", n_name AS value, count(*) AS n FROM ord GROUP BY 2
          UNION ALL SELECT 'c_mktsegment', c_mktsegment, count(*) FROM ord GROUP BY 2),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS INTEGER) AS rank FROM c)
        SELECT * FROM r WHERE rank <= 10""",
)
def top_categories_query(spark, sf):
    return profile.top_categories(fx.orders(spark, sf), ["n_name", "c_mktsegment"], 10)


CORR = "SELECT '{c}' AS \"column\", round(CASE WHEN isnan(k) THEN NULL ELSE k END, 6) + 0.0 AS corr FROM (SELECT corr({c}, target) AS k FROM {s})"


def corr_sql(columns, source):
    return " UNION ALL ".join(CORR.format(c=c, s=source) for c in columns)


@query(
    "target_corr",
    f"WITH {fx.NULLS}, pair AS (SELECT *, 1.0 AS flat FROM nulls) " + corr_sql((*NULL_NUMERIC, "flat"), "pair"),
)
def target_corr_query(spark, sf):
    rows = fx.nulls(spark, sf).withColumn("flat", F.lit(1.0))
    return rounded(profile.target_corr(rows, [*NULL_NUMERIC, "flat"], "target"), "corr")


ZERO_CORR = (
    "SELECT '{c}' AS \"column\", round(coalesce(CASE WHEN isnan(k) THEN NULL ELSE abs(k) END, 0.0), 6) AS corr"
    " FROM (SELECT corr(coalesce({c}, 0.0), target) AS k FROM {s} WHERE target IS NOT NULL)"
)


@query("target_corr_zero", f"WITH {fx.NULLS} " + " UNION ALL ".join(ZERO_CORR.format(c=c, s="nulls") for c in NULL_NUMERIC))
def target_corr_zero_query(spark, sf):
    rows = fx.nulls(spark, sf).where(F.col("target").isNotNull())
    return rounded(profile.target_corr(rows, NULL_NUMERIC, "target", zero_fill=True), "corr")


@query(
    "top_corr",
    f"""WITH {fx.DOCS}, c AS ({corr_sql(fx.DOC_NUMERIC, 'docs')})
        SELECT "column", corr, side, CAST(rank AS INTEGER) AS rank FROM (
          SELECT "column", corr, CASE WHEN corr > 0 THEN 'positive' ELSE 'negative' END AS side,
                 row_number() OVER (PARTITION BY corr > 0 ORDER BY abs(corr) DESC, "column") AS rank
          FROM c WHERE corr <> 0) WHERE rank <= 10""",
)
def top_corr_query(spark, sf):
    return rounded(profile.top_corr(profile.target_corr(fx.docs(spark, sf), fx.DOC_NUMERIC, "target")), "corr")


@query(
    "top_features",
    f"""WITH {fx.DOCS}, c AS ({" UNION ALL ".join(ZERO_CORR.format(c=c, s="docs") for c in fx.DOC_NUMERIC)})
        SELECT "column", corr FROM c ORDER BY corr DESC, "column" LIMIT 3""",
)
def top_features_query(spark, sf):
    corr = profile.target_corr(fx.docs(spark, sf), fx.DOC_NUMERIC, "target", zero_fill=True)
    return rounded(corr.orderBy(F.desc("corr"), "column").limit(3), "corr")


def pair_corr_sql(columns, source):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {i} AS a_idx, {j} AS b_idx,"
        f" round(abs(CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END), 6) AS corr FROM {source}"
        for i, a in enumerate(columns) for j, b in enumerate(columns) if i < j
    )


#: More pairs than one aggregation takes: sums of the numeric columns, with missing values in different places.
WIDE_PAIRS = [(i, i % 4, (i // 4) % 4, 1 + i % 3) for i in range(28)]


def _blend_sql(i: int, a: int, b: int, k: int) -> str:
    one, two = fx.LINE_NUMERIC[a], fx.LINE_NUMERIC[b]
    return f"CASE WHEN l_orderkey % 29 <> {i} THEN {one} + {k} * {two} END AS v{i}"


def _wide_corr_sql() -> str:
    pairs = [(i, j) for i in range(28) for j in range(i + 1, 28)]
    corr = "round(abs(CASE WHEN isnan(corr(v{i}, v{j})) THEN NULL ELSE corr(v{i}, v{j}) END), 6)"
    rows = ", ".join(f"{{'a': 'v{i}', 'b': 'v{j}', 'a_idx': {i}, 'b_idx': {j}, 'corr': {corr.format(i=i, j=j)}}}" for i, j in pairs)
    blends = ", ".join(_blend_sql(*p) for p in WIDE_PAIRS)
    return f"WITH v AS (SELECT {blends} FROM lineitem) SELECT unnest([{rows}], recursive := true) FROM v"


@query("corr_pairs_wide", _wide_corr_sql())
def corr_pairs_wide_query(spark, sf):
    rows = fx.table(spark, sf, "lineitem").selectExpr(*[_blend_sql(*p) for p in WIDE_PAIRS])
    return rounded(profile.corr_pairs(rows, rows.columns), "corr")


@query("corr_pairs", f"WITH {fx.NULLS} " + pair_corr_sql(NULL_NUMERIC, "nulls"))
def corr_pairs_query(spark, sf):
    return rounded(profile.corr_pairs(fx.nulls(spark, sf), NULL_NUMERIC), "corr")


@query(
    "cat_target_assoc",
    f"""WITH {fx.DOCS} SELECT 'lang' AS "column", lang AS value, count(*) AS n, round(avg(target), 6) AS rate FROM docs
        GROUP BY lang UNION ALL SELECT 'source', source, count(*), round(avg(target), 6) FROM docs GROUP BY source""",
)
def cat_target_assoc_query(spark, sf):
    return rounded(profile.cat_target_assoc(fx.docs(spark, sf), ["lang", "source"], "target"), "rate")


@query(
    "red_flags",
    """WITH c AS (SELECT 'l_suppkey' AS "column", CAST(l_suppkey AS VARCHAR) AS value, count(*) AS n FROM lineitem GROUP BY 2
         UNION ALL SELECT 'l_partkey', CAST(l_partkey AS VARCHAR), count(*) FROM lineitem GROUP BY 2),
       t AS (SELECT "column", sum(n) AS rows, count(*) AS levels FROM c GROUP BY 1)
       SELECT c."column", 'rare_categories' AS flag, count(*) AS n FROM c JOIN t USING ("column")
       WHERE n < rows * 0.01 GROUP BY 1
       UNION ALL SELECT "column", 'high_cardinality', levels FROM t WHERE levels > 1000
       UNION ALL SELECT 'y', 'extreme_imbalance', low FROM (SELECT min(n) AS low, sum(n) AS rows FROM
         (SELECT l_extendedprice > 104500 AS y, count(*) AS n FROM lineitem GROUP BY 1)) WHERE low < rows * 0.01""",
)
def red_flags_query(spark, sf):
    rows = fx.table(spark, sf, "lineitem").select(
        "l_suppkey", "l_partkey", (F.col("l_extendedprice") > 104500).cast("int").alias("y")
    )
    return profile.red_flags(rows, ["l_suppkey", "l_partkey"], "y")


@query(
    "duplicate_rows",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_rows_query(spark, sf):
    return profile.duplicate_rows(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_rows_all", "SELECT *, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_rows_all_query(spark, sf):
    """Rows that are alike in every column."""
    return profile.duplicate_rows(fx.table(spark, sf, "lineitem"))


@query(
    "format_masks",
    """WITH m AS (SELECT 'o_orderpriority' AS "column", regexp_replace(regexp_replace(o_orderpriority, '[A-Za-z]', 'A', 'g'),
          '[0-9]', '9', 'g') AS mask FROM orders
        UNION ALL SELECT 'o_custkey', regexp_replace(CAST(o_custkey AS VARCHAR), '[0-9]', '9', 'g') FROM orders)
       SELECT "column", mask, count(*) AS n FROM m GROUP BY 1, 2""",
)
def format_masks_query(spark, sf):
    return profile.format_masks(fx.table(spark, sf, "orders"), ["o_orderpriority", "o_custkey"])


@query(
    "drop_quasi_constant",
    "SELECT o_orderkey, o_orderstatus, CASE WHEN o_totalprice > 490000 THEN NULL ELSE o_totalprice END AS price FROM orders",
)
def drop_quasi_constant_query(spark, sf):
    """A constant, an all-missing and a 99.9 % constant column fall; the rest stays."""
    rows = fx.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_totalprice") <= 490000, F.col("o_totalprice")).alias("price"),
        F.lit(1).alias("flat"), F.lit(None).cast("double").alias("empty"),
        (F.col("o_totalprice") > 499950).cast("int").alias("nearly_flat"),
    )
    return rows.drop(*profile.quasi_constant_columns(rows))


SUMMARY_COLUMNS = ("o_totalprice", "c_acctbal")


def summary_sql(source: str, group: str = "") -> str:
    key = f"{group}, " if group else ""
    tail = f"GROUP BY {group}" if group else ""
    return (
        f"SELECT {key}count(*) AS n_samples, CAST(4 AS BIGINT) AS n_features, CAST(2 AS BIGINT) AS n_numeric,"
        " CAST(2 AS BIGINT) AS n_categorical, round((avg(CAST(o_totalprice IS NULL AS INT)) + avg(CAST(c_acctbal IS NULL"
        " AS INT)) + avg(CAST(n_name IS NULL AS INT)) + avg(CAST(priority IS NULL AS INT))) / 4, 6) AS missing_pct,"
        " round(least(sum(target), count(*) - sum(target)) / greatest(sum(target), count(*) - sum(target)), 6)"
        " AS class_balance, round(4.0 / count(*), 6) AS ratio, CASE WHEN count(*) < 1000 THEN 'tiny'"
        " WHEN count(*) < 5000 THEN 'small' WHEN count(*) < 20000 THEN 'medium' ELSE 'large' END AS size_category"
        f" FROM {source} {tail}"
    )


def _summary(spark, sf, groups=()):
    priced = fx.orders(spark, sf).withColumn(
        "o_totalprice", F.when(F.col("o_totalprice") < 400000, F.col("o_totalprice"))
    )
    return profile.dataset_summary(priced, SUMMARY_COLUMNS, ["n_name", "priority"], "target", groups)


PRICED = f"{fx.ORD}, priced AS (SELECT * REPLACE (CASE WHEN o_totalprice < 400000 THEN o_totalprice END AS o_totalprice) FROM ord)"


@query("dataset_summary", f"WITH {PRICED} {summary_sql('priced')}")
def dataset_summary_query(spark, sf):
    return rounded(_summary(spark, sf), "missing_pct", "class_balance", "ratio")


@query(
    "param_gates",
    f"""WITH {PRICED}, s AS (SELECT c_mktsegment, count(*) AS n, 4.0 / count(*) AS ratio FROM priced GROUP BY 1)
        SELECT c_mktsegment, CAST(CASE WHEN ratio >= 0.010 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS l2,
          CASE WHEN ratio >= 0.030 THEN 70 WHEN ratio >= 0.015 THEN 50 ELSE 20 END AS min_rows,
          CASE WHEN n >= 5000 THEN 10 ELSE 1 END AS n_seeds FROM s""",
)
def param_gates_query(spark, sf):
    """Each market segment is taken as one dataset."""
    return param_gates(_summary(spark, sf, ["c_mktsegment"]), 0, ["c_mktsegment"])


def policy_sql() -> str:
    rows = []
    for family, rules in POLICY.items():
        for param in rules["base"]:
            tests = {
                "wide": f"ratio > {WIDE_RATIO}", "tiny": f"n < {SIZE_LIMITS['tiny']}",
                "small": f"n >= {SIZE_LIMITS['tiny']} AND n < {SIZE_LIMITS['small']}",
                "large": f"n > {SIZE_LIMITS['large']}",
            }
            arms = " ".join(
                f"WHEN {test} THEN {float(rules[name][param])}" for name, test in tests.items()
                if param in rules.get(name, {})
            )
            value = f"CASE {arms} ELSE {float(rules['base'][param])} END" if arms else f"{float(rules['base'][param])}"
            rows.append(f"SELECT n_name, '{family}' AS family, '{param}' AS param, CAST({value} AS DOUBLE) AS value FROM s")
    return " UNION ALL ".join(rows)


@query(
    "param_policy",
    f"WITH {fx.ORD}, s AS (SELECT n_name, count(*) AS n, 3.0 / count(*) AS ratio FROM ord GROUP BY 1) {policy_sql()}",
)
def param_policy_query(spark, sf):
    """Each nation's orders are taken as one dataset."""
    summary = profile.dataset_summary(
        fx.orders(spark, sf), ["o_totalprice", "c_acctbal"], ["priority"], "target", ["n_name"]
    )
    return param_policy(summary, keys=["n_name"])


@query(
    "leakage_flags",
    f"""WITH {fx.DOCS}, f AS (SELECT *, target * 2.0 + 1 AS copy, 3.0 - target AS mirror FROM docs),
          long AS (SELECT 'alpha' AS model, alpha AS p, target AS y FROM f UNION ALL SELECT 'copy', copy, target FROM f
                   UNION ALL SELECT 'mirror', mirror, target FROM f),
          a AS ({fx.auc_sql('long')}),
          c AS (SELECT 'alpha' AS model, corr(alpha, target) AS corr FROM f UNION ALL SELECT 'copy', corr(copy, target) FROM f
                UNION ALL SELECT 'mirror', corr(mirror, target) FROM f)
        SELECT model AS "column", round(corr, 6) AS corr, round(greatest(auc, 1 - auc), 6) AS single_auc
        FROM a JOIN c USING (model) WHERE abs(corr) > 0.95 OR greatest(auc, 1 - auc) > 0.99""",
)
def leakage_flags_query(spark, sf):
    y = F.col("target")
    rows = fx.docs(spark, sf).withColumns({"copy": y * 2.0 + 1, "mirror": F.lit(3.0) - y})
    columns = ["alpha", "copy", "mirror"]
    corr, auc = profile.target_corr(rows, columns, "target"), metrics.column_auc(rows, columns, "target")
    return rounded(profile.leakage_flags(corr, auc), "corr", "single_auc")


REGION_KINDS = {"row_id": ("number", "bigint"), "o_totalprice": ("number", "double"), "priority": ("text", "string")}


@query(
    "compare_datasets",
    f"""WITH {fx.ORD}, d1 AS (SELECT * FROM ord WHERE c_mktsegment = 'BUILDING'),
          d2 AS (SELECT * FROM ord WHERE c_mktsegment <> 'BUILDING'),
          r AS ({type_sql(REGION_KINDS, 'd1')} UNION ALL {type_sql({**REGION_KINDS, 'n_name': ('text', 'string')}, 'd2')})
        SELECT "column", count(*) AS n_datasets, count(DISTINCT type) AS n_types, CAST(sum(n_missing) AS BIGINT) AS n_missing,
          round(avg(n_unique), 6) AS mean_unique FROM r GROUP BY 1""",
)
def compare_datasets_query(spark, sf):
    rows = fx.orders(spark, sf).select("row_id", "o_totalprice", "priority", "n_name", "c_mktsegment", "target")
    building = F.col("c_mktsegment") == "BUILDING"
    sets = {"a": rows.where(building).drop("c_mktsegment", "n_name"), "b": rows.where(~building).drop("c_mktsegment")}
    return rounded(profile.compare_datasets(sets, "target"), "mean_unique")


@query(
    "train_test_report",
    f"""WITH {fx.ORD}, {fx.TRAIN}, {fx.TEST}, a AS ({type_sql(ORD_KINDS, 'train')}),
          b AS ({type_sql({c: k for c, k in ORD_KINDS.items() if c != 'c_acctbal'}, 'test')})
        SELECT coalesce(a."column", b."column") AS "column", a.type AS train_type, a.n_unique AS train_unique,
          a.n_missing AS train_missing, b.type AS test_type, b.n_unique AS test_unique, b.n_missing AS test_missing
        FROM a FULL JOIN b ON a."column" = b."column" """,
)
def train_test_report_query(spark, sf):
    train, test, _ = fx.order_splits(spark, sf)
    return profile.compare_splits(train, test.drop("c_acctbal"), "target")


@query(
    "pooled_stats",
    f"""WITH {fx.ORD}, {fx.TRAIN}, {fx.TEST}, pooled AS (SELECT o_totalprice, c_acctbal FROM train
          UNION ALL SELECT o_totalprice, NULL FROM test) """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std,"
        f" round(quantile_cont({c}, 0.5), 5) AS median, round(quantile_cont({c}, 0.25), 5) AS q25,"
        f" round(quantile_cont({c}, 0.75), 5) AS q75 FROM pooled" for c in SUMMARY_COLUMNS
    ),
)
def pooled_stats_query(spark, sf):
    train, test, _ = fx.order_splits(spark, sf)
    stats = pooled_stats(pool([train.drop("o_orderdate"), test.drop("c_acctbal", "o_orderdate")]), SUMMARY_COLUMNS)
    rows = [(c, *[round(s[k], 5) for k in ("mean", "std", "median", "q25", "q75")]) for c, s in stats.items()]
    return spark.createDataFrame(rows, "column string, mean double, std double, median double, q25 double, q75 double")


@query(
    "pool_union",
    f"""WITH {fx.ORD}, {fx.TRAIN}, {fx.TEST} SELECT row_id, o_totalprice, c_acctbal, 0 AS __dataset_id FROM train
        UNION ALL SELECT row_id, o_totalprice, NULL, 1 FROM test""",
)
def pool_union_query(spark, sf):
    train, test, _ = fx.order_splits(spark, sf)
    return pool([train.select("row_id", "o_totalprice", "c_acctbal"), test.select("row_id", "o_totalprice")])


@query(
    "explore",
    f"""WITH {fx.NULLS}, t AS ({type_sql(NULL_KINDS, 'nulls')}), d AS ({_each(NULL_NUMERIC, DESCRIBE)}),
          c AS ({corr_sql(NULL_NUMERIC, 'nulls')})
        SELECT "column", type, n_unique, n_missing, pct_missing, dtype, d.count, mean, std, min, q25, median, q75, max, corr
        FROM t LEFT JOIN d USING ("column") LEFT JOIN c USING ("column")""",
)
def explore_query(spark, sf):
    found = reports.explore_columns(fx.nulls(spark, sf), "target")
    return rounded(rounded(found, "mean", "std", "min", "q25", "median", "q75", "max", places=4), "corr")


def profile_sql() -> str:
    measures = ["count", "missing", "mean", "std", "min", "max", "median", "skewness", "kurtosis", "q25", "q75", "iqr",
                "zeros_pct", "negative_pct", "outlier_count"]
    numeric = " UNION ALL ".join(
        f"SELECT \"column\", '{m}' AS measure, round(CAST({m} AS DOUBLE), 4) AS value FROM num" for m in measures
    )
    other = " UNION ALL ".join(
        f"SELECT \"column\", '{m}' AS measure, round(CAST({m} AS DOUBLE), 4) AS value FROM cat"
        for m in ("count", "missing", "n_unique", "entropy", "most_common_pct")
    )
    return (
        f"WITH {fx.NULLS}, num AS ({' UNION ALL '.join(moment_sql(c) for c in NULL_NUMERIC)}),"
        f" cat AS ({categorical_sql('id', 'nulls')} UNION ALL {categorical_sql('l_returnflag', 'nulls')})"
        f" {numeric} UNION ALL {other}"
    )


@query("profile", profile_sql())
def profile_query(spark, sf):
    return rounded(reports.profile_long(reports.profile(fx.nulls(spark, sf), "target")), "value", places=4)
