"""Encodings, folds, ranks, bins, transforms and feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.functions import scalar
from scoreloom.operators import encode, features as feat, folds, metrics, ordering, select
from scoreloom.session import materialize
from scoreloom.suite import fixtures as fx
from scoreloom.suite.profiles import ZERO_CORR, pair_corr_sql
from scoreloom.suite.registry import query, rounded

FOLDED = f"folded AS (SELECT *, {fx.fold_sql('row_id', 'target')} AS fold FROM train)"


def _train(spark, sf):
    train, test, _ = fx.order_splits(spark, sf)
    return train, test


def _folded(spark, sf):
    return materialize(folds.safe_folds(_train(spark, sf)[0], "row_id", "target", 5, 42), "folded")


@query("stratified_folds", f"WITH {fx.LINE} SELECT id, target, {fx.fold_sql('id', 'target')} AS fold FROM line")
def stratified_folds_query(spark, sf):
    return folds.assign_folds(fx.line(spark, sf).select("id", "target"), "id", 5, 42, "target")


@query("plain_folds", f"WITH {fx.LINE} SELECT id, {fx.fold_sql('id', None, 3)} AS fold FROM line")
def plain_folds_query(spark, sf):
    return folds.assign_folds(fx.line(spark, sf).select("id"), "id", 3, 42)


@query(
    "stratified_holdout",
    f"""WITH {fx.LINE}, r AS (SELECT id, target, row_number() OVER (PARTITION BY target ORDER BY
          md5(concat_ws('-', id, '42')), id) AS place, count(*) OVER (PARTITION BY target) AS size FROM line)
        SELECT id, target, CAST(place <= ceil(0.2 * size) AS INTEGER) AS is_valid FROM r""",
)
def stratified_holdout_query(spark, sf):
    return folds.assign_holdout(fx.line(spark, sf).select("id", "target"), "id", 0.2, 42, "target")


@query(
    "target_encode",
    f"""WITH {fx.ORD}, {fx.TRAIN}, {fx.TEST}, g AS (SELECT avg(target) AS prior FROM train),
          e AS (SELECT n_name, count(*) AS n, sum(target) AS pos FROM train GROUP BY 1)
        SELECT row_id, round(coalesce((pos + 10 * prior) / (n + 10), prior), 6) AS n_name__te
        FROM test LEFT JOIN e USING (n_name) CROSS JOIN g""",
)
def target_encode_query(spark, sf):
    train, test = _train(spark, sf)
    enc = encode.fit_encoding(train, ["n_name"], "target")
    return rounded(encode.apply_encoding(test.select("row_id", "n_name"), enc).drop("n_name"), "n_name__te")


OOF = """g AS (SELECT avg(target) AS prior FROM folded),
  e AS (SELECT {c} AS c, fold, count(*) AS n, sum(target) AS pos FROM folded GROUP BY 1, 2),
  t AS (SELECT c, fold, sum(n) OVER (PARTITION BY c) - n AS n, sum(pos) OVER (PARTITION BY c) - pos AS pos FROM e)
  SELECT row_id, folded.fold, round((pos + 10 * prior) / (n + 10), 6) AS {c}__te
  FROM folded JOIN t ON folded.{c} = t.c AND folded.fold = t.fold CROSS JOIN g"""


@query("target_encode_oof", f"WITH {fx.ORD}, {fx.TRAIN}, {FOLDED}, {OOF.format(c='n_name')}")
def target_encode_oof_query(spark, sf):
    folded = _folded(spark, sf)
    enc = encode.fit_encoding(folded, ["n_name"], "target", "fold")
    encoded = encode.apply_oof_encoding(folded.select("row_id", "n_name", "fold"), enc, "fold")
    return rounded(encoded.select("row_id", "fold", "n_name__te"), "n_name__te")


@query(
    "target_encode_nulls",
    f"""WITH {fx.NULLS}, train AS (SELECT * FROM nulls WHERE target IS NOT NULL),
          folded AS (SELECT id AS row_id, coalesce(l_returnflag, '__NA__') AS flag, target,
            {fx.fold_sql('id', 'target')} AS fold FROM train), {OOF.format(c='flag')}""",
)
def target_encode_nulls_query(spark, sf):
    """A missing category is a level of its own."""
    train = fx.nulls(spark, sf).where(F.col("target").isNotNull())
    folded = materialize(folds.assign_folds(
        train.select(F.col("id").alias("row_id"), F.col("l_returnflag").alias("flag"), "target"), "row_id", 5, 42, "target"
    ), "folded")
    enc = encode.fit_encoding(folded, ["flag"], "target", "fold")
    encoded = encode.apply_oof_encoding(folded, enc, "fold")
    return rounded(encoded.select("row_id", "fold", "flag__te"), "flag__te")


@query(
    "freq_encode",
    f"""WITH {fx.ORD}, {fx.TRAIN}, {fx.TEST}, e AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS n FROM orders
          WHERE o_orderdate < TIMESTAMP '{fx.SPLIT_DATE}' GROUP BY 1)
        SELECT o_orderkey, coalesce(n, 0.0) AS o_custkey__freq FROM orders LEFT JOIN e USING (o_custkey)""",
)
def freq_encode_query(spark, sf):
    """Orders per customer before the split date, looked up for every order."""
    rows = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.lit(0).alias("y"))
    early = rows.where(F.col("o_orderdate") < F.lit(fx.SPLIT_DATE).cast("timestamp_ntz"))
    enc = encode.fit_encoding(early, ["o_custkey"], "y")
    return encode.apply_frequency(rows.select("o_orderkey", "o_custkey"), enc).drop("o_custkey")


@query(
    "label_encode",
    f"""WITH {fx.ORD}, {fx.TRAIN}, {fx.TEST}, d AS (SELECT n_name, row_number() OVER (ORDER BY n_name) - 1 AS code
          FROM (SELECT n_name FROM train UNION SELECT n_name FROM test))
        SELECT row_id, code AS n_name__code FROM test JOIN d USING (n_name)""",
)
def label_encode_query(spark, sf):
    train, test = _train(spark, sf)
    codes = encode.label_codes([train, test], "n_name")
    return encode.apply_codes(test.select("row_id", "n_name"), "n_name", codes, "n_name__code").drop("n_name")


@query(
    "impute",
    f"""WITH {fx.NULLS}, m AS (SELECT quantile_cont(l_quantity, 0.5) AS q, quantile_cont(l_tax, 0.5) AS t FROM nulls),
          c AS (SELECT l_returnflag AS f FROM nulls WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT id, coalesce(l_quantity, q) AS l_quantity, coalesce(l_tax, t) AS l_tax, coalesce(l_returnflag, f) AS l_returnflag
        FROM nulls CROSS JOIN m CROSS JOIN c""",
)
def impute_query(spark, sf):
    rows = fx.nulls(spark, sf).select("id", "l_quantity", "l_tax", "l_returnflag")
    return encode.apply_impute(rows, encode.fit_impute(rows, ["l_quantity", "l_tax"], ["l_returnflag"]))


@query(
    "one_hot",
    """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS o_orderstatus__F,
         CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus__O, CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus__P
       FROM orders""",
)
def one_hot_query(spark, sf):
    return encode.one_hot(fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus").drop(
        "o_orderstatus"
    )


@query(
    "hash_bucket",
    "SELECT c_custkey, CAST(('0x' || substr(md5(c_name), 1, 8)) AS BIGINT) % 64 AS bucket FROM customer",
)
def hash_bucket_query(spark, sf):
    return fx.table(spark, sf, "customer").select("c_custkey", scalar.hash_bucket("c_name", 64).alias("bucket"))


@query("rank_norm", f"{fx.pred_sql()} SELECT model, split, row_id, round({fx.rank_sql('p', ('model', 'split'))}, 6) AS r FROM preds")
def rank_norm_query(spark, sf):
    ranked = ordering.with_rank_fraction(fx.predictions(spark, sf), "p", "r", ["model", "split"])
    return rounded(ranked.select("model", "split", "row_id", "r"), "r")


@query(
    "pct_rank",
    f"""WITH {fx.NULLS}, r AS (SELECT id, {fx.rank_sql('l_quantity')} AS l_quantity__rank FROM nulls
          WHERE l_quantity IS NOT NULL)
        SELECT nulls.id, round(l_quantity__rank, 6) AS l_quantity__rank FROM nulls LEFT JOIN r ON nulls.id = r.id""",
)
def pct_rank_query(spark, sf):
    ranked = feat.rank_features(fx.nulls(spark, sf).select("id", "l_quantity"), ["l_quantity"])
    return rounded(ranked.select("id", "l_quantity__rank"), "l_quantity__rank")


def quantile_bin_sql(c: str, source: str) -> str:
    probs = ", ".join(str(i / 10) for i in range(11))
    return (
        f"SELECT id, CAST(greatest(0, len(list_filter(e, lambda x: x < {c})) - 1) AS INTEGER) AS {c}__bin10 FROM {source},"
        f" (SELECT list_distinct(quantile_cont({c}, [{probs}])) AS e FROM {source})"
    )


@query("quantile_bin", f"WITH {fx.LINE} {quantile_bin_sql('l_discount', 'line')}")
def quantile_bin_query(spark, sf):
    rows = fx.line(spark, sf).select("id", "l_discount")
    return feat.bin_features(rows, feat.quantile_edges(rows, ["l_discount"])).drop("l_discount")


@query(
    "width_bin",
    f"""WITH {fx.LINE}, e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM line),
          edges AS (SELECT list_transform(range(0, 10), lambda i: lo + i * ((hi - lo) / 10)) || [hi] AS e FROM e)
        SELECT id, CAST(greatest(0, len(list_filter(e, lambda x: x < l_extendedprice)) - 1) AS INTEGER) AS l_extendedprice__bin10
        FROM line, edges""",
)
def width_bin_query(spark, sf):
    rows = fx.line(spark, sf).select("id", "l_extendedprice")
    edges = feat.equal_width_edges(feat.column_stats(rows, ["l_extendedprice"]))
    return feat.bin_features(rows, edges).drop("l_extendedprice")


@query(
    "ffill",
    """WITH e AS (SELECT event_id, ts, CASE WHEN event_type IN ('click', 'view') THEN value END AS value FROM events)
       SELECT event_id, last_value(value IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS filled
       FROM e""",
)
def ffill_query(spark, sf):
    seen = F.when(F.col("event_type").isin("click", "view"), F.col("value"))
    rows = fx.table(spark, sf, "events").select("event_id", "ts", seen.alias("value"))
    return ordering.forward_fill(rows, "value", ["ts", "event_id"], "filled").select("event_id", "filled")


@query(
    "missing_flags",
    f"""WITH {fx.NULLS} SELECT id, CAST(l_quantity IS NULL AS DOUBLE) AS l_quantity__is_missing,
        CAST(l_tax IS NULL AS DOUBLE) AS l_tax__is_missing, CAST(l_returnflag IS NULL AS DOUBLE) AS l_returnflag__is_missing
        FROM nulls""",
)
def missing_flags_query(spark, sf):
    rows = fx.nulls(spark, sf)
    columns = ["l_quantity", "l_extendedprice", "l_tax", "l_returnflag"]
    return feat.missing_flags(rows, feat.missing_rates(rows, columns)).drop(*columns, "l_discount", "target")


@query(
    "log_features",
    """SELECT c_custkey, round(ln(1 + c_custkey), 6) AS c_custkey__log FROM customer""",
)
def log_features_query(spark, sf):
    """Balances go below zero, so only the key gets a logarithm."""
    rows = fx.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    out = feat.log_features(rows, feat.column_stats(rows, ["c_custkey", "c_acctbal"])).drop("c_acctbal")
    return rounded(out, "c_custkey__log")


@query("sqrt_features", f"WITH {fx.NULLS} SELECT id, round(sqrt(l_extendedprice), 6) AS l_extendedprice__sqrt, round(sqrt(l_quantity), 6) AS l_quantity__sqrt FROM nulls")
def sqrt_features_query(spark, sf):
    rows = fx.nulls(spark, sf).select("id", "l_extendedprice", "l_quantity")
    out = feat.sqrt_features(rows, feat.column_stats(rows, ["l_extendedprice", "l_quantity"]))
    return rounded(out.drop("l_extendedprice", "l_quantity"), "l_extendedprice__sqrt", "l_quantity__sqrt")


@query(
    "interactions",
    f"""WITH {fx.NULLS} SELECT id, round(l_quantity * l_tax, 6) AS l_quantity__x__l_tax,
        round(l_quantity * l_discount, 6) AS l_quantity__x__l_discount, round(l_tax * l_discount, 6) AS l_tax__x__l_discount
        FROM nulls""",
)
def interactions_query(spark, sf):
    rows = fx.nulls(spark, sf).select("id", "l_quantity", "l_tax", "l_discount")
    out = feat.interactions(rows, feat.triangle_pairs(["l_quantity", "l_tax", "l_discount"], 4, 6))
    out = out.drop("l_quantity", "l_tax", "l_discount")
    return rounded(out, *[c for c in out.columns if c != "id"])


@query(
    "differences",
    f"""WITH {fx.NULLS} SELECT id, round(l_quantity - l_tax, 6) AS l_quantity__minus__l_tax,
        round(l_tax - l_discount, 6) + 0.0 AS l_tax__minus__l_discount FROM nulls""",
)
def differences_query(spark, sf):
    rows = fx.nulls(spark, sf).select("id", "l_quantity", "l_tax", "l_discount")
    out = feat.differences(rows, feat.neighbour_pairs(["l_quantity", "l_tax", "l_discount"], 1))
    out = out.drop("l_quantity", "l_tax", "l_discount")
    return rounded(out, *[c for c in out.columns if c != "id"])


@query(
    "row_aggregates",
    f"""WITH {fx.NULLS}, v AS (SELECT id, unnest([l_quantity, l_discount, l_tax]) AS v FROM nulls)
        SELECT id, round(avg(v), 6) AS __row_mean, round(stddev_samp(v), 6) AS __row_std, max(v) AS __row_max, min(v) AS __row_min
        FROM v GROUP BY id""",
)
def row_aggregates_query(spark, sf):
    rows = fx.nulls(spark, sf).select("id", "l_quantity", "l_discount", "l_tax")
    out = feat.row_aggregates(rows, ["l_quantity", "l_discount", "l_tax"]).drop("l_quantity", "l_discount", "l_tax")
    return rounded(out, "__row_mean", "__row_std")


@query(
    "zscore",
    f"""WITH {fx.NULLS}, s AS (SELECT avg(l_quantity) AS m, stddev_samp(l_quantity) AS d FROM nulls)
        SELECT id, round((l_quantity - m) / d, 6) + 0.0 AS l_quantity__zscore FROM nulls, s""",
)
def zscore_query(spark, sf):
    rows = fx.nulls(spark, sf).select("id", "l_quantity", F.lit(2.0).alias("flat"))
    out = feat.zscore(rows, feat.column_stats(rows, ["l_quantity", "flat"])).drop("l_quantity", "flat")
    return rounded(out, "l_quantity__zscore")


@query(
    "standard_scale",
    """SELECT o_orderkey, round((o_totalprice - m) / d, 6) + 0.0 AS o_totalprice FROM orders,
       (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM orders)""",
)
def standard_scale_query(spark, sf):
    rows = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rounded(feat.standard_scale(rows, feat.column_stats(rows, ["o_totalprice"])), "o_totalprice")


@query(
    "minmax_scale",
    """SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo), 6) AS o_totalprice FROM orders,
       (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)""",
)
def minmax_scale_query(spark, sf):
    rows = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rounded(feat.minmax_scale(rows, feat.column_stats(rows, ["o_totalprice"])), "o_totalprice")


@query(
    "pooled_features",
    f"""WITH {fx.ORD}, {fx.TRAIN}, {fx.TEST}, s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS d FROM
          (SELECT o_totalprice FROM train UNION ALL SELECT o_totalprice FROM test))
        SELECT row_id, round(o_totalprice - m, 4) + 0.0 AS o_totalprice__dev_from_global_mean,
          round((o_totalprice - m) / d, 6) + 0.0 AS o_totalprice__global_zscore FROM train, s""",
)
def pooled_features_query(spark, sf):
    train, test = _train(spark, sf)
    sets = [df.select("row_id", "o_totalprice") for df in (train, test)]
    stats = feat.column_stats(feat.pool(sets), ["o_totalprice"])
    out = feat.pooled_features(sets[0], stats).drop("o_totalprice")
    out = rounded(out, "o_totalprice__dev_from_global_mean", places=4)
    return rounded(out, "o_totalprice__global_zscore")


@query(
    "pooled_features_all",
    f"""WITH {fx.ORD}, {fx.TRAIN}, {fx.TEST}, p AS (SELECT 0 AS dataset_id, row_id, o_totalprice FROM train
          UNION ALL SELECT 1, row_id, o_totalprice FROM test),
        s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS d FROM p)
        SELECT dataset_id, row_id, round(o_totalprice - m, 4) + 0.0 AS o_totalprice__dev_from_global_mean,
          round((o_totalprice - m) / d, 6) + 0.0 AS o_totalprice__global_zscore FROM p, s""",
)
def pooled_features_all_query(spark, sf):
    """Features of every pooled table, with the table's number."""
    sets = [df.select("row_id", "o_totalprice").withColumn("dataset_id", F.lit(i)) for i, df in enumerate(_train(spark, sf))]
    pooled = sets[0].unionByName(sets[1])
    out = feat.pooled_features(pooled, feat.column_stats(pooled, ["o_totalprice"])).drop("o_totalprice")
    out = rounded(out, "o_totalprice__dev_from_global_mean", places=4)
    out = rounded(out, "o_totalprice__global_zscore")
    return out.select("dataset_id", "row_id", "o_totalprice__dev_from_global_mean", "o_totalprice__global_zscore")


@query(
    "datetime_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS ts__year, CAST(month(ts) AS INTEGER) AS ts__month,
         CAST(day(ts) AS INTEGER) AS ts__day, CAST(isodow(ts) - 1 AS INTEGER) AS ts__dayofweek,
         CAST(hour(ts) AS INTEGER) AS ts__hour, CAST(quarter(ts) AS INTEGER) AS ts__quarter,
         CAST(isodow(ts) >= 6 AS INTEGER) AS ts__is_weekend FROM events""",
)
def datetime_parts_query(spark, sf):
    return feat.add_datetime_parts(fx.table(spark, sf, "events").select("event_id", "ts"), ["ts"]).drop("ts")


CYCLE = "round({f}({v} * 2 * pi() / {k}), 6) + 0.0 AS ts__{n}_{f}"


@query(
    "datetime_cyclical",
    "SELECT event_id, "
    + ", ".join(
        CYCLE.format(f=f, v=f"{n}(ts)", k=k, n=n) for n, k in (("month", 12), ("day", 31), ("hour", 24)) for f in ("sin", "cos")
    )
    + " FROM events",
)
def datetime_cyclical_query(spark, sf):
    out = feat.add_datetime_parts(fx.table(spark, sf, "events").select("event_id", "ts"), ["ts"], cyclical=True).drop("ts")
    return rounded(out, *[c for c in out.columns if c != "event_id"])


@query(
    "ratio_features",
    f"""WITH {fx.NULLS} SELECT id, CASE WHEN l_discount <> 0 THEN round(l_tax / l_discount, 6) END AS l_tax__over__l_discount
        FROM nulls""",
)
def ratio_features_query(spark, sf):
    rows = fx.nulls(spark, sf).select("id", "l_tax", "l_discount")
    return rounded(feat.ratios(rows, [("l_tax", "l_discount")]).drop("l_tax", "l_discount"), "l_tax__over__l_discount")


@query(
    "group_features",
    """SELECT o_orderkey, round(avg(o_totalprice) OVER w, 6) AS o_totalprice__mean_by_o_custkey,
         round(o_totalprice - avg(o_totalprice) OVER w, 6) + 0.0 AS o_totalprice__dev_by_o_custkey
       FROM orders WINDOW w AS (PARTITION BY o_custkey)""",
)
def group_features_query(spark, sf):
    rows = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = feat.group_features(rows, "o_custkey", ["o_totalprice"]).drop("o_custkey", "o_totalprice")
    return rounded(out, "o_totalprice__mean_by_o_custkey", "o_totalprice__dev_by_o_custkey")


ENGINEERED = ("l_quantity", "double_quantity", "l_tax", "noisy_tax", "l_discount")
ENGINEERED_SQL = f"""eng AS (SELECT id, target, l_quantity, 2 * l_quantity + 1 AS double_quantity, l_tax,
  l_tax + l_discount / 1000 AS noisy_tax, l_discount FROM line)"""


def _engineered(spark, sf):
    return fx.line(spark, sf).select(
        "id", "target", "l_quantity", (F.col("l_quantity") * 2 + 1).alias("double_quantity"), "l_tax",
        (F.col("l_tax") + F.col("l_discount") / 1000).alias("noisy_tax"), "l_discount",
    )


@query(
    "corr_prune",
    f"""WITH {fx.LINE}, {ENGINEERED_SQL}, p AS ({pair_corr_sql(ENGINEERED, 'eng')})
        SELECT DISTINCT b AS "column" FROM p WHERE corr > 0.95""",
)
def corr_prune_query(spark, sf):
    return select.correlated_columns(_engineered(spark, sf), ENGINEERED, 0.95)


def mi_sql(columns, source: str) -> str:
    probs = ", ".join(str(i / 10) for i in range(11))
    parts = []
    for c in columns:
        parts.append(
            f"SELECT '{c}' AS \"column\", round(sum(n / t * ln(n * t / (nb * ny))), 6) AS mi FROM ("
            f"SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY b) AS nb, sum(n) OVER (PARTITION BY y) AS ny FROM ("
            f"SELECT greatest(0, len(list_filter(e, lambda x: x < coalesce({c}, 0.0))) - 1) AS b, target AS y, CAST(count(*) AS DOUBLE) AS n"
            f" FROM {source}, (SELECT list_distinct(quantile_cont(coalesce({c}, 0.0), [{probs}])) AS e FROM {source})"
            f" GROUP BY 1, 2))"
        )
    return " UNION ALL ".join(parts)


@query("mutual_info", f"WITH {fx.DOCS} {mi_sql(fx.DOC_NUMERIC, 'docs')}")
def mutual_info_query(spark, sf):
    return rounded(select.mutual_information(fx.docs(spark, sf), fx.DOC_NUMERIC, "target"), "mi")


def importance_sql(source: str, columns) -> str:
    zero = " UNION ALL ".join(ZERO_CORR.format(c=c, s=source) for c in columns)
    return (
        f"mi AS ({mi_sql(columns, source)}), co AS ({zero}), imp AS (SELECT \"column\", mi, corr,"
        f" round((mi / max(mi) OVER () + corr / max(corr) OVER ()) / 2, 6) AS avg_importance"
        f" FROM mi JOIN co USING (\"column\"))"
    )


def _importances(rows, columns):
    from scoreloom.operators.profile import target_corr

    mi = rounded(select.mutual_information(rows, columns, "target"), "mi")
    corr = rounded(target_corr(rows, columns, "target", zero_fill=True), "corr")
    return rounded(select.average_importance(mi.join(corr, "column"), ["mi", "corr"]), "avg_importance")


@query("importance_avg", f"WITH {fx.DOCS}, {importance_sql('docs', fx.DOC_NUMERIC)} SELECT * FROM imp")
def importance_avg_query(spark, sf):
    return _importances(fx.docs(spark, sf), fx.DOC_NUMERIC)


@query(
    "select_features",
    f"""WITH {fx.DOCS}, {importance_sql('docs', fx.DOC_NUMERIC)} SELECT "column", avg_importance FROM imp
        WHERE avg_importance >= (SELECT quantile_cont(avg_importance, 0.2) FROM imp)
        ORDER BY avg_importance DESC, "column" LIMIT 3""",
)
def select_features_query(spark, sf):
    table = _importances(fx.docs(spark, sf), fx.DOC_NUMERIC)
    return select.select_by_importance(table, "avg_importance", 0.2, 3).select("column", "avg_importance")


WIDE_DOCS = ("alpha", "n_chars", "n_words", "digits")


@query(
    "feature_selection",
    f"""WITH {fx.DOCS}, {importance_sql('docs', WIDE_DOCS)}, pairs AS ({pair_corr_sql(WIDE_DOCS, 'docs')}),
          left_over AS (SELECT "column", avg_importance FROM imp WHERE "column" NOT IN (SELECT b FROM pairs WHERE corr > 0.95))
        SELECT "column" FROM left_over WHERE avg_importance >= (SELECT quantile_cont(avg_importance, 0.2) FROM left_over)
        UNION ALL SELECT 'lang' UNION ALL SELECT 'source'""",
)
def feature_selection_query(spark, sf):
    rows = fx.docs(spark, sf)
    kept, _ = select.select_features(rows, WIDE_DOCS, ["lang", "source"], _importances(rows, WIDE_DOCS))
    return spark.createDataFrame([(c,) for c in kept], "column string")


@query(
    "column_auc_docs",
    f"""WITH {fx.DOCS}, folded AS (SELECT *, {fx.fold_sql('doc_id', 'target')} AS fold FROM docs),
          g AS (SELECT avg(target) AS prior FROM docs),
          el AS (SELECT lang AS c, fold, count(*) AS n, sum(target) AS pos FROM folded GROUP BY 1, 2),
          tl AS (SELECT c, fold, sum(n) OVER (PARTITION BY c) - n AS n, sum(pos) OVER (PARTITION BY c) - pos AS pos FROM el),
          es AS (SELECT source AS c, fold, count(*) AS n, sum(target) AS pos FROM folded GROUP BY 1, 2),
          ts AS (SELECT c, fold, sum(n) OVER (PARTITION BY c) - n AS n, sum(pos) OVER (PARTITION BY c) - pos AS pos FROM es),
          long AS (
            SELECT 'alpha' AS model, alpha AS p, target AS y FROM folded
            UNION ALL SELECT 'n_chars', n_chars, target FROM folded
            UNION ALL SELECT 'digits', digits, target FROM folded
            UNION ALL SELECT 'n_words', n_words, target FROM folded
            UNION ALL SELECT 'lang__te', (pos + 10 * prior) / (n + 10), target
              FROM folded JOIN tl ON lang = c AND folded.fold = tl.fold CROSS JOIN g
            UNION ALL SELECT 'source__te', (pos + 10 * prior) / (n + 10), target
              FROM folded JOIN ts ON source = c AND folded.fold = ts.fold CROSS JOIN g)
        SELECT model AS "column", round(auc, 6) AS auc FROM ({fx.auc_sql('long')})""",
)
def column_auc_docs_query(spark, sf):
    """Which column alone ranks document quality best: folds, out-of-fold encodings, exact AUC."""
    rows = materialize(fx.docs(spark, sf), "docs")  # counts are taken from the texts once, for the folds and all fits
    folded = materialize(folds.safe_folds(rows, "doc_id", "target", 5, 42), "folded")
    enc = encode.fit_encoding(folded, ["lang", "source"], "target", "fold")
    encoded = encode.apply_oof_encoding(folded, enc, "fold")
    columns = [*fx.DOC_NUMERIC, "lang__te", "source__te"]
    return rounded(metrics.column_auc(encoded, columns, "target"), "auc").orderBy(F.desc("auc"), "column")
