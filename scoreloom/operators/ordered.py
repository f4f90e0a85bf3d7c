"""Ordered target statistics: a category's rate among the rows before each row in a hash order.

A row's own label never enters its feature, so the encoding can be fitted and used on the same rows, at any number of
levels.  With folds, each row carries one value per fold left out and one for none, from a single pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.scalar import category_text
from scoreloom.operators.lookup import HOT_SHARE, lookup
from scoreloom.session import materialize

#: Ranges of the hash order that a hot category is split into.
PARTS = 64
#: Columns whose rates are found in one chain of shuffles, and the most columns that rows carry through one themselves; wider
#: rows send their key, label and categories, and are joined.
BATCH = 4
NARROW = 24


@dataclass(frozen=True)
class OrderedEncoding:
    """Totals per (column, value) and the folds that can be left out.

    ``totals`` holds (column, value, n, ns, pos): rows, and rows and positives per fold in the order of ``folds``.
    ``priors`` has the rate outside each fold, then the rate of all rows.  Without folds there is one part, never left out.
    """

    columns: tuple[str, ...]
    folds: tuple[int, ...]
    weight: float
    priors: tuple[float, ...]
    totals: DataFrame

    def pick(self, fold: int | None = None) -> int:
        """Place of the value that leaves ``fold`` out (None: that uses every row)."""
        return len(self.priors) - 1 if fold is None else self.folds.index(fold)


def _long(df: DataFrame, cats: Sequence[str], *keep: Column) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), category_text(F.col(f"`{c}`")).alias("value")) for c in cats])
    return df.select(*keep, F.inline(cells))


def _fold_of(fold: str | None, folds: Sequence[int]) -> Column:
    """Zero-based place of a row's fold."""
    if fold is None:
        return F.lit(0)
    return F.array_position(F.array(*[F.lit(f) for f in folds]), F.col(fold).cast("int")).cast("int") - 1


def _values(ns: Sequence[Column], pos: Sequence[Column], enc: OrderedEncoding) -> Column:
    """One smoothed rate per fold left out, then the one over all folds, from counts and positives per fold."""
    def rate(out: int | None, prior: float) -> Column:
        use = [i for i in range(len(ns)) if i != out]
        n, p = (sum((x[i] for i in use[1:]), x[use[0]]) if use else F.lit(0.0) for x in (ns, pos))
        return (p + enc.weight * prior) / (n + enc.weight)

    skipped = list(range(len(enc.folds))) + [None]
    return F.array(*[rate(out, prior) for out, prior in zip(skipped, enc.priors)])


def fit_ordered(
    df: DataFrame, cats: Sequence[str], target: str, fold: str | None = None, weight: float = 1.0
) -> OrderedEncoding:
    """Rows and positives per (column, category, fold), from one shuffle of counts for all columns."""
    facts = df.groupBy(*([fold] if fold else [])).agg(
        F.count(target).alias("n"), F.coalesce(F.sum(F.col(target).cast("double")), F.lit(0.0)).alias("pos")
    ).collect()
    folds = tuple(sorted(r[fold] for r in facts)) if fold else ()
    n, pos = sum(r["n"] for r in facts), sum(r["pos"] for r in facts)
    rest = [(n - r["n"], pos - r["pos"]) for f in folds for r in facts if r[fold] == f] + [(n, pos)]
    priors = tuple(p / m if m else 0.5 for m, p in rest)
    parts = range(len(folds) or 1)
    place = _fold_of(fold, folds)
    long = _long(df, cats, F.col(target).cast("double").alias("y"), place.alias("f")).where(F.col("y").isNotNull())
    totals = long.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.count_if(F.col("f") == i).cast("double") for i in parts]).alias("ns"),
        F.array(*[F.coalesce(F.sum(F.when(F.col("f") == i, F.col("y"))), F.lit(0.0)) for i in parts]).alias("pos"),
    )
    return OrderedEncoding(tuple(cats), folds, weight, priors, materialize(totals, "ordered_totals"))


def _packed(df: DataFrame, key: str, long: DataFrame, enc: OrderedEncoding, suffix: str) -> DataFrame:
    """The long values as columns of the rows again: one shuffle of the rows for any number of columns."""
    packed = long.groupBy("__key").agg(F.map_from_entries(F.collect_list(F.struct("column", "rates"))).alias("__rates"))
    joined = df.join(packed.withColumnRenamed("__key", key), key, "left")
    unseen = F.array(*[F.lit(p) for p in enc.priors])
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.coalesce(F.col("__rates")[c], unseen).alias(f"{c}{suffix}") for c in enc.columns],
    )


def apply_totals(df: DataFrame, enc: OrderedEncoding, key: str, suffix: str = "__ots") -> DataFrame:
    """Rows that were not fitted: a category's rates over all fitted rows; an unseen one gets the priors."""
    long = lookup(_long(df, enc.columns, F.col(key).alias("__key")), enc.totals, ["column", "value"], "n")
    parts = range(len(enc.folds) or 1)
    zero = F.lit(0.0)
    rates = _values(*[[F.coalesce(F.col(c)[i], zero) for i in parts] for c in ("ns", "pos")], enc)
    return _packed(df, key, long.select("__key", "column", rates.alias("rates")), enc, suffix)


def ordered_rates(
    df: DataFrame, enc: OrderedEncoding, target: str, key: str, fold: str | None = None, seed: int = 42,
    suffix: str = "__ots", parts: int = PARTS, hot_share: int = HOT_SHARE,
) -> DataFrame:
    """Add ``<c><suffix>`` to the fitted rows: an array of rates, one per fold left out and one for none.

    Rows follow the md5 of key and seed.  A rate counts the earlier rows of the category outside the fold left out; the
    rate that leaves out a row's own fold, which that fold's model never trains on, counts all rows outside it.  ``key``
    must be unique.

    A category with more than one in ``hot_share`` rows is split into ``parts`` ranges of the hash, each ordered by itself;
    sums of the ranges before are carried in.  So no category, however large, is ordered in one task.
    """
    hot = _hot(enc, hot_share)
    facts = [key, target, *([fold] if fold else [])]
    batches = [enc.columns[i : i + BATCH] for i in range(0, len(enc.columns), BATCH)]
    if len(batches) <= 1 and len(df.columns) <= NARROW:
        return _chained(df, enc.columns, hot, enc, target, key, fold, seed, suffix, parts)
    out = df
    for batch in batches:
        narrow = _chained(df.select(*{c: None for c in (*facts, *batch)}), batch, hot, enc, target, key, fold, seed, suffix, parts)
        out = out.join(narrow.select(key, *[f"{c}{suffix}" for c in batch]), key, "left")
    return out


def _hot(enc: OrderedEncoding, hot_share: int) -> DataFrame:
    """Totals of the categories that are split: at most ``hot_share`` a column."""
    rows = enc.totals.groupBy("column").agg(F.sum("n").alias("all"))
    hot = enc.totals.join(F.broadcast(rows), "column").where(F.col("n") * hot_share > F.col("all"))
    return materialize(hot.select("column", "value", F.lit(True).alias("hot")), "ordered_hot")


def _chained(
    df: DataFrame, cats: Sequence[str], hot: DataFrame, enc: OrderedEncoding, target: str, key: str, fold: str | None, seed: int,
    suffix: str, parts: int,
) -> DataFrame:
    """``df`` with the rates of ``cats``: its rows go from category to category, one shuffle a column.

    Totals of a category that is not hot are those of its window, so the rates that leave out a row's own fold need no join.
    """
    order = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))
    part = F.floor(F.conv(F.substring(order, 1, 8), 16, 10).cast("bigint") * parts / float(1 << 32)).cast("int")
    n_parts, zero = range(len(enc.folds) or 1), F.lit(0.0)
    y, place = F.col(target).cast("double"), _fold_of(fold, enc.folds)
    counted = F.when(y.isNotNull(), F.lit(1.0)).otherwise(zero)
    gained = {f"__n{i}": F.when(place == i, counted).otherwise(zero) for i in n_parts}
    gained |= {f"__p{i}": F.when(place == i, F.coalesce(y, zero)).otherwise(zero) for i in n_parts}

    def placed_rows(rows: DataFrame, c: str, mine: DataFrame) -> DataFrame:
        marked = rows.withColumn("__value", category_text(F.col(f"`{c}`"))).join(F.broadcast(mine), "__value", "left")
        return marked.withColumn("__part", F.when(F.col("__hot"), part).otherwise(F.lit(0)))

    given = df
    for c in cats:
        mine = hot.where(F.col("column") == c).select(F.col("value").alias("__value"), F.col("hot").alias("__hot"))
        base = df.columns
        # At most hot_share categories a column are hot, each with ``parts`` rows here.
        sums = placed_rows(given, c, mine).where("__hot").groupBy("__value", "__part").agg(
            *[F.sum(x).alias(name) for name, x in gained.items()]
        )
        earlier = Window.partitionBy("__value").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy("__value")
        carried = materialize(
            sums.select(
                "__value", "__part", *[F.coalesce(F.sum(x).over(earlier), zero).alias(f"__c{x}") for x in gained],
                *[F.sum(x).over(whole).alias(f"__t{x}") for x in gained],
            ),
            "ordered_carried",
        )
        # The hash is taken again behind the shuffle, which then carries no 32 characters of it per row.
        ordered = placed_rows(df, c, mine).drop("__hot").repartition("__value", "__part").withColumn("__at", order)
        window = Window.partitionBy("__value", "__part").orderBy("__at", key)
        before, all_rows = (window.rowsBetween(Window.unboundedPreceding, end) for end in (-1, Window.unboundedFollowing))
        sides = {f"__b{x}": F.coalesce(F.sum(v).over(before), zero) for x, v in gained.items()}
        if enc.folds:
            sides |= {f"__a{x}": F.sum(v).over(all_rows) for x, v in gained.items()}
        joined = ordered.select(*[f"`{b}`" for b in base], "__value", "__part", *[v.alias(x) for x, v in sides.items()]).join(
            F.broadcast(carried), ["__value", "__part"], "left"
        )
        ns, pos = ([F.col(f"__b__{k}{i}") + F.coalesce(F.col(f"__c__{k}{i}"), zero) for i in n_parts] for k in ("n", "p"))
        rates = _values(ns, pos, enc)
        if enc.folds:
            own = _values(*[[F.coalesce(F.col(f"__t__{k}{i}"), F.col(f"__a__{k}{i}")) for i in n_parts] for k in ("n", "p")], enc)
            joined = joined.withColumns({"__rates": rates, "__own": own})
            rates = F.transform("__rates", lambda r, i: F.when(i == place, F.get("__own", i)).otherwise(r))
        df = joined.select(*[f"`{b}`" for b in base], rates.alias(f"{c}{suffix}"))
    return df
