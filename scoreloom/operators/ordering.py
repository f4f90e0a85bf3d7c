"""Global order without a single-task window.

``Window.orderBy`` with no partition sends every row to one task.  Here equal values are first
collapsed by a map-side-combined ``groupBy``; Spark's sampled range partitioner then orders the
collapsed rows, a window runs inside each range, and one small row per range carries the offset.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.scalar import nan_to_null
from scoreloom.operators.lookup import lookup
from scoreloom.session import broadcast_limit, estimated_bytes, materialize


def in_ranges(df: DataFrame, keys: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Range-partition by ``keys`` and expose the range number as ``__range``."""
    split = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    return split.withColumn("__range", F.spark_partition_id())


def _offsets(df: DataFrame, groups: Sequence[str], weight: str) -> DataFrame:
    """Per (group, range): weight of earlier ranges and of the whole group.

    One row per range plus at most one extra per group, so its size follows the partition count.
    """
    blocks = df.groupBy(*groups, "__range").agg(F.sum(weight).alias("__weight"))
    whole = Window.partitionBy(*(groups or [F.lit(0)]))
    earlier = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        *groups,
        "__range",
        F.coalesce(F.sum("__weight").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__weight").over(whole).alias("__total"),
    )


def positioned(
    collapsed: DataFrame, keys: Sequence[str], groups: Sequence[str] = (), weight: str = "n", ranges: int | None = None
) -> tuple[DataFrame, int]:
    """Add ``upto`` (weight of all rows at or before this one) and ``total`` per group.

    ``collapsed`` must hold one row per (groups, keys).  Also returns the bytes of the stored
    ordered rows, which bound the size of the result.
    """
    groups = list(groups)
    staged = materialize(in_ranges(collapsed, [*groups, *keys], ranges), "ordered")
    inside = Window.partitionBy(*groups, "__range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    local = staged.withColumn("__inside", F.sum(weight).over(inside))
    joined = local.join(F.broadcast(_offsets(staged, groups, weight)), [*groups, "__range"])
    placed = joined.select(
        *collapsed.columns,
        (F.col("__inside") + F.col("__before")).alias("upto"),
        F.col("__total").alias("total"),
    )
    return placed, estimated_bytes(staged)


def value_ranks(
    df: DataFrame, value: str, groups: Sequence[str] = (), ranges: int | None = None
) -> tuple[DataFrame, int]:
    """One row per distinct value: row count ``n``, tie-averaged ``rank_avg``, group ``total``; and bytes."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("n"))
    placed, size = positioned(counts, [value], groups, "n", ranges)
    ranks = placed.select(
        *groups,
        value,
        "n",
        (F.col("upto") - (F.col("n") - 1) / 2.0).alias("rank_avg"),
        "total",
    )
    return ranks, size


def with_rank_fraction(
    df: DataFrame, value: str, out: str, groups: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Tie-averaged rank divided by the non-null count, in (0, 1]; NULL stays NULL."""
    ranks, size = value_ranks(df, value, groups, ranges)
    table = ranks.select(*groups, value, "n", (F.col("rank_avg") / F.col("total")).alias(out))
    return lookup(df, table, [*groups, value], "n", size, again=True)


def with_rank_fractions(
    df: DataFrame, columns: Sequence[str], suffix: str, key: str | None = None, ranges: int | None = None
) -> DataFrame:
    """Rank fractions of several columns from one ordered pass over (column, value) counts.

    Small rank tables are broadcast column by column.  Larger ones would shuffle the wide rows once
    per column, so with a unique ``key`` the rows go through one long lookup instead and come back
    by key.
    """
    columns = list(columns)
    if not columns:
        return df
    ranks, size = value_ranks(unpivot_numeric(df, columns), "value", ["column"], ranges)
    table = materialize(ranks.select("column", "value", "n", (F.col("rank_avg") / F.col("total")).alias("__rank")), "ranks")
    if key is not None and size > broadcast_limit(df.sparkSession):
        long = unpivot_numeric(df, columns, key).where(F.col("value").isNotNull())
        ranked = lookup(long, table, ["column", "value"], "n", size, again=True)
        wide = ranked.groupBy(key).agg(*[F.first(F.when(F.col("column") == c, F.col("__rank")), ignorenulls=True).alias(c) for c in columns])
        return df.join(wide.withColumnsRenamed({c: f"{c}{suffix}" for c in columns}), key, "left")
    for c in columns:
        part = table.where(F.col("column") == c).select(
            F.col("value").alias("__value"), "n", F.col("__rank").alias(f"{c}{suffix}")
        )
        keyed = df.withColumn("__value", nan_to_null(F.col(f"`{c}`").cast("double")))
        df = lookup(keyed, part, ["__value"], "n", size).drop("__value")
    return df


def dense_codes(
    df: DataFrame, value: str, groups: Sequence[str] = (), ranges: int | None = None
) -> tuple[DataFrame, int]:
    """Zero-based position of each distinct value in sorted order, with its row count ``n``; and bytes."""
    distinct = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("n"))
    single = distinct.withColumn("__one", F.lit(1).cast("bigint"))
    placed, size = positioned(single, [value], groups, "__one", ranges)
    return placed.select(*groups, value, "n", (F.col("upto") - 1).cast("bigint").alias("code")), size


def _order_statistics(
    df: DataFrame, wanted: dict[str, list[int]], ranges: int | None
) -> dict[tuple[str, int], float]:
    """Values at the given zero-based positions of each column, in one ordered pass.

    Collapsed (column, value) counts are range-partitioned, and only rows that cover a wanted
    position come back: at most one per requested position.
    """
    long = unpivot_numeric(df, list(wanted)).where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    placed, _ = positioned(counts, ["value"], ["column"], "n", ranges)
    start = F.col("upto") - F.col("n")
    hits = _any(
        (F.col("column") == c) & _any((start <= k) & (k < F.col("upto")) for k in ks) for c, ks in wanted.items()
    )
    found: dict[tuple[str, int], float] = {}
    for row in placed.where(hits).select("column", "value", start.alias("start"), "upto").collect():
        for k in wanted[row["column"]]:
            if row["start"] <= k < row["upto"]:
                found[(row["column"], k)] = row["value"]
    return found


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def unpivot_numeric(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """Long form (keep..., column, value DOUBLE) of numeric columns; NaN counts as missing."""
    wide = df.select(*keep, *[nan_to_null(F.col(f"`{c}`").cast("double")).alias(c) for c in columns])
    return wide.unpivot(list(keep), list(columns), "column", "value")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = 10_000, ranges: int | None = None
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of every column, exact at any size.

    Spark's ``percentile`` gathers a column's distinct values in one task.  Here a mergeable sketch
    brackets each quantile, a counting pass proves the brackets, and only rows inside them (about
    4 / ``accuracy`` of the column each) are ordered.  A bracket that closes on one repeated value is
    already the answer.  What returns to the driver is a few numbers per (column, probability).
    """
    columns, probs = list(columns), list(probs)
    if not columns:
        return {}
    clean = df.select(*[nan_to_null(F.col(f"`{c}`").cast("double")).alias(f"c{i}") for i, c in enumerate(columns)])
    names = clean.columns
    margin = 2.0 / accuracy
    sides = [min(max(p + side, 0.0), 1.0) for p in probs for side in (-margin, margin)]
    sketch = clean.agg(
        *[F.count(c).alias(f"{c}_n") for c in names],
        *[F.percentile_approx(c, sides, accuracy).alias(f"{c}_s") for c in names],
    ).first()
    count = {c: sketch[f"{c}_n"] for c in names}
    targets = [(c, j) for c in names if count[c] for j in range(len(probs))]
    if not targets:
        return {c: [None] * len(probs) for c in columns}
    bounds = {(c, j): tuple(sketch[f"{c}_s"][2 * j:2 * j + 2]) for c, j in targets}
    proof = clean.agg(
        *[F.count_if(F.col(c) < bounds[c, j][0]).alias(f"{c}_{j}_below") for c, j in targets],
        *[F.count_if(F.col(c) <= bounds[c, j][1]).alias(f"{c}_{j}_upto") for c, j in targets],
    ).first()
    values: dict[tuple[str, int], dict[int, float]] = {}
    slices: dict[str, Column] = {}
    wanted: dict[str, list[int]] = {}
    origin: dict[str, tuple[str, int, int]] = {}
    for c, j in targets:
        low, high = bounds[c, j]
        below, upto = proof[f"{c}_{j}_below"], proof[f"{c}_{j}_upto"]
        places = _neighbours(probs[j], count[c])
        proved = below <= places[0] and places[1] < upto
        if proved and low == high:
            values[c, j] = dict.fromkeys(places, low)
            continue
        offset = below if proved else 0
        name = f"{c}_{j}"
        slices[name] = F.when(F.col(c).between(low, high), F.col(c)) if proved else F.col(c)
        wanted[name] = sorted({k - offset for k in places})
        origin[name] = (c, j, offset)
    if slices:
        inside = clean.select(*[value.alias(name) for name, value in slices.items()])
        for (name, k), value in _order_statistics(inside, wanted, ranges).items():
            c, j, offset = origin[name]
            values.setdefault((c, j), {})[k + offset] = value
    return {
        column: [_interpolate(p, count[c], values.get((c, j), {})) for j, p in enumerate(probs)]
        for column, c in zip(columns, names)
    }


def _neighbours(p: float, n: int) -> tuple[int, int]:
    low = int(p * (n - 1))
    return low, min(low + 1, n - 1)


def _interpolate(p: float, n: int, at: dict[int, float]) -> float | None:
    if not n:
        return None
    low, high = _neighbours(p, n)
    return at[low] + (at[high] - at[low]) * (p * (n - 1) - low)


def forward_fill(df: DataFrame, value: str, order: Sequence[str], out: str, ranges: int | None = None) -> DataFrame:
    """Last non-null ``value`` at or before each row in ``order``.

    ``order`` should end with a unique key: the range partitioner then splits even one repeated
    timestamp across ranges.  The last known value of each range is carried into the next.
    """
    staged = materialize(in_ranges(df, order, ranges), "ordered")
    known = F.col(value).isNotNull()
    stamp = F.struct(*order)
    last = staged.where(known).groupBy("__range").agg(F.max_by(value, stamp).alias("__last"))
    # one row per range: read its own carry-in from every earlier range
    every = staged.groupBy("__range").agg(F.lit(1).alias("__seen")).join(last, "__range", "left")
    earlier = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carry = every.select("__range", F.last("__last", ignorenulls=True).over(earlier).alias("__carry"))
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = staged.join(F.broadcast(carry), "__range").withColumn(
        out, F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("__carry"))
    )
    return filled.drop("__range", "__carry")
