"""Distinct counts and heavy values that move sketches, not cells, wherever a sketch can decide."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Relative standard error of the distinct sketch, and how many of them count as out of reach.
ERROR = 0.01
SIGMAS = 8
#: Columns whose sketches share one aggregation.
AT_ONCE = 200
#: Values that a heavy-value summary tracks per column.
TRACKED = 1024

_PLAIN = (T.NumericType, T.BooleanType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def _comparable(df: DataFrame, c: str) -> Column:
    """A column as its own type if rows can be grouped by it; adding zero makes the two floating zeros one value."""
    kind = df.schema[c].dataType
    value = F.col(f"`{c}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return value + F.lit(0.0).cast(kind)
    return value if isinstance(kind, _PLAIN) else value.cast("string")


def native_counts(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """(groups, column, value, n) with the missing value as a group of its own.

    Columns of one type are counted together as that type, so numbers cross the shuffle as numbers; only the counted
    values become text.
    """
    kinds: dict[str, list[str]] = {}
    for c in columns:
        kind = df.schema[c].dataType
        kinds.setdefault(kind.simpleString() if isinstance(kind, _PLAIN) else "string", []).append(c)
    out = None
    for names in kinds.values():
        cells = df.select(*groups, *[_comparable(df, c).alias(c) for c in names]).unpivot(list(groups), names, "column", "value")
        part = cells.groupBy(*groups, "column", "value").agg(F.count(F.lit(1)).alias("n"))
        part = part.withColumn("value", F.col("value").cast("string"))
        out = part if out is None else out.unionByName(part)
    return out


@dataclass(frozen=True)
class Spread:
    """Rows, present rows and distinct values of a column; ``exact`` if the last were counted."""

    rows: int
    present: int
    distinct: int
    exact: bool


def sketched(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, int, int, bool]]:
    """Per column: rows, present rows, estimated distinct values, and whether all present values are equal."""
    found: dict[str, tuple[int, int, int, bool]] = {}
    columns = list(columns)
    for begin in range(0, len(columns), AT_ONCE):
        part = columns[begin : begin + AT_ONCE]
        values = {c: _comparable(df, c) for c in part}
        row = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(v).alias(f"n{i}") for i, v in enumerate(values.values())],
            *[F.approx_count_distinct(v, ERROR).alias(f"d{i}") for i, v in enumerate(values.values())],
            *[F.coalesce(F.min(v) == F.max(v), F.lit(True)).alias(f"e{i}") for i, v in enumerate(values.values())],
        ).first()
        found |= {c: (row["rows"], row[f"n{i}"], row[f"d{i}"], row[f"e{i}"]) for i, c in enumerate(part)}
    return found


def spread(df: DataFrame, columns: Sequence[str], cuts: Callable[[str, int], Sequence[float]]) -> dict[str, Spread]:
    """Distinct values of each column, exact wherever it matters.

    ``cuts(column, rows)`` names the thresholds that the caller compares the count with.  One scan sketches all columns; a
    column whose estimate lies clear of every cut by ``SIGMAS`` standard errors keeps the estimate, which is then on the
    right side of each.  The others are counted exactly, on their own types.  Up to one value is always exact.
    """
    known = sketched(df, columns)
    out: dict[str, Spread] = {}
    open_: list[str] = []
    for c, (rows, present, estimate, equal) in known.items():
        if equal:
            out[c] = Spread(rows, present, min(present, 1), True)
            continue
        room = SIGMAS * ERROR
        low, high = max(2, estimate * (1 - room) - 1), min(present, estimate * (1 + room) + 1)
        if any(low <= cut <= high for cut in cuts(c, rows)):
            open_.append(c)
        else:
            out[c] = Spread(rows, present, min(max(estimate, 2), present), False)
    if open_:
        counted = native_counts(df, open_).groupBy("column").agg(F.count("value").alias("distinct"))
        exact = {r["column"]: r["distinct"] for r in counted.collect()}
        out |= {c: Spread(known[c][0], known[c][1], exact.get(c, 0), True) for c in open_}
    return {c: out[c] for c in columns}


def single_valued(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns without two different present values, by their least and greatest one."""
    values = {c: _comparable(df, c) for c in columns}
    row = df.agg(*[F.coalesce(F.min(v) == F.max(v), F.lit(True)).alias(f"e{i}") for i, v in enumerate(values.values())]).first()
    return [c for i, c in enumerate(values) if row[f"e{i}"]]


def majority_shares(df: DataFrame, columns: Sequence[str], above: float) -> dict[str, float | None]:
    """Share of the most frequent value among all rows, for columns where one value holds more than ``above`` of them.

    None elsewhere.  A mergeable summary of frequent values names one candidate per column; with ``above`` at least one
    half there can be no other.  A second scan counts the candidates, so the answer does not rest on the summary's
    estimates.  Nothing but the summaries and the counts is moved.
    """
    if above < 0.5:
        raise ValueError("only a value of more than half of the rows is sure to be the candidate")
    columns = list(columns)
    out: dict[str, float | None] = {}
    for begin in range(0, len(columns), AT_ONCE):
        part = columns[begin : begin + AT_ONCE]
        values = {c: _comparable(df, c).cast("string") for c in part}
        row = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values.values())]).agg(
            *[F.expr(f"approx_top_k(v{i}, 2, {TRACKED})").alias(f"t{i}") for i in range(len(part))]
        ).first()
        named = {}
        for i, c in enumerate(part):
            named[c] = [item["item"] for item in (row[f"t{i}"] or []) if item["item"] is not None]
        counts = [
            F.count_if(values[c] == F.lit(v)).alias(f"{i}_{j}") for i, c in enumerate(part) for j, v in enumerate(named[c])
        ]
        got = df.agg(F.count(F.lit(1)).alias("rows"), *counts).first()
        for i, c in enumerate(part):
            best = max((got[f"{i}_{j}"] for j in range(len(named[c]))), default=0)
            share = best / got["rows"] if got["rows"] else 0.0
            out[c] = share if share > above else None
    return out
