"""AUC of many candidate scores bounded by mergeable histograms, so that few need an exact ranking.

Rows of two classes in different bins of a score are in the order of their bins; only pairs inside one bin are open.  So
the counts of each bin bound a candidate's AUC from below and above, and a candidate whose upper bound is under another's
lower bound cannot be the best.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Room for the rounding of sums of counts.
SLACK = 1e-12


@dataclass(frozen=True)
class Narrowed:
    """Candidates that may be the best, and how many were bounded in each pass."""

    left: list[int]
    passes: list[int]


def weight_grid(points: Sequence[tuple[int, Sequence[float]]]) -> Column:
    """The weights of numbered candidates as one array literal of structs."""
    entries = ",".join(
        f"named_struct('candidate',{i},'w',array({','.join(f'{float(w)!r}D' for w in weights)}))" for i, weights in points
    )
    return F.expr(f"array({entries})")


def weighted_score(models: Sequence[str]) -> Column:
    """The blend of a candidate's weights ``w``, added in the order of the models."""
    terms = [F.get("w", F.lit(i)) * F.col(f"`{m}`") for i, m in enumerate(models)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def histogram(
    tuples: DataFrame, models: Sequence[str], points: Sequence[tuple[int, Sequence[float]]], low: float, high: float, bins: int
) -> DataFrame:
    """(candidate, bin, pos, n) of each candidate's score over equal parts of [low, high].

    Counts add up in the tasks, so at most candidates x bins rows of each are shuffled, however many rows they read.
    """
    scaled = F.floor((F.col("score") - F.lit(low)) * F.lit(bins / (high - low)))
    spot = F.least(F.greatest(scaled, F.lit(0)), F.lit(bins - 1)).cast("int")
    scored = tuples.select("__pos", "__n", F.inline(weight_grid(points)), *models).select(
        "candidate", "__pos", "__n", weighted_score(models).alias("score")
    )
    return scored.groupBy("candidate", spot.alias("bin")).agg(F.sum("__pos").alias("pos"), F.sum("__n").alias("n"))


def auc_bounds(counts: DataFrame) -> DataFrame:
    """(candidate, low, high) from (candidate, bin, pos, n)."""
    pos, neg = F.col("pos").cast("double"), (F.col("n") - F.col("pos")).cast("double")
    before = Window.partitionBy("candidate").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select("candidate", pos.alias("p"), neg.alias("q"), F.coalesce(F.sum(neg).over(before), F.lit(0.0)).alias("below"))
    pairs = F.sum("p") * F.sum("q")
    return placed.groupBy("candidate").agg(
        F.try_divide(F.sum(F.col("p") * F.col("below")), pairs).alias("low"),
        F.try_divide(F.sum(F.col("p") * (F.col("below") + F.col("q"))), pairs).alias("high"),
    )


def narrow(
    tuples: DataFrame, models: Sequence[str], grid: Sequence[Sequence[float]], cells: int = 1 << 16, enough: int = 4,
    passes: int = 4, bounds: Callable[[DataFrame], DataFrame] = auc_bounds,
) -> Narrowed:
    """Numbers of the grid points whose AUC may be the best.

    A pass bounds every candidate that is left in ``cells`` bins altogether, so the rows shuffled do not grow with the
    grid; fewer candidates get finer bins in the next.  It ends when ``enough`` are left, or when a pass tells none apart.
    """
    left = list(range(len(grid)))
    done: list[int] = []
    ends = tuples.agg(
        F.least(*[F.min(f"`{m}`") for m in models], F.lit(float("inf"))).alias("low"),
        F.greatest(*[F.max(f"`{m}`") for m in models], F.lit(float("-inf"))).alias("high"),
    ).first()
    low, high = float(ends["low"]), float(ends["high"])
    while low < high and len(left) > enough and len(done) < passes:
        bins = max(16, cells // len(left))
        found = bounds(histogram(tuples, models, [(i, grid[i]) for i in left], low, high, bins)).collect()
        done.append(len(left))
        known = {r["candidate"]: (r["low"], r["high"]) for r in found if r["low"] is not None}
        if not known:
            break
        best = max(b for b, _ in known.values())
        kept = [i for i in left if i in known and known[i][1] >= best - SLACK]
        if len(kept) == len(left):
            break
        left = kept
    return Narrowed(left, done)
