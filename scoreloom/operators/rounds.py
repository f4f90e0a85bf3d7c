"""Early stopping of boosted fits by the AUC of every round on held-out rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.operators.metrics import auc_by_weighted

#: Rounds without a better AUC after which a fit stops.
PATIENCE = 50
_LEAF = re.compile(r"Predict: (\S+)")


@dataclass(frozen=True)
class Stopped:
    """The round kept (from 1) and the AUC of each round that was looked at."""

    best: int
    aucs: tuple[float | None, ...]


def leaf_values(model: GBTClassificationModel) -> list[np.ndarray]:
    """What each tree adds to the margin at each of its leaves, from left to right."""
    return [
        np.array([float(v) for v in _LEAF.findall(tree.toDebugString)]) * weight
        for tree, weight in zip(model.trees, model.treeWeights)
    ]


def round_counts(model: GBTClassificationModel, scored: DataFrame, label: str, first: int, last: int) -> DataFrame:
    """(round, score, pos, n) of the margins after the rounds ``first`` to ``last``, from one scan.

    The leaves a row falls into give the running sum of its trees' outputs.  Equal margins of a batch become one row.
    """
    values = leaf_values(model)[:last]
    start = np.concatenate([[0], np.cumsum([len(v) for v in values])])[:-1]
    shared = scored.sparkSession.sparkContext.broadcast((np.concatenate(values), start))
    rows = model.copy().setLeafCol("__leaf").transform(scored).select(
        F.slice(vector_to_array("__leaf", "float32").cast("array<int>"), 1, last).alias("leaf"), F.col(label).cast("int").alias("y")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, begin = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                leaf = batch.column("leaf").flatten().to_numpy().reshape(batch.num_rows, last)
                margin = np.cumsum(table[leaf + begin], axis=1)[:, first - 1 :]
                y = batch.column("y").to_numpy()
                rounds, scores, pos, n = [], [], [], []
                for r in range(margin.shape[1]):
                    value, back = np.unique(margin[:, r], return_inverse=True)
                    rounds.append(np.full(len(value), first + r))
                    scores.append(value)
                    pos.append(np.bincount(back, weights=y).astype(np.int64))
                    n.append(np.bincount(back))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x), t) for x, t in ((rounds, pa.int32()), (scores, pa.float64()), (pos, pa.int64()), (n, pa.int64()))],
                    names=["round", "score", "pos", "n"],
                )

    return rows.mapInArrow(count, "round int, score double, pos long, n long")


def best_round(aucs: list[float | None], patience: int) -> tuple[int, bool]:
    """(best round so far, whether the fit has stopped): the first round with the largest AUC, none better for ``patience``."""
    best = 0
    for i, auc in enumerate(aucs):
        if auc is not None and (aucs[best] is None or auc > aucs[best]):
            best = i
        if i - best >= patience:
            return best + 1, True
    return best + 1, False


def stop_by_auc(fitted: PipelineModel, held_out: DataFrame, label: str, patience: int = PATIENCE) -> tuple[PipelineModel, Stopped]:
    """The fit cut back to its best round on ``held_out``.

    Rounds are judged ``patience`` at a time, each batch of rounds in one scan, until none has been better for that long;
    later trees are never looked at.  Each AUC is exact.
    """
    model = fitted.stages[-1]
    ready = PipelineModel(fitted.stages[:-1]).transform(held_out)
    aucs: list[float | None] = []
    stopped = False
    while len(aucs) < len(model.trees) and not stopped:
        first, last = len(aucs) + 1, min(len(aucs) + patience, len(model.trees))
        counts = round_counts(model, ready, label, first, last)
        found = {r["round"]: r["auc"] for r in auc_by_weighted(counts, "score", "pos", "n", ["round"]).collect()}
        aucs += [found.get(r) for r in range(first, last + 1)]
        best, stopped = best_round(aucs, patience)
    return PipelineModel([*fitted.stages[:-1], first_rounds(model, best)]), Stopped(best, tuple(aucs))


def round_steps(rounds: int, patience: int) -> list[int]:
    """Sizes of the fits that ``fit_by_auc`` may need, the last of all ``rounds``: each four times the one before, while that
    leaves half or more, so that a fit that never stops costs at most 1.7 times its rounds."""
    steps, n = [], max(1, 3 * patience // 2)
    while 2 * n <= rounds:
        steps.append(n)
        n *= 4
    return [*steps, rounds]


def fit_by_auc(
    fit: Callable[[int], Model], rounds: int, held_out: DataFrame, label: str, patience: int = PATIENCE
) -> Model:
    """The fit of ``rounds`` rounds cut back to its best round on ``held_out``, without fitting rounds past the stop.

    A round depends on those before it only, so a fit of fewer rounds is the beginning of a longer one.  If the AUC has been
    waiting for ``patience`` rounds within it, the longer fit would stop there too; otherwise the next step is fitted.
    """
    for n in round_steps(rounds, patience):
        model = fit(n)
        if not isinstance(model, PipelineModel):
            return model
        model, seen = stop_by_auc(model, held_out, label, patience)
        if best_round(list(seen.aucs), patience)[1]:
            break
    return model


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` trees."""
    if rounds >= len(model.trees):
        return model
    gateway = SparkContext._gateway
    classes = gateway.jvm.org.apache.spark.ml
    trees, weights = gateway.new_array(classes.regression.DecisionTreeRegressionModel, rounds), gateway.new_array(gateway.jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(model.trees[:rounds], model.treeWeights[:rounds])):
        trees[i], weights[i] = tree._java_obj, weight
    return model._copyValues(GBTClassificationModel(classes.classification.GBTClassificationModel(model.uid, trees, weights)))
