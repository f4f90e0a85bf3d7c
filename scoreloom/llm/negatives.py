"""Hard negatives by a vertical scan: dimensions in the anchor's order, bounds on the rest, a shrinking candidate set."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm.common import stage

_NONE = np.iinfo(np.int64).min
#: Dimensions read before the bounds are looked at again.
STRIDE = 8


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """Rows of a task as columnar blocks: whole numbers dimension by dimension, rows of one label side by side; stored."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, block_rows):
                batch = whole.slice(at, block_rows)
                label = batch.column("label").to_numpy(zero_copy_only=False)
                order = np.lexsort((batch.column("id").fill_null(0).to_numpy(zero_copy_only=False), label))
                batch = batch.take(pa.array(order))
                vector = batch.column("vector")
                size = np.diff(vector.offsets.to_numpy())
                dims = int(size.max())
                flat = np.floor(vector.flatten().to_numpy(zero_copy_only=False))
                if flat.size and np.abs(flat).max() >= 2**53:
                    raise ValueError("scaled components beyond 53 bits have no exact product")
                cells = np.zeros((dims, batch.num_rows))
                within = np.arange(flat.size) - np.repeat(np.cumsum(size) - size, size)
                cells[within, np.repeat(np.arange(batch.num_rows), size)] = flat
                ids = batch.column("id")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in (
                        (batch.num_rows, pa.int32()), (dims, pa.int32()), (cells.tobytes(), pa.binary()),
                        (label[order].astype(np.int64).tobytes(), pa.binary()),
                        (ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(), pa.binary()),
                        (ids.is_null().to_numpy(zero_copy_only=False).tobytes(), pa.binary()),
                        (batch.column("anchor").to_numpy(zero_copy_only=False).tobytes(), pa.binary()),
                    )],
                    names=["n", "dims", "cells", "labels", "ids", "unnamed", "anchors"],
                )

    packed = rows.mapInArrow(pack, "n int, dims int, cells binary, labels binary, ids binary, unnamed binary, anchors binary")
    return stage(packed.withColumn("block", F.monotonically_increasing_id()), "vector-blocks")


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells (dimension by row), labels, ids and which rows have no id; ids of those sort last."""
    cells = np.frombuffer(row["cells"]).reshape(row["dims"], row["n"])
    labels, ids = np.frombuffer(row["labels"], dtype=np.int64), np.frombuffer(row["ids"], dtype=np.int64)
    return cells, labels, ids, np.frombuffer(row["unnamed"], dtype=bool)


def _anchors(blocks: DataFrame) -> DataFrame:
    """Each anchor row: its place (block and row), id, label and vector; stored."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                cells, labels, ids, unnamed = _opened(row)
                at = np.flatnonzero(np.frombuffer(row["anchors"], dtype=bool) & ~unnamed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), row["block"])), pa.array(at, pa.int32()), pa.array(ids[at]), pa.array(labels[at]),
                     pa.array([cells[:, i].tobytes() for i in at], pa.binary())],
                    names=["block", "at", "id", "label", "vector"],
                )

    return stage(blocks.mapInArrow(take, "block long, at int, id long, label long, vector binary"), "anchors")


def scan(cells: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, alive: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the rows that ``keep`` cannot rule out.

    Dimensions are read in descending magnitude of the anchor's.  What those not yet read can add lies between the sums of
    their least and greatest contributions (``low`` and ``high`` bound each dimension), so every candidate's score has a
    lower and an upper bound; ``keep(lower, upper)`` says which candidates stay.  The candidates are places in the block,
    and only their cells are read from then on.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.stack([anchor * low, anchor * high])
    least, most = ends.min(axis=0)[order], ends.max(axis=0)[order]
    rest_low, rest_high = (np.append(np.cumsum(x[::-1])[::-1], 0) for x in (least, most))
    score = np.zeros(len(alive))
    for begin in range(0, len(order), STRIDE):
        dims = order[begin : begin + STRIDE]
        if len(alive) == cells.shape[1]:
            score += anchor[dims] @ cells[dims]
        else:
            score += anchor[dims] @ cells[dims[:, None], alive]
        done = begin + len(dims)
        stays = keep(score + rest_low[done], score + rest_high[done])
        if not stays.all():
            alive, score = alive[stays], score[stays]
            if not len(alive):
                break
    return alive, score


def _best(scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, unnamed, -scores))[:k]


class _Top:
    """The best ``k`` rows met so far: by score, then id, rows without an id last."""

    __slots__ = ("k", "scores", "ids", "unnamed")

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.unnamed = np.empty(0), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def floor(self) -> float:
        """Score that another row must reach to get in."""
        return self.scores[-1] if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        scores, ids, unnamed = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.unnamed, unnamed)))
        first = _best(scores, ids, unnamed, self.k)
        self.scores, self.ids, self.unnamed = scores[first], ids[first], unnamed[first]


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _fit(vector: np.ndarray, dims: int) -> np.ndarray:
    """A vector cut or filled with zeros to the block's dimensions."""
    return vector[:dims] if len(vector) >= dims else np.append(vector, np.zeros(dims - len(vector)))


def _check(anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
    if np.abs(anchor) @ np.maximum(np.abs(low), np.abs(high)) >= 2**53:
        raise ValueError("products beyond 53 bits are not exact")


def _positives(chunk: list[dict], k: int):
    """Per task and anchor, the best ``k`` other rows of the anchor's label."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[int, _Top] = {}
        for batch in batches:
            for row in batch.to_pylist():
                cells, labels, ids, unnamed = _opened(row)
                names, begin = np.unique(labels, return_index=True)
                span = {int(v): (b, e) for v, b, e in zip(names, begin, [*begin[1:], len(labels)])}
                part = {v: (np.ascontiguousarray(cells[:, b:e]),) for v, (b, e) in span.items()}
                part = {v: (c, c.min(axis=1), c.max(axis=1)) for v, (c,) in part.items()}
                for number, a in enumerate(chunk):
                    if a["label"] not in span:
                        continue
                    b, e = span[a["label"]]
                    own, low, high = part[a["label"]]
                    anchor = _fit(a["values"], len(own))
                    _check(anchor, low, high)
                    alive = np.arange(e - b)
                    if a["block"] == row["block"]:
                        alive = np.delete(alive, a["at"] - b)
                    top = tops.setdefault(number, _Top(k))

                    def keep(lower: np.ndarray, upper: np.ndarray, top: _Top = top) -> np.ndarray:
                        return upper >= max(top.floor, _kth(lower, k))

                    at, score = scan(own, low, high, anchor, alive, keep)
                    if len(at):
                        top.add(score, ids[b:e][at], unnamed[b:e][at])
        yield from _rows(chunk, ((number, 0, top) for number, top in tops.items()))

    return search


def _negatives(chunk: list[dict], k: int, bounds: tuple[int, int, int]):
    """Per task, anchor and positive score, the best ``k`` rows of other labels whose score lies in the positive's window."""
    divide, least, most = bounds

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[tuple[int, int], _Top] = {}
        for batch in batches:
            for row in batch.to_pylist():
                cells, labels, ids, unnamed = _opened(row)
                low, high = cells.min(axis=1), cells.max(axis=1)
                names, begin = np.unique(labels, return_index=True)
                span = {int(v): (b, e) for v, b, e in zip(names, begin, [*begin[1:], len(labels)])}
                for number, a in enumerate(chunk):
                    # Scores are whole, and so are the ends of a window: the least and the greatest score inside.
                    wins = [(p, -(-least * p // divide), most * p // divide) for p in a["wins"] if -(-least * p // divide) <= most * p // divide]
                    if not wins:
                        continue
                    b, e = span.get(a["label"], (0, 0))
                    alive = np.concatenate([np.arange(b), np.arange(e, len(labels))])
                    anchor = _fit(a["values"], len(cells))
                    _check(anchor, low, high)
                    top = {p: tops.setdefault((number, p), _Top(k)) for p, _, _ in wins}

                    def keep(lower: np.ndarray, upper: np.ndarray, wins=wins, top=top) -> np.ndarray:
                        stays = np.zeros(len(lower), dtype=bool)
                        for p, first, last in wins:
                            sure = lower[(lower >= first) & (upper <= last)]
                            stays |= (upper >= max(first, top[p].floor, _kth(sure, k))) & (lower <= last)
                        return stays

                    at, score = scan(cells, low, high, anchor, alive, keep)
                    for p, first, last in wins if len(at) else ():
                        inside = (score >= first) & (score <= last)
                        if inside.any():
                            top[p].add(score[inside], ids[at[inside]], unnamed[at[inside]])
        yield from _rows(chunk, ((number, p, top) for (number, p), top in tops.items()))

    return search


def _rows(chunk: list[dict], found) -> Iterator[pa.RecordBatch]:
    rows = [
        (chunk[number]["block"], chunk[number]["at"], p, int(s), None if u else int(i))
        for number, p, top in found for s, i, u in zip(top.scores, top.ids, top.unnamed)
    ]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    for at in range(0, len(rows), 50_000):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows[at : at + 50_000]), kinds)], names=["block", "at", "positive_score", "score", "id"]
        )


_FOUND = "block long, at int, positive_score long, score long, id long"


def _merged(found: DataFrame, by: list[str], k: int, label: str) -> DataFrame:
    """The best ``k`` of what the tasks found, ranked; stored.  Each task's share is cut to ``k`` before the shuffle."""
    ranked = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
    return stage(found.withColumn("rank", ranked).filter(F.col("rank") <= k), label)


def hard_negatives(
    rows: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
    scale: int = 256, positives: int = 5, negatives: int = 3, window: tuple[int, int, int] = (100, 50, 95),
    block_rows: int = 8192, chunk: int = 4096,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for each anchor and positive.

    A component x counts as floor(scale * x); scores are inner products.  An anchor's positives are its best ``positives``
    other rows of its label, its negatives for each the best ``negatives`` rows of other labels whose score lies between
    ``window[1] / window[0]`` and ``window[2] / window[0]`` of the positive's.  Higher scores come first, ties by smaller key.

    Rows with a null label, a null vector, or a null or non-finite component take no part.  Rows are told apart by place:
    a repeated row may be the positive of its copy.  Rows without a key come last among ties and are no anchors.  Shorter
    vectors count as filled with zeros, empty ones score 0.  Other columns are ignored; an empty table gives an empty result.
    Scores that 53 bits cannot hold raise an error.

    Rows are stored once as columnar blocks of up to ``block_rows``, without a shuffle.  The anchors, a stated query set,
    are dealt into chunks of about ``chunk``; each chunk, bounded by that number and not by the data, is handed to all
    tasks, which scan their blocks vertically (``scan``) and return a few rows an anchor.  A first scan finds the
    positives, a second the negatives inside their windows.
    """
    name = F.col(f"`{label}`") if isinstance(label, str) else label
    raw = F.col(f"`{vector}`")
    fit = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    taken = rows.select(
        F.col(f"`{key}`").cast("long").alias("id"), name.cast("long").alias("label"),
        F.transform(raw, lambda x: x.cast("double") * scale).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.coalesce(fit, F.lit(False)).alias("fit"),
    ).filter("fit and label is not null").drop("fit")
    blocks = _blocks(taken, block_rows)
    chosen = _anchors(blocks)
    parts = max(1, math.ceil(chosen.count() / chunk))
    part = F.pmod(F.xxhash64("block", "at"), F.lit(parts))
    out: DataFrame | None = None
    for number in range(parts):
        asked = [r.asDict() for r in chosen.filter(part == number).collect()]
        for a in asked:
            a["values"] = np.frombuffer(a.pop("vector"))
        best = _merged(blocks.mapInArrow(_positives(asked, positives), _FOUND), ["block", "at"], positives, "positives")
        scores: dict[tuple, set] = {}
        for r in best.select("block", "at", "score").distinct().collect():
            scores.setdefault((r["block"], r["at"]), set()).add(r["score"])
        for a in asked:
            a["wins"] = sorted(scores.get((a["block"], a["at"]), ()))
        hard = _merged(
            blocks.mapInArrow(_negatives(asked, negatives, window), _FOUND), ["block", "at", "positive_score"], negatives, "negatives"
        )
        named = chosen.filter(part == number).select("block", "at", F.col("id").alias("anchor_id"))
        pairs = best.select("block", "at", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        done = named.join(pairs, ["block", "at"]).join(hard, ["block", "at", "positive_score"]).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        out = done if out is None else out.unionByName(done)
    return out
