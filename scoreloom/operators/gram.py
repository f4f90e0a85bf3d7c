"""Pairwise-complete correlations of many columns from one scan: blocked Gram matrices that add up.

A pair of columns needs six sums over the rows where both are present.  For all pairs at once they are products of the
zero-filled values X, their squares and their presence M: X'X, X'M, (XX)'M and M'M.  A task adds those up block by block
of columns with a matrix product per Arrow batch, so a scan of 500 columns yields 124,750 correlations.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns in a block, and bytes of sums that a task may hold.
BLOCK = 128
TASK_BYTES = 256 << 20
#: Tasks' sums are added up in this many parts before the last addition.
FAN_IN = 16
#: A variance below this share of the mean square is rounding.
FLAT = 1e-13


class Sums:
    """Sums of a block of columns against another, of values less a shift per column."""

    __slots__ = ("left", "right", "shift_left", "shift_right", "n", "a", "b", "aa", "bb", "ab")

    def __init__(self, left: int, right: int, shift_left: np.ndarray, shift_right: np.ndarray):
        self.left, self.right, self.shift_left, self.shift_right = left, right, shift_left, shift_right
        size = (len(shift_left), len(shift_right))
        self.n, self.a, self.b, self.aa, self.bb, self.ab = (np.zeros(size) for _ in range(6))

    def add_rows(self, x: np.ndarray, y: np.ndarray, seen_x: np.ndarray, seen_y: np.ndarray) -> None:
        """Rows of both blocks, shifted, with 0 for what is missing; ``seen`` is 1 where a value is present."""
        self.n += seen_x.T @ seen_y
        self.a += x.T @ seen_y
        self.b += seen_x.T @ y
        self.aa += (x * x).T @ seen_y
        self.bb += seen_x.T @ (y * y)
        self.ab += x.T @ y

    def add(self, other: Sums) -> None:
        """Sums of other rows, brought to this shift first."""
        if not other.n.any():
            return
        u = (other.shift_left - self.shift_left)[:, None]
        v = (other.shift_right - self.shift_right)[None, :]
        self.n += other.n
        self.a += other.a + u * other.n
        self.b += other.b + v * other.n
        self.aa += other.aa + 2 * u * other.a + u * u * other.n
        self.bb += other.bb + 2 * v * other.b + v * v * other.n
        self.ab += other.ab + u * other.b + v * other.a + u * v * other.n

    def correlations(self) -> np.ndarray:
        """Pearson correlations; NaN where no pair is present or a side is constant."""
        with np.errstate(invalid="ignore", divide="ignore"):
            mean_a, mean_b = self.a / self.n, self.b / self.n
            spread = []
            for square, mean in ((self.aa / self.n, mean_a), (self.bb / self.n, mean_b)):
                var = square - mean * mean
                spread.append(np.where(var > FLAT * square, var, np.nan))
            return (self.ab / self.n - mean_a * mean_b) / np.sqrt(spread[0] * spread[1])

    def row(self) -> tuple:
        parts = (self.shift_left, self.shift_right, self.n, self.a, self.b, self.aa, self.bb, self.ab)
        return self.left, self.right, np.concatenate([p.ravel() for p in parts]).tobytes()


def _read(left: int, right: int, raw: bytes, widths: Sequence[int]) -> Sums:
    values = np.frombuffer(raw)
    i, j = widths[left], widths[right]
    out = Sums(left, right, values[:i].copy(), values[i : i + j].copy())
    for k, name in enumerate(("n", "a", "b", "aa", "bb", "ab")):
        begin = i + j + k * i * j
        setattr(out, name, values[begin : begin + i * j].reshape(i, j).copy())
    return out


_SCHEMA = "left int, right int, sums binary"


def _arrow(sums: list[Sums]) -> pa.RecordBatch:
    columns = zip(*(s.row() for s in sums)) if sums else ([],) * 3
    kinds = (pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["left", "right", "sums"])


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Values with 0 for missing ones, and where they are present."""
    values = [c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns]
    seen = [np.asarray(c.is_valid()) for c in batch.columns]
    return np.column_stack(values), np.column_stack(seen).astype(float)


def _partial(widths: Sequence[int], pairs: Sequence[tuple[int, int]]):
    starts = np.concatenate([[0], np.cumsum(widths)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], Sums] = {}
        shift: np.ndarray | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values, seen = _matrix(batch)
            if shift is None:
                first = seen.argmax(axis=0)  # a present value, if there is one: constants then have no rounding
                shift = values[first, np.arange(values.shape[1])]
            values = (values - shift) * seen
            for i, j in pairs:
                left, right = slice(starts[i], starts[i + 1]), slice(starts[j], starts[j + 1])
                if (i, j) not in sums:
                    sums[i, j] = Sums(i, j, shift[left], shift[right])
                sums[i, j].add_rows(values[:, left], values[:, right], seen[:, left], seen[:, right])
        yield _arrow(list(sums.values()))

    return scan


def _nothing(widths: Sequence[int], pairs: Sequence[tuple[int, int]]):
    """Sums of no rows, so that an empty table has its pairs too."""

    def zeros(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            for i, j in pairs:
                yield _arrow([Sums(i, j, np.zeros(widths[i]), np.zeros(widths[j]))])

    return zeros


def _added(widths: Sequence[int]):
    """Adds up the sums that meet in a task; one block pair after the other, as rows come sorted."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Sums | None = None
        for batch in batches:
            for left, right, raw in zip(*(batch.column(c) for c in ("left", "right", "sums"))):
                one = _read(left.as_py(), right.as_py(), raw.as_py(), widths)
                if held is not None and (held.left, held.right) == (one.left, one.right):
                    if held.n.any():
                        held.add(one)
                    else:
                        held = one
                    continue
                if held is not None:
                    yield _arrow([held])
                held = one
        if held is not None:
            yield _arrow([held])

    return add


def _finished(widths: Sequence[int], names: Sequence[str]):
    starts = np.concatenate([[0], np.cumsum(widths)]).tolist()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right, raw in zip(*(batch.column(c) for c in ("left", "right", "sums"))):
                sums = _read(left.as_py(), right.as_py(), raw.as_py(), widths)
                corr = np.abs(sums.correlations())
                i, j = np.indices(corr.shape)
                i, j = (i + starts[sums.left]).ravel(), (j + starts[sums.right]).ravel()
                use = i < j
                i, j, corr = i[use], j[use], corr.ravel()[use]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[k] for k in i]), pa.array([names[k] for k in j]), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                     pa.array(corr, pa.float64(), mask=np.isnan(corr))],
                    names=["a", "b", "a_idx", "b_idx", "corr"],
                )

    return finish


def gram_corr_pairs(df: DataFrame, columns: Sequence[str], block: int = BLOCK, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(a, b, a_idx, b_idx, corr) absolute pairwise-complete correlations of the upper triangle, NULL where undefined.

    One scan as long as the sums of all pairs fit in ``task_bytes`` (about 2,300 columns), else one for each part of the
    blocks that does.  What tasks hold and send follows the number of columns, not the rows.
    """
    columns = list(columns)
    widths = [len(columns[i : i + block]) for i in range(0, len(columns), block)]
    pairs = [(i, j) for i in range(len(widths)) for j in range(i, len(widths))]
    at_once = max(1, task_bytes // (48 * block * block))
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    out = None
    for begin in range(0, len(pairs), at_once):
        chunk = pairs[begin : begin + at_once]
        none = df.sparkSession.range(0, 1, 1, 1).mapInArrow(_nothing(widths, chunk), _SCHEMA)
        each = wide.mapInArrow(_partial(widths, chunk), _SCHEMA).unionByName(none).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(FAN_IN)))
        some = each.repartition(len(chunk) * FAN_IN, "left", "right", "part").sortWithinPartitions("left", "right")
        some = some.select("left", "right", "sums").mapInArrow(_added(widths), _SCHEMA)
        whole = some.repartition(len(chunk), "left", "right").sortWithinPartitions("left", "right").mapInArrow(_added(widths), _SCHEMA)
        part = whole.mapInArrow(_finished(widths, columns), "a string, b string, a_idx int, b_idx int, corr double")
        out = part if out is None else out.unionByName(part)
    return out
