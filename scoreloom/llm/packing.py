"""Best-fit packing planned on the histogram of lengths."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.llm.common import by_bytes, stage, tidy
from scoreloom.llm.tokens import encoder

BATCH_BYTES = 1 << 20


def pieces(
    docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Token pieces of every document: ``id, piece, start, length, ids_crc32``, with ``task`` and ``nth``.

    A document is its ids and ``end_id``.  One longer than ``size`` is cut into pieces of ``size`` of which the first
    may be shorter.  ``nth`` counts the pieces of equal length within the writing task, so that ranks need no sort.
    """
    kind = docs.schema[key].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        encode, seen = encoder(tokenizer).encode_batch, [0] * (size + 1)
        for batch in batches:
            rows: list[tuple] = []
            at: list[int] = []
            sizes = pc.binary_length(batch.column("text")).fill_null(0).to_pylist()
            for a, b in by_bytes(sizes, BATCH_BYTES):
                for i, ids in enumerate(encode([t or "" for t in batch.column("text").slice(a, b - a).to_pylist()]), a):
                    ids += end
                    total, start, piece = len(ids) // 4, 0, 0
                    while start < total:
                        length = (total - start) % size or size
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((piece, start, length, crc, task, seen[length]))
                        at.append(i)
                        seen[length] += 1
                        start, piece = start + length, piece + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64())),
                 *(pa.array([r[i] for r in rows], t) for i, t in enumerate(
                     (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())))],
                names=["id", "piece", "start", "length", "ids_crc32", "task", "nth"],
            )

    return docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).mapInArrow(
        tidy(cut), f"id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"
    )


def plan_slots(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over counts: (length, first rank, ranks, first sequence, per sequence, offset).

    Open sequences with equal contents are one range of numbers.  All pieces of a length go to the range with the least
    room that takes them; a sequence takes as many of them as fit, which is where best fit would put them one by one.
    Ranges only split where a length runs out, so the plan is bounded by ``size`` and not by the number of pieces.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}  # room -> ranges (first sequence, sequences)
    order: list[int] = []  # rooms in use, ascending
    plan, opened = [], 0

    def keep(room: int, first: int, count: int) -> None:
        if count and room:
            if room not in rooms:
                order.insert(bisect_left(order, room), room)
                rooms[room] = []
            rooms[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            i = bisect_left(order, length)
            if i < len(order):
                room = order[i]
                first, count = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], order[i]
            else:
                room, first, count = size, opened, -(-left // (size // length))
                opened += count
            per = room // length
            full = min(count, left // per)
            for sequences, each in ((full, per), (int(full < count and left > full * per), left - full * per)):
                if sequences and each:
                    plan.append((length, rank, sequences * each, first, each, size - room))
                    keep(room - each * length, first, sequences)
                    rank, left = rank + sequences * each, left - sequences * each
                    first, count = first + sequences, count - sequences
            keep(room, first, count)
    return plan


def pack(spark: SparkSession, cut: DataFrame, size: int = 1024) -> DataFrame:
    """``cut`` (a stored table as ``pieces`` gives it) with ``sequence_id`` and gapless ``offset``.

    The driver holds at most ``size`` counts and a plan bounded by ``size``.  A piece's rank within its length is its
    number in its task plus the count of earlier tasks; it takes the slot that the plan has for that rank.
    """
    counts = stage(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(
        plan_slots(histogram, size) or [(0, 0, 0, 0, 1, 0)],
        "length long, rank_from long, ranks long, first_sequence long, per_sequence long, offset_from long",
    )
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(bases, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth"))
    nth = F.col("rank") - F.col("rank_from")
    return (
        ranked.join(
            F.broadcast(plan),
            (ranked["length"] == plan["length"]) & (F.col("rank") >= F.col("rank_from"))
            & (F.col("rank") < F.col("rank_from") + F.col("ranks")),
        )
        .select(
            "id", "piece", "start", ranked["length"], "ids_crc32",
            (F.col("first_sequence") + F.floor(nth / F.col("per_sequence"))).alias("sequence_id"),
            (F.col("offset_from") + (nth % F.col("per_sequence")) * ranked["length"]).alias("offset"),
        )
    )


def best_fit_packing(
    docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: ``key, piece, start, length, ids_crc32, sequence_id, offset``.

    Null and empty texts are one piece holding ``end_id`` alone.  Repeated rows and null ids are packed like any other;
    an empty table gives an empty result; other columns are ignored.  Pieces of one sequence never overlap and leave no
    gap from 0 on.  ``ids_crc32`` is taken over the ids as little-endian unsigned 32-bit numbers.
    """
    cut = stage(pieces(docs, tokenizer, size, end_id, key, text), "pack-pieces")
    return pack(docs.sparkSession, cut, size).withColumnRenamed("id", key)
