"""Exact dedup: Grace hash deduplication with spill files and open-addressing tables over complete contents."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.common import sliced, stage, tidy

#: Buckets are made for this multiple of the bytes there are, as a hash does not deal evenly.
ROOM = 2
_BLANKS = bytes(32 if 9 <= b <= 13 else b for b in range(256))
_RUN = re.compile(rb"  +")


def normalise(text: bytes) -> bytes:
    """Each run of space, tab, line feed, vertical tab, form feed and carriage return becomes one space."""
    text = text.translate(_BLANKS)
    return _RUN.sub(b" ", text) if b"  " in text else text


class ContentTable:
    """Open addressing with linear probing.  Two contents are one entry only if all their bytes agree."""

    def __init__(self):
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, h: int, content: bytes) -> tuple[int, int]:
        """(entry or -1, slot where the search ended)"""
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return entry, at
            at = (at + 1) & mask
        return -1, at

    def add(self, h: int, content: bytes, at: int) -> int:
        entry = self.slots[at] = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content)
        if 2 * len(self.hashes) > len(self.slots):
            self.slots = [-1] * (4 * len(self.slots))
            mask = len(self.slots) - 1
            for other, value in enumerate(self.hashes):
                at = value & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = other
        return entry


def _numbered(docs: DataFrame, text: str, table_bytes: int) -> DataFrame:
    """Every row with a number ``rid`` and the number ``rep`` of an equal row of the same task; written once.

    Copies inside a task collapse here, before anything is shuffled: only rows with ``rid = rep`` carry a hash on.
    """
    schema = T.StructType(
        [T.StructField("rid", T.LongType()), T.StructField("rep", T.LongType()), T.StructField("h", T.LongType()),
         T.StructField("row", docs.schema)]
    )

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 36
        seen, owners = ContentTable(), []
        for batch, texts in sliced(batches, lambda b: b.column("row").field(text)):
            rids, reps, hashes = [], [], []
            for raw in texts:
                content = normalise(raw)
                h = xxhash.xxh3_64_intdigest(content)
                entry, at = seen.find(h, content)
                if entry < 0:
                    if seen.bytes + len(content) > table_bytes:
                        seen, owners = ContentTable(), []
                        at = h & (len(seen.slots) - 1)
                    seen.add(h, content, at)
                    owners.append(rid)
                    entry = len(owners) - 1
                rids.append(rid)
                reps.append(owners[entry])
                hashes.append(h - (1 << 63) if owners[entry] == rid else None)
                rid += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids, pa.int64()), pa.array(reps, pa.int64()), pa.array(hashes, pa.int64()), batch.column("row")],
                names=["rid", "rep", "h", "row"],
            )

    return stage(docs.select(F.struct("*").alias("row")).mapInArrow(tidy(collapse), schema), "exact-rows")


def _resolve(contents: DataFrame, table_bytes: int) -> DataFrame:
    """(rep, class, sha): equal contents get one class, the number of one of them.

    Contents are dealt to buckets by hash, as many as their bytes need for a bucket to fit a table of ``table_bytes`` with
    room to spare.  What a full table does not take goes to spill files in the shared folder, and is dealt out anew by the
    next level's hash to as many buckets as it needs by then.  So only the overflow of uneven buckets is written again, and
    the number of levels does not grow with the input.  A full table still resolves the copies of what it holds, and every
    level places at least one content, so this ends.
    """
    spark = contents.sparkSession

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, owners = ContentTable(), []
        names = ["rep", "h", "text", "class", "sha"]
        for batch, texts in sliced(batches, lambda b: b.column("text")):
            reps, hashes = batch.column("rep").to_pylist(), batch.column("h").to_pylist()
            done: list[tuple] = []
            spill: list[tuple] = []
            for rep, h, raw in zip(reps, hashes, texts):
                content = normalise(raw)
                entry, at = held.find(h + (1 << 63), content)
                if entry < 0 and (not owners or held.bytes + len(content) <= table_bytes):
                    entry = held.add(h + (1 << 63), content, at)
                    owners.append((rep, hashlib.sha256(content).hexdigest()))
                if entry < 0:
                    spill.append((rep, h, raw))
                else:
                    done.append((rep, *owners[entry]))
            rows = len(done) + len(spill)
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done] + [s[0] for s in spill], pa.int64()),
                 pa.array([None] * len(done) + [s[1] for s in spill], pa.int64()),
                 pa.array([None] * len(done) + [s[2] for s in spill], pa.binary()),
                 pa.array([d[1] for d in done] + [None] * len(spill), pa.int64()),
                 pa.array([d[2] for d in done] + [None] * (rows - len(done)), pa.string())],
                names=names,
            )

    found, level = None, 0
    while True:
        held = contents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(ROOM * held / table_bytes))
        dealt = contents.repartition(buckets, F.xxhash64("h", F.lit(level))).select("rep", "h", "text")
        out = stage(
            dealt.mapInArrow(tidy(place), "rep long, h long, text binary, class long, sha string"), f"exact-level{level}"
        )
        here = out.filter("class is not null").select("rep", "class", "sha")
        found = here if found is None else found.unionByName(here)
        contents = out.filter("class is null").select("rep", "h", "text")
        if contents.isEmpty():
            return found
        level += 1


def _decisions(docs: DataFrame, key: str, text: str, table_bytes: int) -> tuple[DataFrame, DataFrame]:
    rows = _numbered(docs, text, table_bytes)
    classes = _resolve(
        rows.filter("h is not null").select("rep", "h", F.col(f"row.`{text}`").alias("text")), table_bytes
    )
    ids = rows.select("rid", "rep", F.col(f"row.`{key}`").alias("id"))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("rid").alias("rid"))
    reps = ids.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).join(classes, "rep")
    totals = reps.groupBy("class").agg(F.sum("n").alias("group_size"), F.min("first").alias("first"))
    verdicts = reps.select("rep", "class", "sha").join(totals, "class").select(
        "rep", "group_size", "sha", F.col("first.id").alias("keep_id"), F.col("first.rid").alias("keep_rid")
    )
    return rows, ids.join(verdicts, "rep")


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", table_bytes: int = 32 << 20) -> DataFrame:
    """One row per input row: ``key``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of the normalised text.

    Texts are equal when their normalised bytes are; a null text counts as empty.  The row with the smallest key stays;
    null keys come last, and of rows with equal keys one stays.  Only these columns are returned, whatever else the
    input holds; an empty table gives an empty result.

    Copies collapse inside each task first, so a text that a third of all rows share is moved once per task.  ``h`` of
    what is left deals contents out to buckets; ``table_bytes`` bounds a table in Python.
    """
    _, decided = _decisions(docs, key, text, table_bytes)
    return decided.select(
        F.col("id").alias(key), "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", table_bytes: int = 32 << 20) -> DataFrame:
    """The rows that ``exact_dedup`` keeps, with all their columns as they were."""
    rows, decided = _decisions(docs, key, text, table_bytes)
    # The numbers of dropped rows are stored, so that the join knows their size: where they are few, no text is shuffled.
    gone = stage(decided.filter("rid <> keep_rid").select("rid"), "exact-dropped")
    return rows.join(gone, "rid", "left_anti").select("row.*")
