"""MinHash near-dedup with b-bit signatures, band buckets, and confirmation on full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.common import LOWER, WordHash, grams, mix, sliced, stage, tidy
from scoreloom.llm.components import components

BITS = 2
_MOST = 1024
_RANDOM = np.random.RandomState(8)
_XOR = _RANDOM.randint(0, 2**32, _MOST, dtype=np.uint64).astype(np.uint32)
_TIMES = _RANDOM.randint(0, 2**31, _MOST, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_set(words: list[bytes], known: WordHash, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of ``size`` words; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(grams(known.of(words), min(size, len(words))))


def minima(shingles: np.ndarray, count: int) -> np.ndarray:
    """The least value of each of ``count`` hash functions over a set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    at_once = max(1, 65536 // len(x))
    out = np.empty(count, dtype=np.uint32)
    for a in range(0, count, at_once):
        b = min(count, a + at_once)
        values = x[None, :] ^ _XOR[a:b, None]
        values *= _TIMES[a:b, None]
        values.min(axis=1, out=out[a:b])
    return out


def band_keys(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = least[: bands * rows].reshape(bands, rows).astype(np.uint64)
    total = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(rows):
        total = mix(total + keys[:, j])
    return total.view(np.int64)


def pack_bits(least: np.ndarray) -> bytes:
    """The low ``BITS`` bits of each minimum, four minima to a byte."""
    low = (least & np.uint32(3)).astype(np.uint8).reshape(-1, 4)
    return (low[:, 0] | low[:, 1] << 2 | low[:, 2] << 4 | low[:, 3] << 6).astype(np.uint8).tobytes()


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures: the share of equal minima, corrected for low bits that agree by chance."""
    differ = one ^ others
    differ = (differ | differ >> np.uint64(1)) & np.uint64(0x5555555555555555)
    count = 32 * others.shape[1]
    agree = 1 - np.bitwise_count(differ).sum(axis=1) / count
    chance = 0.5**BITS
    return (agree - chance) / (1 - chance)


def scheme(percent: int, most: int = 512) -> tuple[int, int]:
    """(bands, rows) for a similarity of ``percent`` hundredths: of the schemes that lose a link right at the threshold
    with a chance below one in ten million, the one with the most rows, thus with the fewest needless candidates."""
    for rows in range(12, 0, -1):
        bands = most // rows // 4 * 4
        if (1 - (percent / 100) ** rows) ** bands < 1e-7:
            return bands, rows
    return most, 1


def _sketches(docs: DataFrame, kind: str, size: int, bands: int, rows: int) -> DataFrame:
    count = -(-bands * rows // 32) * 32

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch, texts in sliced(batches, lambda b: b.column("text")):
            done: dict[bytes, tuple] = {}
            out: list[tuple] = []
            for raw in texts:
                shingles = shingle_set(raw.translate(LOWER).split(), known, size)
                if not len(shingles):
                    out.append((0, None, None, None))
                    continue
                fp = xxhash.xxh3_128_digest(shingles.data)
                if fp not in done:
                    least = minima(shingles, count)
                    done[fp] = (len(shingles), fp, band_keys(least, bands, rows), pack_bits(least))
                out.append(done[fp])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())))],
                names=["id", "n", "fp", "buckets", "sig"],
            )

    return stage(docs.mapInArrow(tidy(sketch), f"id {kind}, n long, fp binary, buckets array<long>, sig binary"), "sketches")


def _candidate_groups(reps: DataFrame) -> DataFrame:
    """``id, group`` of texts that share a bucket, directly or over others: each bucket ties its members to its least."""
    member = reps.select("id", F.explode("buckets").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("top")).filter("low < top")
    shared = stage(shared, "buckets")  # stored, so that a hot bucket's join can be split
    ties = member.join(shared.drop("top"), "bucket").filter("id > low").select(F.col("low").alias("a"), F.col("id").alias("b"))
    return components(ties).withColumnRenamed("component", "group")


SMALL_SET = 64


def _confirm(percent: int, slack: float):
    """Links between the rows of one unit, as a forest: a pair that is connected already adds nothing."""

    def confirm(unit: pa.Table) -> pa.Table:
        order = np.argsort(unit.column("block").to_numpy(), kind="stable")
        unit = unit.take(pa.array(order))
        ids, blocks = unit.column("id"), unit.column("block").to_numpy()
        sets = [np.frombuffer(s, dtype=np.uint64) for s in unit.column("shingles").to_pylist()]
        sigs = np.stack([np.frombuffer(s, dtype=np.uint64) for s in unit.column("sig").to_pylist()])
        n = np.array([len(s) for s in sets])
        ends = np.concatenate([[0], np.cumsum(n)])
        # Rows of one block meet all later rows; where a unit has two blocks, only rows of the other one.
        begin = [i + 1 for i in range(len(sets))]
        if blocks[0] != blocks[-1]:
            second = int(np.searchsorted(blocks, blocks[-1]))
            begin = [second] * second + [len(sets)] * (len(sets) - second)
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        here = np.zeros(int(codes.max()) + 1, dtype=np.int64)
        parent = list(range(len(sets)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        links: list[tuple[int, int]] = []
        for i, b in enumerate(begin):
            if b >= len(sets):
                continue
            # Low bits of small sets agree more alike than chance says, so that these are compared without the estimate.
            near = ((np.minimum(n[i], n[b:]) < SMALL_SET) | (estimates(sigs[i], sigs[b:]) >= percent / 100 - slack)) & (
                100 * np.minimum(n[i], n[b:]) >= percent * np.maximum(n[i], n[b:])
            )
            near = [j for j in (b + np.flatnonzero(near)).tolist() if root(j) != root(i)]
            if not near:
                continue
            here[codes[ends[i] : ends[i + 1]]] = 1
            if len(near) * 4 > len(sets) - b:
                common = np.add.reduceat(here[codes[ends[b] :]], ends[b:-1] - ends[b])[np.array(near) - b]
            else:
                common = np.array([here[codes[ends[j] : ends[j + 1]]].sum() for j in near])
            here[codes[ends[i] : ends[i + 1]]] = 0
            for j, both in zip(near, common.tolist()):
                if 100 * both >= percent * (n[i] + n[j] - both) and root(i) != root(j):
                    parent[root(j)] = root(i)
                    links.append((i, j))
        return pa.table({"a": ids.take(pa.array([x[0] for x in links], pa.int64())),
                         "b": ids.take(pa.array([x[1] for x in links], pa.int64()))})

    return confirm


def near_links(
    docs: DataFrame, reps: DataFrame, kind: str, percent: int, size: int, minhashes: int, block_docs: int, block_bytes: int
) -> DataFrame:
    """Confirmed links ``a, b`` between representatives that suffice to connect all linked ones; stored."""
    groups = stage(_candidate_groups(reps), "candidate-groups")
    members = groups.join(reps.select("id", "n", "fp", "sig"), "id")
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("all")).select(
        "group", F.greatest(F.ceil(F.col("m") / block_docs), F.ceil(F.col("all") * 8 / block_bytes)).cast("int").alias("blocks")
    )
    members = members.join(stage(sizes, "group-sizes"), "group").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    with_text = docs.join(members.drop("n").withColumnRenamed("id", "rep"), F.col("id") == F.col("rep")).drop("rep")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch, texts in sliced(batches, lambda b: b.column("text")):
            shingles = [shingle_set(raw.translate(LOWER).split(), known, size) for raw in texts]
            right = [i for i, (s, fp) in enumerate(zip(shingles, batch.column("fp").to_pylist()))
                     if len(s) and xxhash.xxh3_128_digest(s.data) == fp]
            kept = pa.array(right, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(kept) for c in ("id", "group", "blocks", "block", "sig")),
                 pa.array([shingles[i].tobytes() for i in right], pa.binary())],
                names=["id", "group", "blocks", "block", "sig", "shingles"],
            )

    shingled = with_text.select("id", "text", "group", "blocks", "block", "sig", "fp").mapInArrow(
        tidy(sets), f"id {kind}, group {kind}, blocks int, block int, sig binary, shingles binary"
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    units = shingled.select("*", other).select(
        "group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "block", "sig", "shingles"
    )
    spread = math.sqrt((1 + 3 * percent / 100) / 4 * (3 - 3 * percent / 100) / 4 / minhashes) / 0.75
    schema = T.StructType([T.StructField("a", docs.schema["id"].dataType), T.StructField("b", docs.schema["id"].dataType)])
    return stage(units.groupBy("group", "i", "j").applyInArrow(_confirm(percent, 6 * spread), schema), "links")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, size: int = 5, minhashes: int = 512,
    block_docs: int = 256, block_bytes: int = 8 << 20,
) -> DataFrame:
    """One row per document: ``key, n_shingles, component_id, kept``.

    A document's set holds its distinct runs of ``size`` words (A-Z lower-cased, words parted by white space), or its whole
    sequence if shorter.  Documents are linked when the intersection is at least ``percent`` hundredths of the union; a
    component is named by its smallest id, which is the one kept.  Null and empty texts have no set and no link.  Rows
    with a null id have the component of their text but are never kept and name none.  Repeated rows get a row each.
    Other columns are ignored; an empty table gives an empty result.

    1. Texts with equal sets collapse to the smallest id.
    2. Each is signed by ``minhashes`` minima, of which two bits each are kept; whole minima make the band buckets.
    3. Buckets tie their members together.  Groups of up to ``block_docs`` texts and ``block_bytes`` of sets are one unit;
       larger groups are dealt over blocks, and every pair of blocks is a unit, so no task gathers an unbounded group.
    4. A unit compares packed signatures by bit counts, corrected for chance, and confirms on full sets whatever comes
       within six standard errors of the threshold.  It returns a spanning forest of links, not pairs.
    5. Links become components.
    """
    bands, rows = scheme(percent, minhashes)
    kind = docs.schema[key].dataType.simpleString()
    docs = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    sketches = _sketches(docs, kind, size, bands, rows)
    first = stage(sketches.filter("fp is not null and id is not null").groupBy("fp").agg(F.min("id").alias("rep")), "reps")
    reps = stage(
        sketches.join(first, (sketches["fp"] == first["fp"]) & (F.col("id") == F.col("rep")))
        .select("id", "n", sketches["fp"], "buckets", "sig"),
        "signed",
    )
    found = components(near_links(docs, reps, kind, percent, size, minhashes, block_docs, block_bytes))
    named = first.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "fp", F.coalesce("component", "rep").alias("component")
    )
    out = sketches.select("id", "n", "fp").join(named, "fp", "left")
    component = F.when(F.col("fp").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
