"""Benchmark decontamination by winnowing: shared fingerprints of sliding windows, extended to exact hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import ALNUM_LOWER, WordHash, grams, raw_texts, sliced, stage, tidy


def _selected(hashes: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowing: the k-gram with the least hash of every window (of equal ones the last), each listed once.

    Returns places and hashes.  Equal windows select the k-gram at the same place within them.
    """
    each = grams(hashes, k)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    least, at = each[:n].copy(), np.arange(n)
    for j in range(1, window - k + 1):
        later = each[j : j + n] <= least
        least = np.where(later, each[j : j + n], least)
        at = np.where(later, np.arange(j, j + n), at)
    places = np.unique(at)
    return places, each[places]


def _is_selected(each: np.ndarray, at: int, span: int) -> bool:
    """Whether winnowing selects a k-gram: a window of ``span`` more of them around it has no lesser one, nor an equal one behind it."""
    value, before, after = each[at], 0, 0
    while before < span and at - before > 0 and each[at - before - 1] >= value:
        before += 1
    while after < span and at + after + 1 < len(each) and each[at + after + 1] > value:
        after += 1
    return before + after >= span


def _context(words: list[bytes], at: int, size: int, k: int) -> tuple[list[bytes], list[bytes]]:
    """Words before a seed, nearest first, and from its first word on: as many as a window of ``size`` with it can reach."""
    reach = size - k
    return words[max(0, at - reach) : at][::-1], words[at : at + k + reach]


_SEED = "size int, fp long, left array<binary>, right array<binary>"


def _item_seeds(items: DataFrame, key: str, text: str, window: int, k: int) -> DataFrame:
    """(item, size, fp, left, right) of the selected k-grams of every item; one of fewer words is one window of its own."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in batches:
            rows: list[tuple] = []
            for item, raw in zip(batch.column("item").to_pylist(), raw_texts(batch.column("text"))):
                words = raw.translate(ALNUM_LOWER).split()
                size = min(window, len(words))
                if size:
                    short = min(k, size)
                    places, fps = _selected(known.of(words), size, short)
                    rows += [(item, size, fp, *_context(words, at, size, short)) for at, fp in zip(places.tolist(), fps.view(np.int64).tolist())]
            words_of = pa.list_(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in
                 enumerate((pa.string(), pa.int32(), pa.int64(), words_of, words_of))],
                names=["item", "size", "fp", "left", "right"],
            )

    return items.select(F.col(f"`{key}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text")).mapInArrow(
        cut, f"item string, {_SEED}"
    )


#: Bits of the filter for each fingerprint of the items, and the most bits it may have (32 MB, which every task reads).
BITS_EACH, MOST_BITS = 256, 28


def _bitmap(seeds: DataFrame, bits: int | None) -> tuple[np.ndarray, int]:
    """A bit for each fingerprint's top bits, ``bits`` of them or as many as the fingerprints need to be told apart."""
    if bits is None:
        bits = min(MOST_BITS, max(10, (BITS_EACH * seeds.select("fp").distinct().count()).bit_length()))
    slot = F.shiftrightunsigned("fp", 64 - bits)
    words = (
        seeds.select((slot / 64).cast("long").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int")).alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))
    ).toArrow()
    filled = np.zeros(1 << (bits - 6), dtype=np.int64)
    filled[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return filled.view(np.uint64), bits


def _agreeing(one: Column, other: Column) -> Column:
    """How many words two lists have in common from their start."""
    differ = F.array_position(F.zip_with(one, other, lambda a, b: F.coalesce(a != b, F.lit(True))), True)
    return F.when(differ > 0, differ - 1).otherwise(F.size(one)).cast("int")


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", window: int = 10, k: int = 5, filter_bits: int | None = None, inside: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(documents, hits): a row ``rid, id, n_words`` per document, and ``rid, start, size, items`` per hit span.

    Words are runs of ASCII letters and digits and all characters beyond ASCII, with A-Z lower-cased.  Documents and items
    are winnowed alike: of each window of ``window`` words the least of its k-grams is a seed, listed once for all windows
    in a row that select it.  Two equal windows have the same seed at the same place, so every shared span of ``window``
    words has a pair of seeds in common.  Seeds are joined by fingerprint; each pair is extended to the left and the right
    word by word, as far as a window around the seed reaches, and is a hit if it gets ``window`` words long (an item of
    fewer words: if all of it is there).

    A bitmap of the items' fingerprints, its size following their number, drops most seeds of documents during the scan;
    it decides nothing.  Both sides of the join are stored, so that adaptive execution can split a hot fingerprint.

    Null and empty texts have no words and no seeds.  An item without a name marks words but is not named.  Very long
    texts are scanned whole, one at a time.  With ``inside``, ``key`` is a struct that holds the text as a field.
    """
    spark = docs.sparkSession
    seeds = stage(_item_seeds(items, item_key, item_text, window, k), "bench-seeds")
    sizes = sorted(r[0] for r in seeds.filter(F.col("size") < window).select("size").distinct().collect())
    filled, bits = _bitmap(seeds, filter_bits)
    shared = spark.sparkContext.broadcast(filled)
    shift = np.uint64(64 - bits)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 36
        known, bitmap = WordHash(), shared.value
        words_of = pa.list_(pa.binary())
        seed = pa.struct([("start", pa.int32()), ("size", pa.int32()), ("fp", pa.int64()), ("left", words_of), ("right", words_of)])
        for batch, texts in sliced(batches, lambda b: b.column("id").field(text) if inside else b.column("text")):
            rids, counts, found = [], [], []
            for raw in texts:
                words = raw.translate(ALNUM_LOWER).split()
                near: list[dict] = []
                if words:
                    hashes = known.of(words)
                    for size in (*sizes, window):
                        short = min(k, size)
                        each = grams(hashes, short)
                        slot = each >> shift
                        # Few k-grams pass the filter; of these it is asked whether winnowing selects them.
                        for at in np.flatnonzero((bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)).tolist():
                            if len(words) >= size and _is_selected(each, at, size - short):
                                left, right = _context(words, at, size, short)
                                near.append({"start": at, "size": size, "fp": int(each[at].view(np.int64)), "left": left, "right": right})
                rids.append(rid)
                counts.append(len(words))
                found.append(near)
                rid += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids, pa.int64()), batch.column("id"), pa.array(counts, pa.int64()), pa.array(found, pa.list_(seed))],
                names=["rid", "id", "n_words", "near"],
            )

    kind = docs.schema[key].dataType.simpleString()
    near = "near array<struct<start int, size int, fp long, left array<binary>, right array<binary>>>"
    scanned = stage(
        docs.select(F.col(f"`{key}`").alias("id"), *([] if inside else [F.col(f"`{text}`").alias("text")])).mapInArrow(
            tidy(scan), f"rid long, id {kind}, n_words long, {near}"
        ),
        "doc-seeds",
    )
    named = stage(
        seeds.groupBy("size", "fp", F.col("left").alias("item_left"), F.col("right").alias("item_right"))
        .agg(F.array_sort(F.collect_set("item")).alias("items")), "named-seeds",
    )
    before, after = _agreeing(F.col("left"), F.col("item_left")), _agreeing(F.col("right"), F.col("item_right"))
    hits = (
        scanned.select("rid", F.explode("near").alias("n")).select("rid", "n.*")
        .join(named, ["size", "fp"]).select("rid", "start", "size", "items", before.alias("before"), after.alias("after"))
        .filter(F.col("before") + F.col("after") >= F.col("size"))
        .select("rid", (F.col("start") - F.col("before")).alias("start"), (F.col("before") + F.col("after")).alias("size"), "items")
    )
    return scanned.select("rid", "id", "n_words"), hits


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """One row per document: ``key, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``n_hit`` counts words inside any occurrence of an item's window, ``items_sha256`` hashes the sorted, comma-joined
    names of items with such windows (of the empty string if there are none).  Repeated rows are judged each; null ids
    pass through; other columns of either table are ignored; empty tables give an empty or clean result.
    See ``contamination`` for the method and options.
    """
    rows, hits = contamination(docs, items, key=key, **options)
    spans = F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("size")).alias("stop"))))
    judged = hits.groupBy("rid").agg(spans.alias("spans"), F.collect_set("items").alias("sets")).select(
        "rid",
        F.aggregate(
            "spans",
            F.struct(F.lit(0).alias("until"), F.lit(0).cast("long").alias("n")),
            lambda so_far, s: F.struct(
                F.greatest(so_far["until"], s["stop"]).alias("until"),
                (so_far["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(so_far["until"], s["start"]))).alias("n"),
            ),
            lambda so_far: so_far["n"],
        ).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items"),
    )
    n_hit, names = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(judged, "rid", "left").select(
        F.col("id").alias(key), "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns; rows are told apart by number, so ids do not matter."""
    whole = docs.select(F.struct("*").alias("row"))
    rows, hits = contamination(whole, items, key="row", text=text, inside=True, **options)
    # The numbers of hit rows are stored, so that the join knows their size: where they are few, no text is shuffled.
    hit = stage(hits.select("rid").distinct(), "contaminated")
    return rows.join(hit, "rid", "left_anti").select("id.*")
