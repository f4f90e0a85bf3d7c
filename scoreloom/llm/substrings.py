"""Substring dedup: documents factored against blocks of reference text; long factors are repeated passages."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm.common import WordHash, by_bytes, grams, mix, raw_texts, stage
from scoreloom.session import stage_path

#: Words of the seed, a run inside every window by which equal windows meet.
SEED = 8
_KEY = ["h1", "h2"]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


def _windows(hashes: np.ndarray, ends: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """Places in the joined word hashes at which a window of one text begins."""
    start = np.repeat(ends - sizes, np.maximum(sizes - window + 1, 0))
    count = np.maximum(sizes - window + 1, 0)
    return start + np.arange(len(start)) - np.repeat(np.cumsum(count) - count, count)


def _merge(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans, as ordered spans that do not touch."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > reach[:-1])
    return begin[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def _segments(texts: list[bytes], copies: list[int], known: WordHash, window: int) -> list[tuple]:
    """Of each text: ``fps, phs, places, weights`` of its segments, and ``begin, end`` of spans known to recur already.

    The seed of a window is its run of ``SEED`` words with the least hash, so equal windows have equal seeds.  A segment is
    a run of consecutive windows with one seed, at most as many as a window has seeds.  ``fp`` names the seed, ``ph`` the
    whole segment.  Of equal segments in these texts only the first is listed, with weight 2.
    """
    parts = [known.of(t.split()) for t in texts]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    out: list[list] = [[[], [], [], [], np.empty(0, np.int64), np.empty(0, np.int64)] for _ in texts]
    hashes, ends = np.concatenate(parts), np.cumsum(sizes)
    at = _windows(hashes, ends, sizes, window)
    if not len(at):
        return out
    most = window - SEED + 1
    whole, seeds = grams(hashes, window), _least(grams(hashes, SEED), most)
    whole_at, seeds_at = whole[at], seeds[at]
    new = np.append(True, (seeds_at[1:] != seeds_at[:-1]) | (at[1:] != at[:-1] + 1))
    begun = np.flatnonzero(new)
    new |= (np.arange(len(at)) - np.repeat(begun, np.diff(np.append(begun, len(at))))) % most == 0
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    wins = (last - first + 1).astype(np.uint64)
    text_of = np.searchsorted(ends, at[first], side="right")
    weight = np.array(copies, dtype=np.int64)[text_of]
    fps = mix(seeds_at[first])
    phs = mix(mix(whole_at[first] + wins) ^ whole_at[last] * np.uint64(0x9E3779B97F4A7C15))
    _, index, back = np.unique(phs, return_index=True, return_inverse=True)
    together = np.bincount(back, weights=weight) > 1
    weight = np.where(together[back], 2, 1)
    listed = np.zeros(len(first), dtype=bool)
    listed[index] = True
    start = at[first] - (ends - sizes)[text_of]
    edges = np.searchsorted(text_of, np.arange(len(texts) + 1))
    again = weight == 2
    of_text = np.searchsorted(at, ends - sizes), np.searchsorted(at, ends)
    for i, row in enumerate(out):
        a, b = edges[i], edges[i + 1]
        if a == b:
            continue
        pick = a + np.flatnonzero(listed[a:b])
        row[:4] = (fps[pick].view(np.int64), phs[pick].view(np.int64), start[pick] << 8 | wins[pick].astype(np.int64), weight[pick].astype(np.int8))
        pick = a + np.flatnonzero(again[a:b])
        begin, end = start[pick], start[pick] + wins[pick].astype(np.int64) + (window - 1)
        # Windows that the text repeats within itself.
        mine = whole_at[of_text[0][i] : of_text[1][i]]
        ordered = np.sort(mine)
        if (ordered[1:] == ordered[:-1]).any():
            _, back, count = np.unique(mine, return_inverse=True, return_counts=True)
            own = np.flatnonzero(count[back] > 1)
            begin, end = np.concatenate([begin, own]), np.concatenate([end, own + window])
        row[4:] = _merge(begin, end)
    return out


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``h1, h2, text, copies``: every distinct text once (null counts as empty), known by 128 bits, and 2 copies for more.

    Written bucketed by the hash, so that later joins on it move only their other side.  Each task collapses its copies
    before the shuffle.
    """
    spark = docs.sparkSession
    raw = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(*text_key(raw), raw.alias("text")).groupBy(*_KEY).agg(
        F.first("text").alias("text"), F.least(F.count(F.lit(1)), F.lit(2)).cast("int").alias("copies")
    )
    return _bucketed(named, buckets)


def text_key(raw):
    return F.xxhash64(raw).alias("h1"), F.xxhash64(F.lit(12), raw).alias("h2")


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """A stage in the shared folder whose files keep the rows of one hash together."""
    spark = df.sparkSession
    path = stage_path(spark, "llm-texts")
    name = "scoreloom_" + path.rsplit("-", 1)[-1]
    df.write.bucketBy(buckets, *_KEY).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
    return spark.table(name)


def _survey(texts: DataFrame, window: int, batch_bytes: int) -> DataFrame:
    """Per text its segments (see ``_segments``); stored."""

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash(200_000)
        for batch in batches:
            size = pc.binary_length(batch.column("text")).to_pylist()
            for a, b in by_bytes(size, batch_bytes):
                part = batch.slice(a, b - a)
                found = _segments(raw_texts(part.column("text")), part.column("copies").to_pylist(), known, window)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("h1"), part.column("h2"), *(pa.array([f[i] for f in found], pa.list_(k)) for i, k in enumerate(kinds))],
                    names=[*_KEY, "fp", "ph", "place", "weight", "begin", "end"],
                )

    lists = "fp array<long>, ph array<long>, place array<long>, weight array<byte>, begin array<long>, end array<long>"
    return stage(texts.select(*_KEY, "text", "copies").mapInArrow(survey, f"h1 long, h2 long, {lists}"), "segments")


def _hot_cells(segments: DataFrame, cells: int, share: int) -> list[int]:
    """Cells of the seeds' hash space with over ``share`` times the mean number of segments."""
    counts = segments.select(F.explode("fp").alias("fp")).groupBy(F.pmod("fp", F.lit(cells)).alias("cell")).count()
    total, = counts.agg(F.sum("count")).first()
    return [r["cell"] for r in counts.filter(F.col("count") > F.lit(max(64, share * (total or 0) / cells))).collect()]


def _single_windows(texts: DataFrame, segments: DataFrame, cells: int, hot: list[int], window: int) -> DataFrame:
    """Segments of hot seeds as segments of one window each, whose seed is the window itself.

    A seed in very many different surroundings would gather them all in one task; its windows spread over the hash space.
    """
    few = segments.select(*_KEY, F.filter(
        F.zip_with("fp", "place", lambda f, p: F.struct(f.alias("fp"), p.alias("place"))),
        lambda s: F.pmod(s["fp"], F.lit(cells)).isin(hot),
    ).alias("hot")).filter(F.size("hot") > 0).select(*_KEY, F.transform("hot", lambda s: s["place"]).alias("places"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash(200_000)
        for batch in batches:
            found: list[tuple] = [(np.empty(0, np.int64),) * 4]
            for i, (text, copies, places) in enumerate(zip(*(batch.column(c) for c in ("text", "copies", "places")))):
                hashes = known.of(text.as_py().encode().split())
                place = np.array(places.as_py(), dtype=np.int64)
                wins = place & 255
                at = np.repeat(place >> 8, wins) + np.arange(wins.sum()) - np.repeat(np.cumsum(wins) - wins, wins)
                found.append((np.full(len(at), i), grams(hashes, window)[at].view(np.int64), at, np.full(len(at), copies.as_py())))
            row, whole, at, weight = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("h1").take(pa.array(row)), batch.column("h2").take(pa.array(row)), pa.array(whole),
                 pa.array(mix(whole.view(np.uint64) + np.uint64(1)).view(np.int64)), pa.array(at << 8 | 1), pa.array(weight.astype(np.int8))],
                names=[*_KEY, "fp", "ph", "place", "weight"],
            )

    return texts.join(few, _KEY).mapInArrow(cut, "h1 long, h2 long, fp long, ph long, place long, weight byte")


def _shared(occurrences: DataFrame) -> DataFrame:
    """Segments whose seed occurs elsewhere: ``recurs`` if the whole segment does, ``source`` if it is needed to factor others.

    Seeds with one kind of segment need no factoring: it recurs, or not.
    """
    seed, same = Window.partitionBy("fp"), Window.partitionBy("fp", "ph")
    # One of equal segments stands for them all; those of weight 2 are known to recur already.
    ranked = occurrences.withColumn("w", F.sum("weight").over(same)).withColumn(
        "r", F.row_number().over(same.orderBy(*_KEY, "place"))
    ).withColumn("low", F.min("ph").over(seed)).withColumn("high", F.max("ph").over(seed))
    source = (F.col("low") != F.col("high")) & (F.col("r") == 1)
    recurs = (F.col("w") > 1) & (F.col("weight") == 1)
    return stage(
        ranked.select(*_KEY, "fp", "place", (F.col("w") == 1).alias("lone"), recurs.alias("recurs"), source.alias("source"))
        .filter("recurs or source"), "shared-segments",
    )


def factor(pieces: list[np.ndarray], lone: np.ndarray, window: int) -> list[tuple[list[int], list[int]]]:
    """Spans of each lone piece that recur in the block: relative Lempel-Ziv parsing against all its pieces.

    The block's index holds every window of every piece under its hash, with the first and the last place where it stands.
    All lone pieces are parsed in step.  At its cursor a piece looks its window up; without another place the cursor goes
    on to the next window that has one.  With one, the factor runs as long as both places agree, word by word, and is a
    span, as it holds a whole window.  Windows inside it are settled; the first that crosses its end is looked up anew.
    """
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    words, ends = np.concatenate(pieces), np.cumsum(sizes)
    at = _windows(words, ends, sizes, window)
    whole = grams(words, window)[at]
    _, first, back = np.unique(whole, return_index=True, return_inverse=True)
    last = np.zeros(len(first), dtype=np.int64)
    np.maximum.at(last, back, np.arange(len(at)))
    first, last = first[back], last[back]
    here = np.arange(len(at))
    source = np.where(first != here, first, last)
    source[source == here] = -1
    piece_of = np.searchsorted(ends, at, side="right")
    stop = np.searchsorted(piece_of, np.arange(len(pieces)), side="right")
    hits = np.append(np.flatnonzero(source >= 0), len(at))
    cursor = np.searchsorted(piece_of, np.arange(len(pieces)))
    running = np.flatnonzero(lone)
    begin_of = ends - sizes
    spans: list[tuple[list[int], list[int]]] = [([], []) for _ in pieces]
    while len(running):
        i = hits[np.searchsorted(hits, cursor[running])]
        on = i < stop[running]
        running, i = running[on], i[on]
        if not len(running):
            break
        here, there = at[i], at[source[i]]
        limit = np.minimum(ends[running] - here, ends[piece_of[source[i]]] - there)
        length = np.zeros(len(i), dtype=np.int64)
        open_ = np.arange(len(i))
        while len(open_):
            agree = words[here[open_] + length[open_]] == words[there[open_] + length[open_]]
            open_ = open_[agree]
            length[open_] += 1
            open_ = open_[length[open_] < limit[open_]]
        long = length >= window  # the hash led here, the words decide
        for p, b, n in zip(running[long].tolist(), (here - begin_of[running])[long].tolist(), length[long].tolist()):
            spans[p][0].append(b)
            spans[p][1].append(b + n)
        cursor[running] = i + np.maximum(length - window + 1, 1)
    return spans


def _factored(texts: DataFrame, shared: DataFrame, window: int, block_words: int) -> DataFrame:
    """``h1, h2, begin, end`` of the spans that factoring finds in segments that recur in part."""
    source = shared.filter("source")
    blocks = max(1, math.ceil(source.count() * 2 * window / block_words))
    wanted = source.groupBy(*_KEY).agg(F.collect_list(F.struct(
        F.pmod(F.xxhash64("fp"), F.lit(blocks)).cast("int").alias("block"), "place", "lone"
    )).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, block, first, lone, said = [], [], [], [], []
            for i, (text, wanted) in enumerate(zip(batch.column("text"), batch.column("wanted"))):
                words = text.as_py().encode().split()
                for w in wanted.as_py():
                    a = w["place"] >> 8
                    row.append(i)
                    block.append(w["block"])
                    first.append(a)
                    lone.append(w["lone"])
                    said.append(b" ".join(words[a : a + (w["place"] & 255) + window - 1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int32()), *(batch.column(c).take(pa.array(row, pa.int64())) for c in _KEY),
                 pa.array(first, pa.int64()), pa.array(lone, pa.bool_()), pa.array(said, pa.binary())],
                names=["block", *_KEY, "first", "lone", "words"],
            )

    def parse(block: pa.Table) -> pa.Table:
        known = WordHash(200_000)
        lone = block.column("lone").to_numpy()
        spans = factor([known.of(w.split()) for w in block.column("words").to_pylist()], lone, window)
        keep = pa.array([i for i, (b, _) in enumerate(spans) if b], pa.int64())
        first = block.column("first").to_pylist()
        return pa.table({
            "h1": block.column("h1").take(keep), "h2": block.column("h2").take(keep),
            "begin": pa.array([[first[i] + x for x in b] for i, (b, _) in enumerate(spans) if b], pa.list_(pa.int64())),
            "end": pa.array([[first[i] + x for x in e] for i, (b, e) in enumerate(spans) if b], pa.list_(pa.int64())),
        })

    pieces = texts.join(wanted, _KEY).select(*_KEY, "text", "wanted").mapInArrow(
        cut, "block int, h1 long, h2 long, first long, lone boolean, words binary"
    )
    return pieces.groupBy("block").applyInArrow(parse, "h1 long, h2 long, begin array<long>, end array<long>")


def repeated_spans(texts: DataFrame, window: int = 35, batch_bytes: int = 4 << 20, block_words: int = 2_000_000) -> DataFrame:
    """``h1, h2, begins, ends``: spans of words covered by a window that stands elsewhere too; they may overlap.

    1. Texts are cut into segments by content (``_segments``).  Equal segments of a task collapse.
    2. A seed in uncommonly many segments gives way to the windows around it.
    3. Segments meet by seed.  Those that recur as a whole are spans; those with seeds in different surroundings go on.
    4. A block of the reference holds all different segments of its seeds; its own segments are factored against it.
    """
    spark = texts.sparkSession
    cells = max(1 << 14, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    segments = _survey(texts, window, batch_bytes)
    hot = _hot_cells(segments, cells, share=8)
    occurrences = segments.select(*_KEY, F.inline(F.arrays_zip("fp", "ph", "place", "weight")))
    if hot:
        cool = ~F.pmod(F.col("fp"), F.lit(cells)).isin(hot)
        occurrences = occurrences.filter(cool).unionByName(_single_windows(texts, segments, cells, hot, window))
    shared = _shared(occurrences)
    begin = F.shiftright("place", 8)
    lists = [
        segments.filter(F.size("begin") > 0).select(*_KEY, "begin", "end"),
        shared.filter("recurs").select(*_KEY, F.array(begin).alias("begin"), F.array(begin + F.col("place").bitwiseAND(255) + (window - 1)).alias("end")),
        _factored(texts, shared, window, block_words),
    ]
    spans = lists[0].unionByName(lists[1]).unionByName(lists[2])
    return spans.groupBy(*_KEY).agg(F.flatten(F.collect_list("begin")).alias("begins"), F.flatten(F.collect_list("end")).alias("ends"))


def cut_texts(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``h1, h2, n_words, n_removed, removed, kept_text`` per distinct text: the spans as merged pairs, the words left."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, begins, ends in zip(*(batch.column(c) for c in ("text", "begins", "ends"))):
                words = text.as_py().encode().split()
                begin, end = (np.array(x.as_py() or [], dtype=np.int64) for x in (begins, ends))
                begin, end = (x.tolist() for x in _merge(begin, end))
                kept, at = [], 0
                for b, e in zip(begin, end):
                    kept += words[at:b]
                    at = e
                kept += words[at:]
                rows.append((len(words), len(words) - len(kept), [{"begin": b, "end": e} for b, e in zip(begin, end)], b" ".join(kept).decode()))
            pair = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
            columns = zip(*rows) if rows else ([],) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("h1"), batch.column("h2"),
                 *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.list_(pair), pa.string())))],
                names=[*_KEY, "n_words", "n_removed", "removed", "kept_text"],
            )

    return texts.join(spans, _KEY, "left").select(*_KEY, "text", "begins", "ends").mapInArrow(
        cut, "h1 long, h2 long, n_words long, n_removed long, removed array<struct<begin: long, end: long>>, kept_text string"
    )


def substring_dedup(docs: DataFrame, text: str = "text", window: int = 35) -> DataFrame:
    """``h1, h2, n_words, n_removed, removed, kept_text`` for every distinct text of ``docs``; see ``per_document``.

    Words are parted by white space and otherwise unchanged.  Each word is removed that a window of ``window`` consecutive
    words covers whose words also start anywhere else, in another row or the same, in the input as it is.  A text that
    stands in two rows is thus removed whole, if it has a window.  ``kept_text`` joins the words left by one space,
    ``removed`` has the spans of words that went.  Null and empty texts have no words; texts shorter than a window stay.
    Very long texts are single rows of work, cut into segments like others.  Other columns are ignored; an empty table
    gives an empty result.
    """
    if not SEED < window <= 255:
        raise ValueError(f"a window has more than {SEED} and up to 255 words")
    texts = distinct_texts(docs, text)
    return cut_texts(texts, repeated_spans(texts, window))


def per_document(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` of every row with what ``found`` (stored first) says of its text; repeated rows and null keys get a row each."""
    found = stage(found, "cut-texts")
    named = docs.select(F.col(f"`{key}`").alias("__key"), *text_key(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    return named.join(found, _KEY).drop(*_KEY).withColumnRenamed("__key", key)
