"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import LOWER, WordHash, grams, mix, sliced, stage, tidy
from scoreloom.llm.samples import bounded_sample

#: Words (ASCII letters, digits, all bytes beyond ASCII) and runs of marks; ``LOWER`` comes first.
_TOKENS = re.compile(rb"[a-z0-9\x80-\xff]+|[^a-z0-9\x80-\xff\x00-\x20\x7f]+")


def buckets(text: bytes, known: WordHash, width: int) -> np.ndarray:
    """Bucket of every 1-gram and 2-gram of a text; a token that follows itself is one 2-gram, whichever it is."""
    hashes = known.of(_TOKENS.findall(text.translate(LOWER)))
    shift = np.uint64(65 - width.bit_length())
    pairs = grams(hashes, 2) >> shift
    pairs[hashes[1:] == hashes[: len(pairs)]] = width - 1
    return np.concatenate([mix(hashes) >> shift, pairs]).astype(np.int64)


@dataclass
class QualityModel:
    """Log ratio of the target's to the raw text's share of each bucket, and the score from which a text is good."""

    ratio: np.ndarray
    cut: float = 0.0


def fit_ratio(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    width: int = 1 << 14, target_rows: int = 20_000, smooth: float = 1.0,
) -> QualityModel:
    """Bucket shares of all documents (raw) and of a sample of about ``target_rows`` labelled good ones (target).

    Each task sums its documents; the driver receives ``width`` rows.  Only the ids of the sample are broadcast.
    """
    good = labels.filter(F.col(f"`{label}`") == 1).select(F.col(f"`{key}`").alias("good_id")).filter("good_id is not null").distinct()
    sample = bounded_sample(good, F.lit(1), F.col("good_id"), target_rows, seed=3)
    marked = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).join(
        F.broadcast(sample), F.col("id") == F.col("good_id"), "left"
    ).select("text", F.col("good_id").isNotNull().alias("good"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = WordHash(), np.zeros((2, width), dtype=np.int64)
        for batch, texts in sliced(batches, lambda b: b.column("text")):
            for raw, is_good in zip(texts, batch.column("good").to_pylist()):
                found = buckets(raw, known, width)
                np.add.at(sums[0], found, 1)
                if is_good:
                    np.add.at(sums[1], found, 1)
        used = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(sums[0][used]), pa.array(sums[1][used])], names=["bucket", "raw", "target"]
        )

    got = marked.mapInArrow(tidy(count), "bucket int, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    ).toArrow()
    share = np.full((2, width), smooth)
    share[:, got.column("bucket").to_numpy()] += [got.column("raw").to_numpy(), got.column("target").to_numpy()]
    share /= share.sum(axis=1, keepdims=True)
    return QualityModel(np.log(share[1]) - np.log(share[0]))


def log_weights(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Every input row in a struct ``row``, with ``n_grams`` and the summed log ratio ``log_weight`` of its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model.ratio)
    schema = f"row {docs.schema.simpleString()}, n_grams long, log_weight double"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ratio = WordHash(), shared.value
        for batch, texts in sliced(batches, lambda b: b.column("row").field(text)):
            n_grams, weights = [], []
            for raw in texts:
                found = buckets(raw, known, len(ratio))
                n_grams.append(len(found))
                weights.append(float(ratio[found].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_grams, pa.int64()), pa.array(weights, pa.float64())],
                names=["row", "n_grams", "log_weight"],
            )

    return docs.select(F.struct("*").alias("row")).mapInArrow(tidy(weigh), schema)


def kth_largest(values: DataFrame, column: str, k: int, at_once: int = 10_000, bins: int = 1024) -> float | None:
    """The ``k``-th largest value, exactly: counts in ever narrower bins until few values are left to sort."""
    known = values.select(F.col(column).alias("v")).filter("v is not null")
    low, high, n = known.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if not n or k < 1:
        return None
    k = min(k, n)
    while n > at_once and low < high:
        width = (high - low) / bins
        if not low < low + width < high:
            break
        spot = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).cast("int")
        counts = {
            r["spot"]: r for r in known.filter(F.col("v").between(low, high)).groupBy(spot.alias("spot"))
            .agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
        }
        for b in sorted(counts, reverse=True):
            if k <= counts[b]["n"]:
                break
            k -= counts[b]["n"]
        low, high, n = counts[b]["low"], counts[b]["high"], counts[b]["n"]
    if low == high:
        return low
    return known.filter(F.col("v").between(low, high)).orderBy(F.desc("v")).limit(k).agg(F.min("v")).first()[0]


def best_cut(scored: DataFrame, bins: int = 2000, low: float = -10.0, high: float = 10.0) -> float:
    """The cut of ``score`` with the best mean of the shares of good and of bad rows on the right side (``good`` 0 or 1).

    Of cuts that do equally well, the middle.  Without rows of both kinds, the lowest: nothing is rejected.
    """
    width = (high - low) / bins
    spot = F.least(F.greatest(F.floor((F.col("score") - low) / width), F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = np.zeros((2, bins))
    for r in scored.groupBy(spot.alias("spot"), "good").count().collect():
        counts[int(r["good"]), r["spot"]] = r["count"]
    if not counts.sum(axis=1).all():
        return low
    bad = np.concatenate([[0], np.cumsum(counts[0])]) / counts[0].sum()
    lost = np.concatenate([[0], np.cumsum(counts[1])]) / counts[1].sum()
    gain = bad - lost
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    run = best[: np.argmax(np.append(np.diff(best), 2) > 1) + 1]
    return low + width * float(run[0] + run[-1]) / 2


def sample_size(keyed: DataFrame, labels: DataFrame, key: str, label: str) -> int | None:
    """How many documents to sample: those whose key is above the cut that parts the keys of labelled good and bad rows best.

    Keys are sums over whole texts, so the cut is looked for on a logarithmic scale to both sides of zero.  None if no row
    is labelled bad, or none good: then there is nothing to tell what to leave out.
    """
    judged = labels.select(F.col(f"`{key}`").alias("label_id"), F.col(f"`{label}`").cast("int").alias("good")).filter(
        "label_id is not null and good in (0, 1)"
    ).groupBy("label_id").agg(F.max("good").alias("good"))
    scale = F.signum("sample_key") * F.log1p(F.abs("sample_key"))
    keys = keyed.filter("sample_key is not null").select(F.col(f"row.`{key}`").alias("label_id"), scale.alias("score"))
    cut = best_cut(keys.join(judged, "label_id"), bins=8000, low=-40.0, high=40.0)
    return None if cut <= -40.0 else keys.filter(F.col("score") >= cut).count()


def sample_good(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    keep: int | None = None, temperature: float = 1.0, seed: int = 11, **options,
) -> DataFrame:
    """Every input row in ``row``, with ``log_weight``, ``score`` (the weight per n-gram), ``sample_key`` and ``kept``; stored.

    Importance resampling: the log weight of a document is the summed log ratio of the target's to the raw text's n-gram
    shares.  Its key adds a Gumbel draw (times ``temperature``), made by a hash of id and text, and the ``keep`` documents
    with the largest keys are kept (with any that tie with the last): at temperature 1, sampling without replacement in
    proportion to the weight.  Without ``keep``, it is ``sample_size``, so that it follows the input; the labels decide the
    size only.

    Null and empty texts, and others without n-grams, have no key and are kept only where nothing is left out.  Repeated
    rows get equal keys and fate.  Labels with null ids or values are ignored; of several labels the best counts.  An empty
    table gives an empty result.  Very long texts are summed whole, one at a time.
    """
    model = fit_ratio(docs, labels, key, text, label, **options)
    weighed = log_weights(docs, model, text)
    score = F.when(F.col("n_grams") > 0, F.col("log_weight") / F.col("n_grams"))
    spot = F.xxhash64(F.col(f"row.`{key}`"), F.col(f"row.`{text}`"), F.lit(seed))
    uniform = (F.shiftrightunsigned(spot, 11).cast("double") + 0.5) / float(1 << 53)
    noise = -F.log(-F.log(uniform)) * temperature
    sample_key = F.when(F.col("n_grams") > 0, F.col("log_weight") + noise)
    scored = stage(weighed.withColumn("score", score).withColumn("sample_key", sample_key), "quality")
    if keep is None:
        keep = sample_size(scored, labels, key, label)
        if keep is None:
            return scored.withColumn("kept", F.lit(True))
    last = kth_largest(scored, "sample_key", keep)
    return scored.withColumn("kept", F.lit(False) if last is None else F.coalesce(F.col("sample_key") >= last, F.lit(False)))
