"""Toxicity: cumulative-link ordinal regression of severity grades on sparse text features."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import ALNUM_LOWER, raw_texts, stage
from scoreloom.llm.samples import bounded_sample


PREFIXES = (5, 6, 7)


def features(text: bytes, wanted: Callable[[bytes], bool] | None = None) -> dict[bytes, float]:
    """Sparse features of a text: log(1 + n) of each word's count, and for the first 5 to 7 bytes of longer words, marked
    with ^, log(1 + 200 n / words), so that chance hits in long texts weigh little.  ``wanted`` picks features."""
    words = text.translate(ALNUM_LOWER).split()
    starts: Counter = Counter()
    if wanted is None:
        counts = Counter(words)
        for word, n in counts.items():
            for size in PREFIXES:
                if len(word) > size:
                    starts[b"^" + word[:size]] += n
    else:
        counts = Counter(filter(wanted, words))
        for size in PREFIXES:
            starts.update(filter(wanted, [b"^" + w[:size] for w in words if len(w) > size]))
    found = {w: math.log1p(n) for w, n in counts.items()}
    return found | {w: math.log1p(200 * n / len(words)) for w, n in starts.items()}


@dataclass
class SeverityModel:
    """One weight per feature, shared by all thresholds; thresholds ascend, one fewer than grades."""

    weights: dict[bytes, float] = field(default_factory=dict)
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_cumulative(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int, balance: np.ndarray,
    l1: float = 1e-3, steps: int = 300, rate: float = 0.1,
) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of P(grade <= k) = sigmoid(threshold_k - w.x), by proximal AdaGrad with an L1 penalty.

    ``rows, columns, values`` are the non-zero features, ``balance`` a weight per row that sums to 1.
    """
    count, top = len(grades), int(grades.max())
    w, seen = np.zeros(width), np.full(width, 1e-8)
    thresholds, moved = np.linspace(1.0, 2.0, top), np.full(top, 1e-8)
    for _ in range(steps):
        s = np.bincount(rows, weights=values * w[columns], minlength=count)
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        above, below = _sigmoid(edges[grades + 1] - s), _sigmoid(edges[grades] - s)
        chance = np.maximum(above - below, 1e-9)
        slope = balance * (1 - above - below)
        g = np.bincount(columns, weights=values * slope[rows], minlength=width)
        seen += g * g
        pace = rate / np.sqrt(seen)
        w = w - pace * g
        w = np.sign(w) * np.maximum(np.abs(w) - pace * l1, 0)
        t = np.zeros(top + 2)
        np.add.at(t, grades + 1, -balance * above * (1 - above) / chance)
        np.add.at(t, grades, balance * below * (1 - below) / chance)
        moved += t[1:-1] ** 2
        thresholds = np.maximum.accumulate(thresholds - rate * t[1:-1] / np.sqrt(moved) + 1e-3 * np.arange(top))
        thresholds = thresholds - 1e-3 * np.arange(top)
    return w, np.maximum.accumulate(thresholds)


def fit_severity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", levels: int = 3,
    rows_per_label: int = 2000, vocabulary: int = 5000, least_docs: int = 4,
) -> SeverityModel:
    """Fit on about ``rows_per_label`` labelled rows of each label; the driver gets at most ``vocabulary`` counts of each.

    The vocabulary holds the words and word beginnings in at least ``least_docs`` sampled documents whose document frequency differs most
    between labels.  A label above 1 is a grade as it is.  Where labels only say toxic or not, toxic rows are graded 1 to
    ``levels`` by how much they use the features that mark toxic rows.
    """
    known = labels.select(F.col(f"`{key}`").alias("label_id"), F.col(f"`{label}`").cast("int").alias("grade")).filter(
        "label_id is not null and grade >= 0"
    ).groupBy("label_id").agg(F.max("grade").alias("grade"))
    sample = bounded_sample(known, F.col("grade"), F.col("label_id"), rows_per_label, seed=4)
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).join(
        F.broadcast(sample), F.col("id") == F.col("label_id")
    )

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.float64())]))
        for batch in batches:
            found = [[{"word": w, "n": n} for w, n in features(raw).items()]
                     for raw in raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("grade"), pa.array(found, kind)], names=["id", "grade", "words"]
            )

    counted = stage(
        texts.select("id", "grade", "text").mapInArrow(words, "id string, grade int, words array<struct<word binary, n double>>"),
        "toxic-sample",
    )
    totals = {bool(r["bad"]): r["count"] for r in counted.groupBy((F.col("grade") > 0).alias("bad")).count().collect()}
    if len(totals) < 2:
        return SeverityModel()
    flat = counted.select("id", "grade", F.explode("words").alias("w")).select("id", "grade", "w.word", "w.n")
    bad, good = (F.count(F.when(x, 1)) for x in (F.col("grade") > 0, F.col("grade") == 0))
    odds = F.log((F.col("bad") + 0.5) * (totals[False] + 1) / (F.col("good") + 0.5) / (totals[True] + 1))
    z = odds / F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    chosen = flat.groupBy("word").agg(bad.alias("bad"), good.alias("good")).filter(F.col("bad") + F.col("good") >= least_docs)
    chosen = chosen.withColumn("z", z).orderBy(F.desc(F.abs("z")), "word").limit(vocabulary).select("word", "z").toArrow()
    terms, signal = chosen.column("word").to_pylist(), chosen.column("z").to_numpy()
    place = docs.sparkSession.createDataFrame([(t, i) for i, t in enumerate(terms)], "word binary, at int")
    hits = flat.join(F.broadcast(place), "word").select("id", "at", "n").toArrow().sort_by([("id", "ascending"), ("at", "ascending")])
    people = counted.select("id", "grade").toArrow().sort_by([("id", "ascending"), ("grade", "ascending")])
    number = {i: r for r, i in enumerate(people.column("id").to_pylist())}
    rows = np.array([number[i] for i in hits.column("id").to_pylist()], dtype=np.int64)
    columns, n = hits.column("at").to_numpy(), hits.column("n").to_numpy()
    grades = people.column("grade").to_numpy().astype(np.int64)
    if grades.max() == 1 and levels > 1:
        strong = signal[columns] >= 5
        uses = np.bincount(rows[strong], weights=n[strong], minlength=len(grades))
        marks = np.quantile(uses[grades > 0], np.arange(1, levels) / levels)
        grades = np.where(grades > 0, 1 + np.searchsorted(marks, uses), 0)
        grades = np.searchsorted(np.unique(grades), grades)
    even = np.full(len(grades), 1 / len(grades))
    w, _ = fit_cumulative(rows, columns, n, grades, len(terms), even)
    # The penalty picks the features; a fit on those alone, almost without it, gives their weights.
    support = np.flatnonzero(w)
    place_of = np.full(len(terms), -1)
    place_of[support] = np.arange(len(support))
    used = place_of[columns] >= 0
    w, thresholds = fit_cumulative(
        rows[used], place_of[columns[used]], n[used], grades, len(support), even, l1=1e-4, steps=1000, rate=0.5
    )
    return SeverityModel({terms[i]: float(v) for i, v in zip(support, w)}, thresholds)


def grade_severity(docs: DataFrame, model: SeverityModel, text: str = "text") -> DataFrame:
    """Every input row with ``severity`` (the expected grade), ``grade`` (the most probable one) and ``toxic``.

    ``toxic`` is true where a grade above 0 has at least an even chance.  Whole texts are read; null and empty texts and
    those without a known feature have the score of no evidence.  A model without grades gives 0 throughout.  Repeated rows
    are graded each, other columns pass through, an empty table gives an empty result.  No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("severity", "grade", "toxic")
    rest = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        weights = fitted.weights
        for batch in batches:
            s = np.array([
                sum(weights[w] * n for w, n in features(raw, weights.__contains__).items())
                for raw in raw_texts(batch.column(text))
            ], dtype=float)
            above = 1 - _sigmoid(fitted.thresholds[None, :] - s[:, None])
            shares = -np.diff(np.hstack([np.ones((len(s), 1)), above, np.zeros((len(s), 1))]), axis=1)
            toxic = above[:, 0] >= 0.5 if above.shape[1] else np.zeros(len(s), dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(above.sum(axis=1), pa.float64()),
                 pa.array(shares.argmax(axis=1) if len(s) else [], pa.int32()), pa.array(toxic, pa.bool_())],
                names=[*rest, "severity", "grade", "toxic"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text)
    return docs.mapInArrow(run, f"{fields + ', ' if fields else ''}severity double, grade int, toxic boolean")
