"""Language identification: the family first, then one-versus-one linear support vector machines inside it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import by_bytes, raw_texts
from scoreloom.llm.samples import bounded_sample

# Language codes by family.  A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indic": "bn gu hi mr ne pa sa ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "celtic": "br cy ga gd",
    "sinitic": "yue zh",
    "malay": "id jv ms su tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

#: ASCII letters lower-cased, other ASCII turned into a space; bytes of other characters as they are.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def held_out(key: Column) -> Column:
    """Rows that are kept from training: crc32 of the key's text, modulo 5, is 0 (a null key counts as empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def features(text: bytes, width: int) -> np.ndarray:
    """Square roots of the shares of hashed byte 2-, 3- and 4-grams of the whole text; zeros if it is too short."""
    raw = np.frombuffer(b" " + text.translate(_LETTERS) + b" ", dtype=np.uint8).astype(np.uint32)
    counts = np.zeros(width)
    for a in range(0, max(1, len(raw) - 3), 1 << 20):  # long texts piece by piece; neighbouring pieces overlap
        part = raw[a : a + (1 << 20) + 3]
        gram = part[:-1] << np.uint32(8) | part[1:]
        for n in (2, 3, 4):
            if n > 2:
                gram = gram[:-1] << np.uint32(8) | part[n - 1 :]
            spot = (gram * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(32 - width.bit_length() + 1)
            counts += np.bincount(spot, minlength=width)
    total = counts.sum()
    return np.sqrt(counts / total).astype(np.float32) if total else counts.astype(np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 20, seed: int = 1) -> np.ndarray:
    """Weights and bias of an L2-loss linear support vector machine, by dual coordinate descent; ``y`` is +1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    w, alpha = np.zeros(x.shape[1], dtype=np.float32), np.zeros(len(x))
    diagonal = (x * x).sum(axis=1) + 1 / (2 * cost)
    draw = np.random.RandomState(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in draw.permutation(len(x)):
            slope = y[i] * float(w @ x[i]) - 1 + alpha[i] / (2 * cost)
            new = max(alpha[i] - slope / diagonal[i], 0.0)
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


@dataclass
class LanguageModel:
    """Families in order, a one-versus-rest machine for each (none if there is one), pairs of languages inside them."""

    width: int
    families: list[str] = field(default_factory=list)
    languages: dict[str, list[str]] = field(default_factory=dict)
    family_weights: np.ndarray | None = None
    pairs: dict[str, list[tuple[int, int]]] = field(default_factory=dict)
    pair_weights: dict[str, np.ndarray] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and a score from 0 to 1 for each row: the family's share times the winner's weakest duel."""
        x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
        if self.family_weights is None:
            best, score = np.zeros(len(x), dtype=int), np.ones(len(x))
        else:
            margins = x @ self.family_weights.T
            share = np.exp(3 * (margins - margins.max(axis=1, keepdims=True)))
            share /= share.sum(axis=1, keepdims=True)
            best, score = share.argmax(axis=1), share.max(axis=1)
        names = np.empty(len(x), dtype=object)
        for f, family in enumerate(self.families):
            rows, known = np.flatnonzero(best == f), self.languages[family]
            if not len(rows):
                continue
            winner = np.zeros(len(rows), dtype=int)
            if len(known) > 1:
                chance = 1 / (1 + np.exp(-3 * (x[rows] @ self.pair_weights[family].T)))
                votes, least = np.zeros((len(rows), len(known))), np.ones((len(rows), len(known)))
                for p, (a, b) in enumerate(self.pairs[family]):
                    for one, won in ((a, chance[:, p]), (b, 1 - chance[:, p])):
                        votes[:, one] += (won > 0.5) + won / len(known) / 2
                        least[:, one] = np.minimum(least[:, one], won)
                winner = votes.argmax(axis=1)
                score[rows] *= least[np.arange(len(rows)), winner]
            names[rows] = [known[i] for i in winner]
        return names.tolist(), np.clip(score, 0.0, 1.0)


def train(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", width: int = 4096, rows: int = 4000
) -> LanguageModel:
    """Fit on rows that are not held out, have a language and some letter n-gram.

    At most about ``rows`` rows are used, the same number of each language; they reach the driver as ``rows`` vectors of
    ``width`` half-precision numbers.  Rows are drawn by a hash of the key over all labelled rows.
    """
    usable = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    usable = usable.filter(~held_out(F.col("id")) & F.col("lang").isNotNull() & (F.coalesce(F.length("text"), F.lit(0)) > 0))
    kinds = max(1, usable.select("lang").distinct().count())
    sample = bounded_sample(usable, F.col("lang"), F.col("id"), max(1, rows // kinds), seed=5)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [features(raw, width).astype(np.float16).tobytes() for raw in raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.string()), batch.column("lang"), pa.array(vectors, pa.binary())],
                                             names=["id", "lang", "x"])

    got = sample.select("id", "text", "lang").mapInArrow(encode, "id string, lang string, x binary").toArrow().sort_by("id")
    model = LanguageModel(width)
    if not got.num_rows:
        return model
    x = np.stack([np.frombuffer(v, dtype=np.float16) for v in got.column("x").to_pylist()]).astype(np.float32)
    y = np.array(got.column("lang").to_pylist(), dtype=object)
    used = x.any(axis=1)
    x, y = x[used], y[used]
    for code in sorted(set(y)):
        model.languages.setdefault(FAMILY_OF.get(code, code), []).append(code)
    model.families = sorted(model.languages)
    family = np.array([FAMILY_OF.get(c, c) for c in y], dtype=object)
    if len(model.families) > 1:
        model.family_weights = np.stack([linear_svm(x, np.where(family == f, 1.0, -1.0)) for f in model.families])
    for f, known in model.languages.items():
        model.pairs[f] = list(combinations(range(len(known)), 2))
        fits = []
        for a, b in model.pairs[f]:
            here = (y == known[a]) | (y == known[b])
            fits.append(linear_svm(x[here], np.where(y[here] == known[a], 1.0, -1.0)))
        if fits:
            model.pair_weights[f] = np.stack(fits)
    return model


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Every input row with ``lang_pred`` and ``score``, from the whole text alone.

    ``und`` with score 0 for null or empty texts, texts without a letter, and a model that saw no language.  Repeated rows are predicted
    each, other columns pass through, an empty table gives an empty result.  One pass over the scan, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    rest = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            texts = batch.column(text).to_pylist()
            raws = raw_texts(batch.column(text))
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            rows = [i for i, t in enumerate(texts) if t and fitted.families and any(map(str.isalpha, t))]
            for a, b in by_bytes((fitted.width * 4 for _ in rows), 4 << 20):
                x = np.stack([features(raws[i], fitted.width) for i in rows[a:b]])
                found, scores[rows[a:b]] = fitted.predict(x)
                for i, name in zip(rows[a:b], found):
                    names[i] = name
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*rest, "lang_pred", "score"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text)
    return docs.mapInArrow(run, f"{fields + ', ' if fields else ''}lang_pred string, score double")
