"""Spelling variants: words one edit apart, found by pivotal bigrams and grouped under their most frequent form."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import LOWER, stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Length difference and shift of a surviving bigram: a replaced code point shifts nothing, an inserted or deleted one
#: shifts what stands behind it.
SHIFTS = ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))


def misspelt(key: str, run: str, every: int) -> str:
    """The run, less one code point where the checksum of key and run is divisible by ``every``."""
    h = zlib.crc32(f"{key}:{run}".encode())
    if every and h % every == 0:
        at = h % len(run)
        return run[:at] + run[at + 1 :]
    return run


def _runs(text: str) -> Iterator[Counter]:
    """Counts of a text's lower-cased runs; a very long text gives several."""
    low = text.encode().translate(LOWER).decode()
    if len(low) <= 1 << 20:
        yield Counter(RUN.findall(low))
        return
    part: Counter = Counter()
    for m in RUN.finditer(low):
        part[m.group()] += 1
        if len(part) >= 100_000:
            yield part
            part = Counter()
    yield part


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = 5, least_count: int = 3, every: int = 0,
    remember: int = 200_000,
) -> DataFrame:
    """``word, n`` of all words with enough code points and occurrences.

    Each task adds up a bounded table of words before anything is shuffled, so that a word on every line is a row a task.
    ``every`` deletes a code point of some runs (see ``misspelt``; 0: none); a null key counts as the empty string.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for k, t in zip(batch.column("k"), batch.column("t")):
                if not (t := t.as_py()):
                    continue
                begun = zlib.crc32(f"{k.as_py()}:".encode())
                for runs in _runs(t):
                    for run, n in runs.items():
                        if every:
                            h = zlib.crc32(run.encode(), begun)
                            if h % every == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1 :]
                        if len(run) >= least_chars:
                            total[run] = total.get(run, 0) + n
                    if len(total) >= remember:
                        yield rows()
                        total.clear()
        yield rows()

    named = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"), F.col(f"`{text}`").alias("t"))
    return named.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def bigrams(word: str) -> list[str]:
    return [word[i : i + 2] for i in range(len(word) - 1)]


def parities(word: str) -> tuple[int, int]:
    """64 parities of how often letters, and bigrams, stand in a word, dealt by a hash; as signed numbers."""
    codes = [ord(c) for c in word]
    odd = odds = 0
    for i, c in enumerate(codes):
        odd ^= 1 << (c * 37 & 63)
        if i:
            odds ^= 1 << ((codes[i - 1] * 31 + c) * 0x9E3779B1 >> 10 & 63)
    return odd - ((odd & 1 << 63) << 1), odds - ((odds & 1 << 63) << 1)


def pivots(prefix: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Two disjoint bigrams of least total weight among ``(place, weight)`` in order of place.

    Dynamic programming over the places: the best single bigram that ends before a place, joined with the one there.
    """
    best: tuple[int, tuple, tuple] | None = None
    before: list[tuple[int, int]] = []  # before[i]: the lightest of the first i + 1
    for i, (place, weight) in enumerate(prefix):
        j = i - 1
        while j >= 0 and prefix[j][0] + 2 > place:
            j -= 1
        if j >= 0 and (best is None or before[j][1] + weight < best[0]):
            best = (before[j][1] + weight, before[j], (place, weight))
        before.append((place, weight) if not before or weight < before[-1][1] else before[-1])
    return [best[1], best[2]] if best else []


def _bigram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Rank (rare first) and weight of each bigram; as many rows as the alphabet has pairs, 8,100 for the runs above."""
    at = F.explode(F.sequence(F.lit(1), F.char_length("word") - 1))
    seen = words.select("word", at.alias("i")).groupBy(F.expr("substring(word, i, 2)").alias("gram")).count()
    found = sorted((r["count"], r["gram"]) for r in seen.collect())
    return {gram: (rank, weight) for rank, (weight, gram) in enumerate(found)}


def near_words(words: DataFrame) -> DataFrame:
    """``word, other, other_n`` for all words of ``words(word, n)`` exactly one edit apart, both ways round.

    A word's prefix is its three rarest bigrams (with all that tie in kind with the last).  Of these, two disjoint ones of
    least total frequency are its pivots.  One edit spoils at most one of two disjoint bigrams, so the other stands in the
    near word, at most one place off, and in its prefix if that reaches as far in the order of rarity.  So the pivots of
    the word whose prefix ends first are looked up in the prefixes of the others, by bigram, place and length, and each
    meeting is verified in the join, before a pair becomes a row: first by the parities of letters and of bigrams, of which
    one edit changes at most two and four, then by the edit distance.
    """
    order = _bigram_order(words)
    shared = words.sparkSession.sparkContext.broadcast(order)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for batch in batches:
            rows: list[tuple] = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                grams = [(*ranks[g], i) for i, g in enumerate(bigrams(word))]
                last = sorted(grams)[2][0]
                odd, odds = parities(word)
                prefix = [(i, w, r) for r, w, i in grams if r <= last]
                kinds = {i: r for i, _, r in prefix}
                size = len(word)
                rows += [(word, n, last, False, (r << 40) | (i << 20) | size, odd, odds) for i, _, r in prefix]
                rows += [
                    (word, n, last, True, (kinds[i] << 40) | (i + shift << 20) | (size + longer), odd, odds)
                    for i, _ in pivots([(i, w) for i, w, _ in prefix]) for longer, shift in SHIFTS if i + shift >= 0
                ]
            kinds_of = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*rows) if rows else ([],) * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds_of)], names=["word", "n", "last", "pivot", "spot", "odd", "odds"]
            )

    kinds = "word string, n long, last int, pivot boolean, spot long, odd long, odds long"
    entries = stage(words.mapInArrow(index, kinds), "bigrams")
    ask = entries.filter("pivot").drop("pivot")
    have = entries.filter("not pivot").select("spot", F.col("last").alias("reach"), *[
        F.col(c).alias(f"other{i}") for c, i in (("word", ""), ("n", "_n"), ("odd", "_odd"), ("odds", "_odds"))
    ])
    meet = ask.join(have, "spot").filter(
        "last <= reach and bit_count(odd ^ other_odd) <= 2 and bit_count(odds ^ other_odds) <= 4"
        " and word <> other and levenshtein(word, other, 1) = 1"
    )
    both = F.array(F.struct("word", "other", "other_n"), F.struct(
        F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")
    ))
    # Dealt by word once, for the pairs that met twice and for what is counted per word.
    return meet.select(F.inline(both)).repartition("word").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``forms(word, form)``: pointers double their reach until none moves."""
    step = stage(forms.select("word", F.col("form").alias("at")), "pointers")
    while True:
        ahead = step.select(F.col("word").alias("at"), F.col("at").alias("next"))
        moved = stage(step.join(ahead, "at", "left").select("word", F.coalesce("next", "at").alias("at"), F.col("next").isNotNull().alias("moved")), "pointers")
        step = moved.select("word", "at")
        if not moved.filter("moved").limit(1).count():
            return step.withColumnRenamed("at", "root")


def spelling_variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = 5, least_count: int = 3, ratio: int = 2,
    every: int = 0,
) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Words are lower-cased (A-Z only) runs of Latin letters with at least ``least_chars`` code points (4 or more, for three
    bigrams) and ``least_count`` occurrences in all texts.  A word's form is the near word with the largest count (ties:
    first in code-point order) if that is at least ``ratio`` (2 or more) times the word's own; the root follows forms to
    the last.  Null and empty texts have no words; repeated rows count as often as they stand there; a null key counts as
    an empty one; other columns are ignored; an empty table gives an empty result.  Very long texts are counted in parts.
    """
    if least_chars < 4 or ratio < 2:
        raise ValueError("words need four code points, and a form twice the count")
    words = stage(word_counts(docs, key, text, least_chars, least_count, every), "words")
    near = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("top")
    )
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), (-F.col("top.less")).alias("top_n"), F.col("top.form").alias("top_form")
    )
    strong = F.col("top_n") >= ratio * F.col("n")
    found = stage(
        found.select("word", F.when(strong, F.col("top_form")).alias("form"), "n", "n_near", F.when(strong, F.col("top_n")).alias("form_n")),
        "variants",
    )
    roots = _roots(found.filter("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
