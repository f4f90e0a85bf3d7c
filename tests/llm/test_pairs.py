"""Operators 11 and 13 against brute force on small tables with awkward rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import pytest

from scoreloom.llm.negatives import hard_negatives
from scoreloom.llm.variants import bigrams, pivots, spelling_variants

SCHEMA = "doc_id long, text string, n int, word string, k string, t string"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[i + 1:] == b[i + 1:] if len(a) == len(b) else len(a) + 1 == len(b) and a[i:] == b[i + 1:])


def variants_of(rows, every, least_chars=5, least_count=3):
    low, counts = {c: c + 32 for c in range(65, 91)}, Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_count}
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def texts():
    draw = random.Random(5)
    base = ["".join(draw.choice("abcdeé×") for _ in range(draw.randrange(4, 9))) for _ in range(120)]
    words = base + ["aaaaa", "aaaaaa", "aaaaaaa", "Straße", "STRASSE", "ÀÀÀÀÀ", "abcabc", "abcab"]
    rows = [(1, None), (2, ""), (3, "1234 ... 漢字"), (4, "Ab" * 300_000), (None, " ".join(words))]
    for i in range(300):
        picked = []
        for _ in range(draw.randrange(1, 60)):
            w = words[min(int(draw.expovariate(0.03)), len(words) - 1)]
            if draw.random() < 0.2:
                at = draw.randrange(len(w))
                w = w[:at] + draw.choice(["", "x", w[at] + "b"]) + w[at + 1:]
            picked.append(w if draw.random() < 0.9 else w.upper())
        rows.append((i + 10, draw.choice([" ", "-", "\n", "1"]).join(picked)))
    return rows + rows[50:60]


@pytest.mark.parametrize("every", [0, 7])
def test_spelling_variants(spark, no_broadcast, every):
    rows = texts()
    docs = spark.createDataFrame([(*r, 1, "w", "k", "t") for r in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in spelling_variants(docs, every=every).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    want = variants_of(rows, every)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(r[1] and r[1] != r[2] for r in want) and max(r[4] for r in want) > 3


def test_spelling_variants_of_nothing(spark):
    assert spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(spark.createDataFrame([], SCHEMA), least_chars=3)


def test_pivots_are_the_lightest_disjoint_pair():
    draw = random.Random(1)
    for _ in range(300):
        prefix = [(i, draw.randrange(1, 9)) for i in sorted(draw.sample(range(12), draw.randrange(3, 6)))]
        pairs = [(a[1] + b[1]) for i, a in enumerate(prefix) for b in prefix[i + 1:] if b[0] - a[0] >= 2]
        found = pivots(prefix)
        assert found[1][0] - found[0][0] >= 2 and found[0][1] + found[1][1] == min(pairs)
    assert bigrams("abc") == ["ab", "bc"]


def negatives_of(rows, positives=5, negatives=3):
    whole = []
    for key, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole.append((key, [math.floor(256 * x) for x in vector], label))
    out = Counter()
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for i, (key, anchor, label) in enumerate(whole):
        if key is None or key % 5:
            continue
        scored = [(sum(a * b for a, b in zip(anchor, v)), k, own) for j, (k, v, own) in enumerate(whole) if j != i]
        for score, positive, _ in sorted((s for s in scored if s[2] == label), key=order)[:positives]:
            inside = [s for s in scored if s[2] != label and 50 * score <= 100 * s[0] <= 95 * score]
            for rank, (s, k, _) in enumerate(sorted(inside, key=order)[:negatives], 1):
                out[key, positive, rank, k, score, s] += 1
    return out


VECTORS = "vec_id long, embedding array<double>, label int, id string, block int, score double"


def vectors():
    draw = random.Random(3)
    centres = [[draw.gauss(0, 0.2) for _ in range(20)] for _ in range(4)]
    rows = []
    for i in range(400):
        label = draw.choice([0, 0, 0, 1, 2, 3])
        rows.append((i, [round(c + draw.gauss(0, 0.15), 2) for c in centres[label]], label))
    rows += [rows[5], rows[5], rows[17], (1000, rows[5][1], 2), (1001, rows[5][1], 2), (None, rows[10][1], 0), (None, rows[10][1], 1)]
    rows += [(1005, None, 1), (1010, rows[1][1], None), (1015, [1.0, None], 0), (1020, [math.nan] * 20, 0), (1025, [math.inf] * 20, 1)]
    return rows + [(1030, [], 0), (1035, [0.5, -0.5], 3), (1040, [0.1] * 20, 77), (1045, [0.0] * 20, 0)]


@pytest.mark.parametrize("block_rows, chunk", [(8192, 4096), (37, 20)])
def test_hard_negatives(spark, no_broadcast, block_rows, chunk):
    rows = vectors()
    table = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], VECTORS).repartition(3)
    from pyspark.sql import functions as F

    found = hard_negatives(table, F.col("vec_id") % 5 == 0, block_rows=block_rows, chunk=chunk)
    got = Counter(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    want = negatives_of(rows)
    assert sum(want.values()) > 500 and got == want


def test_hard_negatives_of_nothing(spark):
    from pyspark.sql import functions as F

    assert hard_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") % 5 == 0).count() == 0
