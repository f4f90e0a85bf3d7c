"""Operator 12 against brute force on small tables with awkward rows."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from scoreloom.llm import substrings
from scoreloom.llm.substrings import factor, per_document, substring_dedup

SCHEMA = "doc_id long, text string, h1 int, h2 string, copies int, kept_text string"


def cut(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = Counter()
    for (key, _), w in zip(rows, words):
        gone = {p for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for p in range(i, i + window)}
        out[key, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()] += 1
    return out


def texts():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(300)] + ["É", "漢字", "a\x1cb", "x\xa0y"]
    some = lambda n: [draw.choice(words) for _ in range(n)]
    passages = [some(n) for n in (34, 35, 36, 50, 80, 200, 12)]
    line = some(12)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a b " * 200), (6, "x " * 100), (7, "y " * 35), (8, "z " * 36)]
    rows += [(9, " ".join(some(34))), (10, " ".join(some(35))), (11, "\n".join(some(35)))]
    for i in range(60):
        body = some(draw.randrange(0, 60))
        for _ in range(draw.randrange(4)):
            p = list(draw.choice(passages))
            if draw.random() < 0.5:
                a = draw.randrange(len(p))
                p = p[a:] + p[: a // 2]
            if draw.random() < 0.3:
                p[draw.randrange(len(p))] = "edit"
            body += p + some(draw.randrange(0, 40))
        rows.append((100 + i, draw.choice([" ", "\n", "  "]).join(body)))
    rows += [(200 + i, " ".join(some(40) + line + some(40))) for i in range(60)]
    rows += [(300 + i, rows[20][1]) for i in range(30)] + [(301, rows[20][1]), (None, rows[25][1]), (None, "no key " * 3)]
    rows += [(400, " ".join(some(20_000) + passages[5])), (401, " ".join(passages[5][:150] + passages[4])), (402, "long" * 100_000)]
    return rows


def found(docs, window):
    got = per_document(docs, substring_dedup(docs, window=window).select("h1", "h2", "n_words", "n_removed", "kept_text"))
    return Counter(tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_text").collect())


@pytest.mark.parametrize("window", [35, 12])
def test_substring_dedup(spark, no_broadcast, window):
    rows = texts()
    docs = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA).repartition(5)
    assert found(docs, window) == cut(rows, window)


def test_hot_seeds_give_way_to_windows(spark, no_broadcast, monkeypatch):
    rows = texts()
    docs = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA).repartition(5)
    monkeypatch.setattr(substrings, "_hot_cells", lambda segments, cells, share: list(range(0, cells, 3)))
    assert found(docs, 35) == cut(rows, 35)


def test_hot_cells_are_those_far_above_the_mean(spark):
    rows = [([7] * 10 + [i * 31 % 1000 for i in range(k, k + 5)],) for k in range(0, 500, 5)]
    segments = spark.createDataFrame(rows, "fp array<long>")
    assert substrings._hot_cells(segments, 1000, 8) == [7]


def test_factors_cover_what_stands_elsewhere():
    draw = random.Random(2)
    pieces = [np.array([draw.randrange(3) for _ in range(draw.randrange(4, 30))], dtype=np.uint64) for _ in range(40)]
    seen = Counter(tuple(p[i:i + 5].tolist()) for p in pieces for i in range(len(p) - 4))
    lone = np.array([draw.random() < 0.8 for _ in pieces])
    for piece, mine, (begin, end) in zip(pieces, lone, factor(pieces, lone, 5)):
        want = {p for i in range(len(piece) - 4) if seen[tuple(piece[i:i + 5].tolist())] > 1 for p in range(i, i + 5)} if mine else set()
        assert {p for b, e in zip(begin, end) for p in range(b, e)} == want


def test_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert not found(docs, 35)
    with pytest.raises(ValueError):
        substring_dedup(docs, window=8)
