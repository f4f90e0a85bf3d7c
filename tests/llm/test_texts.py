"""Corpus operators against plain Python on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scoreloom.llm.decontaminate import decontaminate, drop_contaminated
from scoreloom.llm.exact_dedup import ContentTable, drop_exact_copies, exact_dedup
from scoreloom.llm.licences import licence_scan, whole_texts
from scoreloom.llm.near_dedup import near_duplicates, scheme
from scoreloom.llm.packing import best_fit_packing, plan_slots
from scoreloom.llm.token_counts import token_counts
from scoreloom.llm.tokens import PieceEncoder, TextEncoder

FILE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, n_tokens string, kept int, component_id int, rid string, h string, row string"


def awkward() -> list[tuple[int | None, str | None]]:
    draw = random.Random(7)
    words = [f"w{i}" for i in range(400)] + ["Éa", "ß9", "漢字"]
    base = [draw.choice(words) for _ in range(120)]
    rows: list[tuple[int | None, str | None]] = [(1, None), (2, ""), (3, "   "), (4, "one"), (5, "ONE"), (6, "a\tb\r\nc"), (7, "a b c")]
    rows += [(10 + i, " ".join(base)) for i in range(40)]
    for i in range(60):
        other = list(base)
        for _ in range(draw.randrange(6)):
            other[draw.randrange(len(other))] = draw.choice(words)
        rows.append((100 + i, (" " if i % 2 else "\n").join(other)))
    rows += [(300 + i, " ".join(draw.choice(words) for _ in range(draw.randrange(1, 60)))) for i in range(60)]
    rows += [(400, "x" * 200_000), (401, "long " * 40_000), (402, " ".join(draw.choice(words) for _ in range(30_000)))]
    rows += [(500, "same row"), (500, "same row"), (501, "<|endoftext|> a<|endoftext|>b"), (None, "no id"), (None, " ".join(base))]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", 1, 2, "y", "z", "r") for r in awkward()], SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def tokens(text: str | None) -> list[int]:
    return Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids


def test_pieces_join_to_the_library_s_ids():
    draw, encode, whole = random.Random(3), PieceEncoder(FILE, long_piece=40, remember=50), Tokenizer.from_file(FILE)
    parts = ["a", "B", " ", "  ", "\n", " \n", "\t", "é", "1", "23", "'s", "<|endoftext|>", "<|", "|>", ",", "漢字", "。", "　",
             "\x85", "\x1c", "᠎", "​", "\xa0", " ", "😀", " the", "don't", "\r\n", "٣", "Ⅷ", " wordé", " Straße.%%"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(60))) for _ in range(2000)]
    for text, ids in zip(texts, encode.encode_batch(texts)):
        assert np.frombuffer(ids, dtype="<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_text_encoder_agrees_with_the_library():
    draw, whole, encode = random.Random(8), Tokenizer.from_file(FILE), TextEncoder(FILE, part=50)
    parts = ["a", "The", " ", "  ", "\n", "\r\n", "\t", "é", "Ünï", "1", "23", "'s", "'", "<|endoftext|>", "<|", ",", "漢字", "。", "ひらがな", "\x85", "\xa0",
             "\xad", "😀", " the", "don't", "Привет", "한국", " \n ", "...", "x" * 70, "ſ", "ǅ", "²", "½", "ª", "٣"]
    known = [p for p in parts if p not in ("<|endoftext|>", "\x85", "\xa0", "😀", "٣")]
    texts = ["", "x" * 5000, "ab1" * 900, "<|endoftext|>"]
    texts += ["".join(draw.choice(known if i % 2 else parts) for _ in range(draw.randrange(90))) for i in range(4000)]
    ids = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, dtype="<u4").tolist() for b in encode.encode_batch(texts)] == ids
    assert encode.count_batch(texts) == [len(i) for i in ids]
    assert 0.2 < sum(map(encode._agree, texts)) / len(texts) < 0.9


def test_token_counts(docs, nothing):
    got = token_counts(docs, FILE, batch_bytes=1000).collect()
    want = Counter((i, len((t or "").encode()), len(tokens(t)), len(tokens(t)) > 512) for i, t in awkward())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert token_counts(nothing, FILE).count() == 0


def best_fit(lengths: list[int], size: int) -> int:
    rooms: list[int] = []
    opened = 0
    for length in sorted(lengths, reverse=True):
        i = bisect_left(rooms, length)
        if i == len(rooms):
            opened += 1
            insort(rooms, size - length)
        else:
            insort(rooms, rooms.pop(i) - length)
    return opened


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit(seed):
    draw = random.Random(seed)
    size = draw.choice([8, 33, 100])
    lengths = [draw.randint(1, size) for _ in range(draw.randrange(1, 400))]
    plan = plan_slots(Counter(lengths), size)
    filled: dict[int, list[tuple[int, int]]] = defaultdict(list)
    ranks = Counter()
    for length, rank, count, first, per, offset in plan:
        assert ranks[length] == rank
        ranks[length] += count
        for k in range(count):
            filled[first + k // per].append((offset + k % per * length, length))
    assert ranks == Counter(lengths)
    for slots in filled.values():
        end = 0
        for start, length in sorted(slots):
            assert start == end
            end += length
        assert end <= size
    assert len(filled) == best_fit(lengths, size)


def test_packing(docs, nothing):
    got = best_fit_packing(docs, FILE, size=1024).collect()
    want, lengths = Counter(), []
    for i, text in awkward():
        ids, start, piece = [*tokens(text), 2], 0, 0
        while start < len(ids):
            length = (len(ids) - start) % 1024 or 1024
            want[i, piece, start, length, zlib.crc32(np.array(ids[start:start + length], dtype="<u4").tobytes())] += 1
            lengths.append(length)
            start, piece = start + length, piece + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for slots in places.values():
        assert [o for o, _ in sorted(slots)] == [sum(x for _, x in sorted(slots)[:k]) for k in range(len(slots))]
        assert sum(x for _, x in slots) <= 1024
    assert len(places) == best_fit(lengths, 1024)
    assert best_fit_packing(nothing, FILE).count() == 0


@pytest.mark.parametrize("table_bytes", [64 << 20, 2000])
def test_exact_dedup(docs, nothing, table_bytes):
    groups = defaultdict(list)
    for i, text in awkward():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    want = Counter()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for n, i in enumerate(sorted(ids, key=lambda i: (i is None, i))):
            want[i, keep, len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()] += 1
    got = exact_dedup(docs, table_bytes=table_bytes)
    assert Counter(tuple(r) for r in got.collect()) == want
    left = drop_exact_copies(docs, table_bytes=table_bytes)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert exact_dedup(nothing).count() == 0


def test_content_table_tells_equal_hashes_apart():
    table = ContentTable()
    for k in range(5000):
        content = str(k).encode()
        entry, at = table.find(7, content) if k < 50 else table.find(k, content)
        assert entry < 0
        table.add(7 if k < 50 else k, content, at)
    assert all(table.find(7, str(k).encode())[0] == k for k in range(50))
    assert table.find(7, b"other")[0] < 0


def shingles(text: str | None) -> frozenset:
    lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    words = (text or "").encode().translate(lower).split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


@pytest.mark.parametrize(("percent", "block"), [(85, 256), (85, 7), (80, 7)])
def test_near_duplicates(docs, nothing, percent, block):
    rows = [(i, shingles(t)) for i, t in awkward()]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(rows):
        for b, (j, o) in enumerate(rows[:a]):
            # A row without an id joins its text's class only if that has a named member, as every class here does.
            if s and o and (s == o or None not in (i, j)) and 100 * len(s & o) >= percent * len(s | o):
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[root(a)] = min(i, least.get(root(a), i))
    want = Counter()
    for a, (i, s) in enumerate(rows):
        component = least.get(root(a))
        want[i, len(s), component, component is not None and i == component] += 1
    got = near_duplicates(docs, percent=percent, block_docs=block)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert near_duplicates(nothing).count() == 0


def test_band_schemes_lose_next_to_nothing():
    for percent in (50, 70, 80, 85, 90, 95):
        bands, rows = scheme(percent)
        assert bands * rows <= 512 and (1 - (percent / 100) ** rows) ** bands < 1e-7


def test_levels_do_not_grow_with_the_input(spark, docs, monkeypatch):
    """A table of a three-hundredth of the input, about ten texts, resolves it in three levels at most, one of a fiftieth in two."""
    from scoreloom.llm import exact_dedup as module

    labels, whole = [], module.stage
    monkeypatch.setattr(module, "stage", lambda df, label: labels.append(label) or whole(df, label))
    draw = random.Random(9)
    rows = [(i, " ".join(draw.choice("abcdefgh") * 9 for _ in range(40))) for i in range(3000)] + [(9000 + i, "copy " * 80) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for part, most in ((300, 3), (50, 2)):
        labels.clear()
        got = exact_dedup(table, table_bytes=sum(len(t) for _, t in rows) // part).collect()
        assert len(got) == len(rows) and {r.group_size for r in got} >= {200} and sum(r.kept for r in got) == len({t.strip() for _, t in rows})
        assert sum(x.startswith("exact-level") for x in labels) <= most


def test_a_seed_is_what_winnowing_selects():
    from scoreloom.llm.common import grams
    from scoreloom.llm.decontaminate import _is_selected, _selected

    draw = np.random.RandomState(4)
    for n in (3, 9, 10, 11, 14, 40, 200):
        for words in (3, 50):
            hashes = draw.randint(0, words, n).astype(np.uint64)
            for size, k in ((10, 5), (7, 5), (3, 3), (1, 1)):
                each = grams(hashes, k)
                places, fps = _selected(hashes, size, k)
                found = [p for p in range(len(each)) if n >= size and _is_selected(each, p, size - k)]
                assert found == places.tolist() and (each[places] == fps).all()


def test_filter_follows_the_number_of_items(spark):
    from scoreloom.llm import decontaminate as module

    sizes = []
    for n in (50, 5000):
        items = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(n)], "item_id int, text string")
        seeds = module._item_seeds(items, "item_id", "text", 10, 5)
        filled, bits = module._bitmap(seeds, None)
        share = int(np.bitwise_count(filled).sum()) / (1 << bits)
        assert share < 0.13
        sizes.append(bits)
    assert sizes[1] > sizes[0] + 4


def test_contamination(spark, docs, nothing):
    texts = dict(awkward())
    cut = texts[402].split()
    items = [(1, " ".join(cut[50:75])), (2, " ".join(cut[60:70]).upper()), (10, "ONE"), (11, None), (12, ""), (None, "no id"),
             (13, "same row"), (14, "never seen words here " * 5), (3, " ".join(cut[100:140])), (3, " ".join(cut[100:140]))]
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id int, text string, fp string")
    find, windows = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), defaultdict(set)
    low = {c: c + 32 for c in range(65, 91)}
    for item, text in items:
        words = find.findall((text or "").translate(low))
        for k in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[k:k + 10])].add(item)
    want, clean = Counter(), 0
    for i, text in awkward():
        words = find.findall((text or "").translate(low))
        hit, named = set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if found := windows.get(tuple(words[k:k + size])):
                    hit.update(range(k, k + size))
                    named |= found - {None}
        ids = ",".join(sorted(map(str, named)))
        want[i, len(words), len(hit), len(named), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)] += 1
        clean += not hit
    assert Counter(tuple(r) for r in decontaminate(docs, bench).collect()) == want
    assert Counter(tuple(r) for r in decontaminate(docs, bench, filter_bits=6).collect()) == want  # a full filter loses nothing
    left = drop_contaminated(docs, bench)
    assert left.columns == docs.columns and left.count() == clean
    assert decontaminate(nothing, bench).count() == 0
    assert not decontaminate(docs, bench.limit(0)).filter("contaminated").count()


def test_licences(spark, nothing):
    rows = [(1, None), (2, ""), (3, "word"), (4, "Intro\nReleased under the MIT Licence.\nreleased under  the mit license\nEnd"),
            (5, "This work is licensed under the GNU General Public License, version 2."), (6, "Licensed under CC BY 4.0."),
            (7, "This Source Code Form is subject to\nthe terms of the Mozilla Public License, v. 2.0."),
            (8, "licensed under the moon " * 5000), (6, "Licensed under CC BY 4.0.")]
    got = {tuple(r) for r in licence_scan(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, licence string")).collect()}
    assert got == {(4, "MIT", 1.0, 1), (5, "GPL-2.0", 1.0, 1), (6, "CC-BY-4.0", 1.0, 2), (7, "MPL-2.0", 1.0, 1)}
    assert licence_scan(nothing).count() == 0


def test_wrapped_licences(spark):
    gpl = ("/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General "
           "Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) "
           "any later version.\n */\n")
    filler = " ".join(f"int v{i} = f{i}(x{i});" for i in range(400))
    rows = [(1, filler + "\n" + gpl + filler), (2, f"{filler} This work is licensed under the GNU General Public License, version 2. {filler}"),
            (3, filler), (4, gpl + filler + gpl.replace("either", "any"))]
    got = {tuple(r) for r in licence_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "GPL-3.0", 1.0, 1), (2, "GPL-2.0", 1.0, 1), (4, "GPL-3.0", 1.0, 1)}


def test_whole_licence_texts(spark):
    whole = dict(whole_texts())
    filler = " ".join(f"int v{i} = f{i}(x{i});" for i in range(200))
    rows = [(n, filler + "\n" + whole[name] + filler) for n, name in enumerate(("MIT", "Apache-2.0", "GPL-3.0"))]
    rows.append((3, whole["MIT"].replace("\n", "\n# ")))
    got = {(r.doc_id, r.licence) for r in licence_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(0, "MIT"), (1, "Apache-2.0"), (2, "GPL-3.0"), (3, "MIT")}


def test_small_sets_need_no_estimate():
    import numpy as np
    import pyarrow as pa

    from scoreloom.llm.near_dedup import _confirm

    sets = [np.arange(10, dtype=np.uint64), np.arange(1, 10, dtype=np.uint64), np.arange(100, 110, dtype=np.uint64)]
    sig = np.zeros(16, dtype=np.uint64)
    unit = pa.table({"id": pa.array([1, 2, 3], pa.int64()), "block": pa.array([0, 0, 0], pa.int32()), "shingles": [s.tobytes() for s in sets],
                     "sig": [sig.tobytes(), (~sig).tobytes(), sig.tobytes()]})
    assert _confirm(80, 0.1)(unit).to_pylist() == [{"a": 1, "b": 2}]
