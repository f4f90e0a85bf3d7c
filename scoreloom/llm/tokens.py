"""Token ids of whole texts by a `tokenizers` file, through pieces cut where no token can cross.

A byte-level BPE file first splits text by a fixed pattern.  No part of that pattern crosses the place before a single
space that a printing character follows: words take at most one leading space, and a run of white space gives its last
space to the word behind it.  So text may be cut there, each piece encoded alone and the ids joined.

Text of characters whose class is the same in every edition of Unicode goes to a second library that merges the same
vocabulary several times faster (``TextEncoder`` says when the two must agree); all other text goes to the first, piece by
piece, of which each worker remembers a bounded number.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import cached_property

#: Characters that no definition of white space contains; a space before any other character is not a safe cut.
_SURE = r"!-~¡-ᙿ⼀-⿿぀-퟿豈-﷿"
_PLAIN = re.compile(rf"[^\n {_SURE}]| [\n ]|\A | \Z")
_CUT = re.compile(rf" (?=[{_SURE}])")
#: Further places to cut a piece without spaces: before a line break, between ASCII letters and digits, and between
#: ideographs and ideographic stops.
_INNER = re.compile(r"(?<=[!-~])(?=\n)|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[一-龥])(?=[、。！，？])")

#: A word of letters, then ASCII marks other than the apostrophe: the file's pattern cuts it between the two, always.
_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_level() -> dict[int, str]:
    """How byte-level files spell bytes: printing Latin-1 characters stand for themselves, the others follow U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


_SPELL = _byte_level()


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    ``remember`` bounds the cache (pieces of up to 64 characters); ``long_piece`` is the number of characters from
    which a piece without safe spaces is cut further.
    """

    def __init__(self, path: str, remember: int = 20_000, long_piece: int = 4096):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.direct = type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel" and self.tokenizer.normalizer is None
        if not self.direct or self.tokenizer.pre_tokenizer.add_prefix_space:
            raise ValueError("only byte-level files without normaliser and prefix space can be cut safely")
        self.remember, self.long_piece = remember, long_piece
        self.pieces: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    def _unit(self, unit: str) -> bytes:
        found = self.units.get(unit)
        if found is None:
            found = array("I", [t.id for t in self.tokenizer.model.tokenize(unit)]).tobytes()
            if len(unit) <= 64:
                if len(self.units) >= self.remember:
                    self.units.clear()
                self.units[unit] = found
        return found

    def _encode(self, piece: str) -> bytes:
        if piece[:1] == " " and (m := _WORD.fullmatch(piece, 1)) and len(piece) < 1000:
            word, marks = m.groups()
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(_SPELL)
            if not marks:
                return self._unit("Ġ" + spelled)
            if not any(s in piece for s in self.added):
                return self._unit("Ġ" + spelled) + self._unit(marks)
        if any(s in piece for s in self.added):
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            return array("I", ids).tobytes()
        if len(piece) > self.long_piece:
            cuts = [0]
            for m in _INNER.finditer(piece):
                if m.start() - cuts[-1] >= self.long_piece:
                    cuts.append(m.start())
            parts = [piece[a:b] for a, b in zip(cuts, [*cuts[1:], len(piece)])]
        else:
            parts = [piece]
        return b"".join(
            self._unit(unit) for part in parts for unit, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)
        )

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; new pieces of the whole batch are encoded once, together."""
        split = [t.split(" ") if not _PLAIN.search(t) else _CUT.split(t) for t in texts]
        new = set().union(*(words[1:] for words in split)) if split else set()
        new = [w for w in new if w not in self.pieces]
        if len(self.pieces) + len(new) > self.remember:
            self.pieces.clear()
            new = set().union(*(words[1:] for words in split))
        rare: dict[str, bytes] = {}
        for w in new:
            (self.pieces if len(w) <= 64 else rare)[w] = self._encode(" " + w)
        out = []
        for words in split:
            known = self.pieces.__getitem__
            try:
                tail = b"".join(map(known, words[1:]))
            except KeyError:
                tail = b"".join(self.pieces.get(w) or rare[w] for w in words[1:])
            out.append((self._encode(words[0]) if words[0] else b"") + tail)
        return out


# Fixed value: the pattern by which byte-level files cut text.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that have been letters, digits, marks or white space alike since long ago.
_STABLE = "\t\n\r -~¡-ɏЀ-ҁ、。ぁ-ゖァ-ヺ一-龥가-힣！，？"
_OTHER = re.compile(f"[^{_STABLE}]")
_STABLE_BYTES = bytes([0x09, 0x0A, 0x0D, *range(0x20, 0x7F), *range(0xA1, 0x100)])


def _is_stable(text: str) -> bool:
    try:
        return not text.encode("latin-1").translate(None, _STABLE_BYTES)
    except UnicodeEncodeError:
        return not _OTHER.search(text)


def _by_rank(said: dict):
    """A file's vocabulary for merging by rank, or None where that need not give the same ids.

    A file merges pairs in the order of its list, a ranked vocabulary the pair whose joint token has the lowest number.
    Both are the same order if every merge's token has a higher number than that of the merge before.
    """
    import tiktoken

    model = said["model"]
    plain = model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges") and not model.get("byte_fallback")
    cut = said["pre_tokenizer"] or {}
    if not plain or said["normalizer"] or cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or cut.get("add_prefix_space"):
        return None
    vocabulary = model["vocab"]
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        return None
    added = {t["id"] for t in said["added_tokens"]}
    spelt = {c: b for b, c in _SPELL.items()}
    ranks = {bytes(spelt[c] for c in token): i for token, i in vocabulary.items() if i not in added}
    return tiktoken.Encoding("ranked", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


class TextEncoder:
    """Ids of whole texts as the file's own library gives them.

    ``part`` is the number of characters from which a text is cut at safe places, where it has any.
    """

    def __init__(self, path: str, part: int = 1 << 20):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        self.path, self.part = path, part
        self.added = [t["content"] for t in said["added_tokens"]]
        self.ranked = _by_rank(said)

    @cached_property
    def pieces(self) -> PieceEncoder:
        """The file's own library, opened when a text needs it."""
        return PieceEncoder(self.path)

    def _parts(self, text: str) -> list[str]:
        cuts = [0]
        while len(text) - cuts[-1] > self.part and (m := _CUT.search(text, cuts[-1] + self.part)):
            cuts.append(m.start())
        return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]

    def _agree(self, text: str) -> bool:
        return self.ranked is not None and _is_stable(text) and not any(s in text for s in self.added)

    def count_batch(self, texts: list[str]) -> list[int]:
        """Number of ids of each text."""
        return [
            sum(len(self.ranked.encode_ordinary(p)) for p in self._parts(t)) if self._agree(t)
            else len(self.pieces.encode_batch([t])[0]) // 4
            for t in texts
        ]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        return [
            b"".join(array("I", self.ranked.encode_ordinary(p)).tobytes() for p in self._parts(t)) if self._agree(t)
            else self.pieces.encode_batch([t])[0]
            for t in texts
        ]


_OPEN: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder per worker and file."""
    if path not in _OPEN:
        _OPEN[path] = TextEncoder(path)
    return _OPEN[path]
