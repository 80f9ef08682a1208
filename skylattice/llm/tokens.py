"""Token ids of whole texts by a public tokenizer, each distinct unit encoded once.

Both vocabularies split text by a pattern before any merge, so ids depend only
on short units.  ``space`` units (word_bpe) are runs of one kind of characters
(letters, digits, others) without white space, lower-cased; ``lead`` units
(byte_bpe) are such runs with the white space before them.  Units are dictionary-encoded per batch and looked up in a bounded
cache, so the tokenizer sees only units that it has not seen lately.  A text
with rarer white space, or with the marker of a special token, is one unit: the
tokenizer then gets it whole.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from .text import LOWER, WHITESPACE, _strings, raw, ragged

#: Kept units; beyond it the cache starts anew. Bounds a worker's memory.
CACHE_UNITS = 300_000
#: Longer units are encoded each time.
CACHE_BYTES = 48
#: Units in one call, with a separator that the vocabularies keep apart from what is around it.
JOINED = 64
SEPARATOR = " \x01"

_open: dict[tuple[str, str], "UnitEncoder"] = {}


def vocabulary_path(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, units: str) -> "UnitEncoder":
    """This worker's encoder."""
    if (path, units) not in _open:
        _open[path, units] = UnitEncoder(path, units)
    return _open[path, units]


class UnitEncoder:
    def __init__(self, path: str, units: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.units = units
        self.glue = SEPARATOR if units == "lead" else f"{SEPARATOR} "
        self.mark = self.tokenizer.encode(SEPARATOR if units == "lead" else SEPARATOR.strip(" "), add_special_tokens=False).ids
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.n = self.used = 0
        self.start, self.length, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32)

    def _add(self, units: list[str]) -> None:
        """Encodes units and appends their ids to the store."""
        lengths = np.zeros(len(units), np.int64)
        parts: list[np.ndarray] = []
        forms = [self._model_form(u) for u in units]
        plain = [k for k, f in enumerate(forms) if f is not None]
        rest = [k for k, f in enumerate(forms) if f is None]
        tokenize = self.tokenizer.model.tokenize
        found = [[t.id for t in tokenize(forms[k])] for k in plain]
        lengths[plain] = list(map(len, found))
        parts.append(np.fromiter(chain.from_iterable(found), np.uint32))
        joined = {k: self._joinable(units[k]) for k in rest}
        order = [k for k in rest if joined[k]] + [k for k in rest if not joined[k]]
        n = sum(joined.values())
        calls = [order[k : min(k + JOINED, n)] for k in range(0, n, JOINED)]
        sep = len(self.mark) - 1
        for group, e in zip(calls, self._encode([self.glue.join(units[k] for k in g) for g in calls])):
            ids = np.asarray(e.ids, np.uint32)
            ends = np.append(np.flatnonzero(ids == self.mark[-1]) - sep, len(ids))
            starts = np.concatenate(([0], ends[:-1] + sep + 1))
            lengths[group] = ends - starts
            keep = np.ones(len(ids), bool)
            for k in range(sep + 1):
                keep[ends[:-1] + k] = False
            parts.append(ids[keep])
        for k, e in zip(order[n:], self._encode([units[k] for k in order[n:]])):
            lengths[k] = len(e.ids)
            parts.append(np.asarray(e.ids, np.uint32))
        new = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        starts = np.zeros(len(units), np.int64)
        order = plain + order
        starts[order] = self.used + np.cumsum(lengths[order]) - lengths[order]
        while self.n + len(units) > len(self.start):
            self.start, self.length = np.concatenate([self.start, np.zeros_like(self.start)]), np.concatenate([self.length, np.zeros_like(self.length)])
        while self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.start[self.n : self.n + len(units)] = starts
        self.length[self.n : self.n + len(units)] = lengths
        self.flat[self.used : self.used + len(new)] = new
        self.n, self.used = self.n + len(units), self.used + len(new)

    def _encode(self, texts: list[str]) -> list:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return encode(texts, add_special_tokens=False) if texts else []

    def _joinable(self, unit: str) -> bool:
        """Can it stand between separators in one call, with the ids that it has alone?"""
        if "\x01" in unit or "<|" in unit or len(unit) > CACHE_BYTES:
            return False
        return self.units == "space" or (unit[0] in " \t\n\r\v\f" and not unit.isspace())

    def _model_form(self, unit: str) -> str | None:
        """What the model gets for a unit of Latin letters, which the pattern never cuts; else None."""
        if self.units == "space":
            letters = unit.lower()
            lead = ""
        else:
            lead = "\u0120" if unit[0] == " " else ""
            letters = unit[1:] if lead else unit
        if letters.isascii():
            return lead + letters if letters.isalpha() and len(letters) <= CACHE_BYTES else None
        if not letters.isalpha() or max(letters) >= "\u0250" or len(letters) > CACHE_BYTES:
            return None
        return lead + letters.encode().decode("latin-1").translate(BYTE_LEVEL)

    def rows(self, units: pa.Array) -> np.ndarray:
        """The store's row of each unit."""
        if self.n > CACHE_UNITS:
            self._clear()
        names = units.to_pylist()
        get = self.known.get
        rows = np.fromiter((get(u, -1) for u in names), np.int64, len(names))
        missing = np.flatnonzero(rows < 0)
        for at in range(0, len(missing), 50_000):
            part = missing[at : at + 50_000]
            texts = [names[i] for i in part.tolist()]
            rows[part] = np.arange(self.n, self.n + len(part))
            for k, u in enumerate(texts, self.n):
                if len(u) <= CACHE_BYTES:
                    self.known[u] = k
            self._add(texts)
        return rows

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by an end id 0; where each text's ids start, one more at the end)."""
        units, first = cut(texts, self.units)
        if len(units):
            d = units.dictionary_encode()
            row = self.rows(d.dictionary)[d.indices.to_numpy(zero_copy_only=False)]
            lengths = self.length[row]
            out = self.flat[ragged(self.start[row], lengths)]
        else:
            lengths, out = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        before = np.concatenate(([0], np.cumsum(lengths)))[first]
        n = len(first) - 1
        return np.insert(out, before[1:], 0), before + np.arange(n + 1)


def _whole(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each text: does it have white space besides ASCII's, or a special token's marker?"""
    odd = (data >= 0x1C) & (data <= 0x1F)
    if len(data) > 1:
        a, b = data[:-1], data[1:]
        odd[:-1] |= (a == 0x3C) & (b == 0x7C)
        odd[:-1] |= (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        odd[:-1] |= (a == 0xE1) & ((b == 0x9A) | (b == 0xA0)) | (a == 0xE3) & (b == 0x80) | (a == 0xE2) & (b == 0x81)
    if len(data) > 2:
        c = data[2:]
        odd[:-2] |= (data[:-2] == 0xE2) & (data[1:-1] == 0x80) & ((c <= 0x8F) | (c >= 0xA8) & (c <= 0xAF))
    at = np.flatnonzero(odd)
    return np.diff(np.searchsorted(at, offsets)) > 0


def cut(texts: pa.Array, units: str) -> tuple[pa.Array, np.ndarray]:
    """(units of all texts in order, index of each text's first unit, one more at the end)."""
    data, offsets = raw(texts)
    if not len(data):
        return pa.array([], pa.large_string()), np.zeros(len(offsets), np.int64)
    kind = KIND[data]
    starts = np.zeros(len(data), bool)
    a, b = kind[:-1], kind[1:]
    ascii_change = CHANGE[a * 5 + b]
    ascii_change &= ~((data[:-1] == 0x27) & (b == LETTER))
    starts[1:] = ascii_change
    if units == "lead":
        space = kind == SPACE
        starts[1:] |= space[1:] & ~space[:-1]
        lone = space & (data != 0x20)  # a single control character never joins what follows
        lone[1:] &= ~space[:-1]
        starts[1:] |= lone[:-1] & ~space[1:]
        keep = None
    else:
        keep = kind != SPACE
        starts[1:] |= (a == SPACE) & keep[1:]
        starts[0] = keep[0]
        data = LOWER[data]
    begin = offsets[:-1][np.diff(offsets) > 0]
    starts[begin] = True if keep is None else keep[begin]
    whole = _whole(data, offsets)
    if whole.any():
        plain = raw(texts)[0]
        data = data.copy()
        for i in np.flatnonzero(whole):
            lo, hi = offsets[i], offsets[i + 1]
            starts[lo:hi] = False
            starts[lo] = True
            data[lo:hi] = plain[lo:hi]
            if keep is not None:
                keep[lo:hi] = True
    at = np.flatnonzero(starts)
    first = np.searchsorted(at, offsets)
    if keep is None:
        return _strings(data, np.append(at, len(data))), first
    kept = np.concatenate(([0], np.cumsum(keep)))
    return _strings(data[keep], np.append(kept[at], kept[-1])), first


SPACE, LETTER, DIGIT, OTHER, HIGH = range(5)
KIND = np.full(256, OTHER, np.uint8)
KIND[WHITESPACE] = SPACE
KIND[48:58] = DIGIT
KIND[65:91] = KIND[97:123] = LETTER
KIND[128:] = HIGH
#: Between two ASCII characters of different kinds, the patterns always cut (but after an apostrophe).
CHANGE = np.zeros(25, bool)
for _a in (LETTER, DIGIT, OTHER):
    for _b in (LETTER, DIGIT, OTHER):
        CHANGE[_a * 5 + _b] = _a != _b
#: The public byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LEVEL = {b: b for b in _PRINTABLE} | {b: 256 + k for k, b in enumerate(x for x in range(256) if x not in set(_PRINTABLE))}
