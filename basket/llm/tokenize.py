"""Exact tokenization with the ``tokenizers`` library, remembering pieces between white space.

A tokenizer's pre-tokenizer never joins text across a white-space boundary, nor across the step from a
letter to ASCII punctuation, so a text's ids are the ids of its pieces in order.  Running prose repeats its
words: a slice of texts is cut with numpy, its pieces are numbered by Arrow's dictionary encoding, and only
pieces not met before go to the library.  ``pieces`` says how white space behaves:

* ``"dropped"``: white space only separates (lower-casing word tokenizers);
* ``"leading"``: white space belongs to the piece that follows (byte-level BPE);
* ``"whole"``: no assumption, every text is encoded in one call.

A text with white space outside ASCII, with one of U+001C..U+001F, or with ``<|``, where a special
token may begin, is always encoded in one call.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from basket.llm.common import keep_between_tasks, utf8

_ODD = "[\x1c-\x1f\x85\xa0  -     　]|<\\|"
#: Pieces that are one word to the tokenizers: Latin-1 letters, after at most one space.
_WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Stands in no piece: a text that has it is encoded in one call.
_APART = "\x1c"
# Byte-level models write these bytes, in order, as the characters from U+0100 on, all others as Latin-1.
_MOVED = [*range(0, 0x21), *range(0x7F, 0xA1), 0xAD]
_SPELLED = np.arange(256, dtype="<u4")
_SPELLED[_MOVED] = 256 + np.arange(len(_MOVED))


def _runs(data: np.ndarray):
    """Whether each byte is white space, an ASCII letter, and ASCII punctuation but for the apostrophe of contractions."""
    space = (data == 32) | (data - np.uint8(9) < 5)
    letter = (data | np.uint8(32)) - np.uint8(97) < 26
    sign = (data - np.uint8(33) < 94) & (data - np.uint8(48) >= 10) & (data != 39) & ~letter
    return space, letter, sign


class _Numbers(dict):
    """Numbers pieces in the order of their first look-up and notes the new ones."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.new.append(piece)
        return n


class Encoder:
    """Ids of texts as arrays of ``dtype``.

    At ``limit`` remembered pieces the memory starts anew.  New one-word pieces go to the library's model in its
    byte-level spelling; all others through the whole tokenizer.
    """

    def __init__(self, path: str, pieces: str, dtype: str = "<u4", limit: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces, self.limit, self.dtype = pieces, limit, np.dtype(dtype)
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers()
        self.start, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.store, self.used = np.zeros(4096, self.dtype), 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        """``_encode`` for one-word pieces."""
        if not words:
            return []
        text = "\n".join(words)
        if self.pieces == "dropped":
            text = text.lower()
        spelled = _SPELLED[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le").split(chr(_SPELLED[10]))
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(w)] for w in spelled]

    def _learn(self) -> None:
        """Keep the ids of the pieces that have just got their numbers."""
        new, self.known.new = self.known.new, []
        n, first = len(new), len(self.known) - len(new)
        is_word = list(map(_WORD.fullmatch, new))
        words = [p for p, m in zip(new, is_word, strict=True) if m]
        found, rest = iter(self._encode_words(words)), iter(self._encode([p for p, m in zip(new, is_word, strict=True) if not m]))
        ids = [next(found) if m else next(rest) for m in is_word]
        sizes = np.fromiter(map(len, ids), np.int32, n)
        flat = np.array(list(chain.from_iterable(ids)), self.dtype)
        while len(self.start) < first + n:
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while len(self.store) < self.used + len(flat):
            self.store = np.resize(self.store, 2 * len(self.store))
        self.length[first : first + n] = sizes
        self.start[first : first + n] = self.used + np.cumsum(sizes) - sizes
        self.store[self.used : self.used + len(flat)] = flat
        self.used += len(flat)

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The pieces as one string array, and the number of the first piece of each text (and the end)."""
        space, letter, sign = _runs(data)
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        begins = begins[:-1]
        tail = sign[1:] & letter[:-1]
        # Latin-1 letters from U+00C0 on: 0xC3 and a second byte, but for the signs × and ÷.
        second = (data >= 0x80) & (data < 0xC0) & (data != 0x97) & (data != 0xB7)
        tail[1:] |= sign[2:] & second[1:-1] & (data[:-2] == 0xC3)
        if self.pieces == "dropped":
            inside = ~space
            begins[1:] |= space[:-1] | tail
            begins &= inside
            data, kept = data + 32 * (data - np.uint8(65) < 26), begins
            data, kept = data[inside].astype(np.uint8, copy=False), kept[inside]
        else:
            begins[1:] |= (~space[:-1] & space[1:]) | tail
            # A line break or tab alone between words is a piece of its own.
            begins[2:] |= ~space[2:] & space[1:-1] & ~space[:-2] & (data[1:-1] != 32)
            kept = begins
        ends = np.append(np.flatnonzero(kept), len(data)).astype(np.int32)
        texts = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data)))
        return texts, np.searchsorted(np.flatnonzero(begins), offsets)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after the other, and the n + 1 offsets; a null text has none.

        A column of at most 2 GB.
        """
        column = pc.fill_null(column.cast(pa.string()), "")
        if self.pieces == "whole":
            return self._joined(self._encode(column.to_pylist()))
        odd = pc.match_substring_regex(column, _ODD)
        plain = pc.if_else(odd, "", column) if (any_odd := pc.any(odd).as_py()) else column
        ids, offsets = self._encode_plain(*utf8(plain))
        if any_odd:
            at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
            parts = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            for i, found in zip(at, self._encode(column.take(pa.array(at)).to_pylist()), strict=True):
                parts[i] = np.array(found, self.dtype)
            ids, offsets = np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return ids, offsets

    def _joined(self, found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for own in found for i in own), self.dtype, int(sizes.sum()))
        return ids, np.concatenate(([0], np.cumsum(sizes)))

    def _encode_plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(data) < 3:
            return self._joined(self._encode([data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:], strict=False)]))
        texts, first = self._cut(data, offsets)
        numbered = texts.dictionary_encode()
        distinct = pa.ListArray.from_arrays(pa.array([0, len(numbered.dictionary)], pa.int32()), numbered.dictionary)
        distinct = pc.binary_join(distinct, _APART)[0].as_py().split(_APART) if len(numbered.dictionary) else []
        if len(self.known) > self.limit:
            self._forget()
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        if self.known.new:
            self._learn()
        row = number[numbered.indices.to_numpy()]
        sizes = self.length[row]
        ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        places = np.repeat(self.start[row] - ends[:-1], sizes)
        places += np.arange(len(places))
        return self.store[places], ends[first]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` and ``offsets`` with ``end_id`` after each text's ids."""
    return np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))


_encoders: dict[tuple, Encoder] = {}
KEEPS = "encoders"
keep_between_tasks(KEEPS, _encoders.clear)


def encoder(path: str, pieces: str, dtype: str = "<u4", limit: int = 600_000) -> Encoder:
    """One encoder per Python worker and tokenizer file; about 250 bytes for each remembered piece."""
    key = (path, pieces, dtype, limit)
    if key not in _encoders:
        _encoders[key] = Encoder(path, pieces, dtype, limit)
    return _encoders[key]
