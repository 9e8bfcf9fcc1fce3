"""Encoding texts with a tokenizers file, each distinct unit of text once.

A unit starts with white space that follows a character that is no white
space. Byte-level pre-tokenisers always cut there, and their patterns look
ahead over white space only, so the ids of a text are the ids of its units in
a row. The most frequent units are encoded once per worker and looked up by a
64-bit hash of their bytes together with their length.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa

from pacewell.llm import textbytes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x0A, 0x09, 0x0D]] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True


def cuts(data: np.ndarray) -> np.ndarray:
    """Marks the blanks that follow a character which is surely no white space."""
    before = np.zeros(len(data), np.uint8)
    before[1:] = data[:-1]
    second, third = np.zeros_like(before), np.zeros_like(before)
    second[2:], third[3:] = data[:-2], data[:-3]
    # Non-ASCII white space is C2 xx, or starts with E1, E2 or E3; other such characters are only not cut at.
    wide = (before >= 0x80) & (second != 0xC2) & ((third < 0xE1) | (third > 0xE3) | (second >= 0xC0))
    return _BLANK[data] & (_PLAIN[before] | wide)


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units start: at cuts and at the start of each text that is not empty."""
    cut = cuts(data)
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids of texts by one tokenizer file; keeps at most ``most`` encoded units."""

    def __init__(self, path: str, most: int = 1 << 21):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bytes_of = _id_bytes(self.tokenizer)
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.n_ids = 0

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encodes new units, many in one call: where they can be cut, their joined text has their ids in a row."""
        lengths = ends - starts
        bounds = np.zeros(len(keys) + 1, np.int64)
        np.cumsum(lengths, out=bounds[1:])
        joined = data[np.repeat(starts - bounds[:-1], lengths) + np.arange(bounds[-1])]
        apart = np.flatnonzero(~cuts(joined)[bounds[:-1]])
        apart = np.union1d(np.append(apart, len(keys)), np.arange(0, len(keys), 1000))
        raw, at = joined.tobytes(), bounds[apart].tolist()
        texts = [raw[a:b].decode() for a, b in zip(at, at[1:])]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.array([i for x in ids for i in x], np.uint32)
        reached = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(self.bytes_of[flat], out=reached[1:])
        first = np.searchsorted(reached, bounds)
        if not np.array_equal(reached[first], bounds):
            raise ValueError("the tokenizer is not a byte-level one")
        at = np.searchsorted(self.keys, keys)
        self.places = np.insert(self.places, at, (self.n_ids + first[:-1]) << 20 | np.diff(first))
        self.keys = np.insert(self.keys, at, keys)
        self.flat = np.concatenate([self.flat, flat])
        self.n_ids += len(flat)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        found = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        return at, found

    def encode(self, texts: pa.Array):
        """Yields (first row, ids, offsets of the rows' ids) for runs of rows."""
        for first, end, data, offsets in textbytes.chunks(texts):
            starts = unit_starts(data, offsets)
            if not len(starts):
                yield first, np.zeros(0, np.uint32), np.zeros(end - first + 1, np.int64)
                continue
            ends = np.append(starts[1:], len(data))
            if (ends - starts).max() >= 1 << 18:  # its ids might not fit the packed length
                yield first, *self._plainly(data, offsets)
                continue
            keys, where, which = np.unique(textbytes.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
            _, found = self._places(keys)
            if len(self.keys) + (~found).sum() > self.most:
                self._forget()
                found[:] = False
            new = where[~found]
            if len(new):
                self._learn(keys[~found], data, starts[new], ends[new])
            at, _ = self._places(keys)
            place = self.places[at][which]
            lengths, sources = place & ((1 << 20) - 1), place >> 20
            bounds = np.zeros(len(lengths) + 1, np.int64)
            np.cumsum(lengths, out=bounds[1:])
            ids = self.flat[np.repeat(sources - bounds[:-1], lengths) + np.arange(bounds[-1])]
            yield first, ids, bounds[np.searchsorted(starts, offsets)]

    def _plainly(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw, bounds = data.tobytes(), offsets.tolist()
        ids = [self.tokenizer.encode(raw[a:b].decode(), add_special_tokens=False).ids for a, b in zip(bounds, bounds[1:])]
        ends = np.cumsum([0, *map(len, ids)])
        return np.fromiter((i for x in ids for i in x), np.uint32, int(ends[-1])), ends


def _id_bytes(tokenizer) -> np.ndarray:
    """Number of bytes that each id of a byte-level vocabulary stands for: one a character, whole for added tokens."""
    added = tokenizer.get_added_tokens_decoder()
    sizes = np.zeros(max(tokenizer.get_vocab().values(), default=0) + 1, np.int64)
    for token, i in tokenizer.get_vocab().items():
        sizes[i] = len(token.encode()) if i in added else len(token)
    return sizes


@functools.cache
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)
