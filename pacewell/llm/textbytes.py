"""Whole batches of texts as one array of bytes: words, code points and hashes without a loop over words.

Arrow keeps a batch of strings as one buffer of UTF-8 bytes and the offsets of
the texts. These helpers work on such buffers, a bounded number of bytes at a
time, so that memory follows the chunk and not the batch. One text longer than
a chunk makes a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of each run of bytes that are no ASCII white space, within texts."""
    word = ~SPACE[data]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    inner = offsets[1:-1]
    at = inner[inner < len(data)]  # a text starts here, so a word cannot go on over it
    opens[at] = word[at]
    at = inner[inner > 0] - 1
    closes[at] = word[at]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        base = _BASE if kind == "up" else np.uint64(pow(int(_BASE), -1, 1 << 64))
        grown = np.full(max(n, 2 * len(have)), base, np.uint64)
        grown[0] = 1
        have = np.cumprod(grown, dtype=np.uint64)
        if len(have) <= 1 << 22:
            _powers[kind] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over the whole range, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes: differences of one running polynomial."""
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _power("up", len(data)), out=run[1:], dtype=np.uint64)
    return mix((run[ends] - run[starts]) * _power("down", len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


def code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of code points of each text."""
    run = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=run[1:])
    return run[offsets[1:]] - run[offsets[:-1]]


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]], empty runs included."""
    run = np.zeros(len(values) + 1, np.result_type(values.dtype, np.int64))
    np.cumsum(values, out=run[1:])
    return run[bounds[1:]] - run[bounds[:-1]]
