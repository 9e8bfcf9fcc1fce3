"""Pre-tokens of byte-level tokenizers, for whole batches of texts at a time.

Such a tokenizer first cuts a text into contractions, runs of letters, of
digits and of other characters (each with one plain space before it, if there
is one) and runs of white space. All of these cuts depend on the classes of
neighbouring characters only, so they are found for all texts of a chunk at
once, in arrays of code points.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

LETTER, DIGIT, BLANK, OTHER, UNKNOWN, NONE = range(6)

_APOSTROPHE, _SPACE = 0x27, 0x20


@functools.cache
def _classes() -> np.ndarray:
    """Class of each code point; those this Python's Unicode tables do not know yet are settled when one is met."""
    kinds = {"L": LETTER, "N": DIGIT, "Z": BLANK}
    every = (unicodedata.category(chr(c)) for c in range(0x110000))
    table = np.fromiter((UNKNOWN if k == "Cn" else kinds.get(k[0], OTHER) for k in every), np.uint8, 0x110000)
    table[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85]] = BLANK
    return table


@functools.cache
def _settled(code_point: int) -> int:
    """Class of a code point by the tokenizers library itself, from what it joins with."""
    from tokenizers.pre_tokenizers import ByteLevel

    c = chr(code_point)
    pieces = ByteLevel(add_prefix_space=False).pre_tokenize_str(f"x{c}1{c}!{c}")
    starts = {at for _, (at, _) in pieces}
    for place, kind in ((1, LETTER), (3, DIGIT), (5, OTHER)):
        if place not in starts:
            return kind
    return BLANK


def _classified(points: np.ndarray) -> np.ndarray:
    found = _classes()[points]
    unknown = np.flatnonzero(found == UNKNOWN)
    if len(unknown):
        distinct, which = np.unique(points[unknown], return_inverse=True)
        found[unknown] = np.array([_settled(int(p)) for p in distinct], np.uint8)[which]
    return found


def _apart(points: np.ndarray, first: np.ndarray, token: str, text: str) -> np.ndarray:
    """Places of an added token that lies within one text."""
    at, places = text.find(token), []
    while at >= 0:
        whole = not first[at + 1 : at + len(token)].any()
        if whole:
            places.append(at)
        at = text.find(token, at + (len(token) if whole else 1))
    return np.array(places, np.int64)


def split(data: np.ndarray, offsets: np.ndarray, added: tuple[str, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(byte at which each pre-token starts, which added token it is or -1) of texts laid end to end.

    ``data`` is valid UTF-8 and ``offsets`` are the texts' bounds in it. A
    pre-token ends where the next one starts; an empty text has none.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = data.tobytes().decode()
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = len(points)
    byte_at = np.arange(n) if n == len(data) else np.flatnonzero((data & 0xC0) != 0x80)
    first = np.zeros(n + 1, bool)
    first[n] = True
    first[np.searchsorted(byte_at, offsets[:-1][offsets[:-1] < offsets[1:]])] = True
    held = [(i, token, _apart(points, first, token, text)) for i, token in enumerate(added) if token in text]
    for _, token, places in held:
        first[places] = first[places + len(token)] = True

    kind = _classified(points)
    before, after = np.full(n, NONE, np.uint8), np.full(n, NONE, np.uint8)
    before[1:], after[:-1] = kind[:-1], kind[1:]
    before[first[:-1]] = NONE
    after[first[1:]] = NONE
    blank = kind == BLANK
    start = kind != before
    # One plain space goes with what follows it; of other runs of blanks the last one stands alone before a word.
    follows_space = np.zeros(n, bool)
    follows_space[1:] = points[:-1] == _SPACE
    start &= ~(follows_space & ~blank & ~first[:-1])
    start |= blank & (after != BLANK) & (after != NONE)
    _cut_contractions(points, first, start)
    for _, token, places in held:
        for at in places.tolist():
            start[at + 1 : at + len(token)] = False
    which = np.full(n, -1, np.int64)
    for i, _, places in held:
        which[places] = i
    at = np.flatnonzero(start)
    return byte_at[at], which[at]


def _cut_contractions(points: np.ndarray, first: np.ndarray, start: np.ndarray) -> None:
    """'s 't 'm 'd 're 've 'll are pre-tokens of their own where an apostrophe starts one."""
    at = np.flatnonzero((points == _APOSTROPHE) & start)
    if not len(at):
        return
    padded = np.append(points, [0, 0])
    one, two = padded[at + 1], padded[at + 2]
    inside = ~first[at + 1]
    long = inside & ~np.append(first, True)[at + 2]
    letter = {c: ord(c) for c in "stmdrevl"}
    short = inside & np.isin(one, [letter[c] for c in "stmd"])
    pair = (two == letter["e"]) & ((one == letter["r"]) | (one == letter["v"])) | (two == letter["l"]) & (one == letter["l"])
    for found, size in ((short, 2), (long & pair & ~short, 3)):
        places = at[found]
        start[places + 1] = False
        ends = places + size
        start[ends[ends < len(start)]] = True
