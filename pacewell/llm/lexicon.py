"""A lexicon of words as one minimal acyclic transducer in flat arrays.

Words that share a beginning share states from the start, words that share an
ending share states up to the end. Each transition has a number as output; the
sum of the outputs along a word is the word's place in ascending order, under
which its ids stand. The transitions lie in one array: that of state s under
byte c at ``base[s] + c``, and ``owner`` there says whose it is. A saved
lexicon is one file of such arrays, which readers map into memory, so that all
workers of a machine share its pages.
"""

from __future__ import annotations

import io
import json
import mmap

import numpy as np

MAGIC = b"acyclic1"
DEAD = 0
_ARRAYS = {"base": np.int32, "final": np.uint8, "owner": np.int32, "target": np.int32, "output": np.int32, "offsets": np.int64, "ids": np.int32}


def _minimal(words: list[bytes]) -> tuple[list[tuple], int]:
    """States as (is final, ((byte, state), ...)) of the minimal automaton of ascending words; each after those it leads to."""
    states: list[tuple] = []
    known: dict[tuple, int] = {}
    path: list[list] = [[False, []]]  # of the word before: states that may still change

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            final, edges = path.pop()
            state = (final, tuple(edges))
            place = known.get(state)
            if place is None:
                place = known[state] = len(states)
                states.append(state)
            parent = path[-1][1]
            parent[-1] = (parent[-1][0], place)

    before = None
    for word in words:
        if before is not None and word <= before:
            raise ValueError("words must ascend and be distinct")
        common = 0
        if before is not None:
            most = min(len(word), len(before))
            while common < most and word[common] == before[common]:
                common += 1
        settle(common)
        for byte in word[common:]:
            path[-1][1].append((byte, None))
            path.append([False, []])
        path[-1][0] = True
        before = word
    settle(0)
    final, edges = path[0]
    states.append((final, tuple(edges)))
    return states, len(states) - 1


def build(words: list[bytes], ids: list[list[int]]) -> dict[str, np.ndarray]:
    """The arrays of a lexicon of distinct words in ascending order, each with its ids."""
    states, root = _minimal(words)
    reach = np.zeros(len(states), np.int64)
    for i, (final, edges) in enumerate(states):
        reach[i] = final + sum(int(reach[to]) for _, to in edges)
    # The root becomes state 1, all others follow; 0 is the state of no word.
    number = np.zeros(len(states), np.int64)
    number[root] = 1
    rest = np.flatnonzero(np.arange(len(states)) != root)
    number[rest] = np.arange(2, len(states) + 1)

    base = np.zeros(len(states) + 1, np.int32)
    final = np.zeros(len(states) + 1, np.uint8)
    room = sum(len(e) for _, e in states) + 512
    owner, target, output = (np.zeros(2 * room, np.int32) for _ in range(3))
    taken = np.zeros(2 * room, bool)
    taken[:256] = True  # a byte added to base 0, which states without transitions have, meets no owner
    begun: dict[int, int] = {}  # by number of labels, where the search for a free place goes on

    def fit(labels: np.ndarray) -> int:
        """A base at which all labels meet free places; places before the last one found are not tried again."""
        at = begun.get(len(labels), 256)
        while True:
            free = at + np.flatnonzero(~taken[at : at + 1024])
            bases = free - labels[0]
            bases = bases[(bases >= 0) & (bases + labels[-1] < len(taken))]
            if len(bases):
                fits = ~taken[bases[:, None] + labels[None, 1:]].any(axis=1)
                if fits.any():
                    begun[len(labels)] = at
                    return int(bases[fits.argmax()])
            at += 1024
            if at + 256 >= len(taken):
                grow()

    def grow() -> None:
        nonlocal owner, target, output, taken
        owner, target, output = (np.concatenate([x, np.zeros(len(x), np.int32)]) for x in (owner, target, output))
        taken = np.concatenate([taken, np.zeros(len(taken), bool)])

    def put(i: int, at: int) -> None:
        ends, edges = states[i]
        labels, to = np.array([b for b, _ in edges]), np.array([t for _, t in edges])
        base[number[i]] = at
        taken[at + labels] = True
        owner[at + labels], target[at + labels] = number[i], number[to]
        output[at + labels] = ends + np.concatenate([[0], np.cumsum(reach[to])[:-1]])

    sizes = np.array([len(edges) for _, edges in states])
    final[number] = [ends for ends, _ in states]
    for i in np.lexsort((np.arange(len(states)), -sizes)).tolist():
        if sizes[i] < 2:
            break
        put(i, fit(np.array([b for b, _ in states[i][1]])))
    # States with one transition take the places left over, all at once.
    single = np.flatnonzero(sizes == 1)
    while (~taken).sum() < len(single):
        grow()
    places = np.flatnonzero(~taken)[: len(single)]
    labels, to = (np.array([states[i][1][0][k] for i in single], np.int64) for k in (0, 1))
    base[number[single]] = places - labels
    owner[places], target[places], output[places] = number[single], number[to], final[number[single]]
    used = int(base.max(initial=0)) + 256
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    flat = np.fromiter((i for x in ids for i in x), np.int32, int(offsets[-1]))
    if used > len(owner):
        grow()
    return {"base": base, "final": final, "owner": owner[:used], "target": target[:used], "output": output[:used], "offsets": offsets, "ids": flat}


def packed(arrays: dict[str, np.ndarray]) -> bytes:
    """The file: a header with the arrays' places, then the arrays, each at a multiple of 64 bytes."""
    places, at, body = {}, 0, io.BytesIO()
    for name, kind in _ARRAYS.items():
        raw = np.ascontiguousarray(arrays[name], kind).tobytes()
        places[name] = (at, len(arrays[name]))
        body.write(raw + bytes(-len(raw) % 64))
        at = body.tell()
    header = json.dumps(places).encode()
    head = MAGIC + len(header).to_bytes(8, "little") + header
    return head + bytes(-len(head) % 64) + body.getvalue()


class Lexicon:
    """Looks up many words at a time in a saved lexicon."""

    def __init__(self, raw):
        if bytes(raw[:8]) != MAGIC:
            raise ValueError("not a lexicon file")
        size = int.from_bytes(bytes(raw[8:16]), "little")
        places = json.loads(bytes(raw[16 : 16 + size]))
        body = -(-(16 + size) // 64) * 64
        arrays = {name: np.frombuffer(raw, kind, places[name][1], body + places[name][0]) for name, kind in _ARRAYS.items()}
        self.base, self.final, self.owner, self.target, self.output, self.offsets, self.ids = (arrays[n] for n in _ARRAYS)
        self.n_words = len(self.offsets) - 1

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        with open(path, "rb") as file:
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
        """Place of each word ``data[start:end]``, or -1; words of more than ``longest`` bytes are not in it.

        All words take one step together; they are held by falling length, so those that go on are always the first.
        """
        sizes = np.minimum(ends - starts, longest + 1).astype(np.uint16)
        order = np.argsort(longest + 1 - sizes, kind="stable")
        order = order[np.searchsorted(longest + 1 - sizes[order], 1) :]  # without the ones that are too long
        sizes, at = sizes[order].astype(np.int64), starts[order]
        state = np.ones(len(order), np.int32)
        place = np.zeros(len(order), np.int32)
        going = len(order) - np.searchsorted(sizes[::-1], np.arange(longest + 1), side="right")
        for step in range(longest):
            n = int(going[step])
            if not n:
                break
            edge = self.base[state[:n]] + data[at[:n] + step]
            ours = self.owner[edge] == state[:n]
            state[:n] = np.where(ours, self.target[edge], DEAD)
            place[:n] += np.where(ours, self.output[edge], 0)
        found = np.full(len(starts), -1, np.int64)
        found[order] = np.where(self.final[state] > 0, place, -1)
        return found
