"""Minimal acyclic transducers that map sorted terms to their lexicographic ordinals.

A block of sorted terms is added term by term: once the next term leaves a branch, the
branch can no longer grow and its states are replaced by registered equal ones, so the
automaton is minimal at every step but for the last term's path. Every edge carries how
many terms of its state come before it; the sum along a path is the term's ordinal.

Text goes through many automata at once: the tokens of a batch advance together, one byte
a step, over numpy tables whose rows are states and whose columns are the bytes that occur.
"""

from bisect import bisect_left, bisect_right
from collections.abc import Iterable

import numpy as np

BLOCK_TERMS = 1 << 16
_PREFIX = 8


def build(terms: Iterable[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """Edges and finality of the minimal automaton of strictly rising terms; state 0 starts."""
    edges: list[dict[int, int]] = [{}]
    final = [False]
    free: list[int] = []
    registry: dict[tuple, int] = {}
    path, last = [0], b""  # states along the last term, whose ends are not registered yet

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            key = (final[state], *edges[state].items())
            same = registry.setdefault(key, state)
            if same != state:
                edges[path[-1]][last[len(path) - 1]] = same
                edges[state], final[state] = {}, False
                free.append(state)

    for term in terms:
        shared = 0
        for a, b in zip(term, last):
            if a != b:
                break
            shared += 1
        close(shared)
        for byte in term[shared:]:
            if free:
                state = free.pop()
            else:
                state = len(edges)
                edges.append({})
                final.append(False)
            edges[path[-1]][byte] = state
            path.append(state)
        final[path[-1]] = True
        last = term
    close(0)
    return edges, final


def pack(terms: list[bytes]) -> bytes:
    """The transducer of one block as bytes: its byte classes, then a row of cells per state.

    A cell holds the number of the next state (0: none) and the terms passed by; the first
    cell of a row says whether a term ends there.
    """
    edges, final = build(terms)
    order = [0]  # reachable states, those without edges into them first
    waiting = {0: 0}
    incoming: dict[int, int] = {}
    seen, stack = {0}, [0]
    while stack:
        for target in edges[stack.pop()].values():
            incoming[target] = incoming.get(target, 0) + 1
            if target not in seen:
                seen.add(target)
                stack.append(target)
    for state in order:
        for target in edges[state].values():
            incoming[target] -= 1
            if not incoming[target]:
                waiting[target] = len(order)
                order.append(target)
    below = [0] * len(edges)
    for state in reversed(order):
        below[state] = final[state] + sum(below[t] for t in edges[state].values())
    used = sorted({b for state in order for b in edges[state]})
    classes = np.full(256, len(used) + 1, np.int32)  # the last column stays empty
    classes[used] = np.arange(1, len(used) + 1)
    width = len(used) + 2
    cells = np.zeros((len(order), width), np.uint64)
    for at, state in enumerate(order):
        passed = cells[at, 0] = int(final[state])
        passed = int(passed)
        for byte, target in edges[state].items():
            cells[at, classes[byte]] = (waiting[target] << 32) | passed
            passed += below[target]
    return classes.tobytes() + cells.tobytes()


def _prefixes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first eight bytes of each token as a number that sorts like them."""
    keys = np.zeros(len(starts), np.uint64)
    for i in range(_PREFIX):
        inside = sizes > i
        byte = data[np.minimum(starts + i, len(data) - 1)].astype(np.uint64)
        keys = (keys << np.uint64(8)) | np.where(inside, byte, np.uint64(0))
    return keys


def _key(term: bytes) -> int:
    return int.from_bytes(term[:_PREFIX].ljust(_PREFIX, b"\0"), "big")


class Lexicon:
    """Blocks ``(lang, start, first, last, packed)`` of the terms of several languages."""

    def __init__(self, blocks: list[tuple[str, int, bytes, bytes, bytes]]):
        blocks = sorted(blocks, key=lambda b: (b[0], b[1]))
        self.classes = np.zeros(256 * max(1, len(blocks)), np.int32)
        self.roots = np.zeros(len(blocks), np.int64)
        at = 1024  # an empty row for tokens that left their automaton
        self.cells = np.zeros(at + sum((len(b[4]) - 1024) // 8 for b in blocks), np.uint64)
        for i, (*_, packed) in enumerate(blocks):
            own = np.frombuffer(packed, np.int32, 256)
            width = np.uint64(int(own.max()) + 1)
            self.classes[256 * i : 256 * i + 256] = own
            self.roots[i] = at
            stored = np.frombuffer(packed, np.uint64, offset=1024)
            for start in range(0, len(stored), 1 << 16):
                cells = stored[start : start + (1 << 16)]
                step = cells >> np.uint64(32)
                moved = np.where(step > 0, step * width + np.uint64(at), np.uint64(0))
                self.cells[at + start : at + start + len(cells)] = (moved << np.uint64(32)) | (cells & np.uint64(0xFFFFFFFF))
            at += len(stored)
        self.starts = np.array([b[1] for b in blocks], np.int64)
        self.ranges: dict[str, tuple[int, np.ndarray, np.ndarray]] = {}
        for lang in dict.fromkeys(b[0] for b in blocks):
            own = [i for i, b in enumerate(blocks) if b[0] == lang]
            firsts = np.array([_key(blocks[i][2]) for i in own], np.uint64)
            lasts = np.array([_key(blocks[i][3]) for i in own], np.uint64)
            self.ranges[lang] = own[0], firsts, lasts

    def ordinals(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, langs: np.ndarray, names: list[str]) -> np.ndarray:
        """The ordinal of each token ``data[start:start + size]`` in its language, -1 for others."""
        found = np.full(len(starts), -1, np.int64)
        keys = _prefixes(data, starts, sizes)
        for code, lang in enumerate(names):
            if lang not in self.ranges:
                continue
            base, firsts, lasts = self.ranges[lang]
            own = np.flatnonzero(langs == code)
            # blocks that may hold the token: several only where a border shares its first bytes
            low = np.searchsorted(lasts, keys[own], "left")
            high = np.searchsorted(firsts, keys[own], "right") - 1
            while True:
                own, low, high = own[low <= high], low[low <= high], high[low <= high]
                if not len(own):
                    break
                got = self._walk(data, starts[own], sizes[own], base + low)
                found[own] = np.maximum(found[own], got)
                low = low + 1
        return found

    def _walk(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, block: np.ndarray) -> np.ndarray:
        out = np.full(len(starts), -1, np.int64)
        token, place, left = np.arange(len(starts)), starts.copy(), sizes
        state, shift, ordinal = self.roots[block], block * 256, self.starts[block].copy()
        while len(token):
            done = left == 0
            if done.any():
                ends = done & (self.cells[state] == 1)
                out[token[ends]] = ordinal[ends]
                going = ~done
                token, place, left, state, shift, ordinal = (x[going] for x in (token, place, left, state, shift, ordinal))
                if not len(token):
                    break
            cell = self.cells[state + self.classes[shift + data[place]]]
            state = (cell >> np.uint64(32)).astype(np.int64)
            ordinal += (cell & np.uint64(0xFFFFFFFF)).astype(np.int64)
            alive = state > 0
            if not alive.all():
                token, place, left, state, shift, ordinal = (x[alive] for x in (token, place, left, state, shift, ordinal))
            place = place + 1
            left = left - 1
        return out


def tokens_of(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all parts, and start, size and part of every run without spaces in them."""
    data = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
    inside = np.append(data != 32, False)
    borders = np.flatnonzero(np.diff(np.append(False, inside)))
    starts, ends = borders[0::2], borders[1::2]
    offsets = np.cumsum([0, *[len(p) + 1 for p in parts]])
    return data, starts, ends - starts, np.searchsorted(offsets, starts, "right") - 1


def block_of(firsts: list[bytes], lasts: list[bytes], term: bytes) -> int:
    """The block whose range holds ``term``, -1 where none does."""
    at = bisect_right(firsts, term) - 1
    return at if at >= 0 and bisect_left(lasts, term) == at else -1
