"""Logistic context mixing over the bits of texts.

A text is a row of units: the bytes up to a space or a line break, with that or the end of the
text as the last symbol. A symbol is coded by a prefix code that goes by the symbol before it
in the unit, so that few bits are needed, and every bit is guessed by several predictors. Each
hashes its own context (the two bytes before, the four before, the unit so far; and the unit so far
with the whole unit before it) with the node of the code into a table of counts of zeros and
ones. The guesses, as log-odds, are added up under weights that a gate picks by how sure the
predictors are; the weights are learnt online. The sum is refined by a table that maps what was said,
gate by gate, to what came true, and by weights that adapt as a document goes on.

All predictors but the last see the unit alone. Whatever depends on a unit alone is worked out
once per task for frequent units, and counted once for the distinct units of a corpus. All
documents of a group advance together, a block of bits a step; long documents are read piece by
piece, so that memory is bounded.
"""

import heapq
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np

END = START = 256
SYMBOLS = 257
INNER = 3  # predictors that see the unit alone: two bytes, four bytes, the unit so far
PREDICTORS = INNER + 1
SLOT_BITS = 22
SLOTS = 1 << SLOT_BITS
SCALE = 12.0  # a table holds log-odds as bytes, this much to one
PIECE = 1 << 19  # bytes of texts that are laid out together
SCORED = 1 << 17  # bytes of texts that are scored together
GROUP = 30_000  # units of a long text whose bits are laid out together
RUN = 8_000  # units of several texts whose bits are scored together
LAID = 8_000  # distinct units laid out at a time
STEP = 512  # bits between two updates
RATE, OWN_RATE = 0.02, 0.004
DEPTHS, LEVELS = 3, 3
STILL = DEPTHS * LEVELS * 2  # gates by what the unit alone tells
GATES = STILL * LEVELS
BUCKETS, REACH = 97, 8.0
BIAS = np.float32(0.3)

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_powers = np.ones(1, np.uint64)
_unpowers = np.ones(1, np.uint64)


def units(text: bytes) -> list[bytes]:
    """The units of a text: plain before a space, with a break before a break, with a space before the end."""
    if b"\n" not in text:
        out = text.split(b" ")
    else:
        out = []
        for line in text.split(b"\n"):
            out += line.split(b" ")
            out[-1] += b"\n"
        out[-1] = out[-1][:-1]
    out[-1] += b" "
    return out


def rounds(texts: list[bytes], size: int | None = None, together: int | None = None) -> Iterator[list[tuple[int, bool, list[bytes]]]]:
    """Lists of ``(text number, first piece, units)`` of about ``PIECE`` bytes, or ``together`` if that is less;
    one text when it is longer than ``PIECE``."""
    size = PIECE if size is None else size
    most = size if together is None else min(size, together)
    held, filled = [], 0
    for i, text in enumerate(texts):
        if len(text) > size:
            at = 0
            while at is not None:
                cut = text.find(b" ", at + size)
                part = units(text[at : cut if cut >= 0 else len(text)])
                if cut >= 0:
                    part[-1] = part[-1][:-1]  # a space follows, not the end
                yield [(i, at == 0, part)]
                at = cut + 1 if cut >= 0 else None
            continue
        if held and filled + len(text) > most:
            yield held
            held, filled = [], 0
        held.append((i, True, units(text)))
        filled += len(text)
    if held:
        yield held


class Code:
    """A prefix code for the symbol that follows each symbol of a unit or its start.

    ``counts[before, symbol]`` tells how often a symbol follows; the code of a symbol that follows
    ``before`` is found at ``before * SYMBOLS + symbol``: how many bits, and from where on they stand
    in ``nodes`` and ``bits``.
    """

    def __init__(self, counts: np.ndarray):
        paths = [path for row in counts.reshape(SYMBOLS, SYMBOLS) for path in _paths(row)]
        self.sizes = np.array([len(p) for p in paths], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.nodes = np.array([n for p in paths for n, _ in p], np.uint8)
        self.bits = np.array([b for p in paths for _, b in p], np.uint8)


def _paths(counts: np.ndarray) -> list[list[tuple[int, int]]]:
    """Node and bit of every step to each symbol, in a tree with the least expected length."""
    floor = max(1, int(counts.sum()) >> 16)  # keeps the codes of rare symbols short
    heap = [(max(int(c), floor), s) for s, c in enumerate(counts)]
    heapq.heapify(heap)
    children: list[tuple[int, int]] = []
    while len(heap) > 1:
        (n, a), (m, b) = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (n + m, len(counts) + len(children)))
        children.append((a, b))
    paths: list[list[tuple[int, int]]] = [[] for _ in counts]
    stack: list[tuple[int, list]] = [(heap[0][1], [])]
    while stack:
        at, path = stack.pop()
        if at < len(counts):
            paths[at] = path
            continue
        node = at - len(counts)
        stack += [(child, [*path, (node, bit)]) for bit, child in enumerate(children[node])]
    return paths


def _grow(n: int) -> None:
    global _powers, _unpowers
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.append(np.uint64(1), np.full(size - 1, _ODD)), dtype=np.uint64)
            _unpowers = np.cumprod(np.append(np.uint64(1), np.full(size - 1, _INVERSE)), dtype=np.uint64)


def _short(value: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hashes mixed to 32 bits."""
    value = (value + np.uint64(salt)) * _ODD
    value ^= value >> np.uint64(32)
    return (value * _ODD >> np.uint64(32)).astype(np.uint32)


class Symbols:
    """The symbols of distinct units, one after another, and their contexts."""

    def __init__(self, distinct: list[bytes]):
        ended = np.array([u[-1:] == b" " for u in distinct], bool)
        closed = [u if u[-1:] in (b" ", b"\n") else u + b" " for u in distinct]
        self.lengths = np.array([len(c) for c in closed], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(closed), np.uint8)
        symbols = self.data.astype(np.int64)
        symbols[(self.starts + self.lengths - 1)[ended]] = END
        before = np.append(START, symbols[:-1])
        before[self.starts] = START
        self.symbols, self.keys = symbols, before * SYMBOLS + symbols
        n = len(symbols)
        _grow(n + 1)
        at = np.repeat(self.starts, self.lengths)
        self.since = np.arange(n) - at
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=sums[1:])
        self.so_far = (sums[:n] - sums[at]) * _unpowers[at]
        ends = self.starts + self.lengths
        self.hashes = (sums[ends] - sums[self.starts]) * _unpowers[self.starts]
        self.whole = _short(self.hashes, 77)

    def context(self, which: int) -> np.ndarray:
        """The context of every symbol for one of the ``INNER`` predictors, as 32-bit hashes."""
        if which == 2:
            return _short(self.so_far, 3)
        value = np.zeros(len(self.symbols), np.uint64)
        for back in range(1, (2, 4)[which] + 1):
            seen = np.zeros(len(value), np.uint64)
            seen[back:] = self.symbols[:-back] + 1
            seen[self.since < back] = 0
            value = value * np.uint64(257) + seen
        return _short(value, which + 1)

    def bits(self, code: Code) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each unit's number of bits; each bit's symbol, depth in its code and place in the code."""
        sizes = code.sizes[self.keys]
        borders = np.append(0, np.cumsum(sizes))
        place = np.repeat(np.arange(len(sizes)), sizes)
        depth = np.arange(borders[-1]) - borders[place]
        per_unit = np.diff(borders[np.append(self.starts, len(sizes))])
        return per_unit, place, depth, code.starts[self.keys][place] + depth


def _marked(hashes: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    return hashes + (nodes.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B)


def _slots(marked: np.ndarray) -> np.ndarray:
    """Slots of the table; changes what it is given."""
    marked *= np.uint32(0x9E3779B1)
    marked >>= np.uint32(32 - SLOT_BITS)
    return marked.astype(np.int64)


def count_followers(distinct: list[bytes], times: np.ndarray, counts: np.ndarray) -> None:
    """Count which symbol follows which in units that occur so many times."""
    if distinct:
        s = Symbols(distinct)
        counts += np.bincount(s.keys, weights=np.repeat(times, s.lengths).astype(np.float64), minlength=len(counts))


def count_inner(code: Code, distinct: list[bytes], times: np.ndarray, which: int, table: np.ndarray) -> None:
    """Add units that occur so many times to one inner predictor's table of zeros and ones."""
    if distinct:
        s = Symbols(distinct)
        _, place, _, at = s.bits(code)
        slots = _slots(_marked(s.context(which)[place], code.nodes[at]))
        np.add.at(table, slots * 2 + code.bits[at], np.repeat(times, s.lengths)[place])


class Counts:
    """A table of zeros and ones of an inner predictor: half as large until a cell could pass 32 bits."""

    def __init__(self) -> None:
        self.table = np.zeros(2 * SLOTS, np.uint32)
        self.most = 0  # no cell holds more

    def add(self, code: Code, distinct: list[bytes], times: np.ndarray, which: int) -> None:
        # a symbol has at most SYMBOLS bits, and a unit meets a cell at most once a bit
        more = sum(n * len(u) for n, u in zip(times.tolist(), distinct)) + int(times.sum())
        more *= int(code.sizes.max(initial=1))
        if self.table.dtype == np.uint32 and self.most + more >= 1 << 32:
            self.most = int(self.table.max())
            if self.most + more >= 1 << 32:
                self.table = self.table.astype(np.uint64)
        self.most += more
        count_inner(code, distinct, times.astype(self.table.dtype), which, self.table)


class Laid:
    """What the outer predictor needs of units: their hashes, and the bits of all of them."""

    FIELDS: dict[str, type] = {"whole": np.uint32, "per_unit": np.int64, "marked": np.uint32, "bit": np.uint8}

    def __init__(self, code: Code, laid: list[bytes]):
        self.symbols = s = Symbols(laid)
        self.whole = s.whole
        self.per_unit, self.place, self.depth, coded = s.bits(code)
        self.nodes, self.bit = code.nodes[coded], code.bits[coded]
        self.marked = _marked(_short(s.so_far, 4)[self.place], self.nodes)


class Layout:
    """Frequent units, laid out once for all rounds of a task, with room for those of a round behind them."""

    def __init__(self, lay: Callable[[list[bytes]], Laid], often: list[bytes]):
        self.lay, self.number = lay, {u: i for i, u in enumerate(often)}
        self.room: dict[str, np.ndarray] = {}
        self.known = self._put(often, {})

    def _put(self, units: list[bytes], known: dict[str, int]) -> dict[str, int]:
        """Lay units out a few at a time, behind what is known; returns how much of the room is filled."""
        filled = dict(known)
        for low in range(0, max(len(units), 1), LAID):
            new = self.lay(units[low : low + LAID])
            for name, kind in new.FIELDS.items():
                more, at = getattr(new, name), filled.get(name, 0)
                held, end = self.room.get(name), at + len(more)
                if held is None or len(held) < end:
                    self.room[name] = np.empty((end * 5 // 4, *more.shape[1:]), kind)
                    if held is not None:
                        self.room[name][:at] = held[:at]
                self.room[name][at:end] = more
                filled[name] = end
        return filled

    def with_units(self, fresh: list[bytes]) -> dict[str, np.ndarray]:
        """The arrays of the frequent units and, behind them, of ``fresh`` ones; good until the next call."""
        filled = self._put(fresh, self.known)
        return {name: held[: filled[name]] for name, held in self.room.items()}


class Round:
    """The units of a few texts, laid out: frequent ones once, any other where it occurs."""

    def __init__(self, members: list[tuple[int, bool, list[bytes]]], before: np.ndarray, layout: Layout):
        occurring = [u for *_, us in members for u in us]
        self.at = np.fromiter(map(layout.number.get, occurring, repeat(-1)), np.int64, len(occurring))
        missing = np.flatnonzero(self.at < 0)
        self.at[missing] = len(layout.number) + np.arange(len(missing))
        self.fresh = [occurring[i] for i in missing.tolist()]
        vars(self).update(layout.with_units(self.fresh))
        self.first_bit = np.cumsum(self.per_unit) - self.per_unit
        self.counts = np.array([len(us) for *_, us in members], np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        whole = self.whole[self.at]
        self.previous = np.append(np.uint32(0), whole[:-1])
        self.previous[self.starts] = before
        self.last = whole[self.starts + self.counts - 1]

    def groups(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Units and members of runs of members with about ``most`` units; a long member alone, by ``GROUP`` units."""
        ends = np.cumsum(self.counts)
        member = 0
        while member < len(ends):
            start = ends[member] - self.counts[member]
            if self.counts[member] > GROUP:
                for low in range(int(start), int(ends[member]), GROUP):
                    yield np.arange(low, min(low + GROUP, int(ends[member]))), np.array([member])
                member += 1
                continue
            upto = max(member + 1, int(np.searchsorted(ends, start + most, "right")))
            yield np.arange(int(start), int(ends[upto - 1])), np.arange(member, upto)
            member = upto

    def spread(self, occurring: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For occurrences of units: their bits among the distinct units', the hash of the unit before
        for each bit, and how many bits each occurrence has."""
        unit = self.at[occurring]
        n = self.per_unit[unit]
        index = np.repeat(self.first_bit[unit] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return index, np.repeat(self.previous[occurring], n), n


class OuterCounts:
    """The table of zeros and ones of the predictor that sees the unit before."""

    def __init__(self, code: Code, often: list[bytes]):
        self.layout = Layout(lambda laid: Laid(code, laid), often)
        self.table = np.zeros(2 * SLOTS, np.uint32)

    def add(self, texts: list[bytes]) -> None:
        for members in rounds(texts):
            r = Round(members, np.zeros(len(members), np.uint32) if members[0][1] else last, self.layout)
            last = r.last
            for occurring, _ in r.groups(GROUP):
                index, previous, _ = r.spread(occurring)
                slots = _slots(previous ^ r.marked[index])
                np.add.at(self.table, slots * 2 + r.bit[index], np.uint32(1))


def log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """What counts say as log-odds in a byte; 0 for a slot that was never met."""
    odds = np.log((ones + 0.4) / (zeros + 0.4))
    return np.clip(np.rint(odds * SCALE), -127, 127).astype(np.int8)


def _level(odds: np.ndarray) -> np.ndarray:
    """How sure a predictor is: never met, somewhat, very."""
    return (odds != 0).astype(np.uint8) + ((odds > 24) | (odds < -24))


class Blocks:
    """Bits of texts dealt to blocks of ``STEP`` bits, all first blocks first."""

    def __init__(self, length: np.ndarray, step: int):
        ends = np.append(0, np.cumsum(length))
        self.order = np.argsort(-length, kind="stable")
        blocks = -(-length[self.order] // step)
        rank = np.repeat(np.arange(len(blocks)), blocks)
        nth = np.arange(len(rank)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        by_step = np.argsort(nth, kind="stable")
        self.rank, nth = rank[by_step], nth[by_step]
        self.runs = np.append(0, np.cumsum(np.bincount(nth)))
        starts = ends[:-1][self.order][self.rank] + nth * step
        index = starts[:, None] + np.arange(step)
        self.live = index < (ends[1:][self.order][self.rank])[:, None]
        self.index = np.where(self.live, index, starts[:, None]).ravel()


class Weighed(Laid):
    """Units with what the inner predictors say of their bits, and what a vocabulary says of their words.

    ``still`` is the part of the gate that the unit decides; ``sums`` the weighted log-odds under
    each level of the outer predictor.
    """

    FIELDS = Laid.FIELDS | {"still": np.uint8, "sums": np.float32, "tally": np.float64}

    def __init__(self, mixer: "Mixer", laid: list[bytes], vocabulary: Callable | None = None):
        super().__init__(mixer.code, laid)
        raw, self.still = mixer.inner(self)
        self.tally = vocabulary(laid) if vocabulary is not None else np.zeros((len(laid), 3))
        weights = mixer.weights.reshape(STILL, LEVELS, PREDICTORS + 1)
        self.sums = np.empty((len(self.still), LEVELS), np.float32)
        for level in range(LEVELS):
            of = [np.ascontiguousarray(weights[:, level, i], np.float32) for i in (*range(INNER), PREDICTORS)]
            total = of[-1][self.still] * BIAS
            for odds, w in zip(raw, of):
                total += (w * np.float32(1 / SCALE))[self.still] * odds
            self.sums[:, level] = total


class Inner(Laid):
    """Units with the log-odds of the inner predictors as they are."""

    FIELDS = Laid.FIELDS | {"still": np.uint8, "raw": np.int8}

    def __init__(self, mixer: "Mixer", laid: list[bytes]):
        super().__init__(mixer.code, laid)
        raw, self.still = mixer.inner(self)
        self.raw = np.stack(raw, axis=1)


class Mixer:
    """The predictors' tables, the gates' weights and the table that refines their sums."""

    def __init__(
        self, code: Code, tables: np.ndarray, weights: np.ndarray | None = None, refined: np.ndarray | None = None,
        often: list[bytes] | None = None,
    ):
        self.code, self.tables = code, tables
        if weights is None:
            weights = np.full((GATES, PREDICTORS + 1), 0.35, np.float32)
            weights[:, -1] = 0.0
        self.weights, self.often = weights, often or []
        points = 1 / (1 + np.exp(-np.linspace(-REACH, REACH, BUCKETS)))
        if refined is None:
            refined = np.zeros((2, GATES, BUCKETS))
        chance = 0.5 * points + 0.5 * (refined[1] + 20 * points) / (refined[0] + 20)
        # the log chance of a zero and of a one, by gate and by what is said
        self.logs = np.log(np.stack([1 - chance, chance], axis=-1)).astype(np.float32).ravel()

    def inner(self, laid: Laid) -> tuple[list[np.ndarray], np.ndarray]:
        """Log-odds of the inner predictors, and the part of the gate that depends on the unit alone."""
        context = laid.symbols.context
        raw = [self.tables[i][_slots(_marked(context(i)[laid.place], laid.nodes))] for i in range(INNER)]
        still = np.minimum(laid.depth, DEPTHS - 1).astype(np.uint8) * LEVELS + _level(raw[2])
        return raw, still * 2 + ((raw[1] > 12) | (raw[1] < -12))

    def layout(self, vocabulary: Callable | None = None) -> Layout:
        """The frequent units laid out for scoring; once per task."""
        return Layout(lambda laid: Weighed(self, laid, vocabulary), self.often)

    def _outer(self, previous: np.ndarray, marked: np.ndarray) -> np.ndarray:
        return self.tables[INNER][_slots(previous ^ marked)]

    def learn(self, texts: list[bytes]) -> int:
        """Move the weights by the bits of ``texts``, a few blocks at a time; returns their number."""
        seen, layout = 0, Layout(lambda laid: Inner(self, laid), [])
        for members in rounds(texts):
            r = Round(members, np.zeros(len(members), np.uint32) if members[0][1] else last, layout)
            last = r.last
            for occurring, _ in r.groups(GROUP):
                index, previous, _ = r.spread(occurring)
                outer = self._outer(previous, r.marked[index])
                x = np.empty((PREDICTORS + 1, len(index)), np.float32)
                x[:INNER] = r.raw[index].T
                x[INNER] = outer
                x[:PREDICTORS] *= np.float32(1 / SCALE)
                x[PREDICTORS] = BIAS
                gate, bit = r.still[index] * LEVELS + _level(outer), r.bit[index]
                seen += len(bit)
                for at in range(0, len(bit), 8 * STEP):
                    now = slice(at, at + 8 * STEP)
                    part, by = x[:, now], gate[now]
                    error = bit[now] - _chance((part * self.weights[by].T).sum(axis=0))
                    n = np.bincount(by, minlength=GATES)
                    for i in range(PREDICTORS + 1):
                        moved = np.bincount(by, weights=error * part[i], minlength=GATES) / np.sqrt(n + 1)
                        self.weights[:, i] += RATE / 4 * moved
        return seen

    def _said(self, texts: list[bytes], layout: Layout, heard: Callable[[list, Round], None] | None = None):
        """The sums of log-odds, with each text's own weights, which follow its earlier bits.

        A text's own weights change the sum of the inner predictors, the outer one and a bias.
        ``heard`` is told of every round.
        """
        share = (self.weights[:, INNER] * np.float32(1 / SCALE)).astype(np.float32)
        for members in rounds(texts, together=SCORED):
            starts = members[0][1]
            if starts:
                own, last = np.zeros((len(members), 3), np.float32), np.zeros(len(members), np.uint32)
            r = Round(members, last, layout)
            last, flat = r.last, r.sums.reshape(-1)
            if heard is not None:
                heard(members, r)
            for occurring, of in r.groups(RUN):
                index, previous, n = r.spread(occurring)
                length = np.array([n.sum()]) if len(of) == 1 else np.add.reduceat(n, np.cumsum(r.counts[of]) - r.counts[of])
                b = Blocks(length, STEP)
                index = index[b.index]
                outer = self._outer(previous[b.index], r.marked[index])
                level = _level(outer)
                gate = r.still[index] * LEVELS + level
                x = np.empty((3, len(index)), np.float32)
                x[0] = flat[index * LEVELS + level]
                x[1] = outer * share[gate]
                x[2] = BIAS
                bit, total = r.bit[index], x[0] + x[1]
                own[of] = self._adapt(b, x, total, bit, own[of])
                yield [members[i][0] for i in of], b, gate, bit, total

    def _adapt(self, b: Blocks, x: np.ndarray, total: np.ndarray, bit: np.ndarray, own: np.ndarray) -> np.ndarray:
        x, total, bit = x.reshape(3, -1, STEP), total.reshape(-1, STEP), bit.reshape(-1, STEP)
        mine = own[b.order]
        for start, end in zip(b.runs[:-1].tolist(), b.runs[1:].tolist()):
            n = end - start
            part, says = x[:, start:end], total[start:end]
            says += np.einsum("ids,di->ds", part, mine[:n])
            error = (bit[start:end] - _chance(says)) * b.live[start:end]
            mine[:n] += OWN_RATE * np.einsum("ids,ds->di", part, error)
        own[b.order] = mine
        return own

    def _spots(self, gate: np.ndarray, total: np.ndarray) -> np.ndarray:
        """The cells of the refining table: the gate, and what is said to the nearest of ``BUCKETS``."""
        said = np.clip(total, np.float32(-REACH), np.float32(REACH))
        said += np.float32(REACH)
        said *= np.float32((BUCKETS - 1) / (2 * REACH))
        said += np.float32(0.5)
        return gate.astype(np.int16) * np.int16(BUCKETS) + said.astype(np.int16)

    def observe(self, texts: list[bytes], refined: np.ndarray, layout: Layout | None = None) -> None:
        """Add to ``refined`` what was said of each bit and what it was."""
        for _, b, gate, bit, total in self._said(texts, layout or self.layout()):
            at, live = self._spots(gate, total), b.live.ravel()
            refined[0] += np.bincount(at, weights=live, minlength=GATES * BUCKETS).reshape(GATES, BUCKETS)
            refined[1] += np.bincount(at, weights=bit * live, minlength=GATES * BUCKETS).reshape(GATES, BUCKETS)

    def scores(self, texts: list[bytes], layout: Layout | None = None, heard: Callable | None = None) -> np.ndarray:
        """The log10 probability of each text."""
        out = np.zeros(len(texts))
        for numbers, b, gate, bit, total in self._said(texts, layout or self.layout(), heard):
            logs = self.logs[self._spots(gate, total) * 2 + bit].reshape(-1, STEP)
            by_block = (logs * b.live).sum(axis=1, dtype=np.float64)
            out[np.array(numbers)[b.order]] += np.bincount(b.rank, weights=by_block, minlength=len(numbers)) / np.log(10)
        return out


def _chance(odds: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * odds)
