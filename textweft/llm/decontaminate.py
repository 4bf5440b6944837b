"""Benchmark decontamination as a prefix-filtered set join.

An item's text is cut into shingles of ``n`` words. Shingles are ordered by rarity, which
is how often their rarest word occurs in the documents. An item that must share ``o`` of
its ``s`` shingles with a window needs only its ``s - o + 1`` rarest ones as a prefix: a
window that holds none of them cannot reach ``o``. Every prefix shingle is looked up by
its rarest word. The word's place in the shingle and the length of the document bound
where the shingle can lie; there all words are compared. With ``o > 1`` the item's other
shingles are then searched in windows as long as the item.

Documents are read where they lie; only counts of the items' own words are shuffled. The
index over the items travels with the tasks while its measured size is below
``INDEX_BYTES``; larger benchmarks are worked off in blocks of that size, one pass over the
documents for each, so that no item is left out.
"""

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textweft.llm.common import LOWER_ASCII, map_columns
from textweft.scratch import materialize

INDEX_BYTES = 32 << 20
_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
# After ASCII folding everything but digits, letters and non-ASCII bytes parts words.
_PARTS = bytes(b if b in _KEPT else 0x20 for b in LOWER_ASCII)


def item_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_PARTS).split() if text else []


def item_shingles(words: list[bytes], n: int) -> list[tuple[bytes, ...]]:
    """Runs of ``n`` words; a shorter text is one run, an empty one none."""
    if not words:
        return []
    return [tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]


@dataclass
class Index:
    """Items of one block, their shingles by rarest word, and what each item asks for."""

    by_word: dict[bytes, list[tuple[int, tuple[bytes, ...], list[int]]]]
    rest: dict[bytes, list[tuple[int, tuple[bytes, ...], list[int]]]]
    ids: list
    asked: list[int]
    spans: list[int]


def build_index(items: list[tuple], rarity: dict[bytes, int], n: int, containment: float) -> Index:
    shingles: dict[tuple, dict[str, list[int]]] = {}
    ids, asked, spans = [], [], []
    for at, (item_id, text) in enumerate(items):
        words = item_words(text)
        own = sorted(set(item_shingles(words, n)), key=lambda s: (min(rarity.get(w, 0) for w in s), s))
        need = max(1, math.ceil(containment * len(own)))
        for place, shingle in enumerate(own):
            held = shingles.setdefault(shingle, {"prefix": [], "rest": []})
            held["prefix" if place <= len(own) - need else "rest"].append(at)
        ids.append(item_id)
        asked.append(need)
        spans.append(len(words))
    found: dict[str, dict] = {"prefix": defaultdict(list), "rest": defaultdict(list)}
    for shingle, held in shingles.items():
        place = min(range(len(shingle)), key=lambda i: (rarity.get(shingle[i], 0), shingle[i], i))
        for kind, owners in held.items():
            if owners:
                found[kind][shingle[place]].append((place, shingle, owners))
    return Index(dict(found["prefix"]), dict(found["rest"]), ids, asked, spans)


def occurrences(words: list[bytes], by_word: dict) -> list[tuple[int, int, list[int]]]:
    """``(start, length, items)`` of every place where an indexed shingle stands."""
    found = []
    for at in [i for i, word in enumerate(words) if word in by_word]:
        for place, shingle, owners in by_word[words[at]]:
            start = at - place
            if start >= 0 and start + len(shingle) <= len(words) and tuple(words[start : start + len(shingle)]) == shingle:
                found.append((start, len(shingle), owners))
    return found


def contained(words: list[bytes], index: Index) -> tuple[set[int], list[tuple[int, int]]]:
    """Items contained in the text, and the spans of words they cover."""
    prefix = occurrences(words, index.by_word)
    if not prefix:
        return set(), []
    single = {i for _, _, owners in prefix for i in owners if index.asked[i] == 1}
    spans = [(start, start + size) for start, size, owners in prefix if not single.isdisjoint(owners)]
    several = {i for _, _, owners in prefix for i in owners} - single
    items = set(single)
    if several:
        by_item = defaultdict(list)
        for start, size, owners in prefix + occurrences(words, index.rest):
            for i in several.intersection(owners):
                by_item[i].append((start, size, tuple(words[start : start + size])))
        for i, places in by_item.items():
            places.sort()
            inside: Counter = Counter()
            first = 0
            for start, size, shingle in places:  # the window ends where this shingle ends
                inside[shingle] += 1
                while places[first][0] < start + size - index.spans[i]:
                    gone = places[first][2]
                    inside[gone] -= 1
                    if not inside[gone]:
                        del inside[gone]
                    first += 1
                if len(inside) >= index.asked[i]:
                    items.add(i)
                    spans += [(s, s + z) for s, z, _ in places[first:] if s <= start]
    return items, spans


def word_counts(docs: DataFrame, wanted: frozenset[bytes], text: str) -> dict[bytes, int]:
    """How often each wanted word occurs in all documents; one small row per word and task."""
    adds = T.StructType([T.StructField("counts", T.MapType(T.BinaryType(), T.LongType()))])

    def work(columns: dict[str, list]) -> dict[str, list]:
        total: Counter = Counter()
        for value in columns[text]:
            total.update(w for w in item_words(value) if w in wanted)
        rows: list = [None] * len(columns[text])
        if rows:
            rows[0] = list(total.items())
        return {"counts": rows}

    counted = map_columns(docs.select(text), [text], adds, work, keep=[])
    pairs = counted.filter("counts IS NOT NULL").select(F.explode("counts").alias("word", "n"))
    return {bytes(r["word"]): r["n"] for r in pairs.groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator()}


def item_blocks(items: DataFrame, item: str, text: str):
    """The items in blocks whose texts take at most ``INDEX_BYTES / 32`` bytes.

    A word becomes about one shingle of up to ``n`` shared word objects.
    """
    block, size = [], 0
    ordered = items.select(F.col(item).alias("i"), F.col(text).alias("t")).filter("t IS NOT NULL")
    for row in ordered.toLocalIterator():
        block.append((row["i"], row["t"]))
        size += len(row["t"])
        if size > INDEX_BYTES // 32:
            yield block
            block, size = [], 0
    yield block


ADDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
    ]
)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    n: int = 10,
    containment: float = 0.0,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` and ``hit_items`` to each document.

    ``hit_spans`` are the merged ``[start, end)`` word spans covered by occurrences,
    ``hit_items`` the distinct ids of contained items, as strings in string order; an item
    without an id counts as the item ``""``. An item is contained when a window as long as
    the item holds at least the share ``containment`` of its distinct shingles, and in any
    case one. Null and empty texts have no words and no hits; items without words are
    contained nowhere. Repeated rows are judged alike, columns named like a result are
    replaced, and an empty benchmark leaves every document clean.
    """
    judged, further = docs, False
    blocks = item_blocks(items, item, item_text)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        wanted = frozenset(w for _, t in block for w in item_words(t))
        index = build_index(block, word_counts(judged, wanted, text) if wanted else {}, n, containment)
        again = [text] if following is not None and keep is not None and text not in keep else []
        judged = judge_block(judged, index, text, None if keep is None else [*keep, *again], further)
        if following is not None:
            judged, further = materialize(judged, "contamination"), True
        block = following
    return judged


def judge_block(docs: DataFrame, index: Index, text: str, keep: list[str] | None, further: bool) -> DataFrame:
    """Judge the documents by one block of items, adding to what earlier blocks found."""

    def work(columns: dict[str, list]) -> dict[str, list]:
        got: dict[str, list] = {name: [] for name in ADDS.names}
        for at, value in enumerate(columns[text]):
            words = item_words(value)
            items, spans = contained(words, index)
            names = {"" if index.ids[i] is None else str(index.ids[i]) for i in items}
            if further:
                names.update(columns["hit_items"][at])
                spans += map(tuple, columns["hit_spans"][at])
            merged: list[list[int]] = []
            for start, end in sorted(set(spans)):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            got["n_words"].append(len(words))
            got["hit_spans"].append(merged)
            got["hit_items"].append(sorted(names))
        return got

    reads = [text, *(["hit_items", "hit_spans"] if further else [])]
    return map_columns(docs, reads, ADDS, work, keep)
