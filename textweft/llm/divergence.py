"""How the sources of a language differ in the terms they use.

A first pass over the texts finds each language's kept terms, those in enough documents.
They are sorted, numbered in that order and built into minimal acyclic transducers, a block
of at most ``BLOCK_TERMS`` terms each. A second pass streams the text through the
transducers and counts ordinals; from then on a term is its ordinal, which sorts like the
term and breaks ties.

The transducers travel to the tasks where their measured size allows it. Beyond that, terms
are counted in their tasks, shuffled to the block whose range holds them and numbered
there, in groups of one block and some of the sources. Either way shuffled rows are summed
per task first. All arithmetic is on whole numbers.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textweft.llm.common import slices
from textweft.llm.lexicon import BLOCK_TERMS, Lexicon, block_of, pack, tokens_of
from textweft.lookup import BROADCAST_BYTES, lookup_join
from textweft.ordered import number_rows
from textweft.scratch import materialize

LEAST_DOCUMENTS = 3
SHARES = 1_000_000_000
TOP = 200
_HELD = 1 << 18  # terms a task holds before it hands on their counts
_SOURCES = 64  # of one block, numbered in one task
_PAIRS = 1 << 21

# letters, lower-cased if ASCII, and whatever is not ASCII; all else parts terms
_FOLD = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def _plain(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`"), F.lit("")).cast("binary")


def _documents(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    return docs.select(_plain(lang).alias("lang"), _plain(source).alias("source"), _plain(text).alias("text"))


def _document_frequency(texts: DataFrame) -> DataFrame:
    """``(lang, term, df)``, summed per task as long as its terms fit."""

    def rows(counts: Counter) -> pa.RecordBatch:
        keys = list(counts)
        columns = [k[0] for k in keys], [k[1] for k in keys], [counts[k] for k in keys]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64())],
            names=["lang", "term", "df"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang: dict[bytes, Counter] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, counts in by_lang.items():
                yield rows(Counter({(lang, term): n for term, n in counts.items()}))
            by_lang.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, Counter()).update(set(text.translate(_FOLD).split(b" ")))
                if sum(map(len, by_lang.values())) > _HELD:
                    yield from flushed()
        yield from flushed()

    found = texts.select("lang", "text").mapInArrow(run, "lang binary, term binary, df long")
    return found.filter(F.length("term") > 0).groupBy("lang", "term").agg(F.sum("df").alias("df"))


def kept_terms(texts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``(lang, term, ordinal)`` of terms in at least ``least`` documents of their language."""
    frequent = _document_frequency(texts).filter(F.col("df") >= least).select("lang", "term")
    numbered = number_rows(frequent, ["lang", "term"], "_number", label="kept-terms")
    first = numbered.groupBy("lang").agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("terms"))
    met = lookup_join(numbered, materialize(first, "languages"), "lang", weight="terms")
    return materialize(met.select("lang", "term", (F.col("_number") - F.col("_first")).alias("ordinal")), "ordinals")


def transducers(kept: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(lang, start, first, last, packed)``: one row per block of consecutive terms."""
    names = ["lang", "start", "first", "last", "packed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        lang, start = b"", 0

        def block() -> pa.RecordBatch:
            packed = pack(held)
            row = [[lang], [start], [held[0]], [held[-1]], [packed]]
            types = [pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            for own, term, ordinal in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held and (own != lang or ordinal != start + len(held) or len(held) >= block_terms):
                    yield block()
                    held = []
                if not held:
                    lang, start = own, ordinal
                held.append(term)
        if held:
            yield block()

    blocks = kept.mapInArrow(run, "lang binary, start long, first binary, last binary, packed binary")
    return materialize(blocks, "transducers")


def _streamed(texts: DataFrame, blocks: list) -> DataFrame:
    """``(lang, source, ordinal, n)`` per slice of text, by transducers that every task holds."""
    sent = texts.sparkSession.sparkContext.broadcast(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(sent.value)
        for batch in batches:
            for part in slices(batch, ["text"]):
                groups: dict[tuple, int] = {}
                of = [groups.setdefault(k, len(groups)) for k in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                langs: dict[bytes, int] = {}
                lang_of = np.array([langs.setdefault(lang, len(langs)) for lang, _ in groups], np.int64)
                data, starts, sizes, doc = tokens_of([t.translate(_FOLD) for t in part.column(2).to_pylist()])
                group = np.array(of, np.int64)[doc]
                found = lexicon.ordinals(data, starts, sizes, lang_of[group], list(langs))
                known = found >= 0
                most = int(found.max(initial=0)) + 1
                keys, n = np.unique(group[known] * most + found[known], return_counts=True)
                at = pa.array(keys // most)
                lists = [pa.array([k[i] for k in groups], pa.binary()).take(at) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*lists, pa.array(keys % most), pa.array(n.astype(np.int64))], names=["lang", "source", "ordinal", "n"])

    return texts.mapInArrow(run, "lang binary, source binary, ordinal long, n long")


def _routed(texts: DataFrame, blocks: DataFrame, sources: int) -> DataFrame:
    """As :func:`_streamed`, with each term numbered where its block is."""
    ranges: dict[bytes, tuple[list, list, list]] = {}
    for r in blocks.select("lang", "start", "first", "last").orderBy("lang", "start").toLocalIterator():
        firsts, lasts, starts = ranges.setdefault(bytes(r["lang"]), ([], [], []))
        firsts.append(bytes(r["first"]))
        lasts.append(bytes(r["last"]))
        starts.append(r["start"])
    sent = texts.sparkSession.sparkContext.broadcast(ranges)
    names = ["lang", "source", "start", "term", "n"]
    types = [pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, ["text"]):
                counts: dict[tuple, Counter] = {}
                for lang, source, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                    counts.setdefault((lang, source), Counter()).update(text.translate(_FOLD).split())
                rows: list[tuple] = []
                for (lang, source), found in counts.items():
                    firsts, lasts, starts = sent.value.get(lang, ([], [], []))
                    for term, n in found.items():
                        at = block_of(firsts, lasts, term)
                        if at >= 0:
                            rows.append((lang, source, starts[at], term, n))
                columns = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    counted = texts.mapInArrow(count, "lang binary, source binary, start long, term binary, n long")
    parts = max(1, math.ceil(sources / _SOURCES))
    dealt = F.pmod(F.xxhash64("source"), F.lit(parts)).alias("part")
    counted = counted.groupBy("lang", "source", "start", "term").agg(F.sum("n").alias("n")).select("*", dealt)
    copies = blocks.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))

    def number(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ["lang", "source", "ordinal", "n"]
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], t) for c, t in zip(out, [types[0], types[1], pa.int64(), pa.int64()])})
        block = [right.column(c)[0].as_py() for c in ("lang", "start", "first", "last", "packed")]
        data, starts, sizes, _ = tokens_of(left.column("term").to_pylist())
        found = Lexicon([tuple(block)]).ordinals(data, starts, sizes, np.zeros(len(starts), np.int64), block[:1])
        table = pa.table([left.column("lang"), left.column("source"), pa.array(found), left.column("n")], names=out)
        return table.filter(pa.array(found >= 0))

    keys = ["lang", "start", "part"]
    met = counted.groupBy(*keys).cogroup(copies.groupBy(*keys))
    return met.applyInArrow(number, "lang binary, source binary, ordinal long, n long")


def term_counts(texts: DataFrame, blocks: DataFrame, sources: int, limit: int | None = None) -> DataFrame:
    """``(lang, source, ordinal, n)``: how often each source of a language uses each kept term."""
    size = blocks.agg(F.sum(F.length("packed") + F.length("first") + F.length("last"))).first()[0] or 0
    if size <= (BROADCAST_BYTES if limit is None else limit):
        rows = blocks.select("lang", "start", "first", "last", "packed").collect()
        counted = _streamed(texts, [(bytes(r[0]), r[1], bytes(r[2]), bytes(r[3]), bytes(r[4])) for r in rows])
    else:
        counted = _routed(texts, blocks, sources)
    return materialize(counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "term-counts")


def _whole(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SHARES * (count + 1) / (total + terms))``; null without terms."""
    top = F.lit(SHARES).cast("decimal(10,0)") * _whole(count + 1)
    return F.when(terms > 0, F.lit(1) + F.call_function("div", top, _whole(total + terms)))


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _both_present(cells: DataFrame) -> DataFrame:
    """``(lang, source, item, value)``: what terms that both sources use add to their distance
    beyond what either would add if the other lacked them; summed per batch."""
    names = ["lang", "source", "item", "value"]

    def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            users = batch.column("users")
            flat = users.flatten()
            source = flat.field("source").dictionary_encode()
            code, known = source.indices.to_numpy().astype(np.int64), source.dictionary
            p, none = flat.field("p").to_numpy(), flat.field("none").to_numpy()
            size = np.diff(users.offsets.to_numpy())
            langs = batch.column("lang").dictionary_encode()
            lang = np.repeat(langs.indices.to_numpy().astype(np.int64), size)
            first = np.repeat(np.cumsum(size) - size, size)
            partners = np.repeat(size, size)
            ends = np.cumsum(partners)
            sums: dict[int, int] = {}
            at = 0
            while at < len(flat):
                upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, "right")))
                n = partners[at:upto]
                a = np.repeat(np.arange(at, upto), n)
                b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + first[a]
                other = a != b
                a, b = a[other], b[other]
                value = distance(p[a], p[b]) - distance(p[a], none[b]) - distance(none[a], p[b]) + distance(none[a], none[b])
                key = (lang[a] * len(known) + code[a]) * len(known) + code[b]
                order = np.argsort(key, kind="stable")
                key, value = key[order], value[order]
                new = np.flatnonzero(np.diff(key, prepend=-1))
                for k, total in zip(key[new].tolist(), np.add.reduceat(value, new).tolist() if len(new) else []):
                    sums[k] = sums.get(k, 0) + total
                at = upto
            keys = np.array(list(sums), np.int64)
            columns = [
                langs.dictionary.take(pa.array(keys // len(known) // len(known) if len(keys) else keys)),
                known.take(pa.array(keys // len(known) % len(known) if len(keys) else keys)),
                known.take(pa.array(keys % len(known) if len(keys) else keys)),
                pa.array(list(sums.values()), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return cells.mapInArrow(run, "lang binary, source binary, item binary, value long")


def _pair_values(users: DataFrame, cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for every two sources of a language.

    If no source used any term, a pair's distance would be the same number for each term. A
    source that uses a term changes that by an amount that depends on its share alone, so
    terms are grouped by share for this; what changes when both use the term is added apart.
    The rows are those of the result, one per pair, however many terms there are.
    """
    other = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("other_none"))
    pairs = groups.join(other, "lang").filter(F.col("source") != F.col("item"))
    idle = _distance(F.col("none"), F.col("other_none"))
    value = F.when(F.col("terms") > 0, F.col("terms") * idle).otherwise(F.lit(0)).cast("long")
    parts = [pairs.select("lang", "source", "item", value.alias("value"))]
    shares = materialize(cells.groupBy("lang", "source", "p", "none").agg(F.count(F.lit(1)).alias("n")), "shares")
    met = shares.join(other, "lang").filter(F.col("source") != F.col("item"))
    forth = _distance(F.col("p"), F.col("other_none")) - idle
    back = _distance(F.col("other_none"), F.col("p")) - _distance(F.col("other_none"), F.col("none"))
    parts.append(met.groupBy("lang", "source", "item").agg(F.sum(F.col("n") * forth).alias("value")))
    swapped = met.groupBy(F.col("lang"), F.col("item").alias("source"), F.col("source").alias("item"))
    parts.append(swapped.agg(F.sum(F.col("n") * back).alias("value")))
    parts.append(_both_present(users.select("lang", "users")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS,
    top: int = TOP, limit: int | None = None, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how sources differ from each other and what marks them.

    Null texts, languages and sources are empty strings. ``pair`` rows give the distance of a
    source to every other one of its language over all kept terms, ``term`` rows the ``top``
    terms that a source uses more than its language does. Ranks go by falling value, then by
    the item's UTF-8 bytes. Sources without terms count as using each kept term equally; in
    languages without kept terms pairs have the value 0. A source alone in its language has
    no pairs, an empty table no rows. Repeated rows count as often as they occur; other
    columns are not read. ``limit`` bounds the bytes of transducers sent to every task.
    """
    texts = _documents(docs, lang, source, text)
    groups = texts.select("lang", "source").distinct()
    kept = kept_terms(texts, least)
    blocks = transducers(kept, block_terms)
    groups = materialize(groups, "sources")
    counts = term_counts(texts, blocks, groups.count(), limit)
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("cells"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    groups = groups.join(sums, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0)
    prefix = F.concat(F.length("lang").cast("string").cast("binary"), F.lit(b":"), "lang", "source")
    groups = groups.withColumns({"none": _share(F.lit(0), F.col("total"), F.col("terms")), "group": prefix})
    groups = materialize(groups, "source-totals")
    known = groups.select("group", "total", "terms", "none", "cells")
    cells = lookup_join(counts.withColumn("group", prefix), known, "group", weight="cells")
    cells = cells.withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))
    cells = materialize(cells.select("lang", "source", "ordinal", "n", "p", "none", "terms"), "shares-by-term")
    # one entry per source that uses the term
    users = cells.groupBy("lang", "ordinal").agg(
        F.collect_list(F.struct("source", "p", "none")).alias("users"), F.sum("n").alias("n"), F.first("terms").alias("terms")
    )
    users = materialize(users, "users-by-term")
    totals = groups.groupBy("lang").agg(F.sum("total").alias("all"), F.count(F.lit(1)).alias("n_sources"))
    whole = lookup_join(users, materialize(totals, "language-totals"), "lang")
    whole = whole.withColumn("q", _share(F.col("n"), F.col("all"), F.col("terms"))).select("lang", "ordinal", "q", F.inline("users"))
    more = whole.filter(F.col("p") > F.col("q")).select("lang", "source", "ordinal", _distance(F.col("p"), F.col("q")).alias("value"))
    by_source = Window.partitionBy("lang", "source")
    place = F.row_number().over(by_source.orderBy(F.desc("value"), "ordinal"))
    terms = materialize(more.withColumn("rank", place).filter(F.col("rank") <= top), "leading-terms")
    terms = terms.join(kept, ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"
    )
    pairs = _pair_values(users, cells, groups)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(by_source.orderBy(F.desc("value"), "item")))
    found = pairs.unionByName(terms)
    shown = {c: F.decode(c, "UTF-8") for c in ("lang", "source", "item")}
    return found.withColumns(shown)
