"""Substring deduplication by relative Lempel-Ziv parsing of word sequences.

The corpus is its own reference. Its distinct texts lie in blocks (buckets of one table),
and every block is indexed. A document is parsed greedily into factors: a factor starts at a
phrase of ``window`` words that the index also has elsewhere and grows word by word for as
long as the phrase that ends there is indexed too. Where it ends, the phrases across the
boundary are checked as well, so that a factor taken from one block hides none from another.
Factors are at least ``window`` words long; the words they cover are duplicate spans.

The index is built in two rounds. Of the short phrases (``GRAM`` words) in a window the one
with the least hash is its anchor; equal windows have equal anchors. A window whose anchor
occurs nowhere else cannot be repeated, so only the others' hashes are indexed. In both
rounds a task settles what repeats among its own texts and sends every other key once;
equal keys then meet in sorted order and are told apart as a stream, so that a phrase found
in a third of all texts is neither gathered anywhere nor sent once per text. Equal texts are
one text with a count. Hashes of windows have 64 bits.
"""

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweft.llm.common import slices, words_of
from textweft.scratch import materialize, new_path

WINDOW = 35
GRAM = 8
REMEMBERED = 500_000  # word hashes a task keeps in mind
_BASE = 0x9E3779B97F4A7C15


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word, 7)
        return value


_hashes = _WordHashes()
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grow(n: int) -> None:
    """Powers of the base and of its inverse modulo 2**64, as far as the longest text needs."""
    if len(_powers[0]) <= n:
        for at, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(2 * n + 1, base, dtype=np.uint64)
            steps[0] = 1
            _powers[at] = np.cumprod(steps, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def phrase_hashes(words: list[bytes], *sizes: int) -> list[np.ndarray]:
    """For each size the hashes of all runs of so many words, from left to right."""
    n = len(words)
    _grow(n)
    own = np.fromiter(map(_hashes.__getitem__, words), np.uint64, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(own * _powers[1][:n], out=sums[1:])
    return [_mixed((sums[k:] - sums[: n + 1 - k]) * _powers[0][: n + 1 - k]) if n >= k else np.zeros(0, np.uint64) for k in sizes]


def anchors(grams: np.ndarray, window: int, gram: int) -> np.ndarray:
    """For every window the place of its anchor, the leftmost of equal ones."""
    inside = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
    return inside.argmin(axis=1) + np.arange(len(inside))


def factors(repeated: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Greedy parse: maximal ``[start, end)`` stretches in which every phrase is indexed."""
    at = np.flatnonzero(repeated)
    if not len(at):
        return []
    breaks = np.flatnonzero(np.diff(at) > 1)
    starts, ends = at[np.append(0, breaks + 1)], at[np.append(breaks, len(at) - 1)] + window
    return list(zip(starts.tolist(), ends.tolist()))


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans merged across their boundaries."""
    merged: list[tuple[int, int]] = []
    for start, end in spans:
        if merged and start <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(end, merged[-1][1])
        else:
            merged.append((start, end))
    return merged


def _keyed_texts(docs: DataFrame) -> DataFrame:
    """Distinct texts of a batch under two hashes, with the number of their copies there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, ["text"]):
                seen: dict[str, int] = {}
                for text in part.column(0).to_pylist():
                    seen[text or ""] = seen.get(text or "", 0) + 1
                data = [t.encode("utf-8", "surrogatepass") for t in seen]
                columns = [pa.array([_signed(xxhash.xxh64_intdigest(d, seed)) for d in data], pa.int64()) for seed in (11, 12)]
                columns += [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["tid", "tid2", "text", "n"])

    return docs.select("text").mapInArrow(run, "tid long, tid2 long, text string, n long")


def _keyed_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, tid, tid2)`` of every row."""
    schema = docs.select("doc_id").schema
    kind = next(iter(schema.fields)).dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, ["text"]):
                data = [(t or "").encode("utf-8", "surrogatepass") for t in part.column(1).to_pylist()]
                columns = [pa.array([_signed(xxhash.xxh64_intdigest(d, seed)) for d in data], pa.int64()) for seed in (11, 12)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", "tid", "tid2"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, tid long, tid2 long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def reference_blocks(docs: DataFrame) -> str:
    """Write the distinct texts, bucketed by ``tid``, and return the table's name.

    Later steps join on ``tid`` without shuffling any text again.
    """
    spark = docs.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keyed_texts(docs).repartition(blocks, "tid")
    texts = keyed.groupBy("tid", "tid2").agg(F.first("text").alias("text"), F.sum("n").alias("copies"))
    name = f"reference_{uuid.uuid4().hex}"
    writer = texts.write.format("parquet").bucketBy(blocks, "tid")
    writer.option("path", new_path(spark, "reference")).saveAsTable(name)
    return name


Keys = Callable[[str, "np.ndarray | None"], np.ndarray]


def _send(texts: DataFrame, keys: Keys, settled: bool) -> DataFrame:
    """Keys that the texts of a task's batch hold, as ``(key, tid)``.

    With ``settled`` those that several texts of the batch, or one text twice, hold, once per
    text; without it every key once per batch.
    """
    columns = ["tid", "text", *(["keys"] if "keys" in texts.columns else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, ["text"]):
                tids = part.column(0).to_numpy(zero_copy_only=False)
                given = part.column(2) if len(columns) > 2 else None
                found = []
                for at, text in enumerate(part.column(1).to_pylist()):
                    known = None if given is None or not given[at].is_valid else np.asarray(given[at].values, dtype=np.int64).view(np.uint64)
                    found.append(np.zeros(0, np.uint64) if given is not None and known is None else keys(text, known))
                key = np.concatenate(found) if found else np.zeros(0, np.uint64)
                tid = np.repeat(tids, [len(f) for f in found])
                order = np.argsort(key, kind="stable")
                key, tid = key[order], tid[order]
                first = np.append(True, key[1:] != key[:-1])[: len(key)]
                if settled:
                    several = ~(first & np.append(first[1:], True)[: len(key)])
                    again = several & np.append(True, (key[1:] != key[:-1]) | (tid[1:] != tid[:-1]))[: len(key)]
                    key, tid = key[again], tid[again]
                else:
                    key, tid = key[first], tid[first]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(tid)], names=["key", "tid"])

    return texts.select(*columns).mapInArrow(run, "key long, tid long")


def _meet(rows: DataFrame) -> DataFrame:
    """Rows whose key comes more than once, as a stream over sorted partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_tid, emitted = None, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy(zero_copy_only=False)
            tid = batch.column(1).to_numpy(zero_copy_only=False)
            same = np.append(key[0] == held_key if held_key is not None else False, key[1:] == key[:-1])
            repeated = same | np.append(same[1:], False)
            keys, tids = key[repeated], tid[repeated]
            if same[0] and not emitted:
                keys, tids = np.append(held_key, keys), np.append(held_tid, tids)
            held_key, held_tid, emitted = key[-1], tid[-1], bool(repeated[-1])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(tids, pa.int64())], names=["key", "tid"])

    blocks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(blocks, "key").sortWithinPartitions("key").mapInArrow(run, "key long, tid long")


def _repeated(texts: DataFrame, keys: Keys) -> DataFrame:
    """``(tid, keys)``: of each text the keys that it shares with another text or place."""
    found = _send(texts, keys, True).unionByName(_meet(_send(texts, keys, False)))
    return found.groupBy("tid").agg(F.collect_set("key").alias("keys"))


OUTPUTS = "n_words long, n_removed long, kept_sha256 string, spans array<array<int>>"


def _parsed(texts: DataFrame, window: int, kept_text: bool) -> DataFrame:
    """Parse each text against its repeated phrases and cut the spans out."""
    schema = f"tid long, tid2 long, {OUTPUTS}" + (", kept_text string" if kept_text else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, ["text"]):
                rows = []
                given = part.column("keys")
                copies = part.column("copies").to_pylist()
                for at, text in enumerate(part.column("text").to_pylist()):
                    words, spans = words_of(text), []
                    if len(words) >= window and copies[at] > 1:
                        spans = [(0, len(words))]
                    elif len(words) >= window and given[at].is_valid:
                        (phrases,) = phrase_hashes(words, window)
                        index = np.asarray(given[at].values, dtype=np.int64)
                        spans = covered(factors(np.isin(phrases.view(np.int64), index), window))
                    kept, done = [], 0
                    for start, end in spans:
                        kept += words[done:start]
                        done = end
                    kept += words[done:]
                    left = b" ".join(kept)
                    removed = len(words) - len(kept)
                    row = (len(words), removed, hashlib.sha256(left).hexdigest(), [list(s) for s in spans])
                    rows.append((*row, left.decode("utf-8", "surrogatepass")) if kept_text else row)
                columns = [part.column("tid"), part.column("tid2")]
                columns += [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int32()))] + [pa.string()] * kept_text
    names = ["tid", "tid2", "n_words", "n_removed", "kept_sha256", "spans"] + ["kept_text"] * kept_text
    return texts.select("tid", "tid2", "text", "copies", "keys").mapInArrow(run, schema)


def remove_repeated_spans(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    text: str = "text",
    id: str = "doc_id",
    kept_text: bool = False,
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, spans)`` of every row, and ``kept_text`` if asked for.

    ``spans`` are the merged ``[start, end)`` word spans covered by windows of ``window``
    words that also start somewhere else, in the same text or in another; what is kept are
    the other words, joined by one space. Null and empty texts have no words; texts shorter
    than a window lose nothing; of repeated rows and equal texts all are cut alike, none is
    left whole. Ids may be null or repeated, other columns are not read, an empty table gives
    an empty result.
    """
    if not 0 < gram <= window:
        raise ValueError("an anchor must fit into a window")
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    keyed = materialize(_keyed_rows(rows), "text-keys")
    name = reference_blocks(rows)
    texts = spark.table(name)

    def anchor_keys(value: str, _: np.ndarray | None) -> np.ndarray:
        words = words_of(value)
        if len(words) < window:
            return np.zeros(0, np.uint64)
        (grams,) = phrase_hashes(words, gram)
        return grams[np.unique(anchors(grams, window, gram))]

    def window_keys(value: str, repeated: np.ndarray | None) -> np.ndarray:
        words = words_of(value)
        if len(words) < window or repeated is None:
            return np.zeros(0, np.uint64)
        grams, phrases = phrase_hashes(words, gram, window)
        return phrases[np.isin(grams[anchors(grams, window, gram)], repeated)]

    shared = materialize(_repeated(texts, anchor_keys), "anchors")
    marked = texts.select("tid", "text").join(shared, "tid")
    phrases = materialize(_repeated(marked, window_keys), "phrases")
    parsed = materialize(_parsed(texts.join(phrases, "tid", "left"), window, kept_text), "parsed")
    spark.sql(f"DROP TABLE {name}")
    return keyed.join(parsed, ["tid", "tid2"]).drop("tid", "tid2")
