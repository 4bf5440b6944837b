"""Language-model scores of texts, by logistic context mixing and by word counts.

What the corpus teaches is gathered over all training rows. One pass counts the units of all
texts (see :mod:`textweft.llm.mixing`); the distinct units with their counts then give the words'
counts, the prefix code and the tables of the predictors that see a unit alone. One more pass
counts what the last predictor sees, the unit before. A task adds up its own table and hands it
on in compressed blocks, which are summed in groups of ``FAN`` until one table is left, so that
no task reads more than ``FAN`` blocks at a time and the driver only the finished tables of
``PREDICTORS * SLOTS`` bytes.

One training row in twenty is kept out of the tables; those rows teach the weights, each task
its own, which are averaged by bits, and then what the weighted sums meant. So weights are
learnt on texts the tables have not seen.

Words are looked up in two ways: at most ``HEAD_WORDS`` frequent ones travel to the tasks as
64-bit hashes, the others are joined with the table of counts.
"""

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textweft.llm.common import map_columns, slices, tidy
from textweft.llm.mixing import (
    BUCKETS, GATES, INNER, LOWER, PREDICTORS, SLOTS, SYMBOLS, Code, Counts, Mixer, OuterCounts, Round, Symbols, count_followers, log_odds,
    units,
)
from textweft.scratch import materialize

HEAD_WORDS = 1 << 19
OFTEN = 60_000  # units laid out once per task
FAN = 64
BLOCK = 1 << 16  # slots of a predictor that travel together
_HELD = 1 << 18  # units a task holds before it hands on their counts
_LAID = 8_000  # distinct units laid out together
ADDS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def _remainder(id: str, by: int) -> Column:
    return F.crc32(F.col(f"`{id}`").cast("string").cast("binary")) % by


def held_out(id: str) -> Column:
    """Rows that never teach: crc32 of the id as text divides by ten; a null id does not."""
    return F.coalesce(_remainder(id, 10) == 0, F.lit(False))


def _weighing(id: str) -> Column:
    return F.coalesce(_remainder(id, 20) == 1, F.lit(False))


def _lowered(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text")


def _by_task(texts: DataFrame, schema: str, start: Callable, take: Callable, result: Callable) -> DataFrame:
    """One pass with a state per task: ``take`` adds texts to it, ``result`` makes its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, any_text = None, False
        for batch in batches:
            for part in slices(batch, ["text"]):
                state = start() if state is None else state
                any_text = any_text or part.num_rows > 0
                take(state, [t.translate(LOWER) for t in part.column(0).to_pylist()])
        if any_text:
            yield result(state)

    return texts.mapInArrow(tidy(run), schema)


def _numbers(values: np.ndarray, more: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values), *[pa.array(v) for v in more.values()]], names=["at", *more]
    )


def unit_counts(texts: DataFrame) -> DataFrame:
    """``(unit, n, taught)``: how often each unit occurs, and how often in texts that teach the tables."""

    def rows(counts: Counter, weighs: bool) -> pa.RecordBatch:
        times = pa.array(list(counts.values()), pa.int64())
        taught = pa.array(np.zeros(len(counts), np.int64)) if weighs else times
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), times, taught], names=["unit", "n", "taught"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {False: Counter(), True: Counter()}
        for batch in batches:
            for part in slices(batch, ["text"]):
                for text, weighs in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts[weighs].update(units(text.translate(LOWER)))
                    if len(counts[weighs]) > _HELD:
                        yield rows(counts[weighs], weighs)
                        counts[weighs] = Counter()
        for weighs, held in counts.items():
            yield rows(held, weighs)

    found = texts.select("text", "weighs").mapInArrow(tidy(run), "unit binary, n long, taught long")
    return found.groupBy("unit").agg(F.sum("n").alias("n"), F.sum("taught").alias("taught"))


def _over_units(counted: DataFrame, column: str, schema: str, start: Callable, take: Callable, result: Callable) -> DataFrame:
    """One pass over counted units with a state per task, a few units at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for at in range(0, batch.num_rows, _LAID):
                part = batch.slice(at, _LAID)
                state = start() if state is None else state
                take(state, part.column(0).to_pylist(), part.column(1).to_numpy())
        if state is not None:
            yield result(state)

    return counted.filter(F.col(column) > 0).select("unit", column).mapInArrow(tidy(run), schema)


def _code(counted: DataFrame) -> Code:
    """The prefix code by what follows what; at most ``SYMBOLS ** 2`` sums reach the driver."""

    def result(counts: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(counts)
        return _numbers(at, {"n": counts[at].astype(np.int64)})

    found = _over_units(
        counted, "n", "at long, n long", lambda: np.zeros(SYMBOLS * SYMBOLS), lambda s, u, n: count_followers(u, n, s), result
    )
    counts = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    for r in found.groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[r["at"]] = r["n"]
    return Code(counts)


def _often(counted: DataFrame, most: int) -> list[bytes]:
    """Frequent units, ``most`` at most: all from some power of two on."""
    least, _ = _from_power(counted, most)
    return sorted(bytes(r["unit"]) for r in counted.filter(F.col("n") >= least).select("unit").collect())


def _from_power(counted: DataFrame, most: int) -> tuple[int, list]:
    """The least power of two that at most ``most`` rows reach with ``n``, and the sums by power."""
    sizes = counted.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(
        F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("tokens")
    )
    sizes = sorted(sizes.collect(), key=lambda r: -r["power"])  # one row per power of two
    least, filled = 1 << 62, 0
    for r in sizes:
        filled += r["distinct"]
        if filled > most:
            break
        least = 1 << r["power"]
    return least, sizes


def _squeezed(counts: np.ndarray) -> bytes:
    """Counts as compressed planes of their bytes; planes that hold zeros only are left out."""
    planes = counts.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = max(1, (int(counts.max(initial=0)).bit_length() + 7) // 8)
    return pa.compress(np.ascontiguousarray(planes[:used]), codec="zstd", asbytes=True) + bytes([used])


def _unsqueezed(data: bytes, n: int) -> np.ndarray:
    used = data[-1]
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :used] = np.frombuffer(pa.decompress(data[:-1], used * n, codec="zstd", asbytes=True), np.uint8).reshape(used, n).T
    return planes.view("<u8").ravel()


_TABLE = "at long, part long, counts binary"


def _table_blocks(table: np.ndarray) -> pa.RecordBatch:
    """A task's table in blocks."""
    blocks = table.reshape(-1, 2 * BLOCK)
    at = np.flatnonzero(blocks.any(axis=1))
    part = np.full(len(at), TaskContext.get().partitionId(), np.int64)
    counts = pa.array([_squeezed(blocks[i]) for i in at], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(part), counts], names=["at", "part", "counts"])


def _summed(found: DataFrame, parts: int) -> np.ndarray:
    """A predictor's log-odds for every slot, one byte each, from the blocks of ``parts`` tasks."""

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(2 * BLOCK, np.uint64)
        for data in rows.column("counts"):
            total += _unsqueezed(data.as_py(), 2 * BLOCK)
        return pa.table({"at": [rows.column("at")[0].as_py()], "part": [rows.column("part")[0].as_py()], "counts": [_squeezed(total)]})

    def said(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            odds = []
            for data in batch.column("counts"):
                cells = _unsqueezed(data.as_py(), 2 * BLOCK).astype(np.float64)
                odds.append(log_odds(cells[0::2], cells[1::2]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("at"), pa.array(odds, pa.binary())], names=["at", "odds"])

    while parts > 1:
        parts = math.ceil(parts / FAN)
        found = found.withColumn("part", F.pmod("part", F.lit(parts)))
        found = found.groupBy("at", "part").applyInArrow(add, _TABLE)
    table = np.zeros((SLOTS // BLOCK, BLOCK), np.int8)
    for r in found.mapInArrow(tidy(said), "at long, odds binary").collect():
        table[r["at"]] = np.frombuffer(r["odds"], np.int8)
    return table.ravel()


def _tables(counted: DataFrame, texts: DataFrame, code: Code, often: list[bytes]) -> np.ndarray:
    """Every predictor's log-odds for every slot."""
    sent = texts.sparkSession.sparkContext.broadcast((code, often))
    tables = np.zeros((PREDICTORS, SLOTS), np.int8)
    parts = counted.rdd.getNumPartitions()
    for which in range(INNER):

        def take(counts: Counts, distinct: list[bytes], times: np.ndarray, which: int = which) -> None:
            counts.add(sent.value[0], distinct, times, which)

        found = _over_units(counted, "taught", _TABLE, Counts, take, lambda counts: _table_blocks(counts.table))
        tables[which] = _summed(found, parts)
    found = _by_task(texts, _TABLE, lambda: OuterCounts(*sent.value), lambda s, t: s.add(t), lambda s: _table_blocks(s.table))
    tables[INNER] = _summed(found, texts.rdd.getNumPartitions())
    return tables


def _weights(texts: DataFrame, code: Code, tables: np.ndarray, often: list[bytes]) -> Mixer:
    """The weights of the mixture, averaged over tasks, and then what its sums meant."""
    context = texts.sparkSession.sparkContext
    sent = context.broadcast((code, tables))

    def result(state: list) -> pa.RecordBatch:
        mixer, seen = state
        weights = mixer.weights.astype(np.float64).ravel()
        return _numbers(np.arange(len(weights)), {"w": weights * seen, "n": np.full(len(weights), float(seen))})

    def learn(state: list, part: list[bytes]) -> None:
        state[1] += state[0].learn(part)

    found = _by_task(texts, "at long, w double, n double", lambda: [Mixer(*sent.value), 0], learn, result)
    first = Mixer(code, tables).weights.astype(np.float64).ravel()
    for r in found.groupBy("at").agg((F.sum("w") / F.sum("n")).alias("w")).collect():
        first[r["at"]] = r["w"]
    weights = first.reshape(GATES, PREDICTORS + 1).astype(np.float32)

    def meant(state: tuple) -> pa.RecordBatch:
        n, ones = state[1].reshape(2, -1)
        return _numbers(np.arange(len(n)), {"n": n, "ones": ones})

    def watch() -> tuple:
        mixer = Mixer(*sent.value, weights)
        return mixer, np.zeros((2, GATES, BUCKETS)), mixer.layout()

    seen = _by_task(
        texts, "at long, n double, ones double", watch, lambda s, t: s[0].observe(t, s[1], s[2]), meant,
    )
    refined = np.zeros((2, GATES * BUCKETS))
    for r in seen.groupBy("at").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).collect():
        refined[:, r["at"]] = r["n"], r["ones"]
    return Mixer(code, tables, weights, refined.reshape(2, GATES, BUCKETS), often)


def word_counts(counted: DataFrame) -> DataFrame:
    """``(token, n)`` of all words of counted units, which part at spaces and line breaks only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [u.split() for u in batch.column(0).to_pylist()]
            times = np.repeat(batch.column(1).to_numpy(), [len(w) for w in words])
            yield pa.RecordBatch.from_arrays([pa.array(chain.from_iterable(words), pa.binary()), pa.array(times)], names=["token", "n"])

    return counted.select("unit", "n").mapInArrow(tidy(run), "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _hashed(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of words, by rising hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                hashes = Symbols(batch.column(0).to_pylist()).hashes.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), batch.column(1)], names=["hash", "n"])

    got = words.select("token", "n").mapInArrow(tidy(run), "hash long, n long").toArrow()
    hashes, n = got.column(0).to_numpy().view(np.uint64), got.column(1).to_numpy()
    order = np.argsort(hashes, kind="stable")
    return hashes[order], n[order]


@dataclass
class LanguageModel:
    """A mixture and the counts of all training words; ``head`` holds the frequent ones."""

    mixer: Mixer
    words: DataFrame
    head: tuple[np.ndarray, np.ndarray]
    least: int  # words with at least this count are in ``head``
    texts: int
    tokens: int
    distinct: int

    def floor(self) -> float:
        """The log10 probability of a token that was never met."""
        return math.log10(0.1 / (self.tokens + 0.1 * (self.distinct + 1)))


def fit_language_model(docs: DataFrame, id: str = "doc_id", text: str = "text", head_words: int = HEAD_WORDS) -> LanguageModel:
    """Learn from all rows that are not held out.

    Null texts are empty and teach an end; rows without id teach. Repeated rows teach as often
    as they occur. Without training rows every bit is as likely as the other and no word is
    known.
    """
    taught = docs.filter(~held_out(id)).select(_lowered(text), _weighing(id).alias("weighs"))
    counted = materialize(unit_counts(taught), "unit-counts")
    code, often = _code(counted), _often(counted, OFTEN)
    tables = _tables(counted, taught.filter(~F.col("weighs")).select("text"), code, often)
    mixer = _weights(taught.filter("weighs").select("text"), code, tables, often)
    words = materialize(word_counts(counted), "word-counts")
    least, sizes = _from_power(words, head_words)
    n = taught.select("weighs").count()
    tokens, distinct = sum(r["tokens"] for r in sizes) + n, sum(r["distinct"] for r in sizes) + (n > 0)
    return LanguageModel(mixer, words, _hashed(words.filter(F.col("n") >= least)), least, n, tokens, distinct)


class Vocabulary:
    """What the frequent words of a corpus say of units: words, known words, and the log chance of those."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: float):
        self.hashes, self.counts, self.total = hashes, counts, total

    def known(self, words: list[bytes]) -> np.ndarray:
        """How often the corpus holds each word, 0 where that is not known here."""
        if not words or not len(self.hashes):
            return np.zeros(len(words), np.int64)
        asked = Symbols(words).hashes
        spot = np.minimum(np.searchsorted(self.hashes, asked), len(self.hashes) - 1)
        return np.where(self.hashes[spot] == asked, self.counts[spot], 0)

    def __call__(self, units: list[bytes]) -> np.ndarray:
        words = [u.split() for u in units]
        sizes = np.array([len(w) for w in words], np.int64)
        n = self.known(list(chain.from_iterable(words)))
        owner = np.repeat(np.arange(len(units)), sizes)
        logs = np.where(n > 0, np.log10((n + 0.1) / self.total), 0.0)
        columns = (sizes, np.bincount(owner, n > 0, len(units)), np.bincount(owner, logs, len(units)))
        return np.stack(columns, axis=1).astype(np.float64)


class Tally:
    """Sums over the words of texts, gathered as they are scored; rare words are listed."""

    def __init__(self, vocabulary: Vocabulary, often: list[bytes], texts: int):
        self.vocabulary, self.often = vocabulary, often
        self.sums, self.rare = np.zeros((texts, 3)), [[] for _ in range(texts)]

    def hear(self, members: list, r: Round) -> None:
        of = np.array([i for i, *_ in members])
        tally = r.tally[r.at]
        np.add.at(self.sums, of, np.add.reduceat(tally, r.starts, axis=0))
        odd = np.flatnonzero(tally[:, 0] > tally[:, 1])
        units = [self.often[u] if u < len(self.often) else r.fresh[u - len(self.often)] for u in r.at[odd].tolist()]
        words = [u.split() for u in units]
        sizes = [len(w) for w in words]
        flat = list(chain.from_iterable(words))
        owner = np.repeat(of[np.searchsorted(r.starts, odd, "right") - 1], sizes)
        for i in np.flatnonzero(self.vocabulary.known(flat) == 0).tolist():
            self.rare[owner[i]].append(flat[i])


def _portions(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Lower-cased texts, about a megabyte at a time."""
    held, filled = [], 0
    for text in texts:
        held.append(text.translate(LOWER))
        filled += len(text)
        if filled > 1 << 20:
            yield held
            held, filled = [], 0
    if held:
        yield held


def score_texts(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``n_tokens``, ``n_known``, ``base_score`` and ``score`` to the columns ``keep``.

    ``score`` is the mixture's log10 probability of the bytes of the whole text, ASCII capitals
    lower-cased, and of its end; divided by the bytes and by -log10(2) it gives bits per byte.
    ``base_score`` sums over words and the end what their counts say, by adding a tenth to
    each count. Null texts are empty and hold an end alone. Equal texts get equal scores and
    repeated rows stay repeated; columns named like a result are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ADDS.names]
    sent = docs.sparkSession.sparkContext.broadcast(
        (model.mixer, model.head, model.texts, model.tokens + 0.1 * (model.distinct + 1))
    )
    held: dict = {}  # each task's own copy
    inner = T.StructType(
        [
            T.StructField("_n", T.LongType()),
            T.StructField("_known", T.LongType()),
            T.StructField("_base", T.DoubleType()),
            T.StructField("_score", T.DoubleType()),
            T.StructField("_rare", T.ArrayType(T.BinaryType())),
        ]
    )

    def work(columns: dict[str, list]) -> dict[str, list]:
        mixer, head, ends, total = sent.value
        vocabulary = Vocabulary(*head, total)
        if "layout" not in held:
            held["layout"] = mixer.layout(vocabulary)
        end = math.log10((ends + 0.1) / total)
        out: dict[str, list] = {name: [] for name in inner.names}
        for texts in _portions(columns["_text"]):
            tally = Tally(vocabulary, mixer.often, len(texts))
            out["_score"] += mixer.scores(texts, held["layout"], tally.hear).tolist()
            n, known, base = tally.sums.T
            out["_n"] += (n.astype(np.int64) + 1).tolist()
            out["_known"] += known.astype(np.int64).tolist()
            out["_base"] += (base + end).tolist()
            out["_rare"] += tally.rare
        return out

    named = [F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)]
    source = docs.select(*named, _lowered(text).alias("_text"))
    scored = map_columns(source, ["_text"], inner, work, [f"_keep{i}" for i in range(len(keep))])
    scored = materialize(scored.withColumn("_row", F.monotonically_increasing_id()), "scored-texts")
    rare = scored.select("_row", F.explode("_rare").alias("token")).groupBy("_row", "token").agg(F.count(F.lit(1)).alias("k"))
    counted = model.words.filter(F.col("n") < model.least).select("token", "n")
    chance = F.log10((F.col("n") + 0.1) / (model.tokens + 0.1 * (model.distinct + 1)))
    found = rare.join(counted, "token").groupBy("_row").agg(
        F.sum("k").alias("_more"), F.sum(F.col("k") * (chance - F.lit(model.floor()))).alias("_gain")
    )
    met = scored.join(found, "_row", "left")
    known = F.col("_known") + F.coalesce("_more", F.lit(0)) + F.lit(int(model.texts > 0))
    unknown = F.size("_rare") * F.lit(model.floor())
    return met.select(
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_n").alias("n_tokens"),
        known.alias("n_known"),
        (F.col("_base") + unknown + F.coalesce("_gain", F.lit(0.0))).alias("base_score"),
        F.col("_score").alias("score"),
    )
