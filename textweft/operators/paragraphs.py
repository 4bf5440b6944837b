"""Paragraph vectors: a paragraph and the words around a place predict its word.

A model is one table ``weights(key, vec)``: words, inner nodes of a binary code tree
over the words, and paragraphs. An epoch cuts the corpus into blocks of bounded size;
each block is joined with just the weights it uses, trains on them, and returns the
rows it changed, which are averaged by how often they were changed. Only these are
written (:mod:`textweft.operators.weight_table`). No vocabulary, however large, is
collected or broadcast whole.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textweft.functions.vectors import l2_normalize, mean_vector, random_vector
from textweft.lookup import BROADCAST_BYTES, lookup_join
from textweft.operators.blocks import BLOCK_WORDS as ROW_WORDS
from textweft.operators.blocks import Part, encode_words, lists, map_blocks
from textweft.operators.embeddings import most_similar
from textweft.operators.vocabulary import (
    add_oov,
    add_padding_word,
    extend_vocabulary,
    number_by_count,
    paragraph_digest,
    paragraph_vocabulary,
    token_counts,
)
from textweft.operators.weight_table import EpochLog, WeightTable
from textweft.ordered import number_rows, running_total
from textweft.scratch import materialize, release, spread_groups
from textweft.sources.vectors import PADDING, UNKNOWN, UNKNOWN_CAPITAL

MAX_ACTIVATION = 6.0  # fixed value: beyond it a node is taken as learnt
BLOCK_WORDS = 1_000_000  # averages go as far in an epoch as one block does, and small blocks hold more rows in all
RUN_PLACES = 20_000  # whose contexts and codes are looked up together
LEAST_WORDS, EVEN_BLOCKS = 200_000, 24  # of a corpus that does not fill so many blocks
BLOCK_BYTES = 512 * 1024 * 1024  # of the vectors that a block's words and tree nodes can need
_WORD, _NODE, _PARAGRAPH = 0, 1, 2
PARAGRAPH_KIND = _PARAGRAPH
_TRAINED = pa.schema({"key": pa.int64(), "vec": pa.list_(pa.float64()), "n": pa.int64(), "error": pa.float64()})
_SETTLED = pa.schema([*list(_TRAINED)[:3], pa.field("epoch", pa.int32()), _TRAINED.field("error")])
MARKERS = (UNKNOWN, UNKNOWN_CAPITAL, PADDING)


@dataclass(frozen=True)
class Settings:
    size: int = 64
    paragraph_size: int = 64
    window: int = 5
    mode: str = "mean"  # mean, concat, self or skipgram
    symmetric_window: bool = True
    random_window: bool = False
    all_pairs: bool = False  # skipgram: every neighbour of a randomly reduced window, not one
    scale_updates: bool = False
    decay: bool = True
    alpha: float = 0.035
    min_alpha: float = 0.0001
    batch: int = 100
    seed: int = 1

    @property
    def slots(self) -> int:
        return self.window * (2 if self.symmetric_window else 1)

    @property
    def input_size(self) -> int:
        """The length of a node vector."""
        if self.mode in ("self", "skipgram"):
            return self.size
        return self.paragraph_size + self.size * (self.slots if self.mode == "concat" else 1)

    @property
    def block_words(self) -> int:
        """Words in a block of text: fewer if vectors are long."""
        most = BLOCK_BYTES // (8 * (self.size + self.input_size + self.paragraph_size))
        return max(1000, min(BLOCK_WORDS, most))


@dataclass
class ParagraphModel:
    settings: Settings
    vocab: DataFrame  # (word, id, cf, leaf)
    paragraphs: DataFrame  # (para_id, digest, first_doc, copies)
    weights: DataFrame  # (key, vec)
    epochs: list[tuple[int, float, int, float]] = field(default_factory=list)
    written: list[int] = field(default_factory=list)  # rows of weights that each epoch wrote

    def _vectors(self, kind: int, name: str) -> DataFrame:
        rows = self.weights.filter(F.pmod("key", F.lit(4)) == kind)
        return rows.select(F.shiftright("key", 2).alias(name), "vec")

    def word_vectors(self) -> DataFrame:
        """``(id, vec, word, cf)``."""
        return self._vectors(_WORD, "id").join(self.vocab.select("id", "word", "cf"), "id")

    def node_vectors(self) -> DataFrame:
        """``(node, vec)``: nodes are numbered like a heap, the root is 1."""
        return self._vectors(_NODE, "node")

    def paragraph_vectors(self) -> DataFrame:
        """``(para_id, vec)``."""
        return self._vectors(_PARAGRAPH, "para_id")

    def epoch_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.epochs, "epoch int, alpha double, batch int, error double")


def _key(id: Column, kind: int) -> Column:
    return F.shiftleft(id.cast("long"), 2) + kind


# ---------------------------------------------------------------- vocabulary and tree


def code_table(vocab: DataFrame) -> DataFrame:
    """Add ``leaf`` to ``vocab(word, id, cf)``: the word's place in a binary code tree.

    Frequent words get short codes: a word takes the binary digits of the count of all
    more frequent words, cut where no other word can share them. A running total is all
    it takes, so the tree is never built in one place. ``leaf`` is the heap number of the
    word; halving it walks up to the root, 1.
    """
    summed = running_total(vocab, [F.desc("cf"), "word"], "cf", "_before", label="codes")
    total = vocab.agg(F.sum("cf")).scalar()
    depth = F.when(total > 1, F.length(F.bin(total - 1))).otherwise(F.lit(0))
    spare = F.length(F.bin("cf")) - 1  # whole powers of two in the word's own count
    bits = F.call_function("shiftright", F.col("_before"), spare)
    leaf = F.call_function("shiftleft", F.lit(1).cast("long"), depth - spare) + bits
    return summed.withColumn("leaf", leaf).drop("_before")


def code_paths(coded: DataFrame) -> DataFrame:
    """Add ``code`` (0/1 per level) and ``point`` (the inner node per level) to a code table."""
    n = F.length(F.bin("leaf")) - 1

    def levels(value: Callable[[Column], Column]) -> Column:
        empty = F.array().cast("array<long>")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), value)).otherwise(empty)

    def up(steps: Column) -> Column:
        return F.call_function("shiftright", F.col("leaf"), steps)

    return coded.withColumns(
        {
            "code": levels(lambda level: up(n - level - 1).bitwiseAND(F.lit(1).cast("long"))),
            "point": levels(lambda level: up(n - level)),
        }
    )


def training_vocabulary(tokens: DataFrame, min_count: int = 5) -> DataFrame:
    """``(word, id, cf, leaf)`` with the unknown markers and the padding word."""
    counts = materialize(token_counts(tokens), "counts")
    kept = number_by_count(counts.filter(F.col("n") >= min_count))
    rare = max(counts.filter(F.col("n") < min_count).count(), 1)
    whole = materialize(add_padding_word(add_oov(kept, rare)), "words")
    return materialize(code_table(whole), "training-vocabulary")


def _encode(
    tokens: DataFrame, vocab: DataFrame, texts: DataFrame, block_words: int, limit: int | None
) -> tuple[DataFrame, int, DataFrame]:
    """``(doc_id, block, para_id, ids)``, the number of blocks, and the written table behind the rows.

    Unknown words get the marker's id. Copies of a text fall into different blocks.
    """
    unknown = vocab.filter(F.col("word") == UNKNOWN).select("id").first()["id"]
    digest = paragraph_digest(F.array_join("words", " ")).alias("digest")
    coded = encode_words(tokens.select("doc_id", "words", digest), vocab, unknown, limit=limit)
    known = texts.select("digest", "para_id", "copies")
    owned = lookup_join(coded, known, "digest", weight="copies", limit=limit)
    encoded = materialize(owned.select("doc_id", "para_id", "ids"), "encoded")
    words = encoded.agg(F.sum(F.size("ids"))).first()[0] or 0
    blocks = max(1, -(-words // block_words), min(EVEN_BLOCKS, words // LEAST_WORDS))
    return encoded.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")), blocks, encoded


def _needed(encoded: DataFrame, vocab: DataFrame, blocks: int, pad_id: int, limit: int | None) -> tuple[DataFrame, DataFrame]:
    """``(block, key, leaf)``: the weights each block uses, words with their leaves; and a written table behind it."""
    ids = encoded.select("block", F.explode(F.array_distinct("ids")).alias("id")).distinct()
    met = lookup_join(ids, vocab.select("id", "leaf", "cf"), "id", weight="cf", limit=limit)
    words = materialize(met.select("block", _key(F.col("id"), _WORD).alias("key"), "leaf"), "needed-words")

    def passed(key: tuple, rows: pa.Table) -> pa.Table:
        """The nodes above the leaves of a block, once each."""
        level, nodes = np.unique(rows["leaf"].to_numpy()), []
        while len(level):
            level = np.unique(level[level > 1] >> 1)
            nodes.append(level)
        found = np.unique(np.concatenate([np.zeros(0, np.int64), *nodes]))
        return pa.table({"block": pa.array(np.full(len(found), key[0].as_py(), np.int32)), "key": found * 4 + _NODE})

    leaves = spread_groups(words.select("block", "leaf"), blocks, "block")
    nodes = leaves.groupBy("block").applyInArrow(passed, "block int, key long")
    paragraphs = encoded.select("block", _key(F.col("para_id"), _PARAGRAPH).alias("key")).distinct()
    pads = encoded.select("block").distinct().select("block", _key(F.lit(pad_id), _WORD).alias("key"))
    pads = pads.join(words.select("block", "key"), ["block", "key"], "left_anti")
    others = nodes.unionByName(paragraphs).unionByName(pads)
    return words.unionByName(others.withColumn("leaf", F.lit(None).cast("long"))), words


# ---------------------------------------------------------------- one block


def _add_rows(target: np.ndarray, rows: np.ndarray, values: np.ndarray, touched: np.ndarray, source: np.ndarray | None = None) -> None:
    """``target[rows] += values`` (``values[source]`` if given) with repeated rows, and ``touched[rows] += 1``."""
    if not len(rows):
        return
    order = np.argsort(rows)
    along = rows[order]
    new = np.empty(len(along), bool)
    new[0] = True
    np.not_equal(along[1:], along[:-1], out=new[1:])
    first = np.flatnonzero(new)
    unique = along[first]
    target[unique] += np.add.reduceat(values[order if source is None else source[order]], first, axis=0)
    ends = np.empty_like(first)
    ends[:-1], ends[-1] = first[1:], len(along)
    touched[unique] += ends - first


def _positions(left: pd.DataFrame, s: Settings, epoch: int) -> np.ndarray:
    """The places to predict in this epoch, as indexes into the block's joined texts."""
    lengths = left["ids"].str.len().to_numpy()
    starts = np.cumsum(lengths) - lengths
    if s.random_window and s.mode in ("mean", "concat"):
        return starts + left["pos"].to_numpy()
    return np.arange(lengths.sum())


def _paths(leaves: np.ndarray, nodes: np.ndarray):
    """The ways from the root down to distinct leaves, behind each other: where each starts, how many steps it has,
    the rows of its nodes and its code bits; and for each given leaf its place among the distinct ones."""
    distinct, place = np.unique(leaves, return_inverse=True)
    depth = np.frexp(distinct.astype(np.float64))[1].astype(np.int64) - 1
    if not len(nodes):
        depth[:] = 0
    starts = np.cumsum(depth) - depth
    up = np.repeat(depth, depth) - (np.arange(depth.sum()) - np.repeat(starts, depth))
    leaf = np.repeat(distinct, depth)
    rows = np.minimum(np.searchsorted(nodes, (leaf >> up) * 4 + _NODE), max(len(nodes) - 1, 0))
    return starts, depth, rows, (leaf >> (up - 1)) & 1, place


def _matrix(rows: pd.DataFrame, width: int) -> np.ndarray:
    """The vectors of some rows below each other; missing ones are zeros."""
    there = rows["vec"].notna().to_numpy()
    table = np.zeros((len(rows), width))
    if width and there.any():
        table[there] = np.concatenate(rows["vec"].to_numpy()[there]).reshape(-1, width)
    return table


class _Block:
    """A block of texts with the weights it uses."""

    def __init__(self, left: pd.DataFrame, right: pd.DataFrame, s: Settings, pad_key: int):
        kind = right["key"].to_numpy() & 3
        self.tables, self.keys = [], []
        for k, width in ((_WORD, s.size), (_NODE, s.input_size), (_PARAGRAPH, s.paragraph_size)):
            rows = right[kind == k].sort_values("key")
            self.keys.append(rows["key"].to_numpy())
            self.tables.append(_matrix(rows, width))
        self.left = left
        lengths = left["ids"].str.len().to_numpy()
        self.ids = np.searchsorted(self.keys[_WORD], np.concatenate(left["ids"].to_numpy()) * 4 + _WORD)
        if "leaves" in left:
            self.paths = _paths(np.concatenate(left["leaves"].to_numpy()), self.keys[_NODE])
        else:  # a leaf for each word of the block
            leaves = right[kind == _WORD].sort_values("key")["leaf"].fillna(1).to_numpy().astype(np.int64)
            *way, place = _paths(leaves, self.keys[_NODE])
            self.paths = (*way, place[self.ids])
        paragraph = np.searchsorted(self.keys[_PARAGRAPH], left["para_id"].to_numpy() * 4 + _PARAGRAPH)
        self.owner = np.repeat(paragraph, lengths)
        self.first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.last = self.first + np.repeat(lengths, lengths)
        self.pad = np.searchsorted(self.keys[_WORD], pad_key)
        self.length_of = np.ones(len(self.tables[_PARAGRAPH]))
        self.length_of[self.owner] = self.last - self.first

    def train(self, s: Settings, alpha: float, epoch: int, paragraphs_only: bool) -> tuple[float, int, list[np.ndarray]]:
        """One epoch: the squared error, how many places were predicted, how often each row changed."""
        words, nodes, paragraphs = self.tables
        touched = [np.zeros(len(t), dtype=np.int64) for t in self.tables]
        ids, owner, first, last, pad = self.ids, self.owner, self.first, self.last, self.pad
        starts, depth, path, bits, word_of = self.paths
        work = np.zeros_like(paragraphs)
        offsets = np.array([o for o in range(-s.window, s.window + 1) if o < 0 or (o > 0 and s.symmetric_window)])
        rng = np.random.default_rng([s.seed, epoch, len(ids)])
        with_paragraph = s.mode in ("mean", "concat")
        error = 0.0

        places = _positions(self.left, s, epoch)
        if s.mode == "skipgram" and s.all_pairs:
            reach = rng.integers(1, s.window + 1, len(places))
            other = places[:, None] + offsets
            inside = (np.abs(offsets) <= reach[:, None]) & (other >= first[:, None]) & (other < last[:, None])
            places, source = np.repeat(places, inside.sum(axis=1)), other[inside]
        elif s.mode == "skipgram":
            jump = rng.integers(-s.window, s.window, len(places))
            other = places + np.where(jump == 0, 1, jump)
            inside = (other >= first) & (other < last)
            places, source = places[inside], other[inside]
        else:
            source = places

        slots = len(offsets)
        run = max(1, RUN_PLACES // s.batch) * s.batch
        for begin in range(0, len(places), run):
            # what does not change while training is looked up for many batches at once
            places_of_run = places[begin : begin + run]
            word = word_of[places_of_run]
            n = depth[word]
            ends = np.concatenate([[0], np.cumsum(n)])
            if not ends[-1]:
                continue
            step_at = np.repeat(starts[word] - ends[:-1], n) + np.arange(ends[-1])
            node_of_run, target_of_run = path[step_at], 1.0 - bits[step_at]
            place_of_step = np.repeat(np.arange(len(word)), n)
            if with_paragraph:
                near = places_of_run[:, None] + offsets
                here = (near >= first[places_of_run][:, None]) & (near < last[places_of_run][:, None])
                near_of_run = np.where(here, ids[np.clip(near, 0, len(ids) - 1)], pad)
                owner_of_run = owner[places_of_run]
            else:
                source_of_run = ids[source[begin : begin + run]]

            for lo in range(0, len(word), s.batch):
                hi = min(lo + s.batch, len(word))
                rate = max(s.min_alpha, alpha * (1 - (begin + lo) / len(places))) if s.decay else alpha
                steps = slice(ends[lo], ends[hi])
                row, at = node_of_run[steps], place_of_step[steps] - lo
                if with_paragraph:
                    near_ids = near_of_run[lo:hi]
                    context = words[near_ids]
                    flat = context.reshape(hi - lo, -1) if s.mode == "concat" else context.sum(axis=1) / slots
                    inputs = np.concatenate([paragraphs[owner_of_run[lo:hi]], flat], axis=1)
                else:
                    inputs = words[source_of_run[lo:hi]]

                given, weights = inputs[at], nodes[row]
                activation = np.einsum("sd,sd->s", given, weights)
                miss = target_of_run[steps] - 1 / (1 + np.exp(-activation.clip(-30, 30)))
                learnt = np.abs(activation) >= MAX_ACTIVATION
                miss[learnt] = 0.0
                error += float(miss @ miss)
                step = (miss * rate)[:, None]
                back = np.add.reduceat(step * weights, ends[lo:hi] - ends[lo], axis=0)

                if with_paragraph:
                    _add_rows(work, owner_of_run[lo:hi], back[:, : s.paragraph_size], touched[_PARAGRAPH])
                if paragraphs_only:
                    continue
                if learnt.any():
                    row, step, given = row[~learnt], step[~learnt], given[~learnt]
                _add_rows(nodes, row, step * given, touched[_NODE])
                if not with_paragraph:
                    _add_rows(words, source_of_run[lo:hi], back, touched[_WORD])
                elif s.mode == "concat":
                    _add_rows(words, near_ids.reshape(-1), back[:, s.paragraph_size :].reshape(-1, s.size), touched[_WORD])
                else:
                    share = back[:, s.paragraph_size :] / slots
                    _add_rows(words, near_ids.reshape(-1), share, touched[_WORD], np.repeat(np.arange(hi - lo), slots))

        paragraphs += work / self.length_of[:, None] if s.scale_updates else work
        return error, len(places), touched

    def rows(self, kind: int, touched: np.ndarray) -> pd.DataFrame:
        """The changed rows of one kind and how often they were changed."""
        at = np.flatnonzero(touched)
        return pd.DataFrame({"key": self.keys[kind][at], "vec": list(self.tables[kind][at]), "n": touched[at]})


def _train_block(left, right, s: Settings, alpha: float, epoch: int, pad_key: int, paragraphs_only: bool) -> pd.DataFrame:
    """The rows that one epoch over a block changes; the row of key -1 holds the error."""
    block = _Block(left, right, s, pad_key)
    error, places, touched = block.train(s, alpha, epoch, paragraphs_only)
    out = [block.rows(kind, touched[kind]) for kind in (_WORD, _NODE, _PARAGRAPH)]
    out.append(pd.DataFrame({"key": [-1], "vec": [[0.0]], "n": [max(places, 1)]}))
    result = pd.concat(out, ignore_index=True)
    result["error"] = 0.0
    result.loc[len(result) - 1, "error"] = error
    return result


def _settle_block(left, right, s: Settings, alphas: list[float], pad_key: int) -> pd.DataFrame:
    """Train the paragraphs of a block through all epochs, with words and nodes as they are.

    The rows of key -1 hold the error and the batch of each epoch that was run. When the error rises
    for a batch that cannot grow, the block has settled.
    """
    block = _Block(left, right, s, pad_key)
    log, before = [], np.inf
    lengths = left["ids"].str.len().to_numpy()
    for epoch, alpha in enumerate(alphas):
        if s.random_window:
            block.left = left.assign(pos=np.random.default_rng([s.seed, epoch, len(block.ids)]).integers(0, lengths))
        error, places, _ = block.train(s, alpha, epoch, True)
        log.append((epoch, error, places))
        if error > before:
            break
        before = error
    log += [(epoch, error, 0) for epoch in range(len(log), len(alphas))]
    out = block.rows(_PARAGRAPH, np.ones(len(block.keys[_PARAGRAPH]), np.int64))
    out["epoch"], out["error"] = -1, 0.0
    said = pd.DataFrame({"key": -1, "vec": [[0.0] for _ in log], "n": [n for *_, n in log], "epoch": [e for e, *_ in log]})
    said["error"] = [error for _, error, _ in log]
    return pd.concat([out, said], ignore_index=True)


# ---------------------------------------------------------------- training


@dataclass
class _Job:
    """A corpus laid out for training: ``needed(block, key, leaf)``, ``uses(key, uses)``, ``keys`` how many are needed."""

    encoded: DataFrame
    needed: DataFrame
    uses: DataFrame
    pad_key: int
    blocks: int
    keys: int
    written: list[DataFrame]  # which nothing but the job reads

    def small(self, s: Settings, limit: int | None) -> bool:
        """Whether all weights the corpus needs fit a broadcast; the keys stay the same in all epochs."""
        width = max(s.size, s.input_size, s.paragraph_size)
        return self.keys * (48 + 8 * width) <= (BROADCAST_BYTES if limit is None else limit)


def _lay_out(tokens: DataFrame, vocab: DataFrame, texts: DataFrame, block_words: int, limit: int | None) -> _Job:
    pad_id = vocab.filter(F.col("word") == PADDING).select("id").first()["id"]
    pad_key = int(pad_id) * 4 + _WORD
    encoded, blocks, laid = _encode(tokens, vocab, texts, block_words, limit)
    rows, words = _needed(encoded, vocab, blocks, int(pad_id), limit)
    needed = materialize(rows, "needed")
    release(words)
    uses = materialize(needed.groupBy("key").agg(F.count(F.lit(1)).alias("uses")), "uses")
    return _Job(encoded, needed, uses, pad_key, blocks, uses.count(), [laid, needed, uses])


def _pulled(job: _Job, weights: DataFrame, s: Settings, limit: int | None) -> DataFrame:
    """``(block, key, leaf, vec)``: the weights of every block, null where a node was never trained."""
    small = job.small(s, limit)
    if not small:
        weights = weights.join(job.uses, "key")
    return lookup_join(job.needed, weights, "key", "left", weight="uses", limit=limit, small=small).select(
        "block", "key", "leaf", "vec"
    )


def _epoch(
    job: _Job, table: WeightTable, s: Settings, alpha: float, epoch: int, limit: int | None, write: Callable[[DataFrame], DataFrame]
) -> float:
    """Train once over the corpus, add what changed to the table and return the summed squared error."""
    pad_key = job.pad_key
    draw = F.pmod(F.xxhash64(F.lit(s.seed), F.lit(epoch), "doc_id"), F.size("ids")).cast("int")
    texts = job.encoded.withColumn("pos", draw).select("doc_id", "block", "para_id", "ids", "pos")

    def train(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _train_block(left.sort_by("doc_id").to_pandas(), right.to_pandas(), s, alpha, epoch, pad_key, False)
        return pa.Table.from_pandas(found, _TRAINED, preserve_index=False)

    pulled = _pulled(job, table.read(), s, limit)
    changed = (
        spread_groups(texts, job.blocks, "block")
        .groupBy("block")
        .cogroup(spread_groups(pulled, job.blocks, "block").groupBy("block"))
        .applyInArrow(train, "key long, vec array<double>, n long, error double")
    )
    width = max(s.size, s.input_size, s.paragraph_size)
    mean = mean_vector(F.col("vec"), F.col("n").cast("double"), width)
    # the row of key -1 comes along, so that one pass over the text gives rows and error
    averaged = changed.groupBy("key").agg(mean.alias("vec"), F.sum("error").alias("error"))
    averaged = write(averaged)
    error = averaged.filter(F.col("key") < 0).agg(F.sum("error")).first()[0] or 0.0
    table.change(averaged.filter(F.col("key") >= 0).select("key", "vec"))
    return error


def _paragraph_texts(tokens: DataFrame) -> DataFrame:
    keyed = tokens.select("doc_id", F.array_join("words", " ").alias("text"))
    return paragraph_vocabulary(keyed)


def start_weights(vocab: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """``(key, vec)``: the vectors that words and paragraphs start from."""
    words = vocab.select(
        _key(F.col("id"), _WORD).alias("key"), random_vector(F.col("id"), s.size, s.seed).alias("vec")
    )
    return words.unionByName(start_paragraphs(texts, s))


def start_paragraphs(texts: DataFrame, s: Settings) -> DataFrame:
    """``(key, vec)``: the vectors that paragraphs start from."""
    vec = random_vector(F.col("para_id"), s.paragraph_size, s.seed + 1)
    return texts.select(_key(F.col("para_id"), _PARAGRAPH).alias("key"), vec.alias("vec"))


def _schedule(alpha: float, epoch: int, max_iter: int) -> float:
    return alpha * (1 - epoch / (max_iter - 1)) if max_iter > 1 else alpha


@dataclass
class _Progress:
    """What decides the next epoch: errors so far, and whether the batch has just grown."""

    batch: int
    errors: list[float] = field(default_factory=list)
    grown: bool = False
    ended: bool = False

    def after(self, error: float, max_batch: int) -> None:
        worse = bool(self.errors) and error > self.errors[-1] and not self.grown
        self.errors.append(error)
        self.grown = False
        if worse and self.batch >= max_batch:
            self.ended = True
        elif worse:
            self.batch, self.grown = min(max_batch, self.batch + 50), True


def _run(model: ParagraphModel, job: _Job, max_iter: int, max_batch: int, limit: int | None, log: EpochLog | None) -> ParagraphModel:
    s, progress = model.settings, _Progress(model.settings.batch)
    needed = job.uses.select("key")
    started = model.weights.join(needed, "key", "left_semi")
    first = materialize(started, "weights") if log is None else log.start(started)
    table, wrote = WeightTable.of(first), [first]
    rest = model.weights.join(needed, "key", "left_anti")  # never read or written while training
    for epoch in range(max_iter):
        alpha = _schedule(s.alpha, epoch, max_iter)
        batch = progress.batch
        done = log.finished(epoch) if log is not None else None
        if done is not None:
            changed, error = done
            table.change(changed)
        else:

            def write(rows: DataFrame, epoch: int = epoch) -> DataFrame:
                wrote.append(materialize(rows, "changed") if log is None else log.changed(epoch, rows))
                return wrote[-1]

            error = _epoch(job, table, replace(s, batch=batch), alpha, epoch, limit, write)
            if log is not None:
                log.finish(epoch, error)
        model.epochs.append((epoch, float(alpha), batch, float(error)))
        progress.after(error, max_batch)
        if progress.ended:
            break
    model.written = table.written
    model.weights = materialize(rest.unionByName(table.read()), "weights")
    release(*wrote, *[part.rows for part in table.parts], *job.written)
    return model


def pvdm_fit(
    tokens: DataFrame,
    settings: Settings = Settings(),
    min_count: int = 5,
    max_iter: int = 5,
    max_batch: int = 500,
    start: ParagraphModel | None = None,
    limit: int | None = None,
    folder: str | None = None,
) -> ParagraphModel:
    """Train on ``tokens(doc_id, words)``; every document is a paragraph.

    The rate falls linearly over the epochs. When the error rises the batch grows by 50,
    up to ``max_batch``, where training stops. ``start`` goes on from a pre-trained model.
    With a ``folder`` that outlives the driver each epoch is kept there; a call with the same
    arguments goes on after the last one that was finished.
    """
    tokens = tokens.filter(F.size("words") > 0)
    log = None if folder is None else EpochLog(tokens.sparkSession, folder, f"{settings} {min_count} {max_iter} {max_batch}")
    if start is None:
        vocab, texts = training_vocabulary(tokens, min_count), _paragraph_texts(tokens)
        weights = materialize(start_weights(vocab, texts, settings), "weights")
        model = ParagraphModel(settings, vocab, texts, weights)
    else:
        model = ParagraphModel(settings, start.vocab, start.paragraphs, start.weights)
    started = model.weights
    job = _lay_out(tokens, model.vocab, model.paragraphs, settings.block_words, limit)
    _run(model, job, max_iter, max_batch, limit, log)
    if start is None:
        release(started)
    return model


def extend_model(model: ParagraphModel, tokens: DataFrame, min_count: int = 5) -> ParagraphModel:
    """A model made ready for more text: ``pvdm_fit(tokens, start=…)`` then goes on with it.

    Counts are added up; new words of ``min_count`` or more get the next ids and start anew, and
    new texts become paragraphs. The code tree is laid out anew by the summed counts. A node
    of it starts from the old nodes that parted the same words at the same level, by how
    often those words occur, and against the sign where their codes differ; where no count
    changes the order of words the tree is the old one. Old word and paragraph vectors stay.
    """
    tokens = tokens.filter(F.size("words") > 0)
    s, old = model.settings, model.vocab.select("word", "id", "cf", "leaf")
    counts = materialize(token_counts(tokens), "new-counts")
    met = counts.join(old.select("word"), "word", "left_anti")
    rare = met.filter(F.col("n") < min_count).count()
    grown = extend_vocabulary(old.select("word", "id", "cf"), tokens, min_count)
    cf = F.when(F.col("word") == UNKNOWN, F.col("cf") + rare).otherwise(F.col("cf"))
    vocab = materialize(code_table(materialize(grown.withColumn("cf", cf), "grown-words")), "training-vocabulary")
    texts = _more_paragraphs(model.paragraphs, tokens)
    kind = F.pmod("key", F.lit(4))
    kept = model.weights.filter(kind != _NODE)
    fresh = start_weights(vocab, texts, s).join(kept.select("key"), "key", "left_anti")
    nodes = _merged_nodes(old, vocab, model.weights.filter(kind == _NODE), s.input_size)
    weights = kept.unionByName(fresh).unionByName(nodes)
    return ParagraphModel(s, vocab, texts, materialize(weights, "weights"), list(model.epochs))


def _more_paragraphs(known: DataFrame, tokens: DataFrame) -> DataFrame:
    """Known paragraphs with the copies found anew, and new ones under the next ids."""
    found = _paragraph_texts(tokens).select("digest", "first_doc", "copies", "para_id")
    first = (known.agg(F.max("para_id")).first()[0] + 1) if not known.isEmpty() else 0
    again = found.select("digest", F.col("copies").alias("more"))
    seen = known.join(again, "digest", "left").withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0)))
    new = found.join(known.select("digest"), "digest", "left_anti")
    numbered = number_rows(new.drop("para_id"), ["first_doc"], name="para_id", start=first, label="new-paragraphs")
    columns = ["para_id", "digest", "first_doc", "copies"]
    return materialize(seen.select(*columns).unionByName(numbered.select(*columns)), "paragraphs")


def _merged_nodes(old: DataFrame, new: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``(key, vec)`` of the nodes of a new tree, from those that words passed in the old one."""
    was = old.select("id", F.col("leaf").alias("old_leaf"), F.col("cf").alias("n"))
    both = was.join(new.select("id", "leaf"), "id").filter((F.col("leaf") > 1) & (F.col("old_leaf") > 1))
    depth = F.least(F.length(F.bin("leaf")), F.length(F.bin("old_leaf"))) - 1
    levels = both.select("n", "leaf", "old_leaf", F.explode(F.sequence(F.lit(0), depth - 1)).alias("level"))

    def above(leaf: str, extra: int) -> Column:
        return F.call_function("shiftright", F.col(leaf), F.length(F.bin(leaf)) - 1 - F.col("level") - extra)

    sign = F.when(above("leaf", 1).bitwiseAND(F.lit(1)) == above("old_leaf", 1).bitwiseAND(F.lit(1)), 1).otherwise(-1)
    passed = levels.select(above("leaf", 0).alias("node"), above("old_leaf", 0).alias("from"), sign.alias("sign"), "n")
    # words are summed up before any vector moves
    shares = passed.groupBy("node", "from").agg(F.sum(F.col("sign") * F.col("n")).alias("share"), F.sum("n").alias("n"))
    vectors = nodes.select(F.shiftright("key", 2).alias("from"), "vec")
    met = lookup_join(shares, vectors, "from")
    # every share counts in the weight, those against the sign with the vector turned round
    vec = F.transform("vec", lambda x: x * F.col("share") / F.col("n"))
    moved = met.select(_key(F.col("node"), _NODE).alias("key"), vec.alias("vec"), F.col("n").cast("double").alias("n"))
    return moved.groupBy("key").agg(mean_vector(F.col("vec"), F.col("n"), width).alias("vec"))


def pretrain(
    tokens: DataFrame,
    settings: Settings,
    min_count: int = 5,
    max_iter: int = 3,
    limit: int | None = None,
) -> ParagraphModel:
    """Warm up word vectors: ``settings.mode`` is ``self`` (a word predicts itself) or
    ``skipgram`` (a random neighbour predicts the word, or each one with ``all_pairs``)."""
    if settings.mode not in ("self", "skipgram"):
        raise ValueError("mode must be self or skipgram")
    return pvdm_fit(tokens, settings, min_count, max_iter, limit=limit)


def word2vec_fit(
    tokens: DataFrame,
    size: int = 100,
    window: int = 5,
    min_count: int = 5,
    alpha: float = 0.025,
    min_alpha: float = 0.0001,
    iterations: int = 1,
    batch: int = 1000,
    seed: int = 1,
    limit: int | None = None,
) -> ParagraphModel:
    """Skip-gram vectors with a code tree over the vocabulary, from all pairs of reduced windows.

    Vectors stay in tables; a block of text pulls the rows it uses. Within an epoch the rate
    falls to ``min_alpha``. The model's ``word_vectors()`` also hold the unknown and padding words.
    """
    settings = Settings(
        size=size, paragraph_size=0, window=window, mode="skipgram", all_pairs=True, alpha=alpha, min_alpha=min_alpha, batch=batch, seed=seed
    )
    return pvdm_fit(tokens, settings, min_count, iterations, max_batch=batch, limit=limit)


def expand_nodes(nodes: DataFrame, repeats: int, paragraph_size: int, vec: str = "vec") -> DataFrame:
    """Node vectors of a pre-trained tree made ready for windows: zeros for the paragraph,
    then each value ``repeats`` times, divided by ``repeats``."""
    zeros = F.array_repeat(F.lit(0.0), paragraph_size)
    spread = F.flatten(F.transform(vec, lambda x: F.array_repeat(x.cast("double") / repeats, repeats)))
    return nodes.withColumn(vec, F.concat(zeros, spread))


def expand_to_windows(model: ParagraphModel, settings: Settings) -> ParagraphModel:
    """Turn a pre-trained model into one that predicts from windows; paragraphs start anew."""
    if model.settings.mode not in ("self", "skipgram"):
        raise ValueError("the model already predicts from windows")
    repeats = settings.slots if settings.mode == "concat" else 1
    is_node = F.pmod("key", F.lit(4)) == _NODE
    is_word = F.pmod("key", F.lit(4)) == _WORD
    nodes = expand_nodes(model.weights.filter(is_node), repeats, settings.paragraph_size)
    weights = (
        model.weights.filter(is_word)
        .unionByName(nodes)
        .unionByName(start_paragraphs(model.paragraphs, settings))
    )
    return ParagraphModel(settings, model.vocab, model.paragraphs, materialize(weights, "weights"))


def pvdm_infer(
    model: ParagraphModel, tokens: DataFrame, max_iter: int = 5, limit: int | None = None
) -> ParagraphModel:
    """Vectors of new paragraphs; words and tree stay as they are.

    No two paragraphs share what is trained, so a block pulls its words and nodes once and trains
    through all epochs in one visit; of copies of a text one is read. A block ends when its error
    rises. The epochs' errors are sums over blocks, the last one of a block that had ended.
    """
    tokens = tokens.filter(F.size("words") > 0)
    texts, s = _paragraph_texts(tokens), model.settings
    learnt = model.weights.filter(F.pmod("key", F.lit(4)) != _PARAGRAPH)
    started = materialize(start_paragraphs(texts, s), "started")
    firsts = tokens.join(texts.select(F.col("first_doc").alias("doc_id")), "doc_id", "left_semi")
    job = _lay_out(firsts, model.vocab, texts, s.block_words, limit)
    alphas, pad_key = [_schedule(s.alpha, epoch, max_iter) for epoch in range(max_iter)], job.pad_key
    rows = job.encoded.withColumn("pos", F.lit(0)).select("doc_id", "block", "para_id", "ids", "pos")

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _settle_block(left.sort_by("doc_id").to_pandas(), right.to_pandas(), s, alphas, pad_key)
        return pa.Table.from_pandas(found, _SETTLED, preserve_index=False)

    pulled = _pulled(job, learnt.unionByName(started), s, limit)
    found = (
        spread_groups(rows, job.blocks, "block")
        .groupBy("block")
        .cogroup(spread_groups(pulled, job.blocks, "block").groupBy("block"))
        .applyInArrow(settle, "key long, vec array<double>, n long, epoch int, error double")
    )
    found = materialize(found, "inferred")
    trained = found.filter(F.col("key") >= 0).select("key", "vec")
    fresh = ParagraphModel(s, model.vocab, texts, materialize(learnt.unionByName(trained), "weights"))
    sums = found.filter(F.col("key") < 0).groupBy("epoch").agg(F.sum("error").alias("error")).collect()
    by_epoch = {r["epoch"]: r["error"] for r in sums}
    release(found, started, *job.written)
    fresh.epochs = [(e, float(alphas[e]), s.batch, float(by_epoch[e])) for e in sorted(by_epoch)]
    return fresh


# ---------------------------------------------------------------- inputs and neighbours


def pvdm_input(
    windows: DataFrame, word_vectors: DataFrame, paragraph_vectors: DataFrame, mode: str = "mean", limit: int | None = None
) -> DataFrame:
    """``(doc_id, pos, target, input)``: the vector a window hands to the tree.

    ``windows(doc_id, pos, target, context)``, ``word_vectors(id, vec)``,
    ``paragraph_vectors(doc_id, vec)``. The paragraph comes first, then all window vectors
    one after another (``concat``) or their mean (``mean``).
    """
    if mode not in ("concat", "mean"):
        raise ValueError("mode must be concat or mean")

    def work(part: Part) -> Iterator[list[pa.Array]]:
        owned = part.rows["doc_id"].to_pylist()
        for low, high, run in part.row_runs(part.matrix.shape[1]):
            at = part.at[run]
            found = at != part.missing
            n = np.bincount(part.owner[run][found] - low, minlength=high - low)
            kept = np.array([n[i - low] > 0 and owned[i] in part.owners for i in range(low, high)], bool)
            if not kept.any():
                continue
            words = part.matrix[at[found & kept[part.owner[run] - low]]]
            own = np.stack([part.owners[owned[i]] for i in low + np.flatnonzero(kept)])
            n = n[kept]
            if mode == "mean":
                window = np.add.reduceat(words, np.cumsum(n) - n, axis=0) / n[:, None]
                inputs = lists(np.concatenate([own, window], axis=1))
            elif (n == n[0]).all():
                inputs = lists(np.concatenate([own, words.reshape(len(n), -1)], axis=1))
            else:  # slots without a vector are left out
                inputs = pa.array([np.concatenate([o, w.ravel()]) for o, w in zip(own, np.split(words, np.cumsum(n)[:-1]))])
            rows = pa.array(low + np.flatnonzero(kept))
            yield [*[part.rows[c].take(rows) for c in ("doc_id", "pos", "target")], inputs]

    id = word_vectors.schema["id"].dataType.simpleString()
    rows = windows.select("doc_id", "pos", "target", F.col("context").cast(f"array<{id}>").alias("context"))
    kept = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", "pos", "target"))
    owners = paragraph_vectors.select(F.col("doc_id").cast(rows.schema["doc_id"].dataType).alias("doc_id"), "vec")
    return map_blocks(
        rows, "doc_id", "context", word_vectors, "id", work, f"{kept}, input array<double>", owners.filter("doc_id IS NOT NULL"),
        block_words=4 * ROW_WORDS, limit=limit,
    )


def normalize_paragraphs(paragraph_vectors: DataFrame, replace: bool = False) -> DataFrame:
    """Add the unit vector as ``unit``, or put it in the place of ``vec``."""
    return paragraph_vectors.withColumn("vec" if replace else "unit", l2_normalize(F.col("vec")))


def most_similar_paragraph(
    questions: DataFrame, paragraph_vectors: DataFrame, texts: DataFrame, topn: int = 10
) -> DataFrame:
    """``(question_id, text, id, score, rank)``: nearest paragraphs to a weighted mean.

    ``questions(question_id, text, weight[, vec])`` names paragraphs by their text, or gives
    raw vectors. The paragraphs of a question are left out of its answer.
    """
    named = paragraph_vectors.join(texts, "para_id").select(F.col("para_id").alias("id"), "text", "vec")
    return most_similar(questions, named, topn, item="text")
