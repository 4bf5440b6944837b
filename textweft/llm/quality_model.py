"""A quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of 64 words that together hold all its words. Each passage is
encoded from hashed byte trigrams, the shares of byte classes and repeated words; a layer that
is learnt from the labels turns this into an embedding. A gated attention (a tanh and a sigmoid
layer, multiplied) weighs the passages, and the weighted embedding is scored. Only document
labels teach it, on a sample of about ``SAMPLE`` labelled rows with at most ``PASSAGES`` passages
each, which bounds what reaches the driver; every text is scored by all its passages where it
lies, without a shuffle.
"""

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textweft.llm.common import drawn_rows, map_columns, words_of
from textweft.scratch import materialize

SAMPLE = 4096
PASSAGES = 32  # of a text that teaches, drawn by its id
PASSAGE_WORDS = 64
GRAMS = 64  # places that the hashes of three bytes in a row are counted in
HIDDEN, GATE = 16, 8
STEPS = 400
TRIGRAM_DECAY = 1e-2

_CLASSES = (b"\n", b".", b",", b"!", b"?", b"#*$%&", b"|", b"<>", b"\"'", b"()[]{}", b"0123456789", b"=_/\\@+-:;")
_N_CLASSES = len(_CLASSES) + 6
_PLAIN = _N_CLASSES + 4
WIDTH = _PLAIN + GRAMS


def _class_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.int64)  # 0: whatever is not named below
    for at, members in enumerate(_CLASSES):
        table[list(members)] = at + 1
    rest = len(_CLASSES) + 1
    table[list(b" \t\r\v\f")] = rest
    table[ord("a") : ord("z") + 1] = rest + 1
    table[ord("A") : ord("Z") + 1] = rest + 2
    table[0x80:0xC0] = rest + 3
    table[0xC0:] = rest + 4
    return table


_CLASS_OF = _class_table()
_SIZES = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


def passages(text: str | None) -> np.ndarray:
    """One row of features per passage of 64 words; a text without words is one passage of zeros.

    Bytes and their trigrams are counted over the words joined by single spaces; a trigram belongs
    to the passage it starts in.
    """
    words = words_of(text)
    if not words:
        return np.zeros((1, WIDTH), dtype=np.float32)
    starts = range(0, len(words), PASSAGE_WORDS)
    parts = [words[s : s + PASSAGE_WORDS] for s in starts]
    joined = [b" ".join(part) for part in parts]
    sizes = np.array([len(j) + 1 for j in joined])
    n = len(parts)
    data = np.frombuffer(b" ".join(joined) + b" ", np.uint8)
    owner = np.repeat(np.arange(n), sizes)
    words_in = np.array([len(p) for p in parts], np.float64)
    rows = np.zeros((n, WIDTH))
    counts = np.bincount(owner * _N_CLASSES + _CLASS_OF[data], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES)
    counts[np.arange(n), _CLASS_OF[ord(" ")]] -= 1  # the space behind the passage
    rows[:, :_N_CLASSES] = counts / words_in[:, None]
    rows[:, _N_CLASSES] = [sum(map(bytes.__eq__, p, p[1:])) for p in parts] / words_in
    rows[:, _N_CLASSES + 1] = [len(set(p)) for p in parts] / words_in
    rows[:, _N_CLASSES + 2] = (sizes - 1) / words_in / 10
    rows[:, _N_CLASSES + 3] = np.log1p(words_in) / 5
    if len(data) > 2:
        folded = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
        gram = folded[:-2] * _SIZES[0] + folded[1:-1] * _SIZES[1] + folded[2:] * _SIZES[2]
        gram = (gram ^ (gram >> np.uint32(15))) % np.uint32(GRAMS)
        found = np.bincount(owner[:-2] * GRAMS + gram, minlength=n * GRAMS).reshape(n, GRAMS)
        rows[:, _PLAIN:] = found / sizes[:, None] * 10
    return rows.astype(np.float32)


def taught_passages(text: str | None, id: object, most: int = PASSAGES) -> np.ndarray:
    """At most ``most`` passages of a text, drawn by its id."""
    rows = passages(text)
    if len(rows) <= most:
        return rows
    drawn = np.random.default_rng(zlib.crc32(str(id).encode())).choice(len(rows), most, replace=False)
    return rows[np.sort(drawn)]


class Model:
    """Standardisation, embedding, gated attention and scorer."""

    def __init__(self, bags: list[np.ndarray], labels: np.ndarray, seed: int = 5, steps: int = STEPS):
        self.constant = float(labels.mean()) if len(labels) else 0.5
        self.fitted = len(labels) > 0 and 0.0 < self.constant < 1.0
        if self.fitted:
            x = np.concatenate(bags)
            self.centre, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-3
            self._fit(self._scaled(x), np.cumsum([0, *[len(b) for b in bags]])[:-1], labels.astype(float), seed, steps)

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.spread
        return np.sign(z) * np.log1p(np.abs(z))

    def _forward(self, x: np.ndarray, starts: np.ndarray) -> tuple:
        w, b, v, u, a, c, d = self.weights
        h = np.tanh(x @ w + b)
        t, s = np.tanh(h @ v), 1 / (1 + np.exp(-(h @ u)))
        sizes = np.diff(np.append(starts, len(x)))
        # weights rise with the number of passages, so that one telling passage is not outweighed by many
        sharp = np.repeat(1 + np.log(sizes), sizes)
        e = (t * s) @ a * sharp
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        attention = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(attention[:, None] * h, starts, axis=0)
        return h, t, s, attention, z, 1 / (1 + np.exp(-(z @ c + d))), sizes, sharp

    def _fit(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray, seed: int, steps: int) -> None:
        random = np.random.default_rng(seed)
        shapes = [(x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN, GATE), (HIDDEN, GATE), (GATE,), (HIDDEN,), ()]
        self.weights = [random.normal(0, 0.3 if len(s) else 0.0, s) for s in shapes]
        self.weights[0][_PLAIN:] = 0.0  # trigrams start without a say, and pay for one
        decay = [np.full(s, 1e-4) for s in shapes]
        decay[0][_PLAIN:] = TRIGRAM_DECAY
        first, second = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
        for step in range(1, steps + 1):
            h, t, s, attention, z, p, sizes, sharp = self._forward(x, starts)
            w, b, v, u, a, c, d = self.weights
            error = (p - y) / len(y)
            by_passage = np.repeat(error, sizes)
            pull = h @ c
            mean_pull = np.repeat(z @ c, sizes)
            g_e = by_passage * attention * (pull - mean_pull) * sharp  # through the softmax
            g_t, g_s = g_e[:, None] * a * s * (1 - t * t), g_e[:, None] * a * t * s * (1 - s)
            g_h = (by_passage * attention)[:, None] * c + g_t @ v.T + g_s @ u.T
            g_in = g_h * (1 - h * h)
            grads = [x.T @ g_in, g_in.sum(axis=0), h.T @ g_t, h.T @ g_s, (t * s).T @ g_e, z.T @ error, error.sum()]
            for i, (weight, grad) in enumerate(zip(self.weights, grads)):
                grad = grad + decay[i] * weight
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad * grad
                rate = 0.02 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                self.weights[i] = weight - rate * first[i] / (np.sqrt(second[i]) + 1e-8)

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if not self.fitted or not bags:
            return np.full(len(bags), self.constant)
        return self._forward(self._scaled(np.concatenate(bags)), np.cumsum([0, *[len(b) for b in bags]])[:-1])[5]


def held_out(id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 1 modulo 3; a null id does not."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_quality_model(
    docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", label: str = "quality", sample: int = SAMPLE
) -> Model:
    """Fit on about ``sample`` labelled rows that are not held out, those with the least id digest.

    Rows without id or label teach nothing, an id with two labels counts as good, and of a
    repeated id one row teaches. The sampled labels are few enough to meet the documents by
    broadcast.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull() & ~held_out(F.col(id)))
    known = known.groupBy(F.col(id).alias("_known")).agg((F.max(label) > 0).cast("int").alias("_good"))
    known = materialize(known, "known-labels")
    drawn = materialize(drawn_rows(known, sample, F.xxhash64("_known")), "drawn-labels")
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(drawn), F.col("_id") == F.col("_known")).select("_id", "_good", "text")
    adds = T.StructType([T.StructField("bag", T.BinaryType())])

    def work(columns: dict[str, list]) -> dict[str, list]:
        bags = [taught_passages(text, id) for text, id in zip(columns["text"], columns["_id"])]
        return {"bag": [bag.astype(np.float16).tobytes() for bag in bags]}

    encoded = map_columns(rows, ["text", "_id"], adds, work, keep=["_id", "_good"])
    taught = encoded.groupBy("_id").agg(F.min(F.struct("_good", "bag")).alias("row")).select("_id", "row.*").collect()
    taught.sort(key=lambda r: str(r["_id"]))
    bags = [np.frombuffer(r["bag"], np.float16).astype(np.float32).reshape(-1, WIDTH) for r in taught]
    return Model(bags, np.array([r["_good"] for r in taught], dtype=float))


def score_quality(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) for each whole text.

    Null and empty texts are scored as one passage without words; equal texts get equal
    scores and repeated rows stay repeated. A model taught by one label only, or by none,
    gives every text that label's share, 0.5 without any. Columns named like a result are
    replaced; no other column is read.
    """
    adds = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def work(columns: dict[str, list]) -> dict[str, list]:
        scores = model.scores([passages(value) for value in columns[text]]).tolist()
        return {"score": scores, "predicted": [int(s >= 0.5) for s in scores]}

    return map_columns(docs, [text], adds, work, keep)
