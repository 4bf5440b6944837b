"""Quality rules: rule statistics, and an isolation forest that judges them.

Every document gets the counts that heuristic rules look at. A document fails outright when
it has too few words or repeats too much of itself. An isolation forest over the statistics
judges the rest: trees of random splits, grown on small random draws, isolate unusual
documents on short paths. Its score counts as a rejection from a threshold on that is
calibrated on all labelled rows, so that no more than ``LOST`` of those marked good go.

The forest is grown on a sample of at most ``SAMPLE`` labelled rows, chosen by the least
digest of their statistics' row; counts, scores and the calibration cover every row.
"""

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textweft.llm.common import drawn_rows, map_columns
from textweft.scratch import materialize

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
SAMPLE = 8192
TREES = 128
DRAW = 256
LOST = 0.005
SCORE_BINS = 2000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_upper", "n_punctuation", "n_same")
_UPPER = bytes(range(65, 91))
_PUNCTUATION = b"!?.,;:"


def _drop(data: bytes, gone: bytes) -> int:
    return len(data) - len(data.translate(None, gone))


def rule_counts(text: str | None) -> tuple[int, ...]:
    """The numbers named in ``COUNTS`` and ``MORE`` for one text; zeros for null."""
    if not text:
        return (0,) * len(COUNTS + MORE)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    blanks = _drop(data, b" \t\n\r\v\f")
    lines = Counter(line for line in data.split(b"\n") if line.strip(b" \t\n\r\v\f"))
    repeated, n = 0, len(words)
    windows = list(zip(*[words[i:] for i in range(WINDOW)]))
    seen = Counter(windows)
    if len(seen) < len(windows):
        end = 0  # words before this place are counted
        for at, window in enumerate(windows):
            if seen[window] > 1:
                repeated += at + WINDOW - max(end, at)
                end = at + WINDOW
    return (
        n,
        len(text) - blanks,
        _drop(data, SYMBOLS),
        sum(c - 1 for c in lines.values()),
        repeated,
        _drop(data, _UPPER) if data.isascii() else sum(map(str.isupper, text)),
        _drop(data, _PUNCTUATION),
        sum(map(bytes.__eq__, words, words[1:])),
    )


def shares(counts: np.ndarray) -> np.ndarray:
    """Statistics that do not grow with a text and are damped for short ones, one row each."""
    n, chars, symbols, lines, repeats, upper, marks, same = counts.T.astype(float)
    return np.stack(
        [
            symbols / (n + 5),
            upper / (chars + 50),
            marks / (n + 10),
            (chars + 60) / (n + 10),
            lines / (n + 50),
            repeats / (n + 10),
            same / (n + 10),
        ],
        axis=1,
    )


LEAST_RANGE = np.array([0.05, 0.05, 0.2, 1.0, 0.05, 0.1, 0.05])  # of each statistic
MARGIN = 0.25  # of a statistic's range, beyond which it is an excess


class Rules:
    """The range of each statistic among good documents; what lies outside is an excess."""

    def __init__(self, good: np.ndarray):
        ends = np.quantile(good, [0.001, 0.999], axis=0) if len(good) else np.array([[-np.inf], [np.inf]]) * np.ones(7)
        self.low, self.high = ends
        self.range = np.maximum(self.high - self.low, LEAST_RANGE)

    def excess(self, counts: np.ndarray) -> np.ndarray:
        x = shares(counts)
        beyond = np.maximum(np.maximum(x - self.high, self.low - x) / self.range - MARGIN, 0.0)
        return beyond / (1.0 + beyond)


def path_scale(n: float) -> float:
    """The mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n if n > 2 else 1.0


class Forest:
    """Isolation trees as arrays: feature, cut, children, and path length at leaves."""

    def __init__(self, rows: np.ndarray, seed: int = 7, trees: int = TREES, draw: int = DRAW):
        random = np.random.default_rng(seed)
        draw = min(draw, len(rows))
        self.scale = max(path_scale(draw), 1e-9)
        self.depth = max(1, math.ceil(math.log2(max(draw, 2))))
        self.trees = [self._grow(rows[random.choice(len(rows), draw, replace=False)], random) for _ in range(trees)]

    def _grow(self, rows: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, cut, left, right, path = [], [], [], [], []

        def add(part: np.ndarray, depth: int) -> int:
            at = len(feature)
            for column, value in ((feature, -1), (cut, 0.0), (left, at), (right, at), (path, 0.0)):
                column.append(value)
            low, high = part.min(axis=0), part.max(axis=0)
            open_ = np.flatnonzero(high > low)
            if depth >= self.depth or len(part) <= 1 or not len(open_):
                path[at] = depth + path_scale(len(part))
                return at
            feature[at] = int(random.choice(open_))
            cut[at] = float(random.uniform(low[feature[at]], high[feature[at]]))
            below = part[:, feature[at]] < cut[at]
            left[at], right[at] = add(part[below], depth + 1), add(part[~below], depth + 1)
            return at

        if len(rows):
            add(rows, 0)
        return tuple(np.array(x) for x in (feature, cut, left, right, path))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly scores between 0 and 1, higher for shorter paths."""
        if not len(rows) or not self.trees or not len(self.trees[0][0]):
            return np.full(len(rows), 0.5)
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for feature, cut, left, right, path in self.trees:
            at = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth):
                split = feature[at]
                at = np.where(rows[every, split] < cut[at], left[at], right[at])
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / self.scale)


ADDS = T.StructType([T.StructField(name, T.LongType()) for name in COUNTS + MORE])


def with_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add the counts of ``COUNTS`` and ``MORE`` for each whole text."""

    def work(columns: dict[str, list]) -> dict[str, list]:
        rows = [rule_counts(value) for value in columns[text]]
        return {name: [r[i] for r in rows] for i, name in enumerate(COUNTS + MORE)}

    return map_columns(docs, [text], ADDS, work, keep)


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge_base(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


class Judge:
    """Rules and forest, fitted on sampled counts and whether each row is good."""

    def __init__(self, counts: np.ndarray, good: np.ndarray, seed: int = 7):
        self.rules = Rules(shares(counts[good]))
        self.forest = Forest(self.rules.excess(counts), seed)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return self.forest.scores(self.rules.excess(counts))


NAMES = [*COUNTS, *MORE]


def fit_judge(labelled: DataFrame, label: str, sample: int = SAMPLE, seed: int = 7) -> Judge:
    """Fit on at most ``sample`` rows of ``labelled`` counts that pass the base rules.

    Rows are drawn by ``doc_id``, so that many copies of one text fill no more of the sample than
    their share of the rows. Of an id that is repeated one row is drawn.
    """
    passed = labelled.filter(~base_failed()).select("doc_id", *NAMES, label)
    drawn = drawn_rows(passed, sample, F.xxhash64(F.lit(seed), "doc_id"))
    drawn = drawn.groupBy("doc_id").agg(F.min(F.struct(*NAMES, label)).alias("row")).select("row.*").collect()
    rows = sorted(tuple(r) for r in drawn)  # one order, whatever the partitions were
    if len(rows) > sample:
        rows = [rows[i] for i in np.sort(np.random.default_rng(seed).choice(len(rows), sample, replace=False))]
    counts = np.array([r[:-1] for r in rows], dtype=np.int64).reshape(-1, len(NAMES))
    return Judge(counts, np.array([bool(r[-1]) for r in rows], dtype=bool), seed)


def with_score(counted: DataFrame, judge: Judge, keep: list[str]) -> DataFrame:
    def work(columns: dict[str, list]) -> dict[str, list]:
        counts = np.array([columns[n] for n in NAMES], dtype=np.int64).T.reshape(-1, len(NAMES))
        return {"anomaly": judge.scores(counts).tolist()}

    return map_columns(counted, NAMES, T.StructType([T.StructField("anomaly", T.DoubleType())]), work, keep)


def calibrate(scored: DataFrame, label: str, lost: float = LOST) -> float:
    """The threshold that parts good from bad rows best, losing at most ``lost`` of the good.

    All labelled rows count, through a histogram of fixed size. Without rows of both
    labels nothing is rejected.
    """
    bin_ = F.least(F.lit(SCORE_BINS - 1), F.floor(F.col("anomaly") * SCORE_BINS)).cast("int")
    rows = scored.groupBy(bin_.alias("bin"), F.col(label).alias("good")).count().collect()
    good, bad = np.zeros(SCORE_BINS), np.zeros(SCORE_BINS)
    for r in rows:
        if r["good"] is not None:
            (good if r["good"] else bad)[r["bin"]] += r["count"]
    if not good.sum() or not bad.sum():
        return math.inf
    rejected_good = good[::-1].cumsum()[::-1] / good.sum()  # with a threshold at the bin's start
    rejected_bad = bad[::-1].cumsum()[::-1] / bad.sum()
    gain = np.where(rejected_good <= lost, rejected_bad - rejected_good, -1.0)
    best = int(gain.argmax())
    return best / SCORE_BINS if gain[best] > 0 else math.inf


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    label: str = "quality",
    sample: int = SAMPLE,
    lost: float = LOST,
) -> tuple[DataFrame, Judge, float]:
    """The counts of all documents by ``doc_id``, what was fitted, and its threshold.

    Only counts meet the labels, so texts are not shuffled. Rows without an id or a label
    teach nothing; an id with two labels counts as good.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull())
    known = known.groupBy(F.col(id).alias("doc_id")).agg(F.max(label).alias("good"))
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    counted = materialize(with_counts(rows, keep=["doc_id"]), "rule-counts")
    labelled = materialize(counted.join(known, "doc_id").select("doc_id", *NAMES, "good"), "labelled-counts")
    judge = fit_judge(labelled, "good", sample)
    return counted, judge, calibrate(with_score(labelled.filter(~base_failed()), judge, ["good"]), "good", lost)


VERDICT = T.StructType(
    [
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("anomaly", T.DoubleType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def verdicts(counts: np.ndarray, judge: Judge, threshold: float) -> dict[str, list]:
    failed, anomaly = judge_base(counts), judge.scores(counts)
    kept = ~failed & (anomaly < threshold)
    return {"base_failed": failed.tolist(), "anomaly": anomaly.tolist(), "kept": kept.tolist()}


def judge_counts(counted: DataFrame, judge: Judge, threshold: float, keep: list[str]) -> DataFrame:
    """Verdicts for rows whose counts are there already."""

    def work(columns: dict[str, list]) -> dict[str, list]:
        counts = np.array([columns[n] for n in NAMES], dtype=np.int64).T.reshape(-1, len(NAMES))
        return verdicts(counts, judge, threshold)

    return map_columns(counted, NAMES, VERDICT, work, keep)


def judge_texts(docs: DataFrame, judge: Judge, threshold: float, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Counts and verdicts for texts, row by row, with what was fitted before."""

    def work(columns: dict[str, list]) -> dict[str, list]:
        counts = np.array([rule_counts(value) for value in columns[text]], dtype=np.int64).reshape(-1, len(NAMES))
        return {name: counts[:, i].tolist() for i, name in enumerate(COUNTS)} | verdicts(counts, judge, threshold)

    adds = T.StructType([*ADDS.fields[: len(COUNTS)], *VERDICT.fields])
    return map_columns(docs, [text], adds, work, keep)


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    label: str = "quality",
    keep: list[str] | None = None,
    sample: int = SAMPLE,
    lost: float = LOST,
) -> DataFrame:
    """Add the counts, ``base_failed``, ``anomaly`` and ``kept`` to each document.

    Labels teach only the forest, the range of each statistic among good rows, and the
    threshold. Null and empty texts have no words and fail. Equal texts get equal verdicts,
    repeated rows stay repeated, and columns named like a result are replaced. Without
    labels, or with labels of one kind only, the base rules alone decide; an empty table
    gives an empty result.
    """
    _, judge, threshold = fit_quality(docs, labels, text, id, label, sample, lost)
    return judge_texts(docs, judge, threshold, text, keep)
