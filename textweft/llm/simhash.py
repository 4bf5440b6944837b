"""SimHash near-duplicates found by the generalised pigeonhole principle.

Texts with the same 64-bit fingerprint are one class, so copies never multiply pairs. The
distinct fingerprints are cut into ``m`` partitions of bits, correlated bits together. If
two fingerprints differ in at most ``t`` bits and the partitions have thresholds that add up
to ``t - m + 1`` (a partition may have -1 and is then skipped), then in some partition they
differ in no more bits than its threshold. For every fingerprint dynamic programming deals
out the thresholds at the least estimated cost: probes, and candidates estimated from
histograms of sub-partitions. Probes meet the index on ``(partition, value)`` and each
candidate's distance is checked inside that join. The number of partitions with the least
cost over all fingerprints is taken, so it follows the size of the corpus.

A partition value held by more than ``HOT`` fingerprints is not joined. Its fingerprints are
linked through keys one flipped bit away: two fingerprints at most two bits apart share such
a key, all that share one are at most two apart, and no key has more than 65.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textweft.llm.common import LOWER_ASCII, free_name, map_columns, tidy
from textweft.llm.components import connected_components
from textweft.scratch import materialize

BITS = 64
HOT = 10_000
PROBE_COST = 8.0  # what a probe costs against a compared candidate
PARTITIONS = (2, 3, 4)
MERGERS = 8  # rows of summed statistics that reach the driver
SUB_BITS = 11  # histograms of sub-partitions have at most 2**11 bins
_LANES = np.array([sum(1 << (8 * i) for i in range(8) if b >> i & 1) for b in range(256)], dtype=np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set, added in byte lanes 255 at a time."""
    lanes = _LANES[hashes.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    return sums.view(np.uint8).reshape(len(sums), BITS).sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, size: int = 3) -> int:
    """The SimHash of the shingles of ``size`` words, as a signed 64-bit number; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER_ASCII).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    count = max(1, len(words) - size + 1)
    last = (ends - 1).tolist()[min(size, len(words)) - 1 :]
    xxh = xxhash.xxh64_intdigest
    hashes = np.array([xxh(joined[s:e], 42) for s, e in zip(starts[:count], last)], dtype=np.uint64)
    bits = bit_counts(hashes) * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def with_fingerprint(
    docs: DataFrame, size: int = 3, text: str = "text", name: str = "fingerprint", keep: list[str] | None = None
) -> DataFrame:
    """Add each row's fingerprint; null and empty texts have 0."""

    def work(columns: dict[str, list]) -> dict[str, list]:
        return {name: [fingerprint(value, size) for value in columns[text]]}

    return map_columns(docs, [text], T.StructType([T.StructField(name, T.LongType())]), work, keep)


def _bits_of(prints: np.ndarray) -> np.ndarray:
    raw = np.ascontiguousarray(prints.astype(np.int64)).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little")


def _summed(prints: DataFrame, count: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """Add up an array of fixed length over all fingerprints, in tasks and then in ``MERGERS``.

    Every task hands on one row whatever its number of fingerprints; None without any.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = count(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float64)
                total = part if total is None else total + part
        yield _sum_row(total)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                part = np.frombuffer(value.as_buffer(), np.float64)
                total = part.copy() if total is None else total + part
        yield _sum_row(total)

    rows = prints.select("fp").mapInArrow(tidy(run), "sums binary").repartition(MERGERS).mapInArrow(tidy(merge), "sums binary")
    parts = [np.frombuffer(r["sums"], np.float64) for r in rows.collect()]
    return np.sum(parts, axis=0) if parts else None


def _sum_row(total: np.ndarray | None) -> pa.RecordBatch:
    rows = [] if total is None else [total.tobytes()]
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["sums"])


def group_bits(together: np.ndarray, total: float, m: int) -> list[list[int]]:
    """``m`` partitions of about equal width; each grows by the bit most correlated with it."""
    share = np.diag(together) / max(total, 1)
    cov = together / max(total, 1) - np.outer(share, share)
    spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    tied = np.abs(cov / np.outer(spread, spread))
    left, parts = list(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        pairs = tied[np.ix_(left, left)] - 2 * np.eye(len(left))
        part = [left[int(pairs.max(axis=1).argmax())]]
        left.remove(part[0])
        while len(part) < width:
            best = max(left, key=lambda b: (tied[b, part].sum(), -b))
            part.append(best)
            left.remove(best)
        parts.append(sorted(part))
    return parts


def _values(bits: np.ndarray, part: list[int]) -> np.ndarray:
    return bits[:, part].astype(np.int64) @ (1 << np.arange(len(part), dtype=np.int64))


def _subs(part: list[int]) -> list[list[int]]:
    pieces = -(-len(part) // SUB_BITS)
    return [part[i::pieces] for i in range(pieces)]


def _near_counts(histogram: np.ndarray, width: int, reach: int) -> np.ndarray:
    """For every value of a sub-partition, how many rows differ from it in 0, 1, … bits."""
    values = np.arange(1 << width)
    at = [histogram]
    if reach >= 1:
        flips = [histogram[values ^ (1 << i)] for i in range(width)]
        at.append(np.sum(flips, axis=0))
    if reach >= 2:
        twice = [histogram[values ^ (1 << i) ^ (1 << j)] for i in range(width) for j in range(i)]
        at.append(np.sum(twice, axis=0) if twice else np.zeros_like(histogram))
    return np.stack(at)


class Plan:
    """Partitions of the bits and the estimates that deal out thresholds."""

    def __init__(self, parts: list[list[int]], near: list[list[np.ndarray]], total: float, reach: int):
        self.parts, self.near, self.total, self.reach = parts, near, max(total, 1.0), reach

    def costs(self, bits: np.ndarray) -> np.ndarray:
        """Estimated cost ``[partition, threshold + 1, fingerprint]``."""
        n, reach = len(bits), self.reach
        out = np.zeros((len(self.parts), reach + 2, n))
        for i, part in enumerate(self.parts):
            exact = None  # expected rows that differ in exactly d bits of the partition
            for sub, near in zip(_subs(part), self.near[i]):
                here = near[:, _values(bits, sub)]
                if exact is None:
                    exact = here
                else:
                    exact = np.stack([sum(exact[a] * here[d - a] for a in range(d + 1)) for d in range(reach + 1)]) / self.total
            probes = 0.0
            for t in range(reach + 1):
                probes += [1, len(part), len(part) * (len(part) - 1) / 2][t]
                out[i, t + 1] = exact[: t + 1].sum(axis=0) + PROBE_COST * probes
        return out

    def allocate(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Thresholds ``[partition, fingerprint]`` that add up to ``reach - m + 1``, and their cost."""
        costs, budget, n = self.costs(bits), self.reach + 1, len(bits)
        best = np.full((budget + 1, n), np.inf)
        best[0] = 0.0
        taken = []
        for cost in costs:  # spend threshold + 1 on each partition, reach + 1 in all
            options = np.full((budget + 1, budget + 1, n), np.inf)
            for spent in range(budget + 1):
                for own in range(spent + 1):
                    options[spent, own] = best[spent - own] + cost[own]
            taken.append(options.argmin(axis=1))
            best = options.min(axis=1)
        thresholds = np.zeros((len(self.parts), n), dtype=np.int64)
        spent, rows = np.full(n, budget), np.arange(n)
        for i in reversed(range(len(self.parts))):
            own = taken[i][spent, rows]
            thresholds[i] = own - 1
            spent = spent - own
        return thresholds, best[budget]

    def probes(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(partition, value, row)`` for every value within a fingerprint's thresholds."""
        bits = _bits_of(prints)
        thresholds, _ = self.allocate(bits)
        kinds, values, rows = [], [], []
        for i, part in enumerate(self.parts):
            flips = [np.zeros(1, np.int64), 1 << np.arange(len(part), dtype=np.int64)]
            flips.append(np.array([1 << a | 1 << b for a in range(len(part)) for b in range(a)], dtype=np.int64))
            own = _values(bits, part)
            for t in range(self.reach + 1):
                at = np.flatnonzero(thresholds[i] >= t)
                if len(at) and len(flips[t]):
                    found = (own[at][:, None] ^ flips[t][None, :]).ravel()
                    values.append(found)
                    rows.append(np.repeat(at, len(flips[t])))
                    kinds.append(np.full(len(found), i))
        return np.concatenate(kinds), np.concatenate(values), np.concatenate(rows)


def make_plan(prints: DataFrame, reach: int) -> Plan:
    """Measure the distinct fingerprints ``(fp)`` and choose the cheapest partitioning."""

    def together(p: np.ndarray) -> np.ndarray:
        bits = _bits_of(p).astype(np.float32)
        return np.append((bits.T @ bits).astype(np.float64).ravel(), len(p))

    sums = _summed(prints, together)
    sums = np.zeros(BITS * BITS + 1) if sums is None else sums
    total, joint = sums[-1], sums[:-1].reshape(BITS, BITS)
    groups = {m: group_bits(joint, total, m) for m in PARTITIONS}
    subs = [(m, i, sub) for m, parts in groups.items() for i, part in enumerate(parts) for sub in _subs(part)]
    offsets = np.cumsum([0, *[1 << len(sub) for _, _, sub in subs]])

    def histograms(p: np.ndarray) -> np.ndarray:
        bits = _bits_of(p)
        return np.concatenate([np.bincount(_values(bits, sub), minlength=1 << len(sub)) for _, _, sub in subs])

    counts = _summed(prints, histograms)
    counts = np.zeros(offsets[-1]) if counts is None else counts
    plans = {}
    for m, parts in groups.items():
        near: list[list[np.ndarray]] = [[] for _ in parts]
        for k, (of, i, sub) in enumerate(subs):
            if of == m:
                near[i].append(_near_counts(counts[offsets[k] : offsets[k + 1]], len(sub), reach))
        plans[m] = Plan(parts, near, total, reach)

    def cost(p: np.ndarray) -> np.ndarray:
        bits = _bits_of(p)
        return np.array([plan.allocate(bits)[1].sum() for plan in plans.values()])

    spent = _summed(prints, cost)
    return list(plans.values())[0 if spent is None else int(spent.argmin())]


def _emit(prints: DataFrame, rows: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0).to_numpy(zero_copy_only=False)
            for start in range(0, len(whole), 4096):
                prints = whole[start : start + 4096]
                kinds, values, at = rows(prints)
                columns = [pa.array(kinds, pa.int32()), pa.array(values, pa.int64()), pa.array(prints[at], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "value", "fp"])

    return prints.select("fp").mapInArrow(tidy(run), "part int, value long, fp long")


def _flipped_keys(rows: DataFrame, reach: int) -> DataFrame:
    """Links among the fingerprints of crowded values, through keys at most one flip away."""

    def flip(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        masks = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(BITS, dtype=np.uint64)]).view(np.int64)
        keys = (prints[:, None] ^ masks[None, :]).ravel()
        return np.zeros(len(keys), np.int32), keys, np.repeat(np.arange(len(prints)), len(masks))

    keyed = _emit(rows.select("fp").distinct(), flip)
    shared = keyed.groupBy("value").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    if reach == 1:  # one bit apart: the key is itself one of the two
        centre = shared.filter(F.array_contains("fps", F.col("value"))).withColumn("centre", F.col("value"))
    else:
        centre = shared.withColumn("centre", F.array_min("fps"))
    return centre.select(F.explode("fps").alias("a"), F.col("centre").alias("b")).filter("a <> b")


def fingerprint_links(prints: DataFrame, reach: int = 2, hot: int = HOT) -> DataFrame:
    """Links ``(a, b)`` that join exactly the fingerprints ``(fp)`` at most ``reach`` bits apart.

    ``prints`` holds distinct fingerprints, none null; an empty table has no links. Crowded
    values give enough of their links to connect what belongs together, the others all.
    """
    if not 0 <= reach <= 2:
        raise ValueError("fingerprints link at 0, 1 or 2 differing bits")
    if reach == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    plan = make_plan(prints, reach)

    def index(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bits = _bits_of(p)
        values = np.concatenate([_values(bits, part) for part in plan.parts])
        return np.repeat(np.arange(len(plan.parts)), len(p)), values, np.tile(np.arange(len(p)), len(plan.parts))

    indexed, probes = materialize(_emit(prints, index), "index"), _emit(prints, plan.probes)
    crowded = indexed.groupBy("part", "value").count().filter(F.col("count") > hot).select("part", "value")
    crowded = materialize(crowded, "crowded")
    links = None
    if crowded.limit(1).count():
        # a value holds over `hot` fingerprints, and each lies in one value of a partition
        probes = materialize(probes, "probes")
        full = probes.join(crowded, ["part", "value"], "left_semi").select("fp")
        full = full.unionByName(indexed.join(crowded, ["part", "value"], "left_semi").select("fp"))
        links = _flipped_keys(full, reach)
        probes = probes.join(crowded, ["part", "value"], "left_anti")
    left, right = indexed.withColumnRenamed("fp", "a"), probes.withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= reach
    pairs = (
        left.alias("l")
        .join(right.alias("r"), (F.col("l.part") == F.col("r.part")) & (F.col("l.value") == F.col("r.value")) & (F.col("a") != F.col("b")) & near)
        .select("a", "b")
    )
    return pairs if links is None else pairs.unionByName(links)


def fingerprint_groups(
    docs: DataFrame, size: int = 3, reach: int = 2, text: str = "text", id: str = "doc_id", hot: int = HOT
) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc_id, fp)``, and for each distinct ``fp`` its least id and its group's ``root``."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    marked = materialize(with_fingerprint(rows, size, name="fp", keep=["doc_id"]), "fingerprints")
    classes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = connected_components(fingerprint_links(classes.select("fp"), reach, hot)).withColumnRenamed("node", "fp")
    grouped = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return marked, materialize(grouped, "groups")


def near_duplicates(
    docs: DataFrame, size: int = 3, reach: int = 2, text: str = "text", id: str = "doc_id", hot: int = HOT
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    The fingerprint is a signed 64-bit number over shingles of ``size`` words, and the
    component the least id among the rows whose fingerprints can be reached by steps of at
    most ``reach`` bits. Null and empty texts have fingerprint 0 and link like any other.
    Repeated rows stay repeated; a component without any id has a null id; an empty table
    gives an empty result. Other columns are not read.
    """
    marked, grouped = fingerprint_groups(docs, size, reach, text, id, hot)
    least = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialize(grouped.join(least, "root").select("fp", "component_id"), "named")
    return marked.join(named, "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def keep_one_of_each(
    docs: DataFrame, size: int = 3, reach: int = 2, text: str = "text", id: str = "doc_id", hot: int = HOT
) -> DataFrame:
    """The row with the least id of each group of near-duplicates, with all its columns.

    Among rows of that id those with the least fingerprint count, and of several such rows
    one stays. A group without any id keeps one row. Texts are shuffled once, by id; only
    rows whose id is null or repeated are fingerprinted again to tell them apart.
    """
    marked, grouped = fingerprint_groups(docs, size, reach, text, id, hot)
    return keep_first(docs, marked, grouped, lambda d, name: with_fingerprint(d, size, text, name), id)


def keep_first(
    docs: DataFrame, marked: DataFrame, grouped: DataFrame, mark_rows: Callable[[DataFrame, str], DataFrame], id: str = "doc_id"
) -> DataFrame:
    """The row that stands for each ``root`` of ``grouped``; ``mark_rows`` adds a row's ``fp`` under a name."""
    order = F.struct(F.col("first_id").isNull(), "first_id", "fp")
    kept = grouped.groupBy("root").agg(F.min_by(F.struct("first_id", "fp"), order).alias("k")).select("k.*")
    times = marked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).filter("doc_id IS NULL OR times > 1")
    repeated = materialize(times.select("doc_id"), "repeated")
    key, mark, kept_mark = (free_name(docs, n) for n in ("_key", "_mark", "_kept_mark"))
    kept = materialize(kept.select(F.col("first_id").alias(key), F.col("fp").alias(kept_mark)), "kept")
    once = kept.join(repeated, F.col(key) == F.col("doc_id"), "left_anti").filter(F.col(key).isNotNull())
    plain = docs.join(once, F.col(id) == F.col(key), "left_semi")
    if not repeated.limit(1).count():
        return plain
    again = docs.join(repeated.select(F.col("doc_id").alias(key)), F.col(id).eqNullSafe(F.col(key)), "left_semi")
    again = mark_rows(again, mark)
    same = F.col(mark).eqNullSafe(F.col(kept_mark)) & F.col(id).eqNullSafe(F.col(key))
    hard = again.join(kept, same, "left_semi").dropDuplicates([id, mark])
    return plain.unionByName(hard.select(*docs.columns))
