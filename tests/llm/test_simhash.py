"""SimHash near-duplicates against a brute-force version."""

import random

import numpy as np
import pytest
import xxhash

from textweft.llm import simhash
from textweft.llm.simhash import fingerprint, fingerprint_links, group_bits, keep_one_of_each, near_duplicates


def slow_fingerprint(text, size=3):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [w for w in "".join(" " if c in "\t\n\r\v\f" else c for c in (text or "").translate(fold)).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def slow_components(prints):
    """Least id reachable by steps of at most two bits; ``prints`` are ``(id, fingerprint)``."""
    least = {}
    for start in {p for _, p in prints}:
        least.setdefault(start, min((i for i, p in prints if p == start and i is not None), default=None))
    values, group = sorted(least), {}
    for value in values:
        if value in group:
            continue
        reached, queue = {value}, [value]
        while queue:
            at = queue.pop()
            for other in values:
                if other not in reached and bin((at ^ other) & (1 << 64) - 1).count("1") <= 2:
                    reached.add(other)
                    queue.append(other)
        ids = [least[v] for v in reached if least[v] is not None]
        group.update(dict.fromkeys(reached, min(ids, default=None)))
    return group


def texts():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(300)]
    rows = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 30, 300]))) for _ in range(60)]
    for text in list(rows):
        words = text.split()
        for _ in range(3):
            copy = list(words)
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
    return rows + rows[:9] + [None, "", " \n", rows[3].upper(), "  ".join(rows[4].split()), "x " * 5000, "x y z " * 20_000]


@pytest.mark.parametrize("text", [None, "", "a", "A b", "a b c", "É é a\tb\vc d", "x y " * 700, "a\x1fb c\x85d e f g"])
def test_fingerprint(text):
    assert fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("hot", [10_000, 3])
def test_groups_equal_brute_force(spark, hot):
    rows = [(i if i != 17 else None, t, "x", i) for i, t in enumerate(texts())]
    rows.append((5, rows[5][1], "again", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, root long")
    got = near_duplicates(docs, hot=hot).collect()
    marked = [(i, slow_fingerprint(t)) for i, t, _, _ in rows]
    group = slow_components(marked)
    assert sorted(map(str, ((r.doc_id, r.fingerprint, r.component_id) for r in got))) == sorted(
        map(str, ((i, p, group[p]) for i, p in marked))
    )


@pytest.mark.parametrize("reach", [0, 1, 2])
@pytest.mark.parametrize("hot", [10_000, 1])
def test_links_connect_exactly_what_is_near(spark, reach, hot):
    rng = random.Random(reach)
    centres = [rng.getrandbits(64) for _ in range(12)]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(40)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), reach, hot).collect()

    def roots(pairs):
        parent = {v: v for v in signed}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[max(root(a), root(b))] = min(root(a), root(b))
        return {v: root(v) for v in signed}

    near = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= reach]
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= reach for r in links)
    assert roots([(r.a, r.b) for r in links]) == roots(near)


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40] = bits[:, 3]
    bits[:, 21] = bits[:, 3]
    parts = group_bits((bits.T @ bits).astype(float), 4000.0, 3)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert any({3, 21, 40} <= set(p) for p in parts)


def test_thresholds_add_up(spark):
    plan = simhash.make_plan(spark.createDataFrame([(i * 7919 << 13 ^ i,) for i in range(500)], "fp long"), 2)
    bits = simhash._bits_of(np.arange(50, dtype=np.int64) * 104729)
    thresholds, cost = plan.allocate(bits)
    assert (thresholds.sum(axis=0) == 2 - len(plan.parts) + 1).all() and (cost > 0).all()


def test_one_row_of_each_group_stays(spark):
    rows = [(2, "a b c", 1), (1, "A b  c", 2), (1, "A b  c", 2), (4, None, 3), (3, "", 4), (None, "q r s t", 5), (None, "Q r s t", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id long")
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), (r.text or "").lower().split()) for r in kept.collect()) == [
        ("1", ["a", "b", "c"]),
        ("3", []),
        ("None", ["q", "r", "s", "t"]),
    ]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).collect() == [] and keep_one_of_each(docs).collect() == []
