"""Context mixing: a proper distribution, texts in any grouping, gathering in parts; word counts in full."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from textweft.llm import lm_score, mixing
from textweft.llm.lm_score import fit_language_model, score_texts
from textweft.llm.mixing import LOWER, SYMBOLS, Code, Mixer, OuterCounts, Symbols, count_followers, count_inner, log_odds, rounds, units


def taught(texts, often=()):
    counted = Counter(u for t in texts for u in units(t))
    distinct, times = list(counted), np.array(list(counted.values()), np.uint64)
    follows = np.zeros(SYMBOLS * SYMBOLS)
    count_followers(distinct, times, follows)
    code = Code(follows)
    tables = [np.zeros(2 * mixing.SLOTS, np.uint64) for _ in range(mixing.INNER)]
    for which, table in enumerate(tables):
        count_inner(code, distinct, times, which, table)
    outer = OuterCounts(code, list(often))
    outer.add(texts)
    odds = np.stack([log_odds(t[0::2].astype(float), t[1::2].astype(float)) for t in [*tables, outer.table]])
    return Mixer(code, odds, often=list(often)), outer.table


def prose(n, seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choices("etaoin shrdlu"[:9], k=rng.randint(2, 7))).strip() for _ in range(80)]
    return [" ".join(rng.choices(words, k=rng.randint(5, 60))).encode() for _ in range(n)]


def test_units_hold_every_byte():
    rng = random.Random(3)
    for text in [b"", b" ", b"\n", b"a", b"a ", b"a\n", b"a b\n\nc  d \n", *(bytes(rng.choices(b"ab \n\t", k=30)) for _ in range(200))]:
        found = units(text)
        assert found[-1][-1:] == b" " and all(u[-1:] != b" " for u in found[:-1])
        assert b"".join(u if u[-1:] == b"\n" else u + b" " for u in found[:-1]) + found[-1][:-1] == text
        assert [w for u in found for w in u.split()] == text.split()
    pieces = [(i, first, us) for group in rounds([b"a b " * 900, b"c d", b"x" * 5000 + b" y"], 1000) for i, first, us in group]
    assert [first for i, first, _ in pieces if i == 0] == [True] + [False] * (len([1 for i, *_ in pieces if i == 0]) - 1)
    for i, text in enumerate([b"a b " * 900, b"c d", b"x" * 5000 + b" y"]):
        assert [u for j, _, us in pieces if j == i for u in us] == units(text)


def test_all_ways_to_go_on_have_a_chance_of_one():
    """The code is complete and every bit has a chance, so symbols after any start add up to one."""
    texts = prose(60)
    mixer, _ = taught(texts)
    mixer.learn(texts[:10])
    seen = np.zeros((2, mixing.GATES, mixing.BUCKETS))
    mixer.observe(texts[:10], seen)
    mixer = Mixer(mixer.code, mixer.tables, mixer.weights, seen)
    pairs = np.exp(mixer.logs).reshape(-1, 2).sum(axis=1)
    assert np.allclose(pairs, 1, atol=1e-6)
    sizes = mixer.code.sizes.reshape(SYMBOLS, SYMBOLS)
    assert np.allclose((2.0**-sizes).sum(axis=1), 1)
    # two-symbol alphabet, all texts of up to three letters: no more than one in sum
    every = [b""] + [bytes(x) for n in (1, 2, 3) for x in itertools.product(b"ab ", repeat=n)]
    assert 0 < (10 ** mixer.scores(every)).sum() < 1


def test_bits_do_not_depend_on_what_follows():
    whole = Symbols([b"abcd", b"ab\n", b"abx "])
    for which in range(mixing.INNER):
        h = whole.context(which)
        assert (h[:3] == h[5:8]).all() and (h[:3] == h[8:11]).all()
        alone = Symbols([b"abc"]).context(which)
        assert (alone[:4] == h[:4]).all()


def test_scores_do_not_depend_on_neighbours_or_on_what_is_laid_out_before():
    texts = prose(40) + [b"", b"\0\xff", b"x" * 5000, b" \n \n"]
    mixer, _ = taught(texts)
    alone = np.array([mixer.scores([t])[0] for t in texts])
    assert np.allclose(mixer.scores(texts), alone, rtol=1e-5)
    assert np.allclose(mixer.scores(texts[::-1])[::-1], alone, rtol=1e-5)
    often = sorted({u for t in texts[:20] for u in units(t)})
    assert np.allclose(taught(texts, often)[0].scores(texts), alone, rtol=1e-5)
    assert (taught(texts, often)[1] == taught(texts)[1]).all()
    assert mixer.scores([]).size == 0


def test_scores_hold_however_few_units_are_laid_out_at_a_time(monkeypatch):
    texts = prose(60, 5)
    mixer, _ = taught(texts, sorted({u for t in texts[:20] for u in units(t)}))
    want = mixer.scores(texts)
    for name, few in (("LAID", 7), ("RUN", 30), ("SCORED", 200)):
        monkeypatch.setattr(mixing, name, few)
    layout = mixer.layout()
    assert (mixer.scores(texts, layout) == want).all()
    assert layout.room["still"].itemsize == 1  # one of STILL gates for every bit of a frequent unit


def test_long_texts_are_read_in_pieces(monkeypatch):
    texts = [b" ".join(prose(60)), b"short one"]
    mixer, table = taught(texts)
    whole = mixer.scores(texts)
    monkeypatch.setattr(mixing, "PIECE", 1000)
    monkeypatch.setattr(mixing, "GROUP", 50)
    cut, again = taught(texts)
    # the unit before is known over borders, so counts are the same; own weights carry over
    assert (table == again).all()
    assert np.allclose(cut.scores(texts), whole, rtol=2e-2)


def test_score_equals_plain_loops():
    """One text bit by bit, with dictionaries in the place of tables."""
    texts = prose(30)
    mixer, _ = taught(texts)
    mixer.learn(texts[:5])
    mixer = Mixer(mixer.code, mixer.tables, mixer.weights)
    for text in (texts[3], b"one  two\nthree", b""):
        own, total, waiting, previous = np.zeros(3), 0.0, [], np.uint32(0)
        for unit in units(text):
            s = Symbols([unit])
            hashes = [s.context(i) for i in range(mixing.INNER)] + [mixing._short(s.so_far, 4)]
            for at, key in enumerate(s.keys):
                for depth in range(mixer.code.sizes[key]):
                    place = mixer.code.starts[key] + depth
                    node, bit = mixer.code.nodes[place], int(mixer.code.bits[place])
                    marked = [(int(h[at]) + (int(node) + 1) * 0x85EBCA6B) % 2**32 for h in hashes]
                    marked[3] ^= int(previous)
                    odds = [int(t[(m * 0x9E3779B1 % 2**32) >> (32 - mixing.SLOT_BITS)]) for t, m in zip(mixer.tables, marked)]

                    def level(o):
                        return (o != 0) + (abs(o) > 24)

                    gate = (min(depth, 2) * 3 + level(odds[2])) * 2 + (abs(odds[1]) > 12)
                    gate = gate * 3 + level(odds[3])
                    w = mixer.weights[gate]
                    x = np.array([sum(w[i] * odds[i] / 12 for i in range(3)) + w[4] * mixing.BIAS, w[3] * odds[3] / 12, mixing.BIAS])
                    says = x[0] + x[1] + own @ x
                    spot = int((min(max(says, -8), 8) + 8) * (mixing.BUCKETS - 1) / 16 + 0.5)
                    total += mixer.logs[(gate * mixing.BUCKETS + spot) * 2 + bit]
                    waiting.append((x, bit - 1 / (1 + math.exp(-says))))
                    if len(waiting) == mixing.STEP:
                        own, waiting = own + mixing.OWN_RATE * sum(e * x for x, e in waiting), []
            previous = s.whole[0]
        assert math.isclose(total / math.log(10), mixer.scores([text])[0], rel_tol=2e-3)


def test_learning_helps():
    texts, more = prose(300), prose(300)[200:]
    mixer, _ = taught(texts[:200])
    untaught = Mixer(mixer.code, np.zeros_like(mixer.tables))
    plain = mixer.scores(more).sum()
    assert plain > untaught.scores(more).sum()
    for _ in range(3):
        mixer.learn(more)
    assert mixer.scores(more).sum() > plain


def plain_scores(rows):
    """Word counts by hand: tokens, known ones and the base score of every row."""
    low = [(i, (t or "").encode().translate(LOWER).split()) for i, t in rows]
    teach = [i is None or zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    counts = Counter(w for (_, words), t in zip(low, teach) if t for w in words)
    counts[None] = sum(teach)
    total, distinct = sum(counts.values()), len([c for c in counts.values() if c])
    out = []
    for i, words in low:
        met = [counts[w] for w in [*words, None]]
        out.append((i, len(met), sum(c > 0 for c in met), sum(math.log10((c + 0.1) / (total + 0.1 * (distinct + 1))) for c in met)))
    return total, out


@pytest.mark.parametrize("head", [1 << 20, 20, 0])
def test_base_scores_equal_counting(spark, hard_docs, monkeypatch, head):
    monkeypatch.setattr(lm_score, "FAN", 2)
    model = fit_language_model(hard_docs, head_words=head)
    total, want = plain_scores([(r["doc_id"], r["text"]) for r in hard_docs.collect()])
    assert model.tokens == total
    got = score_texts(hard_docs, model).collect()
    assert got[0]["kept"] == "own" and len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], round(r[3], 6))
    found = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in got), key=key)
    for a, b in zip(found, sorted(want, key=key)):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-9)
    by_text = {}
    for r in got:
        assert r["score"] <= 0 and math.isfinite(r["score"])
        assert math.isclose(by_text.setdefault(r["text"] or "", r["score"]), r["score"], rel_tol=1e-4)


def test_tables_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "FAN", 2)
    texts = prose(50)
    mixer, _ = taught(texts)
    rows = spark.createDataFrame([(bytearray(t), False) for t in texts], "text binary, weighs boolean")
    for n in (1, 7):
        part = rows.repartition(n)
        counted = lm_score.unit_counts(part).repartition(n)
        assert (lm_score._code(counted).bits == mixer.code.bits).all()
        assert (lm_score._tables(counted, part.select("text"), mixer.code, []) == mixer.tables).all()


def test_empty_table_and_only_held_out_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = fit_language_model(none)
    assert score_texts(none, model).count() == 0
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0]
    held = spark.createDataFrame([(ids[0], "never seen"), (ids[1], None)], "doc_id long, text string")
    got = score_texts(held, fit_language_model(held)).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"]) for r in got] == [(3, 0), (1, 0)]
    assert all(math.isfinite(r["base_score"]) and r["score"] < 0 for r in got)


def test_counts_are_narrow_until_a_cell_could_overflow():
    distinct = [u for t in prose(20) for u in units(t)]
    few, many = np.full(len(distinct), 3, np.int64), np.full(len(distinct), (1 << 31) - 1, np.int64)
    follows = np.zeros(SYMBOLS * SYMBOLS)
    count_followers(distinct, few, follows)
    code, want, counts = Code(follows), np.zeros(2 * mixing.SLOTS, np.uint64), mixing.Counts()
    for times, kind in ((few, np.uint32), (many, np.uint64)):
        counts.add(code, distinct, times, 2)
        count_inner(code, distinct, times.astype(np.uint64), 2, want)
        assert counts.table.dtype == kind
        assert (counts.table == want).all()
    assert want.max() > 1 << 32
