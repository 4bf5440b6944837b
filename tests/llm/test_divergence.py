"""Transducers against sorted lists, and source divergence against whole-number arithmetic."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from textweft.llm.divergence import source_divergence
from textweft.llm.lexicon import Lexicon, block_of, build, pack, tokens_of


def some_terms(n, seed=1):
    rng = random.Random(seed)
    return sorted({"".join(rng.choices("abcdé", k=rng.randint(1, 12))).encode() for _ in range(n)})


@pytest.mark.parametrize("size", [1, 7, 5000])
def test_ordinals_are_places_in_sorted_order(size):
    terms = some_terms(1000)
    blocks = [("en", s, p[0], p[-1], pack(p)) for s in range(0, len(terms), size) for p in [terms[s : s + size]]]
    text = random.Random(2).choices(terms, k=5000) + [b"zz", b"a" * 500, b"ab\xff", b"a\0b"]
    data, starts, sizes, part = tokens_of([b" ".join(text), b"", b"abc  zzz", b" "])
    found = Lexicon(blocks).ordinals(data, starts, sizes, np.zeros(len(starts), np.int64), ["en"])
    place = {t: i for i, t in enumerate(terms)}
    assert found.tolist() == [place.get(t, -1) for t in [*text, b"abc", b"zzz"]]
    assert part[-2:].tolist() == [2, 2]
    firsts, lasts = [b[2] for b in blocks], [b[3] for b in blocks]
    for t in [*terms, b"zz", b"\0"]:
        at = block_of(firsts, lasts, t)
        assert at == next((i for i, b in enumerate(blocks) if b[2] <= t <= b[3]), -1)
    none = Lexicon([]).ordinals(data, starts, sizes, np.zeros(len(starts), np.int64), ["en"])
    assert (none == -1).all()


def test_automaton_is_minimal():
    edges, final = build(some_terms(300))

    def language(state):
        return final[state], tuple((b, language(t)) for b, t in sorted(edges[state].items()))

    reached, stack = set(), [0]
    while stack:
        state = stack.pop()
        if state not in reached:
            reached.add(state)
            stack += edges[state].values()
    assert len({language(s) for s in reached}) == len(reached)


def exact(rows, least=3, top=200):
    """``rows`` of (text, lang, source); every sum written out."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = [(g or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower))) for t, g, s in rows]
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in found:
        seen[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang in {g for g, _, _ in found}:
        kept = sorted((t for t, n in seen[lang].items() if n >= least), key=str.encode)
        sources = {s for g, s, _ in found if g == lang}

        def shares(of):
            total = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, values, limit in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(values, key=lambda v: (-v[0], v[1].encode()))[:limit]
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)}
    return out


def found_of(frame):
    rows = [tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


@pytest.mark.parametrize("limit, block_terms", [(None, 1 << 16), (None, 16), (0, 1 << 16), (0, 16)])
def test_equals_exact_sums(spark, hard_texts, limit, block_terms):
    rng = random.Random(4)
    rows = [(t, rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", None, "ü", "only" + str(i % 2)])) for i, t in enumerate(hard_texts)]
    rows += [("no numbers 123 here", "xx", "a"), (None, "xx", "b"), ("", "yy", "a")]
    rows += [("Same SAME sameé word", "en", "a")] * 30
    docs = spark.createDataFrame([(*r, "own", 1) for r in rows], "text string, lang string, source string, item string, rank int")
    got = found_of(source_divergence(docs.repartition(5), limit=limit, block_terms=block_terms))
    assert got == exact(rows)


def test_many_sources_and_ties(spark):
    rng = random.Random(8)
    words = [f"w{'abcdefghij'[i % 10]}{'xyz'[i % 3]}{chr(97 + i // 30)}" for i in range(300)]
    rows = [(" ".join(rng.choices(words, k=40)), "en", f"s{rng.randint(0, 150)}") for _ in range(600)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    for limit in (None, 0):
        assert found_of(source_divergence(docs, limit=limit, top=20)) == exact(rows, top=20)


def test_empty_table(spark):
    none = spark.createDataFrame([], "text string, lang string, source string")
    assert source_divergence(none).count() == 0 and source_divergence(none, limit=0).count() == 0
