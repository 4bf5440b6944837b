"""Repeated windows against brute force."""

import hashlib
import random

import numpy as np
import pytest

from textweft.llm.substrings import anchors, covered, factors, phrase_hashes, remove_repeated_spans


def slow(texts, window):
    words = [t.encode().split() if t else [] for t in texts]
    seen = {}
    for w in words:
        for i in range(len(w) - window + 1):
            seen[tuple(w[i : i + window])] = seen.get(tuple(w[i : i + window]), 0) + 1
    out = []
    for w in words:
        gone = {p for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for p in range(i, i + window)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest(), gone, kept.decode()))
    return out


def make(rng, n):
    words = [f"w{i}" for i in range(400)]
    passages = [rng.choices(words, k=rng.randint(30, 60)) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [rng.choices(words, k=rng.randint(0, 50)) for _ in range(3)]
        parts.insert(1, rng.choice(passages) if rng.random() < 0.5 else [])
        texts.append(" ".join(w for p in parts for w in p))
    return texts


@pytest.mark.parametrize("window, gram", [(35, 8), (35, 35), (5, 2), (3, 1)])
def test_equals_brute_force(spark, window, gram):
    rng = random.Random(window)
    texts = make(rng, 60) + [None, "", "a b " * 200, "x y z " * 12, " ".join(f"u{i}" for i in range(35))]
    texts += [texts[0], texts[1].replace(" ", "  \n"), texts[2] + " tail", " ".join(texts[3].split()[5:])]
    rows = [(None if i == 4 else 9 if i == 8 else i, t, i, "own") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tid long, keys string").repartition(3)
    got = remove_repeated_spans(docs, window, gram, kept_text=True).collect()
    key = lambda r: tuple(map(str, r))
    want = [(i, n, g, h, t) for (i, _, _, _), (n, g, h, _, t) in zip(rows, slow(texts, window))]
    assert sorted((key((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text)) for r in got)) == sorted(map(key, want))
    places = {key((r.doc_id, r.n_words, r.kept_sha256)): {p for s, e in r.spans for p in range(s, e)} for r in got}
    for (i, _, _, _), (n, _, h, gone, _) in zip(rows, slow(texts, window)):
        assert places[key((i, n, h))] == gone


def test_spans_and_anchors():
    repeated = np.array([0, 1, 1, 0, 0, 1, 0, 0, 0, 0, 0, 1], dtype=bool)
    assert factors(repeated, 4) == [(1, 6), (5, 9), (11, 15)]
    assert covered(factors(repeated, 4)) == [(1, 9), (11, 15)]
    words = [b"a", b"b"] * 30
    grams, phrases = phrase_hashes(words, 3, 10)
    assert len(set(phrases.tolist())) == 2 and len(phrases) == 51
    at = anchors(grams, 10, 3)
    assert len(set(grams[at].tolist())) == 1 and (np.diff(at) >= 0).all()


def test_empty_and_bad_parameters(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert remove_repeated_spans(docs).collect() == []
    with pytest.raises(ValueError):
        remove_repeated_spans(docs, 5, 6)
