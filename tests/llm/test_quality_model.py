"""Multiple-instance learning: gradients, held-out accuracy and edges."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from textweft.llm.quality_model import (
    _CLASS_OF, _N_CLASSES, _PLAIN, GRAMS, PASSAGES, TRIGRAM_DECAY, WIDTH, Model, fit_quality_model, held_out, passages, score_quality,
    taught_passages,
)


def test_passages_hold_every_word():
    assert passages(None).shape == passages("").shape == (1, WIDTH) and not passages(" \n").any()
    assert len(passages("a " * 64)) == 1 and len(passages("a " * 65)) == 2
    # a long text has more passages, not longer ones; only what teaches is drawn from them
    assert len(passages("a " * 1_000_000)) == 15_625
    assert len(taught_passages("a b " * 100_000, 7)) == PASSAGES and len(taught_passages("a b " * 100, 7)) == 4
    once, again = (taught_passages(" ".join(map(str, range(20_000))), 7) for _ in range(2))
    assert np.array_equal(once, again)


def plain_passages(text):
    """The features passage by passage and byte by byte."""
    words = (text or "").encode().split()
    rows = []
    for start in range(0, len(words), 64):
        part = words[start : start + 64]
        row = np.zeros(WIDTH)
        for b in b" ".join(part):
            row[_CLASS_OF[b]] += 1 / len(part)
        row[_N_CLASSES] = sum(a == b for a, b in zip(part, part[1:])) / len(part)
        row[_N_CLASSES + 1] = len(set(part)) / len(part)
        row[_N_CLASSES + 2] = len(b" ".join(part)) / len(part) / 10
        row[_N_CLASSES + 3] = np.log1p(len(part)) / 5
        here = b" ".join(part) + b" "
        after = b" ".join(words[start + 64 : start + 128])[:2]
        after = (after + b"  ")[:2] if len(words) > start + 64 else b""
        data = (here + after).lower() if (here + after).isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in here + after)
        for i in range(len(here)):
            if i + 2 < len(data):
                h = (data[i] * 0x9E3779B1 + data[i + 1] * 0x85EBCA6B + data[i + 2] * 0xC2B2AE35) % 2**32
                row[_PLAIN + (h ^ (h >> 15)) % GRAMS] += 10 / len(here)
        rows.append(row)
    return np.array(rows) if rows else np.zeros((1, WIDTH))


def test_features_equal_plain_loops(hard_texts):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["Ab", "é!", "#x9", "the", "THE"], k=n)) for n in (1, 2, 63, 64, 65, 200)]
    for text in [*texts, *[t for t in hard_texts if len(t or "") < 3000]]:
        assert np.allclose(passages(text), plain_passages(text), atol=1e-5)


def test_score_equals_attention_by_hand():
    rng = np.random.default_rng(3)
    bags = [rng.normal(size=(n, WIDTH)) for n in (1, 4, 300)]
    model = Model(bags * 3, np.array([1, 0, 1, 0, 1, 0, 1, 1, 0]), steps=20)
    w, b, v, u, a, c, d = model.weights
    for bag, got in zip(bags, model.scores(bags)):
        parts = []
        for row in bag:
            z = (row - model.centre) / model.spread
            h = np.tanh(np.sign(z) * np.log1p(np.abs(z)) @ w + b)
            parts.append((np.exp((np.tanh(h @ v) / (1 + np.exp(-(h @ u)))) @ a * (1 + np.log(len(bag)))), h))
        whole = sum(e * h for e, h in parts) / sum(e for e, _ in parts)
        assert abs(1 / (1 + np.exp(-(whole @ c + d))) - got) < 1e-9


def test_one_bad_passage_counts_in_a_text_of_any_length():
    rng = random.Random(5)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "erat", "magna", "nulla"]

    def prose(n):
        return rng.choices(words, k=n)

    good = [" ".join(prose(rng.randint(64, 900))) for _ in range(150)]
    bad = []
    for _ in range(150):
        n = rng.randint(2, 12) * 64
        bad.append(" ".join([*prose(n), *["$$$#%"] * 64, *prose(64)]))
    model = Model([passages(t) for t in good + bad], np.array([1.0] * 150 + [0.0] * 150))
    for n in (512, 6400, 19_200):
        with_bad = " ".join([*prose(n), *["$$$#%"] * 64])
        plain, spoilt = model.scores([passages(" ".join(prose(n + 64))), passages(with_bad)])
        assert plain > 0.9 and spoilt < 0.5


def test_attention_finds_the_telling_passage():
    rng = np.random.default_rng(1)
    bags, labels = [], []
    for i in range(400):
        bag = rng.normal(0, 1, (rng.integers(1, 12), WIDTH))
        if i % 2:
            bag[rng.integers(len(bag)), 0] += 6
        bags.append(bag)
        labels.append(i % 2)
    model = Model(bags[:300], np.array(labels[:300]))
    right = (model.scores(bags[300:]) >= 0.5) == np.array(labels[300:], dtype=bool)
    assert right.mean() > 0.9
    again = Model(bags[:300], np.array(labels[:300]))
    assert np.array_equal(model.scores(bags), again.scores(bags))


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    bags, y = [rng.normal(0, 1, (n, WIDTH)) for n in (1, 3, 2)], np.array([1.0, 0.0, 1.0])
    model = Model(bags, y, steps=0)
    before = [w.copy() for w in model.weights]
    x, starts = model._scaled(np.concatenate(bags)), np.array([0, 1, 4])

    def loss():
        p = model._forward(x, starts)[5]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    model.weights = [w.copy() for w in before]
    model._fit(x, starts, y, 5, 1)  # the first step of Adam goes by the sign of each gradient
    signs = [np.sign(np.asarray(b) - np.asarray(a)) for a, b in zip(model.weights, before)]
    for i in range(len(before)):
        flat = np.atleast_1d(before[i]).ravel()
        for place in rng.integers(0, flat.size, 4):
            slope = []
            for step in (1e-5, -1e-5):
                moved = flat.copy()
                moved[place] += step
                model.weights = [moved.reshape(np.shape(before[i])) if j == i else w for j, w in enumerate(before)]
                slope.append(loss())
            trigram = i == 0 and place // np.shape(before[0])[1] >= _PLAIN
            gradient = (slope[0] - slope[1]) / 2e-5 + (TRIGRAM_DECAY if trigram else 1e-4) * flat[place]
            if abs(gradient) > 1e-6:
                assert np.sign(gradient) == np.atleast_1d(signs[i]).ravel()[place]


def test_held_out_accuracy(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(300)]
    rows = []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randint(3, 400))]
        good = rng.random() < 0.6
        rows.append((i, " ".join(text) if good else " ".join(w.upper() + "!!" for w in text), int(good)))
    docs = spark.createDataFrame([(i, t, "own") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, q, "x") for i, _, q in rows], "doc_id long, quality int, text string")
    found = score_quality(docs, fit_quality_model(docs, labels)).withColumn("out", held_out(F.col("doc_id"))).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    unseen = [(r.predicted, rows[r.doc_id][2]) for r in found if r.out]
    assert len(unseen) > 200 and sum(a == b for a, b in unseen) > 0.97 * len(unseen)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)


def test_edges(spark, hard_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in score_quality(hard_docs, fit_quality_model(hard_docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(40)] + [(None, 0), (3, None)], "doc_id long, quality int")
    model = fit_quality_model(hard_docs, one)
    assert {r.score for r in score_quality(hard_docs, model).collect()} == {1.0}
    both = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    rows = score_quality(hard_docs, fit_quality_model(hard_docs, both)).collect()
    assert len(rows) == hard_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip(" \t\n\r\v\f")}) == 1
    assert score_quality(hard_docs.limit(0), model).collect() == []
