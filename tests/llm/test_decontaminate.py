"""Contamination against brute force over all windows."""

import math
import random
import re

import pytest

from textweft.llm import decontaminate
from textweft.llm.decontaminate import contamination, item_words

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_words(text):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return PATTERN.findall((text or "").translate(fold))


def slow(text, items, n=10, containment=0.0):
    words, hit, names = slow_words(text), set(), set()
    for item_id, item in items:
        own = slow_words(item)
        if not own:
            continue
        shingles = {tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1))}
        size = len(next(iter(shingles)))
        at = [i for i in range(len(words) - size + 1) if tuple(words[i : i + size]) in shingles]
        need = max(1, math.ceil(containment * len(shingles)))
        for first in at:
            inside = [i for i in at if first <= i and i + size <= first + len(own)]
            if len({tuple(words[i : i + size]) for i in inside}) >= need:
                names.add("" if item_id is None else str(item_id))
                hit.update(p for i in inside for p in range(i, i + size))
    return len(words), hit, sorted(names)


def make(rng):
    words = ["a", "b", "É", "the", "of", "x1", "zz"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 10, 12, 25])))) for i in range(25)]
    items += [(None, "The of. A b"), (90, None), (91, ""), (92, "?!"), (1, items[1][1]), (93, items[2][1])]
    docs = [" ".join(rng.choices(words, k=rng.choice([0, 2, 30, 300]))) for _ in range(40)]
    docs += [d + " " + items[rng.randrange(25)][1].upper() + " tail" for d in docs[:20]] + [None, "", "a " * 20_000]
    return items, docs


def test_words():
    for text in [None, "", "A-b_c é1ü\x7fd\tE", "ſ K ΑΒ   x"]:
        assert [w.decode() for w in item_words(text)] == slow_words(text)


@pytest.mark.parametrize("containment", [0.0, 0.6, 1.0])
@pytest.mark.parametrize("block", [32 << 20, 32 * 300])
def test_equals_brute_force(spark, monkeypatch, containment, block):
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", block)
    items, docs = make(random.Random(5))
    docs = [d if d is None or len(d) < 9000 else "a b " * 40 for d in docs]
    table = spark.createDataFrame([(i, t, "own") for i, t in enumerate(docs)], "doc_id long, text string, n_words string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    got = contamination(table, bench, containment=containment).collect()
    assert len(got) == len(docs)
    for r in got:
        n, hit, names = slow(docs[r.doc_id], items, containment=containment)
        assert (r.n_words, r.hit_items) == (n, names)
        assert {p for s, e in r.hit_spans for p in range(s, e)} == hit


def test_edges(spark, hard_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    clean = contamination(hard_docs, none)
    assert clean.count() == hard_docs.count() and clean.filter("size(hit_items) > 0").count() == 0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert contamination(empty, spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []
    long = contamination(hard_docs, spark.createDataFrame([(1, "word " * 12)], "item_id long, text string"))
    assert [r.hit_spans for r in long.filter("size(hit_items) > 0").collect()] == [[[0, 30_000]]]
