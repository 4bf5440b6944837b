"""Rule counts against brute force, and verdicts of the isolation forest."""

import math
import random
import re

import numpy as np

from pyspark.sql import functions as F

from textweft.llm.common import drawn_rows
from textweft.llm.quality_rules import COUNTS, MORE, Forest, calibrate, fit_judge, fit_quality, quality_verdicts, rule_counts


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    places = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(places)


def test_counts(hard_texts):
    rng = random.Random(1)
    odd = [" ".join(rng.choices("a b c d\n e# f<".split(" "), k=rng.randint(1, 80))) for _ in range(60)]
    for text in odd + ["a b c d e a b c d e", "x\nx\n \n x\nx", "# # # # # # #"] + [t for t in hard_texts if len(t or "") < 5000]:
        assert rule_counts(text)[:5] == slow_counts(text)


def test_forest_isolates_what_is_odd():
    rng = np.random.default_rng(0)
    rows = np.vstack([rng.normal(0, 0.1, (500, 4)), [[3, 3, 3, 3]]])
    scores = Forest(rows).scores(rows)
    assert scores[-1] > scores[:-1].max() and (scores > 0).all() and (scores < 1).all()
    assert len(Forest(rows[:0]).scores(rows)) == len(rows) and len(Forest(rows).scores(rows[:0])) == 0


def corpus(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(500)]
    rows = []
    for i in range(600):
        text = ". ".join(" ".join(rng.choices(words, k=12)).capitalize() for _ in range(rng.randint(2, 12)))
        bad = i % 5 == 0
        if bad:
            text = " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in text.split())
        rows.append((i, text, int(not bad)))
    return rows


def test_verdicts(spark):
    rows = corpus(spark)
    docs = spark.createDataFrame([(i, t, "own") for i, t, _ in rows], "doc_id long, text string, good string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows if i < 300] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, text int")
    got = {r.doc_id: r.kept for r in quality_verdicts(docs, labels).collect()}
    unseen = [(got[i], q) for i, _, q in rows if i >= 300]
    assert sum(k for k, q in unseen if q) >= 0.98 * sum(q for _, q in unseen)
    assert not any(k for k, q in unseen if not q)


def test_edges(spark, hard_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality_verdicts(hard_docs, labels).collect()
    assert len(rows) == hard_docs.count()
    for r in rows:
        counts = rule_counts(r.text)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert (r.base_failed, r.kept) == (failed, not failed) and r.n_words == counts[0] and r.fp == "own"
    one_kind = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    assert fit_quality(hard_docs, one_kind)[2] == math.inf
    assert quality_verdicts(hard_docs.limit(0), labels).collect() == []


def test_calibration_bounds_what_good_rows_lose(spark):
    rows = [(0.3, 1)] * 995 + [(0.7, 1)] * 5 + [(0.7, 0)] * 80 + [(0.9, 0)] * 20
    scored = spark.createDataFrame(rows, "anomaly double, good int")
    assert 0.3 < calibrate(scored, "good", 0.005) <= 0.7 and calibrate(scored, "good", 0.001) > 0.7
    assert len(COUNTS + MORE) == len(rule_counts("a"))


def test_a_hot_group_of_copies_takes_its_share_of_the_sample(spark):
    one = [10, 50, 0, 0, 0, 0, 0, 0, 0]
    names = [*COUNTS, *MORE]
    rows = [(i, *(one if i % 3 == 0 else [10 + i % 50, 50 + i, i % 7, 0, 0, 0, 0, 0, 0])[: len(names)], 1) for i in range(6000)]
    rows += [(1, *one[: len(names)], 1)] * 3000  # one id, many times
    labelled = spark.createDataFrame(rows, ["doc_id", *names, "good"]).repartition(9)
    drawn = drawn_rows(labelled, 900, F.xxhash64(F.lit(7), "doc_id"))
    ids = [r["doc_id"] for r in drawn.select("doc_id").distinct().collect()]
    assert 450 < len(ids) < 800 and 0.25 < sum(i % 3 == 0 for i in ids) / len(ids) < 0.42
    judges = [fit_judge(labelled.repartition(n), "good", 900) for n in (1, 5)]
    counts = np.array([r[1:-1] for r in rows[:200]])
    assert np.array_equal(judges[0].scores(counts), judges[1].scores(counts))
    assert drawn_rows(labelled, 10_000, F.xxhash64("doc_id")).count() == 9000
