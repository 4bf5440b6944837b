import numpy as np
import pytest

from textweft.operators import embeddings as e, windows as w
from textweft.sources.vectors import UNKNOWN


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, f"w{i}", rng.normal(size=4).tolist(), 100 - i) for i in range(30)]
    return spark.createDataFrame(rows, "id long, word string, vec array<double>, cf long").cache()


def unit(vectors):
    rows = sorted(vectors.collect(), key=lambda r: r["id"])
    m = np.array([r["vec"] for r in rows])
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def test_most_similar_leaves_out_the_inputs(spark, vectors):
    asked = spark.createDataFrame([(7, "w1", 1.0), (7, "w2", 1.0), (7, "w3", -1.0)], "question_id long, word string, weight double")
    found = e.most_similar(asked, vectors, 5).orderBy("rank").collect()
    m = unit(vectors)
    scores = m @ (m[1] + m[2] - m[3]) / np.linalg.norm(m[1] + m[2] - m[3])
    want = [i for i in np.argsort(-scores) if i not in (1, 2, 3)][:5]
    assert [r["id"] for r in found] == want
    assert [r["score"] for r in found] == pytest.approx(scores[want], abs=1e-6)
    unknown = spark.createDataFrame([(7, "nope", 1.0)], "question_id long, word string, weight double")
    with pytest.raises(Exception, match="unknown item"):
        e.most_similar(unknown, vectors, 5).collect()


def test_analogies_count_only_frequent_words(spark, vectors):
    m = unit(vectors)
    scores = m[:20] @ (m[1] + m[2] - m[0])
    answer = next(i for i in np.argsort(-scores) if i not in (0, 1, 2))
    rows = [("s", "w0", "w1", "w2", f"w{answer}"), ("s", "w0", "w1", "w2", "w19" if answer != 19 else "w18"),
            ("s", "w0", "w1", "w2", "w25"), ("empty", "w0", "w1", "nope", "w3")]
    asked = spark.createDataFrame(rows, "section string, a string, b string, c string, expected string")
    found = {r["section"]: (r["correct"], r["incorrect"]) for r in e.analogy_accuracy(asked, vectors, 20).collect()}
    assert found == {"s": (1, 1), "empty": (0, 0), "total": (1, 1)}


def test_word_vector_is_strict(spark, vectors):
    words = spark.createDataFrame([("w1",), ("nope",)], "word string")
    with pytest.raises(Exception, match="no vector"):
        e.word_vector(words, vectors).collect()
    assert e.word_vector(words, vectors, strict=False).count() == 1


def test_unknown_word_gets_the_marker(spark, vectors):
    vocab = vectors.select("word", "id", "cf").replace({"w0": UNKNOWN}, subset="word")
    words = spark.createDataFrame([("w1",), ("nope",)], "word string")
    found = {r["word"]: r["id"] for r in e.word_vector_or_unknown(words, vocab, vectors).collect()}
    assert found == {"w1": 1, "nope": 0}


def test_start_vectors_do_not_depend_on_partitions(spark):
    ids = spark.range(50)
    a = {r["id"]: r["vec"] for r in e.init_vectors(ids.repartition(7), 8).collect()}
    b = {r["id"]: r["vec"] for r in e.init_vectors(ids.coalesce(1), 8).collect()}
    assert a == b and all(abs(x) <= 0.5 / 8 for v in a.values() for x in v)
    wide = e.init_vectors(ids, 8, init_range=0.1).collect()
    assert max(abs(x) for r in wide for x in r["vec"]) > 0.5 / 8


def pairs(ids, window):
    return sorted(
        (i, ids[i], ids[j])
        for i in range(len(ids)) for j in range(max(0, i - window), min(len(ids), i + window + 1))
        if i != j and ids[i] is not None and ids[j] is not None
    )


def test_skipgram_pairs(spark):
    ids = [5, None, 6, 7, 5, 8]
    rows = spark.createDataFrame([(0, ids), (1, [])], "doc_id long, ids array<long>")
    found = sorted((r["pos"], r["center"], r["context"]) for r in e.skipgram_pairs(rows, 2).collect())
    assert found == pairs(ids, 2)
    shrunk = [(r["pos"], r["center"], r["context"]) for r in e.skipgram_pairs(rows, 2, reduced=True).collect()]
    assert set(shrunk) <= set(found) and shrunk


def test_cbow_mean(spark):
    rows = spark.createDataFrame([(0, [0, 1, 2])], "doc_id long, ids array<long>")
    vecs = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(3)], "id long, vec array<double>")
    found = {r["pos"]: r["vec"] for r in e.cbow_context(rows, vecs, 1).collect()}
    assert found == {0: [1.0, 1.0], 1: [1.0, 1.0], 2: [1.0, 1.0]}


def test_context_windows(spark):
    rows = spark.createDataFrame([(0, [1, 2, 3]), (1, [])], "doc_id long, ids array<long>")
    found = {r["pos"]: (r["target"], r["context"]) for r in w.context_windows(rows, 2, 0).collect()}
    assert found == {0: (1, [0, 0, 2, 3]), 1: (2, [0, 1, 3, 0]), 2: (3, [1, 2, 0, 0])}
    before = {r["pos"]: r["context"] for r in w.context_windows(rows, 2, 0, symmetric=False).collect()}
    assert before == {0: [0, 0], 1: [0, 1], 2: [1, 2]}


def test_stream_windows_cross_documents(spark):
    text = [("a b c".split(), 0), ([], 3), ("d e f g h i j k".split(), 3), ("l m".split(), 11)]
    stream = spark.createDataFrame(text, "words array<string>, start long")
    found = {r["win_id"]: "".join(r["words"]) for r in w.fixed_windows(stream, 4).collect()}
    assert found == {0: "abcd", 1: "efgh", 2: "ijkl"}
    assert w.fixed_windows(stream, 4, limit=2).count() == 2
    records = w.next_word_windows(stream, 3).collect()
    assert sorted((r["win_id"], "".join(r["words"]), r["target"]) for r in records) == [(0, "abc", "d"), (1, "efg", "h")]
    tokens = spark.createDataFrame([(0, list("abcdefgh")), (1, list("xy"))], "doc_id long, words array<string>")
    inside = w.next_word_windows_by_document(tokens, 3).collect()
    assert [(r["win"], "".join(r["words"]), r["target"]) for r in inside] == [(0, "abc", "d"), (1, "efg", "h")]


def test_windows_with_unknown_words_are_dropped(spark):
    wins = spark.createDataFrame([(0, ["a", "b"], "a"), (1, ["a", "q"], "b"), (2, ["b", "a"], "q")],
                                 "win_id long, words array<string>, target string")
    vecs = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0])], "word string, vec array<double>")
    rows = w.vectorize_windows(wins, vecs).collect()
    assert [(r["win_id"], r["x"], r["y"]) for r in rows] == [(0, [1.0, 2.0, 3.0, 4.0], [1.0, 2.0])]
    plain = w.vectorize_windows(wins.drop("target"), vecs).orderBy("win_id").collect()
    assert [r["win_id"] for r in plain] == [0, 2] and plain[0]["y"] is None


def test_sampled_place_changes_with_the_epoch(spark):
    rows = spark.createDataFrame([(i, list(range(50))) for i in range(40)], "doc_id long, ids array<long>")
    first, second = ([r["pos"] for r in w.sample_window(rows, n).orderBy("doc_id").collect()] for n in (0, 1))
    assert first != second and all(0 <= p < 50 for p in first)
