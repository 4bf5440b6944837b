import pytest
from goldens import TITLE_BOW, TITLE_WORDS
from pyspark.sql import functions as F

from textweft.operators import bags, vocabulary as v


def tokens(spark, *texts):
    rows = [(i, text.split()) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, words array<string>")


def test_dictionary_of_titles(titles):
    vocab = v.build_dictionary(v.drop_rare(titles)).orderBy("id").collect()
    assert [r["word"] for r in vocab] == TITLE_WORDS
    assert [r["id"] for r in vocab] == list(range(12))
    assert {r["word"]: r["df"] for r in vocab}["system"] == 3


def test_bag_of_words_of_titles(titles):
    bow = bags.doc2bow(titles, v.build_dictionary(titles, min_cf=2)).collect()
    found = {}
    for r in bow:
        found.setdefault(r["doc_id"], []).append((r["id"], r["tf"]))
    assert [sorted(found[d]) for d in range(9)] == TITLE_BOW


@pytest.mark.parametrize("limit", [None, 0])
def test_drop_rare_keeps_order_and_empty_documents(spark, limit):
    kept = v.drop_rare(tokens(spark, "a b a c", "b x", "y", ""), limit=limit).orderBy("doc_id")
    assert [r["words"] for r in kept.collect()] == [["a", "b", "a"], ["b"], [], []]


def test_drop_listed_words(spark):
    listed = spark.createDataFrame([("a",), ("a",), ("q",)], "word string")
    kept = v.drop_listed_words(tokens(spark, "a b a c", "a", "b"), listed).orderBy("doc_id")
    assert [r["words"] for r in kept.collect()] == [["b", "c"], [], ["b"]]


def test_filter_extremes_closes_up_ids(spark):
    vocab = v.build_dictionary(tokens(spark, "a b c", "a b d", "a e d", "a d f"))
    kept = v.filter_extremes(vocab, 4, no_below=2, no_above=0.75, keep_n=2).orderBy("id").collect()
    assert [(r["word"], r["id"]) for r in kept] == [("b", 0), ("d", 1)]


def test_extend_adds_counts_and_appends(spark):
    first = v.min_count_vocabulary(tokens(spark, "a a b b b c"), 2)
    wider = v.extend_vocabulary(first, tokens(spark, "a z z z y y x"), 2).orderBy("id").collect()
    assert [(r["word"], r["cf"]) for r in wider] == [("b", 3), ("a", 3), ("z", 3), ("y", 2)]


def test_unknown_words(spark):
    vocab = v.min_count_vocabulary(tokens(spark, "a a b b b"), 2)
    words = spark.createDataFrame([("a",), ("nope",)], "word string")
    assert [r["word"] for r in v.map_oov(words, vocab).collect()] == ["a"]
    for limit in (None, 0):
        ids = {r["word"]: r["id"] for r in v.map_oov(words, v.add_oov(vocab), limit).collect()}
        assert ids == {"a": 1, "nope": 2}
    assert v.add_oov(v.add_oov(vocab)).count() == 4
    assert v.add_padding_word(vocab).orderBy(F.desc("id")).first()["cf"] == 1_000_000


def test_insertion_dictionary(spark):
    ids = v.insertion_dictionary(tokens(spark, "z y z", "a y")).orderBy("id").collect()
    assert [r["word"] for r in ids] == ["<pad>", "z", "y", "a"]


def test_statistics(spark):
    stats = v.corpus_statistics(tokens(spark, "a b", "a b", "c", "")).first()
    assert tuple(stats) == (4, 5, 3, 3)
    assert v.corpus_statistics_approx(tokens(spark, "a b", "a b", "c", "")).first()["n_word_types"] == 3


def test_words_seen_counts_only_the_start(spark):
    text = tokens(spark, "a b a q a")
    vocab = v.min_count_vocabulary(tokens(spark, "a a b b"), 2)
    assert v.words_seen(text, vocab, 3).first()[0] == 3


def test_paragraph_ids_of_many_copies(spark):
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(F.concat(F.lit("t"), "id")).alias("text")
    )
    vocab = v.paragraph_vocabulary(docs)
    assert vocab.count() == 201
    ids = v.paragraph_ids(docs, vocab, limit=0)
    assert ids.count() == 300 and ids.filter("doc_id % 3 = 0").select("para_id").distinct().count() == 1


def test_encode_and_pad(spark):
    text = tokens(spark, "a b a", "c", "")
    vocab = v.insertion_dictionary(text)
    encoded = bags.encode_tokens(text, vocab)
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == {0: [1, 2, 1], 1: [3], 2: []}
    padded = bags.pad_batch(bags.batch_plan(encoded, 2), max_len=2).orderBy("doc_id").collect()
    assert [r["ids"] for r in padded] == [[1, 2], [3, 0], []]
    with pytest.raises(Exception, match="not in dictionary"):
        bags.encode_tokens(tokens(spark, "new"), vocab).collect()


def test_render(titles):
    vocab = v.build_dictionary(titles, min_cf=2)
    text = bags.render_bow(bags.doc2bow(titles, vocab), vocab).filter("doc_id = 3").first()["text"]
    assert text == "human system eps"


def test_encoding_regroups_no_occurrences(spark):
    text = tokens(spark, "b a b a c", "c d", "")
    vocab = v.insertion_dictionary(text)
    assert [r["word"] for r in vocab.orderBy("id").collect()][1:] == ["b", "a", "c", "d"]
    plan = bags.encode_tokens(text, vocab)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
