import pytest
from pyspark.sql import functions as F

from textweft.functions import text as tx
from textweft.functions.vectors import cosine, l2_normalize


def one(spark, expression, value):
    rows = spark.createDataFrame([(value,)], "text string").select(expression.alias("out"))
    return rows.first()["out"]


@pytest.mark.parametrize(
    "text, words",
    [("  A\tb C d\n", ["a", "b", "c", "d"]), ("", []), (" \n ", []), ("Ünïcode", ["ünïcode"])],
)
def test_tokenize_ws(spark, text, words):
    assert one(spark, tx.tokenize_ws(F.col("text")), text) == words


def test_tokenize_word_splits_on_everything_but_letters_digits_and_underscore(spark):
    assert one(spark, tx.tokenize_word(F.col("text")), "It's a_b, niño-3!") == ["it", "s", "a_b", "niño", "3"]


def test_stopwords_keep_repeats(spark):
    words = tx.remove_stopwords(tx.tokenize_ws(F.col("text")))
    assert one(spark, words, "the cat and the cat") == ["cat", "cat"]


def test_tokenize_review(spark):
    assert one(spark, tx.tokenize_review(F.col("text")), "Good, isn't it?!") == [
        "good", ",", "isn", "'", "t", "it", "?", "!"
    ]


@pytest.mark.parametrize("text, pairs", [("你好 吗", ["你好", "好吗"]), ("好", ["好"]), ("", []), (" ", [])])
def test_tokenize_cjk(spark, text, pairs):
    assert one(spark, tx.tokenize_cjk(F.col("text")), text) == pairs


def test_bad_lines(spark):
    rows = [("a | b",), ("x&y",), ("a = b",), ("a=b",), ("ok & fine",), ("",)]
    kept = tx.drop_bad_lines(spark.createDataFrame(rows, "text string"))
    assert {r["text"] for r in kept.collect()} == {"a = b", "ok & fine", ""}


def test_blank_lines_of_every_kind_are_dropped(spark):
    rows = spark.createDataFrame([("",), ("\r",), (" \t",), ("x",), (None,)], "text string")
    assert [r["text"] for r in tx.drop_blank(rows).collect()] == ["x"]


def test_strip_mail(spark):
    post = "From: me\nSubject: hi\n\nHello\n> old\nBob wrote:\nworld\n\n--\nsignature\nphone"
    assert one(spark, tx.strip_mail(F.col("text")), post) == "Hello\nworld\n"
    assert one(spark, tx.strip_mail(F.col("text")), "no header\nat all") == "no header\nat all"


def test_tagged_words(spark):
    line = "The/AT Dog/NN a/b/c plain ,/,"
    assert one(spark, tx.tagged_words(F.col("text")), line) == ["the", "dog", ","]


def test_zero_vector_has_no_unit(spark):
    rows = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0])], "a array<float>, b array<double>")
    out = rows.select(l2_normalize(F.col("a")).alias("a"), cosine(F.col("b"), F.col("b")).alias("c")).first()
    assert out["a"] is None and out["c"] == pytest.approx(1.0)
