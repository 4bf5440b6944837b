"""Bags of words in long form, token ids, and batches of ids."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textweft.lookup import lookup_join
from textweft.operators.blocks import encode_words
from textweft.operators.vocabulary import word_rows
from textweft.ordered import number_rows


def by_document(texts: DataFrame, id: str = "doc_id") -> DataFrame:
    """Partition compact document rows by id, before they are tokenized.

    Exploding, counting and windows by document then need no further shuffle, so
    only the plain text crosses the network and never a row per token.
    """
    return texts.repartition(id)


def term_counts(tokens: DataFrame) -> DataFrame:
    """``(doc_id, word, tf)``; local to each task after :func:`by_document`."""
    return word_rows(tokens, "doc_id").groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("tf"))


def doc2bow(tokens: DataFrame, vocab: DataFrame, limit: int | None = None) -> DataFrame:
    """``(doc_id, id, tf)``; words outside the vocabulary are ignored."""
    words = lookup_join(
        term_counts(tokens), vocab.select("word", "id", "df"), "word", weight="df", limit=limit
    )
    return words.select("doc_id", "id", "tf")


def render_bow(bow: DataFrame, vocab: DataFrame, limit: int | None = None) -> DataFrame:
    """``(doc_id, text)``: the words of each document's ids, in id order, once each."""
    named = lookup_join(bow, vocab.select("id", "word", "df"), "id", weight="df", limit=limit)
    words = F.array_sort(F.collect_list(F.struct("id", "word")))["word"]
    return named.groupBy("doc_id").agg(F.array_join(words, " ").alias("text"))


def encode_tokens(tokens: DataFrame, vocab: DataFrame, limit: int | None = None) -> DataFrame:
    """``(doc_id, ids)`` in text order; a word outside the vocabulary is an error."""
    return encode_words(tokens.select("doc_id", "words"), vocab, strict=True, limit=limit)


def batch_plan(rows: DataFrame, size: int, order: str = "doc_id") -> DataFrame:
    """Add ``batch_id``: consecutive groups of ``size`` rows in order."""
    numbered = number_rows(rows, [order], name="_row", label="batches")
    return numbered.withColumn("batch_id", F.floor(F.col("_row") / size)).drop("_row")


def cursor_batches(rows: DataFrame, size: int, steps: DataFrame, n_rows: int, order: str = "doc_id") -> DataFrame:
    """The rows each of ``steps(step)`` takes from a cursor over the full batches that
    starts over at the end."""
    per_round = max(n_rows // size, 1)
    asked = steps.withColumn("batch_id", F.col("step") % per_round)
    return batch_plan(rows, size, order).join(asked, "batch_id")


def pad_batch(encoded: DataFrame, pad_id: int = 0, max_len: int = 500) -> DataFrame:
    """Cut or pad ``ids`` to the longest of the batch, at most ``max_len``."""
    longest = F.least(F.max(F.size("ids")).over(Window.partitionBy("batch_id")), F.lit(max_len))
    cut = F.slice("ids", F.lit(1), F.col("_longest"))
    fill = F.array_repeat(F.lit(pad_id).cast("long"), F.col("_longest") - F.size(cut))
    return (
        encoded.withColumn("_longest", longest).withColumn("ids", F.concat(cut, fill)).drop("_longest")
    )
