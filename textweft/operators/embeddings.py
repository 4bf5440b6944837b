"""Word vectors ``(word, vec)``: look-up, pairs of neighbours, nearest words and analogies."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweft.functions.arrays import let
from textweft.functions.vectors import (
    cosine,
    doubles,
    hash_uniform,
    l2_normalize,
    mean_vector,
    random_vector,
    vector_width,
)
from textweft.lookup import attach, fits_broadcast, lookup_join
from textweft.operators.blocks import Part, lists, map_blocks
from textweft.operators.similarity import best_k, nearest
from textweft.operators.vocabulary import map_oov, restrict_vocabulary
from textweft.scratch import materialize

def init_vectors(ids: DataFrame, size: int, seed: int = 1, init_range: float | None = None, key: str = "id") -> DataFrame:
    """Add ``vec``: a starting vector that depends on the key and the seed alone."""
    return ids.withColumn("vec", random_vector(F.col(key), size, seed, init_range))


def extend_weights(vocab: DataFrame, vectors: DataFrame, size: int, seed: int = 1) -> DataFrame:
    """``(word, id, vec)`` for an extended vocabulary: old vectors stay, new words start fresh."""
    old = lookup_join(vocab.select("word", "id"), vectors.select("word", "vec"), "word", "left")
    return old.withColumn("vec", F.coalesce(doubles(F.col("vec")), random_vector(F.col("id"), size, seed)))


def word_vector(words: DataFrame, vectors: DataFrame, strict: bool = True) -> DataFrame:
    """Add the vector of each ``word``; an unknown word is an error, or dropped if not strict."""
    found = lookup_join(words, vectors.select("word", "vec"), "word", "left")
    if not strict:
        return found.filter(F.col("vec").isNotNull())
    missing = F.raise_error(F.concat(F.lit("no vector for "), F.col("word")))
    return found.withColumn(
        "vec", F.when(F.col("vec").isNull(), missing.cast(vectors.schema["vec"].dataType)).otherwise(F.col("vec"))
    )


def word_vector_or_unknown(words: DataFrame, vocab: DataFrame, vectors: DataFrame) -> DataFrame:
    """Add id and vector of each ``word``; unknown words get those of the marker."""
    return lookup_join(map_oov(words, vocab), vectors.select("id", "vec"), "id")


def word_similarity(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with the cosine of their vectors as ``score``."""
    table = vectors.select("word", "vec")
    first = table.withColumnsRenamed({"word": "a", "vec": "_va"})
    second = table.withColumnsRenamed({"word": "b", "vec": "_vb"})
    both = lookup_join(lookup_join(pairs, first, "a"), second, "b")
    return both.withColumn("score", cosine(F.col("_va"), F.col("_vb"))).drop("_va", "_vb")


def _contexts(ids: Column, window: int, shrink) -> Column:
    """Per position its centre and the in-vocabulary neighbours, as an array of structs."""

    def around(all_ids: Column) -> Column:
        def at(centre: Column, i: Column) -> Column:
            reach = F.lit(window) - shrink(i)
            first = F.greatest(i - reach, F.lit(0))
            before = F.slice(all_ids, first + 1, i - first)
            after = F.slice(all_ids, i + 2, F.greatest(reach, F.lit(0)))
            near = F.filter(F.concat(before, after), lambda x: x.isNotNull())
            return F.struct(i.alias("pos"), centre.alias("center"), near.alias("near"))

        return F.transform(all_ids, at)

    return let(ids, around)


def context_rows(encoded: DataFrame, window: int = 5, reduced: bool = False, seed: int = 1) -> DataFrame:
    """``(doc_id, pos, center, near)`` for each in-vocabulary centre of ``ids``.

    A null id is an unknown word: it is skipped but takes up its position. With
    ``reduced`` each centre shrinks its window by a repeatable random 0…window-1.
    Neighbours are slices of the document's own array, so nothing is shuffled.
    """

    def shrink(i: Column) -> Column:
        if not reduced:
            return F.lit(0)
        return F.floor(hash_uniform(F.lit(seed), "doc_id", i) * window).cast("int")

    rows = encoded.select("doc_id", F.explode_outer(_contexts(F.col("ids"), window, shrink)).alias("c"))
    return rows.select("doc_id", "c.pos", "c.center", "c.near").filter(F.col("center").isNotNull())


def skipgram_pairs(encoded: DataFrame, window: int = 5, reduced: bool = False, seed: int = 1) -> DataFrame:
    """``(doc_id, pos, center, context)``."""
    rows = context_rows(encoded, window, reduced, seed)
    return rows.select("doc_id", "pos", "center", F.explode("near").alias("context"))


def cbow_context(encoded: DataFrame, vectors: DataFrame, window: int = 5, limit: int | None = None) -> DataFrame:
    """``(doc_id, pos, center, vec)``: the mean vector of the neighbours of each centre.

    Neighbours without a vector are left out; a centre with no other ones has no row.
    """
    offsets = np.array([o for o in range(-window, window + 1) if o])

    def work(part: Part) -> Iterator[list[pa.Array]]:
        first, last = part.starts[part.owner], part.ends[part.owner]
        centres = part.flat.is_valid().to_numpy(zero_copy_only=False)
        for run in part.runs(len(offsets) * part.matrix.shape[1]):
            at = np.arange(run.start, run.stop)[centres[run]]
            near = at[:, None] + offsets
            inside = (near >= first[at][:, None]) & (near < last[at][:, None])
            rows = np.where(inside, part.at[np.clip(near, 0, len(part.at) - 1)], part.missing)
            n = (rows != part.missing).sum(axis=1)
            at, rows, n = at[n > 0], rows[n > 0], n[n > 0]
            means = part.matrix[rows].sum(axis=1) / n[:, None]
            place = pa.array((at - first[at]).astype(np.int32))
            yield [part.rows["doc_id"].take(pa.array(part.owner[at])), place, part.flat.take(pa.array(at)), lists(means)]

    doc, centre = encoded.schema["doc_id"].dataType.simpleString(), vectors.schema["id"].dataType.simpleString()
    rows = encoded.select("doc_id", F.col("ids").cast(f"array<{centre}>").alias("ids"))
    schema = f"doc_id {doc}, pos int, center {centre}, vec array<double>"
    return map_blocks(rows, "doc_id", "ids", vectors, "id", work, schema, limit=limit)


def most_similar(questions: DataFrame, vectors: DataFrame, topn: int = 10, item: str = "word") -> DataFrame:
    """``(question_id, item, score, rank)``: nearest items to a signed mean of unit vectors.

    ``questions(question_id, item, weight)``: weight 1 adds the item, -1 subtracts it,
    any other number scales it. A row may carry ``vec`` in place of the item. The items
    of a question are left out of its answer. An unknown item is an error.
    """
    keyed = vectors.select("id", item, "vec")
    units = keyed.select(F.col(item), F.col("id").alias("_id"), l2_normalize(F.col("vec")).alias("_unit"))
    inputs = lookup_join(questions, units, item, "left")
    raw = doubles(F.col("vec")) if "vec" in questions.columns else F.lit(None).cast("array<double>")
    unknown = F.raise_error(F.concat(F.lit("unknown item "), F.col(item).cast("string"))).cast("array<double>")
    value = F.coalesce(raw, F.col("_unit"), F.when(F.col("_id").isNull(), unknown))
    inputs = inputs.withColumn("_value", F.transform(value, lambda x: x * F.col("weight")))
    inputs = materialize(inputs.select("question_id", "_id", "_value"), "question-inputs")
    mean = mean_vector(F.col("_value"), width=vector_width(vectors))
    means = inputs.groupBy("question_id").agg(mean.alias("vec"), F.count("_id").cast("int").alias("more"))
    index = keyed.select(F.col("id").alias("doc_id"), "vec")
    # a question gets as many rows more as it names items, which are left out again
    found = nearest(index, means.withColumnRenamed("question_id", "query_id"), topn)
    used = inputs.select(F.col("question_id").alias("query_id"), F.col("_id").alias("doc_id")).dropna()
    left = best_k(found.drop("rank").join(used, ["query_id", "doc_id"], "left_anti"), topn)
    named = attach(left, keyed.select(F.col("id").alias("doc_id"), item), "doc_id")
    return named.select(
        F.col("query_id").alias("question_id"), item, F.col("doc_id").alias("id"), "score", "rank"
    )


def search_vector(queries: DataFrame, vectors: DataFrame, topn: int = 10) -> DataFrame:
    """``(query_id, word, score, rank)``: the words nearest to raw ``queries(query_id, vec)``.

    For every score instead of the best, use ``similarity.dense_cosine``.
    """
    index = vectors.select(F.col("id").alias("doc_id"), "vec")
    found = nearest(index, queries, topn)
    names = vectors.select(F.col("id").alias("doc_id"), "word")
    return attach(found, names, "doc_id").select("query_id", "word", "score", "rank")


def analogy_accuracy(questions: DataFrame, vectors: DataFrame, restrict_vocab: int | None = 30_000) -> DataFrame:
    """``(section, correct, incorrect)`` per section, and ``total``.

    ``questions(section, a, b, c, expected)`` asks for the word nearest to b + c - a among
    the most frequent words (all of them if ``restrict_vocab`` is None), other than a, b and
    c. Questions with other words are skipped.
    ``vectors(word, id, vec, cf)``.
    """
    frequent = vectors if restrict_vocab is None else restrict_vocabulary(vectors, restrict_vocab)
    frequent = frequent.select("word", F.col("id").alias("doc_id"), l2_normalize(F.col("vec")).alias("vec"))
    frequent = materialize(frequent, "frequent")
    small = fits_broadcast(frequent)
    asked = questions.withColumn("query_id", F.xxhash64("section", "a", "b", "c", "expected"))
    asked = asked.select("query_id", "section", "a", "b", "c", "expected")
    for role in ("a", "b", "c", "expected"):
        names = frequent.select(
            F.col("word").alias(role), F.col("doc_id").alias(f"{role}_id"), F.col("vec").alias(f"{role}_vec")
        )
        asked = lookup_join(asked, names.drop("expected_vec"), role, small=small)
    asked = materialize(asked, "questions")
    mix = F.transform(
        F.arrays_zip(F.col("b_vec").alias("b"), F.col("c_vec").alias("c"), F.col("a_vec").alias("a")),
        lambda x: (x["b"] + x["c"] - x["a"]) / 3,
    )
    distinct_questions = asked.select("query_id", mix.alias("vec")).dropDuplicates(["query_id"])
    found = nearest(frequent, distinct_questions, 4)
    inputs = asked.select(
        "query_id", F.explode(F.array("a_id", "b_id", "c_id")).alias("doc_id")
    ).distinct()
    answers = best_k(found.drop("rank").join(inputs, ["query_id", "doc_id"], "left_anti"), 1)
    judged = asked.join(answers.select("query_id", "doc_id"), "query_id", "left")
    right = F.coalesce(F.col("doc_id") == F.col("expected_id"), F.lit(False))
    counted = judged.select("section", right.cast("long").alias("right"), (~right).cast("long").alias("wrong"))
    none = F.lit(0).cast("long")
    every = questions.select("section").distinct().select("section", none.alias("right"), none.alias("wrong"))
    rolled = counted.unionByName(every).rollup("section").agg(
        F.grouping("section").alias("_total"),
        F.sum("right").alias("correct"),
        F.sum("wrong").alias("incorrect"),
    )
    section = F.when(F.col("_total") == 1, F.lit("total")).otherwise(F.col("section"))
    return rolled.select(section.alias("section"), "correct", "incorrect")
