"""Counting words and giving them ids.

``tokens`` is ``(doc_id, words array<string>)``, one row per document. All counts
are plain aggregates, so frequent words are summed up before the shuffle.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweft.functions.arrays import let
from textweft.lookup import lookup_join
from textweft.ordered import number_rows
from textweft.scratch import materialize
from textweft.sources.vectors import PAD, PADDING, UNKNOWN, UNKNOWN_CAPITAL


def word_rows(tokens: DataFrame, *keep: str, words: str | Column = "words") -> DataFrame:
    """``(*keep, word)``, one row per word.

    The outer form keeps Catalyst from adding a non-empty test on the array, which
    would tokenize every text a second time.
    """
    rows = tokens.select(*keep, F.explode_outer(words).alias("word"))
    return rows.filter(F.col("word").isNotNull())


def placed_words(tokens: DataFrame, *keep: str, words: str | Column = "words") -> DataFrame:
    """``(*keep, pos, word)``, one row per word, 0-based."""
    rows = tokens.select(*keep, F.posexplode_outer(words).alias("pos", "word"))
    return rows.filter(F.col("word").isNotNull())


def token_counts(tokens: DataFrame) -> DataFrame:
    """``(word, n)``: occurrences in the corpus."""
    return word_rows(tokens).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_statistics(tokens: DataFrame) -> DataFrame:
    """``(word, cf, df, first_doc)`` in one pass and one shuffle on the word.

    Sorting a document's words puts repeats side by side, so the first of each run
    counts the document once without a distinct.
    """
    marked = let(
        F.array_sort("words"),
        lambda ordered: F.transform(
            ordered,
            lambda w, i: F.struct(w.alias("word"), ((i == 0) | (w != F.get(ordered, i - 1))).alias("first")),
        ),
    )
    rows = (
        tokens.select("doc_id", F.explode_outer(marked).alias("t"))
        .select("doc_id", "t.word", "t.first")
        .filter(F.col("word").isNotNull())
    )
    return rows.groupBy("word").agg(
        F.count(F.lit(1)).alias("cf"),
        F.count_if("first").alias("df"),
        F.min("doc_id").alias("first_doc"),
    )


def document_frequency(tokens: DataFrame) -> DataFrame:
    """``(word, df)``: documents that hold the word."""
    rows = word_rows(tokens, words=F.array_distinct("words"))
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("df"))


def drop_rare(tokens: DataFrame, more_than: int = 1, limit: int | None = None) -> DataFrame:
    """Remove words that occur ``more_than`` times or less in the corpus; order is kept."""
    kept = materialize(token_counts(tokens).filter(F.col("n") > more_than), "kept-words")
    return _regroup(tokens, kept, F.col("n").isNotNull(), "n", limit)


def drop_listed_words(tokens: DataFrame, listed: DataFrame, limit: int | None = None) -> DataFrame:
    """Remove the words of a table ``listed(word)``, for stop word lists of any length."""
    marked = materialize(listed.select("word").distinct().join(token_counts(tokens), "word"), "listed-words")
    return _regroup(tokens, marked, F.col("n").isNull(), "n", limit)


def _regroup(tokens: DataFrame, words: DataFrame, keep: Column, weight: str, limit: int | None) -> DataFrame:
    """Filter the words of each document by a look-up table; emptied documents stay."""
    rows = tokens.select("doc_id", F.posexplode_outer("words").alias("pos", "word"))
    rows = lookup_join(rows, words, "word", "left", weight=weight, limit=limit)
    kept = F.when(keep & F.col("word").isNotNull(), F.struct("pos", "word"))
    return rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(kept))["word"].alias("words"))


def build_dictionary(tokens: DataFrame, min_cf: int = 1) -> DataFrame:
    """``(word, id, df, cf)``; ids follow the first document, then the word."""
    stats = word_statistics(tokens)
    if min_cf > 1:
        stats = stats.filter(F.col("cf") >= min_cf)
    return number_rows(stats, ["first_doc", "word"], label="dictionary").select("word", "id", "df", "cf")


def dictionary_report(vocab: DataFrame) -> DataFrame:
    """``(word, id, freq)`` in id order; ``freq`` is the document frequency."""
    return vocab.select("word", "id", F.col("df").alias("freq")).orderBy("id")


def filter_extremes(
    vocab: DataFrame, n_docs: int, no_below: int = 20, no_above: float = 0.5, keep_n: int = 100_000
) -> DataFrame:
    """Keep words in at least ``no_below`` documents and at most ``no_above`` of them.

    Of these the ``keep_n`` most frequent stay; ids close up in their old order.
    """
    kept = vocab.filter((F.col("df") >= no_below) & (F.col("df") <= no_above * n_docs))
    top = most_frequent(kept, [F.desc("df"), "id"], keep_n).withColumnRenamed("id", "old_id")
    return number_rows(top, ["old_id"], label="filtered").drop("old_id")


def most_frequent(vocab: DataFrame, order: list, n: int) -> DataFrame:
    """The first ``n`` rows in order. For large ``n`` no task has to hold them all."""
    ranked = number_rows(vocab, order, name="_rank", label="ranked")
    return ranked.filter(F.col("_rank") < n).drop("_rank")


def min_count_vocabulary(tokens: DataFrame, min_count: int = 5) -> DataFrame:
    """``(word, id, cf)`` of words with at least ``min_count`` occurrences.

    Ids go by falling count, then by word.
    """
    return number_by_count(token_counts(tokens).filter(F.col("n") >= min_count))


def number_by_count(counts: DataFrame) -> DataFrame:
    """``counts(word, n)`` to ``(word, id, cf)``."""
    renamed = counts.withColumnRenamed("n", "cf")
    return number_rows(renamed, [F.desc("cf"), "word"], label="vocabulary").select("word", "id", "cf")


def extend_vocabulary(vocab: DataFrame, tokens: DataFrame, min_count: int = 5) -> DataFrame:
    """Add the counts of new text; new words of ``min_count`` or more get the next ids.

    New ids go by falling count, then by word.
    """
    counts = token_counts(tokens)
    known = vocab.join(counts, "word", "left").select(
        "word", "id", (F.col("cf") + F.coalesce("n", F.lit(0))).alias("cf")
    )
    fresh = counts.filter(F.col("n") >= min_count).join(vocab, "word", "left_anti")
    first = (vocab.agg(F.max("id")).first()[0] + 1) if not vocab.isEmpty() else 0
    numbered = number_rows(fresh, [F.desc("n"), "word"], start=first, label="new-words")
    return known.unionByName(numbered.select("word", "id", F.col("n").alias("cf")))


def _add_word(vocab: DataFrame, word: str, count) -> DataFrame:
    """Append one word with the next id, unless it is there."""
    row = vocab.agg(
        F.lit(word).alias("word"),
        (F.coalesce(F.max("id"), F.lit(-1)) + 1).cast(vocab.schema["id"].dataType).alias("id"),
        F.lit(count).cast("long").alias("cf"),
        F.coalesce(F.bool_or(F.col("word") == word), F.lit(False)).alias("_there"),
    )
    return vocab.unionByName(row.filter(~F.col("_there")).drop("_there"))


def add_oov(vocab: DataFrame, count: int = 1) -> DataFrame:
    """Append the two markers for unknown words; look-ups use the first."""
    columns = vocab.select("word", "id", "cf")
    return _add_word(_add_word(columns, UNKNOWN, count), UNKNOWN_CAPITAL, count)


def add_padding_word(vocab: DataFrame, count: int = 1_000_000) -> DataFrame:
    return _add_word(vocab.select("word", "id", "cf"), PADDING, count)


def restrict_vocabulary(vocab: DataFrame, top_n: int = 30_000) -> DataFrame:
    """The ``top_n`` most frequent words."""
    return most_frequent(vocab, [F.desc("cf"), "word"], top_n)


def map_oov(words: DataFrame, vocab: DataFrame, limit: int | None = None) -> DataFrame:
    """Add the id of each ``word``: its own, or that of the unknown marker.

    Without a marker in the vocabulary, unknown words are dropped.
    """
    unknown = vocab.filter(F.col("word") == UNKNOWN).agg(F.max("id").alias("id"))
    known = lookup_join(words, vocab.select("word", "id", "cf"), "word", "left", weight="cf", limit=limit)
    ids = F.coalesce(F.col("id"), unknown.scalar())
    return known.withColumn("id", ids).drop("cf").filter(F.col("id").isNotNull())


def insertion_dictionary(tokens: DataFrame) -> DataFrame:
    """``(word, id)``: the pad word is 0, others follow their first occurrence."""
    # a document's distinct words keep the order in which they first come
    firsts = (
        placed_words(tokens, "doc_id", words=F.array_distinct("words"))
        .filter(F.col("word") != PAD)
        .groupBy("word")
        .agg(F.min(F.struct("doc_id", "pos")).alias("first"))
    )
    words = number_rows(firsts, ["first"], start=1, label="insertion").select("word", "id")
    pad = tokens.sparkSession.range(1).select(F.lit(PAD).alias("word"), F.lit(0).cast("long").alias("id"))
    return pad.unionByName(words)


def paragraph_digest(text: str | Column) -> Column:
    """What tells texts apart in :func:`paragraph_vocabulary`."""
    return F.sha2(text, 256)


def paragraph_vocabulary(paragraphs: DataFrame) -> DataFrame:
    """``(para_id, digest, first_doc, copies)`` of the distinct texts in order of first appearance.

    Texts are told apart by their digest, so no text is shuffled, and copies are merged
    before the shuffle. :func:`paragraph_texts` gives the texts.
    """
    firsts = paragraphs.groupBy(paragraph_digest("text").alias("digest")).agg(
        F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies")
    )
    numbered = number_rows(firsts, ["first_doc"], name="para_id", label="paragraphs")
    return numbered.select("para_id", "digest", "first_doc", "copies")


def paragraph_texts(vocab: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """``(para_id, text)`` from the documents where the texts first appeared."""
    owners = vocab.select("para_id", F.col("first_doc").alias("doc_id"))
    return owners.join(paragraphs.select("doc_id", "text"), "doc_id").select("para_id", "text")


def paragraph_ids(paragraphs: DataFrame, vocab: DataFrame, limit: int | None = None) -> DataFrame:
    """``(doc_id, para_id)`` of ``paragraphs(doc_id, text)``; unknown texts are dropped."""
    keyed = paragraphs.select("doc_id", paragraph_digest("text").alias("digest"))
    known = vocab.select("digest", "para_id", "copies")
    return lookup_join(keyed, known, "digest", weight="copies", limit=limit).select("doc_id", "para_id")


def corpus_statistics(tokens: DataFrame) -> DataFrame:
    """Exact ``(n_sentences, n_words, n_word_types, n_paragraph_types)``."""
    sizes = tokens.agg(
        F.count(F.lit(1)).alias("n_sentences"), F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("n_words")
    )
    types = token_counts(tokens).agg(F.count(F.lit(1)).alias("n_word_types"))
    keys = tokens.select(F.array_join("words", " ").alias("key")).select(paragraph_digest("key").alias("digest"))
    paragraphs = keys.distinct().agg(F.count(F.lit(1)).alias("n_paragraph_types"))
    return sizes.select(
        "n_sentences",
        "n_words",
        types.scalar().alias("n_word_types"),
        paragraphs.scalar().alias("n_paragraph_types"),
    )


def corpus_statistics_approx(tokens: DataFrame, rsd: float = 0.02) -> DataFrame:
    """One pass without a shuffle of words: distinct counts are estimates."""
    words = word_rows(tokens).agg(F.approx_count_distinct("word", rsd).alias("n_word_types"))
    return tokens.agg(
        F.count(F.lit(1)).alias("n_sentences"),
        F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("n_words"),
        F.approx_count_distinct(F.array_join("words", " "), rsd).alias("n_paragraph_types"),
    ).select("*", words.scalar().alias("n_word_types"))


def words_seen(tokens: DataFrame, vocab: DataFrame, max_words: int, limit: int | None = None) -> DataFrame:
    """In-vocabulary tokens among the first ``max_words`` of each sentence."""
    counted = word_rows(tokens, words=F.slice("words", 1, max_words)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    seen = lookup_join(counted, vocab.select("word"), "word", "left_semi", limit=limit)
    return seen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("words_seen"))
