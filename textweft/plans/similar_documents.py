"""From two tables of text to the most similar documents by TF-IDF cosine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweft.lookup import fits_broadcast, lookup_join
from textweft.operators.bags import term_counts
from textweft.operators.similarity import best_k, positive_scores, similarity_join
from textweft.operators.vocabulary import word_statistics
from textweft.operators.weighting import tfidf_transform
from textweft.ordered import number_rows
from textweft.scratch import materialize


def word_model(tokens: DataFrame, min_cf: int = 2) -> DataFrame:
    """``(word, df, n_docs)`` of words occurring at least ``min_cf`` times.

    Nothing here needs dense ids, so the word itself is the key.
    """
    n_docs = tokens.count()
    stats = word_statistics(tokens).filter(F.col("cf") >= min_cf)
    return materialize(stats.select("word", "df", F.lit(n_docs).alias("n_docs")), "word-model")


def most_similar_documents(documents: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``(query_id, doc_id, score, rank)`` for ``documents`` and ``queries``, both
    ``(doc_id, words)`` and partitioned by document; words that occur once in the
    documents are ignored."""
    model = word_model(documents)
    asked = tfidf_transform(term_counts(queries), model, "word")
    asked = asked.withColumnRenamed("doc_id", "query_id")
    weights = tfidf_transform(term_counts(documents), model, "word")
    if fits_broadcast(asked):
        return best_k(positive_scores(weights, asked, "word", small=True), k)
    ids = number_rows(model, ["word"], label="word-ids").select("word", "id", "df")
    return similarity_join(
        lookup_join(weights, ids, "word", weight="df"), lookup_join(asked, ids, "word", weight="df"), k
    )
