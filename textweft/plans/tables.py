"""The tables the registered queries read, and shared steps on them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textweft.functions import text as tx
from textweft.operators.bags import by_document, doc2bow
from textweft.operators.blocks import encode_words
from textweft.operators.vocabulary import build_dictionary, min_count_vocabulary
from textweft.operators.weighting import tfidf_transform
from textweft.scratch import materialize
from textweft.sources.vectors import vectors_from_matrix


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out over all cores when the files give fewer splits than cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def word_tokens(texts: DataFrame, id: str = "doc_id") -> DataFrame:
    """``(id, words)``: lower-case words without the short stop word list."""
    return texts.select(id, tx.remove_stopwords(tx.tokenize_word(F.col("text"))).alias("words"))


def document_words(spark: SparkSession, sf: str, grouped: bool = False) -> DataFrame:
    """``(doc_id, words)``; ``grouped`` when the next steps work by document."""
    texts = documents(spark, sf)
    return word_tokens(by_document(texts) if grouped else spread(texts))


def benchmark_words(spark: SparkSession, sf: str) -> DataFrame:
    """The benchmark texts as ``(doc_id, words)``."""
    texts = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return word_tokens(by_document(texts))


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """``(word, id, df, cf)`` of words that occur at least twice."""
    return build_dictionary(document_words(spark, sf), min_cf=2)


def bow(spark: SparkSession, sf: str, vocab: DataFrame | None = None) -> DataFrame:
    return doc2bow(document_words(spark, sf, True), vocab if vocab is not None else dictionary(spark, sf))


def with_size(vocab: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """The dictionary as a TF-IDF model: ``(…, id, df, n_docs)``."""
    return vocab.withColumn("n_docs", F.lit(table(spark, sf, "documents").count()))


def weights(spark: SparkSession, sf: str, vocab: DataFrame | None = None) -> DataFrame:
    """TF-IDF ``(doc_id, id, w)`` of the documents."""
    vocab = vocab if vocab is not None else dictionary(spark, sf)
    return tfidf_transform(bow(spark, sf, vocab), with_size(vocab, spark, sf))


def query_weights(spark: SparkSession, sf: str, vocab: DataFrame) -> DataFrame:
    """TF-IDF ``(query_id, id, w)`` of the benchmark texts in the documents' model."""
    asked = doc2bow(benchmark_words(spark, sf), vocab)
    return tfidf_transform(asked, with_size(vocab, spark, sf)).withColumnRenamed("doc_id", "query_id")


def embedding_words(spark: SparkSession, sf: str) -> DataFrame:
    """The embeddings as word vectors ``(id, word, vec)``."""
    rows = table(spark, sf, "embeddings").withColumn("word", F.concat(F.lit("w"), F.col("vec_id")))
    return vectors_from_matrix(rows, "vec_id", "embedding", "word")


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """``(word, id, cf)`` of words with five or more occurrences."""
    return min_count_vocabulary(document_words(spark, sf), 5)


def weighted(vec: str) -> Column:
    """All numbers of a vector in one: the first once, the second twice, …"""
    return F.aggregate(F.transform(vec, lambda x, i: x * (i + 1)), F.lit(0.0), lambda total, x: total + x)


def word_vectors(spark: SparkSession, sf: str, vocab: DataFrame | None = None) -> DataFrame:
    """``(id, word, cf, vec)``: embeddings dealt out in turn to the vocabulary.

    Every embedding serves equally many words, so the join has no hot key.
    """
    vocab = vocab if vocab is not None else vocabulary(spark, sf)
    given = table(spark, sf, "embeddings")
    n = given.count()
    rows = given.select(F.col("vec_id").alias("turn"), F.col("embedding").cast("array<double>").alias("vec"))
    dealt = vocab.withColumn("turn", F.pmod("id", F.lit(n)))
    return materialize(dealt.join(rows, "turn").select("id", "word", "cf", "vec"), "word-vectors")


def encoded_documents(spark: SparkSession, sf: str, vocab: DataFrame) -> DataFrame:
    """``(doc_id, ids)``; words outside the vocabulary are null."""
    return encode_words(document_words(spark, sf), vocab)


def document_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, line_no, lang, line)``."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "lang", "text"))
    return docs.select("doc_id", "lang", F.posexplode(F.split("text", tx.LINE_BREAK)).alias("line_no", "line"))
