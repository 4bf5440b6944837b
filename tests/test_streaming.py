from pyspark.sql import functions as F

from textweft.functions import text as tx
from textweft.operators import bags, similarity, vocabulary, weighting
from textweft.scratch import materialize
from textweft.streaming import scoring, vocabulary as streams


def arrive(spark, folder, *batches):
    for texts in batches:
        rows = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
        rows.write.mode("append").parquet(folder)


def test_streamed_counts_equal_the_batch(spark, tmp_path):
    folder, counts, state = (str(tmp_path / n) for n in ("in", "counts", "state"))
    words = tx.tokenize_ws(F.col("text"))

    def run():
        arriving = streams.stream_documents(spark, folder, "*.parquet", "doc_id long, text string", 1)
        streams.stream_extend_vocabulary(arriving, words, counts, state).awaitTermination()

    arrive(spark, folder, [(0, "a b a")], [(1, "c a")])
    run()
    arrive(spark, folder, [(2, "c d")])
    run()
    seen = dict(map(tuple, streams.streamed_vocabulary(spark, counts).collect()))
    whole = spark.read.parquet(folder).select(words.alias("words"))
    assert seen == dict(map(tuple, vocabulary.token_counts(whole).collect())) == {"a": 3, "b": 1, "c": 2, "d": 1}
    assert dict(map(tuple, streams.streamed_vocabulary(spark, counts, 2).collect())) == {"a": 3, "c": 2}

    # a batch that is replayed overwrites itself
    again = str(tmp_path / "state-lost")
    arriving = streams.stream_documents(spark, folder, "*.parquet", "doc_id long, text string", 1)
    streams.stream_extend_vocabulary(arriving, words, counts, again).awaitTermination()
    assert dict(map(tuple, streams.streamed_vocabulary(spark, counts).collect())) == seen

    streams.compact_counts(spark, counts, str(tmp_path / "compact"))
    assert dict(map(tuple, streams.streamed_vocabulary(spark, str(tmp_path / "compact")).collect())) == seen


def test_streamed_scores_equal_the_batch(spark, titles, tmp_path):
    vocab = vocabulary.build_dictionary(titles, min_cf=2)
    model = vocab.withColumn("n_docs", F.lit(9))
    bow = bags.doc2bow(titles, vocab)
    index = materialize(weighting.tfidf_transform(bow, model), "index")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, folder, [(100, "human computer interaction")], [(101, "graph trees"), (102, "nothing known")])
    arriving = streams.stream_documents(spark, folder, "*.parquet", "doc_id long, text string", 1)
    queries = arriving.select("doc_id", tx.tokenize_ws(F.col("text")).alias("words"))
    scoring.stream_score(queries, index, model, 2, out, str(tmp_path / "state")).awaitTermination()
    found = sorted(map(tuple, scoring.scored(spark, out).collect()))

    asked = spark.read.parquet(folder).select("doc_id", tx.tokenize_ws(F.col("text")).alias("words"))
    weights = weighting.tfidf_transform(bags.doc2bow(asked, vocab), model).withColumnRenamed("doc_id", "query_id")
    batch = similarity.best_k(similarity.positive_scores(index, weights), 2)
    assert found == sorted(map(tuple, batch.collect())) and len({r[0] for r in found}) == 2


def test_stream_of_a_table_that_is_a_folder(spark, tmp_path):
    rows = spark.createDataFrame([(1, "b a b"), (2, "c b")], "doc_id long, text string")
    rows.repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    arriving = streams.stream_documents(spark, f"{tmp_path}/", "documents.parquet", "doc_id long, text string")
    counts = f"{tmp_path}/counts"
    assert streams.streamed_vocabulary(spark, counts).count() == 0
    streams.stream_extend_vocabulary(arriving, F.split("text", " "), counts, f"{tmp_path}/state").awaitTermination()
    assert {r.word: r.n for r in streams.streamed_vocabulary(spark, counts).collect()} == {"a": 1, "b": 3, "c": 1}
