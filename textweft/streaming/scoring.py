"""Arriving text scored against a fixed index."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from textweft.lookup import fits_broadcast
from textweft.operators.bags import doc2bow
from textweft.operators.similarity import best_k, positive_scores, similarity_join
from textweft.operators.weighting import tfidf_transform
from textweft.scratch import materialize


def stream_score(
    arriving: DataFrame, index: DataFrame, model: DataFrame, k: int, out_path: str, checkpoint: str
) -> StreamingQuery:
    """Write the ``k`` most similar documents of each arriving ``(doc_id, words)``.

    ``index(doc_id, id, w)`` and ``model(word, id, df, n_docs)`` are written tables. Each
    micro-batch overwrites its own part of ``out_path``, so a replay changes nothing.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        weights = tfidf_transform(doc2bow(batch, model), model)
        queries = materialize(weights.withColumnRenamed("doc_id", "query_id"), "arrived")
        if fits_broadcast(queries):
            found = best_k(positive_scores(index, queries, small=True), k)
        else:
            found = similarity_join(index, queries, k)
        found.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return (
        arriving.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def scored(spark: SparkSession, out_path: str) -> DataFrame:
    rows = spark.read.schema("query_id long, doc_id long, score double, rank int, batch_id long").parquet(out_path)
    return rows.drop("batch_id")
