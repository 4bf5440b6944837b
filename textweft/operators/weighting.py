"""TF-IDF weights in long form ``(doc_id, id, w)``."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textweft.lookup import lookup_join


def tfidf_fit(bow: DataFrame, n_docs: int) -> DataFrame:
    """``(id, df, n_docs)`` of a bag-of-words table with one row per document and id."""
    return bow.groupBy("id").agg(F.count(F.lit(1)).alias("df")).withColumn("n_docs", F.lit(n_docs))


def tfidf_transform(
    bow: DataFrame, model: DataFrame, key: str = "id", doc: str = "doc_id", limit: int | None = None
) -> DataFrame:
    """``(doc, key, w)``: ``tf * log2(N / df)`` at unit length per document.

    Zero weights and unknown ids vanish. Rows of ``bow`` that are already partitioned
    by document are not shuffled while the model fits a broadcast.
    """
    known = lookup_join(bow, model.select(key, "df", "n_docs"), key, weight="df", limit=limit)
    raw = known.select(
        doc, key, (F.col("tf") * F.log2(F.col("n_docs") / F.col("df"))).alias("w")
    ).filter(F.col("w") != 0)
    return l2_normalize_rows(raw, doc)


def l2_normalize_rows(weights: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Divide ``w`` by the length of its document's vector; zero vectors are dropped."""
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc)))
    return (
        weights.withColumn("_length", length)
        .filter(F.col("_length") > 0)
        .withColumn("w", F.col("w") / F.col("_length"))
        .drop("_length")
    )
