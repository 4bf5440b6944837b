"""Word counts kept up to date while documents arrive."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textweft.operators.vocabulary import token_counts


def stream_documents(spark: SparkSession, folder: str, pattern: str, schema: str, per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving in a folder, as an unbounded table; ``per_trigger`` bounds a batch's files.

    ``pattern`` names files, or tables that are folders of files themselves.
    """
    reader = spark.readStream.schema(schema)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(f"{folder.rstrip('/')}/{{{pattern}}}")


def stream_extend_vocabulary(arriving: DataFrame, words: Column, counts_path: str, checkpoint: str) -> StreamingQuery:
    """Add up the words of each micro-batch under ``counts_path/batch_id=N``.

    A batch only writes its own counts and overwrites them when it is replayed, so
    nothing is counted twice and no earlier count is read again.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        counts = token_counts(batch.select(words.alias("words")))
        counts.write.mode("overwrite").parquet(f"{counts_path}/batch_id={batch_id}")

    return (
        arriving.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def streamed_vocabulary(spark: SparkSession, counts_path: str, min_count: int = 1) -> DataFrame:
    """``(word, n)`` of everything that has arrived; rare words stay counted, not shown."""
    schema = "word string, n long, batch_id long"
    try:
        counts = spark.read.schema(schema).parquet(counts_path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        counts = spark.createDataFrame([], schema)  # nothing has arrived yet
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def compact_counts(spark: SparkSession, counts_path: str, new_path: str) -> None:
    """Write the counts of all batches into one, for a fresh start at ``new_path``."""
    streamed_vocabulary(spark, counts_path).write.parquet(f"{new_path}/batch_id=-1")
