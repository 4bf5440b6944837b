"""JSON-lines reviews and labelled token lines."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REVIEW_SCHEMA = "text string, stars int"
TOKEN_LINE_SCHEMA = "label int, text array<string>"


def read_reviews_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """``(text, stars)``; lines lacking either field are dropped."""
    return spark.read.schema(REVIEW_SCHEMA).json(path).dropna()


def write_tokens_jsonl(df: DataFrame, path: str) -> None:
    """Write ``{"label": int, "text": [str, …]}`` lines."""
    df.select(F.col("label").cast("int").alias("label"), "text").write.json(path)


def read_tokens_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOKEN_LINE_SCHEMA).json(path)
