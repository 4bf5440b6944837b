"""Saved vocabularies, dictionaries and model tables."""

import json
from collections.abc import Callable
from dataclasses import asdict, fields, is_dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweft.ordered import number_rows
from textweft.sources.lines import read_ordered_lines


def save_table(df: DataFrame, path: str) -> None:
    """Save TF-IDF weights, LSI tables, word vectors or any other model table."""
    df.write.parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model: MLWritable, path: str) -> None:
    """Save a fitted MLlib model (a classifier, a window code)."""
    model.write().save(path)


def save_record(record: object, path: str) -> None:
    """Save a model that is a dataclass of tables and plain values (LSI, LDA, paragraphs).

    Each table goes to a folder of its own, the values to one row of JSON beside them.
    """
    plain, spark = {}, None
    for field in fields(record):
        value = getattr(record, field.name)
        if isinstance(value, DataFrame):
            spark = value.sparkSession
            value.write.parquet(f"{path}/{field.name}")
        else:
            plain[field.name] = asdict(value) if is_dataclass(value) else value
    row = spark.createDataFrame([(json.dumps(plain),)], "value string")
    row.coalesce(1).write.text(f"{path}/_values")


def load_record(kind: type, spark: SparkSession, path: str, **inner: type):
    """Load a model saved by :func:`save_record`; ``inner`` names the classes of nested values."""
    plain = json.loads(spark.read.text(f"{path}/_values").first()["value"])
    plain = {name: inner[name](**value) if name in inner else value for name, value in plain.items()}
    tables = {f.name: spark.read.parquet(f"{path}/{f.name}") for f in fields(kind) if f.name not in plain}
    return kind(**plain, **tables)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _read_if_saved(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def vocabulary_snapshot(
    spark: SparkSession, root: str, corpus: str, min_count: int, build: Callable[[], DataFrame]
) -> DataFrame:
    """The vocabulary saved for this corpus and minimum count, built on first use."""
    path = f"{root}/corpus={corpus}/min_count={min_count}"
    saved = _read_if_saved(spark, path)
    if saved is None:
        build().write.parquet(path)
        saved = spark.read.parquet(path)
    return saved


def save_dictionary_json(vocab: DataFrame, path: str) -> None:
    """One JSON line per word with its id, in id order."""
    ordered = vocab.repartitionByRange("id").sortWithinPartitions("id")
    ordered.select(F.to_json(F.struct("id", "word")).alias("value")).write.text(path)


def load_dictionary_json(spark: SparkSession, path: str) -> DataFrame:
    """``(word, id)``; a file without ids counts its lines."""
    lines = read_ordered_lines(spark, path)
    words = lines.select("line_order", F.from_json("text", "id long, word string").alias("w")).select("line_order", "w.*")
    if not words.filter(F.col("id").isNull()).limit(1).count():
        return words.select("word", "id")
    words = words.drop("id")
    return number_rows(words, ["line_order"], label="dictionary").select("word", "id")
