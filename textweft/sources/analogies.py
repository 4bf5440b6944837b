"""Analogy question files: ``: SECTION`` lines, then lines of four words."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweft.functions.text import split_ws
from textweft.ordered import carry_forward
from textweft.sources.lines import read_ordered_lines


def read_analogies(spark: SparkSession, path: str) -> DataFrame:
    """``(section, line_order, a, b, c, expected)``; malformed lines are left out.

    The parts of a folder are read on from one to the next. A question before any
    section header is an error.
    """
    lines = read_ordered_lines(spark, path)
    header = F.when(
        F.col("text").startswith(": "),
        F.trim(F.regexp_replace("text", "^[: ]+", "")),
    )
    placed = carry_forward(lines.withColumn("_header", header), ["line_order"], "_header", "_section", "analogies")
    words = split_ws(F.col("text"))
    section = F.when(
        F.col("_section").isNull(), F.raise_error(F.lit("question before the first section header"))
    ).otherwise(F.col("_section"))
    return (
        placed.filter(F.col("_header").isNull())
        .withColumn("w", words)
        .filter(F.size("w") == 4)
        .select(
            section.alias("section"),
            "line_order",
            F.col("w")[0].alias("a"),
            F.col("w")[1].alias("b"),
            F.col("w")[2].alias("c"),
            F.col("w")[3].alias("expected"),
        )
    )


def write_analogies(questions: DataFrame, path: str, section: str = "section", order: str = "line_no") -> None:
    """Write ``(section, order, a, b, c, expected)`` with a header before each section."""
    body = questions.select(
        F.col(section).cast("string").alias("s"),
        F.col(order).cast("long").alias("o"),
        F.concat_ws(" ", "a", "b", "c", "expected").alias("value"),
    )
    heads = body.groupBy("s").agg((F.min("o") - 1).alias("o")).withColumn("value", F.concat(F.lit(": "), "s"))
    lines = heads.unionByName(body)
    lines.repartitionByRange("s", "o").sortWithinPartitions("s", "o").select("value").write.text(path)
