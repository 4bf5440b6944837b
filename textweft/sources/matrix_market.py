"""MatrixMarket coordinate files, as a folder of ordered parts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweft.scratch import materialize
from textweft.sources.lines import read_ordered_lines

BANNER = "%%MatrixMarket matrix coordinate real general"


def write_mm(entries: DataFrame, path: str, value: str = "tf", row: str = "doc_id", column: str = "id") -> None:
    """Write ``(row, column, value)`` 1-based, in row-major order after the header."""
    cells = entries.select(
        F.col(row).cast("long").alias("r"),
        F.col(column).cast("long").alias("c"),
        F.col(value).cast("double").alias("v"),
    )
    cells = materialize(cells, "matrix-cells")  # the size, the ranges and the lines are read from one result
    whole = F.col("v") == F.floor("v")
    number = F.when(whole, F.col("v").cast("long").cast("string")).otherwise(F.col("v").cast("string"))
    body = cells.select("r", "c", F.concat_ws(" ", F.col("r") + 1, F.col("c") + 1, number).alias("value"))
    size = cells.agg(
        F.concat_ws(
            " ", F.coalesce(F.max("r") + 1, F.lit(0)), F.coalesce(F.max("c") + 1, F.lit(0)), F.count(F.lit(1))
        ).alias("value")
    ).select(F.lit(-1).cast("long").alias("r"), F.lit(0).cast("long").alias("c"), "value")
    banner = entries.sparkSession.range(1).select(
        F.lit(-2).cast("long").alias("r"), F.lit(0).cast("long").alias("c"), F.lit(BANNER).alias("value")
    )
    lines = banner.unionByName(size).unionByName(body)
    lines.repartitionByRange("r", "c").sortWithinPartitions("r", "c").select("value").write.text(path)


def read_mm(spark: SparkSession, path: str, value: str = "tf", row: str = "doc_id", column: str = "id") -> DataFrame:
    """``(row, column, value)`` 0-based. The first line that is no comment is the size line."""
    lines = read_ordered_lines(spark, path).filter(
        ~F.col("text").startswith("%") & (F.trim("text") != "")
    )
    size_line = lines.agg(F.min("line_order").alias("line_order"))
    parts = F.split(F.trim("text"), r"\s+")
    return (
        lines.join(F.broadcast(size_line), "line_order", "left_anti")
        .select(parts.alias("p"))
        .select(
            (F.col("p")[0].cast("long") - 1).alias(row),
            (F.col("p")[1].cast("long") - 1).alias(column),
            F.col("p")[2].cast("double").alias(value),
        )
    )
