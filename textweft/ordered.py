"""Global order without a single-task window.

Rows are range-partitioned and sorted, written once, and numbered from the
partition number and the place inside it. Only one small row per partition is
summed up to carry offsets from one partition to the next.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textweft.scratch import materialize

BLOCK, PLACE = "_block", "_place"
_PLACE_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def lay_in_order(df: DataFrame, order: Sequence[str | Column], label: str = "ordered") -> DataFrame:
    """Write ``df`` range-partitioned by ``order`` with its block and place."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    mark = F.monotonically_increasing_id()
    marked = ordered.withColumn("_mark", mark)
    marked = marked.withColumns(
        {
            BLOCK: F.shiftright("_mark", _PLACE_BITS).cast("int"),
            PLACE: F.col("_mark").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)),
        }
    )
    return materialize(marked.drop("_mark"), label)


def _before_block(laid: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Per block, each total summed over all earlier blocks (one row per block)."""
    per_block = laid.groupBy(BLOCK).agg(*[c.alias(n) for n, c in totals.items()])
    earlier = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return per_block.select(
        BLOCK, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in totals]
    )


def number_rows(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "id",
    start: int = 0,
    label: str = "ordered",
) -> DataFrame:
    """Add dense ids ``start, start+1, …`` in the given total order."""
    laid = lay_in_order(df, order, label)
    offsets = _before_block(laid, {"_offset": F.count(F.lit(1))})
    return (
        laid.join(F.broadcast(offsets), BLOCK)
        .withColumn(name, F.col("_offset") + F.col(PLACE) + F.lit(start))
        .drop(BLOCK, PLACE, "_offset")
    )


def running_total(
    df: DataFrame,
    order: Sequence[str | Column],
    value: str,
    name: str,
    label: str = "ordered",
) -> DataFrame:
    """Add the sum of ``value`` over all earlier rows (0 for the first)."""
    laid = lay_in_order(df, order, label)
    offsets = _before_block(laid, {"_offset": F.sum(value)})
    inside = (
        Window.partitionBy(BLOCK).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        laid.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), BLOCK)
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop(BLOCK, PLACE, "_offset", "_inside")
    )


def carry_forward(
    df: DataFrame,
    order: Sequence[str | Column],
    value: str,
    name: str,
    label: str = "ordered",
) -> DataFrame:
    """Add the last non-null ``value`` at or before each row."""
    laid = lay_in_order(df, order, label)
    last_in_block = laid.groupBy(BLOCK).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(PLACE))).alias("_last")
    )
    earlier = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = last_in_block.select(
        BLOCK, F.last("_last", ignorenulls=True).over(earlier).alias("_carried")
    )
    inside = (
        Window.partitionBy(BLOCK).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        laid.withColumn("_inside", F.last(value, ignorenulls=True).over(inside))
        .join(F.broadcast(carried), BLOCK, "left")
        .withColumn(name, F.coalesce("_inside", "_carried"))
        .drop(BLOCK, PLACE, "_inside", "_carried")
    )
