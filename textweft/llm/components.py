"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join; nothing but a change signature reaches the
driver. Each task first reduces its own links to a spanning forest, so that dense groups of
links shrink before the first shuffle. Tables between steps lie in the shared folder.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweft.llm.common import tidy
from textweft.scratch import materialize


def local_forest(links: DataFrame) -> DataFrame:
    """Links ``(a, b)`` with ``a > b`` that join the same nodes, at most one per node and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent.setdefault(up, up)
            return x

        def flush() -> pa.RecordBatch:
            pairs = [(x, r) for x in list(parent) if (r := root(x)) != x]
            parent.clear()
            columns = [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            if len(parent) > 1_000_000:
                yield flush()
        yield flush()

    return links.select("a", "b").mapInArrow(tidy(run), "a long, b long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    moved = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with a link; the root is the least node reachable.

    ``links`` has two whole-number columns ``a`` and ``b`` in any order; nulls, self-links and
    repeats are ignored. An empty table gives an empty result.
    """
    pairs = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = materialize(local_forest(pairs).distinct(), "links")
    before = _signature(edges)
    while before[0]:
        edges = materialize(_small_star(_large_star(edges)), "stars")
        now = _signature(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
