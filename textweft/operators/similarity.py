"""Cosine scores and rankings.

Reports that hold every (query, document) score go over the documents once for each
block of queries that fits a broadcast. Top-k searches take two tables of any size: few
queries travel to the unmoved documents, many visit only blocks that can hold a better hit
(:mod:`textweft.operators.pruned_join` for sparse vectors, :mod:`textweft.operators.pruned_nearest`
for dense ones). Only positive scores are hits of a sparse search, whichever way it takes.

Scores are rounded to ``DIGITS`` before ranking, so that equal vectors tie and
the smaller id comes first whatever the order of summation was.
"""

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textweft.functions.vectors import dot, l2_normalize
from textweft.lookup import BROADCAST_BYTES, lookup_join, measured_bytes
from textweft.operators.pruned_join import DIGITS, similarity_join
from textweft.operators.pruned_nearest import TILE_ROWS, best_rows, nearest_by_clusters, top_rows, wanted_clusters
from textweft.ordered import number_rows
from textweft.scratch import materialize

BLOCK_BYTES = 32 * 1024 * 1024
TRAVEL_BYTES = 2 * 1024 * 1024


def sparse_cosine(
    index: DataFrame, docs: DataFrame, queries: DataFrame, limit: int | None = None
) -> DataFrame:
    """``(query_id, doc_id, score)`` for every query and every row of ``docs``.

    ``index(doc_id, id, w)`` and ``queries(query_id, id, w)`` hold unit vectors.
    Documents without a common term score 0. The output has one row per query and
    document by definition; queries that do not fit a broadcast are worked off in blocks.
    """
    return _by_query_blocks(queries, limit, lambda part: _sparse_report(index, docs, part))


def _by_query_blocks(queries: DataFrame, limit: int | None, report: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One report over all queries, or the union of reports over parts that fit a broadcast."""
    queries = materialize(queries, "asked")
    most = BROADCAST_BYTES if limit is None else limit
    parts = math.ceil(measured_bytes(queries) / max(most, 1))
    if parts <= 1:
        return report(queries)
    part = F.pmod(F.xxhash64("query_id"), F.lit(parts))
    found = [report(queries.filter(part == i)) for i in range(parts)]
    return reduce(DataFrame.unionByName, found)


def _sparse_report(index: DataFrame, docs: DataFrame, queries: DataFrame) -> DataFrame:
    hits = scores_of_common_terms(index, queries)
    found = hits.groupBy("doc_id").agg(
        F.map_from_entries(F.collect_list(F.struct("query_id", "score"))).alias("found")
    )
    ids = queries.agg(F.collect_set("query_id")).scalar()
    every = docs.join(found, "doc_id", "left").select("doc_id", "found", F.explode(ids).alias("query_id"))
    return every.select(
        "query_id", "doc_id", F.coalesce(F.try_element_at("found", F.col("query_id")), F.lit(0.0)).alias("score")
    )


def positive_scores(index: DataFrame, queries: DataFrame, key: str = "id", small: bool = False, limit: int | None = None) -> DataFrame:
    """``(query_id, doc_id, score)`` of pairs with a score above 0 once rounded.

    Queries that do not fit a broadcast are worked off in blocks; ``small`` says that they were measured.
    """

    def report(part: DataFrame) -> DataFrame:
        return scores_of_common_terms(index, part, key).filter(F.col("score") > 0)

    return report(queries) if small else _by_query_blocks(queries, limit, report)


def scores_of_common_terms(index: DataFrame, queries: DataFrame, key: str = "id") -> DataFrame:
    """``(query_id, doc_id, score)`` of pairs with a common term; ``queries`` is small.

    Each term carries its short list of queries, so an index that is partitioned by
    document is neither shuffled before nor after the join.
    """
    postings = queries.groupBy(key).agg(
        F.collect_list(F.struct("query_id", F.col("w").alias("qw"))).alias("posting")
    )
    hits = index.join(F.broadcast(postings), key).select(
        "doc_id", (F.col("w")).alias("w"), F.explode("posting").alias("q")
    )
    return (
        hits.groupBy("doc_id", F.col("q.query_id").alias("query_id"))
        .agg(F.sum(F.col("w") * F.col("q.qw")).alias("score"))
        .select("query_id", "doc_id", F.round("score", DIGITS).alias("score"))
    )


def _check_space(index: DataFrame, queries: DataFrame) -> None:
    if "space" not in index.columns or "space" not in queries.columns:
        return
    spaces = index.select("space").union(queries.select("space")).distinct().limit(2)
    if len(spaces.collect()) > 1:
        raise ValueError("index and queries hold vectors of different models")


def dense_cosine(index: DataFrame, queries: DataFrame, limit: int | None = None) -> DataFrame:
    """``(query_id, doc_id, score)`` for every query and every indexed vector.

    ``index(doc_id, vec)`` and ``queries(query_id, vec)`` may both carry a ``space``
    column naming the model the vectors come from; two spaces do not mix.
    """
    _check_space(index, queries)
    return _by_query_blocks(queries.select("query_id", "vec"), limit, lambda part: _dense_report(index, part))


def _dense_report(index: DataFrame, queries: DataFrame) -> DataFrame:
    unit = queries.select("query_id", l2_normalize(F.col("vec")).alias("qvec"))
    packed = unit.agg(F.collect_list(F.struct("query_id", "qvec"))).scalar()
    rows = index.select("doc_id", l2_normalize(F.col("vec")).alias("unit"), F.explode(packed).alias("q"))
    score = F.coalesce(dot(F.col("unit"), F.col("q.qvec")), F.lit(0.0))
    return rows.select(F.col("q.query_id").alias("query_id"), "doc_id", F.round(score, DIGITS).alias("score"))


def top1(scores: DataFrame) -> DataFrame:
    """Per query the best document with a positive score; the first one wins a tie."""
    best = F.max_by(F.struct("doc_id", "score"), F.struct("score", (-F.col("doc_id")).alias("first")))
    return (
        scores.filter(F.col("score") > 0)
        .groupBy("query_id")
        .agg(best.alias("best"))
        .select("query_id", "best.doc_id", "best.score")
    )


def rank_all(scores: DataFrame, k: int | None = None, item: str = "doc_id", query: str = "query_id") -> DataFrame:
    """Add ``rank`` by falling score, then by id; keep the first ``k`` if given."""
    if k is None:
        return _full_rank(scores, item, query)
    return best_k(scores, k, item, query)


def best_k(scores: DataFrame, k: int, item: str = "doc_id", query: str = "query_id") -> DataFrame:
    order = Window.partitionBy(query).orderBy(F.desc("score"), item)
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _full_rank(scores: DataFrame, item: str, query: str) -> DataFrame:
    """Complete ranking. A query's scores are spread over many tasks: rows are laid in
    (query, score) order and a row's rank is its place minus the place of the query's first."""
    placed = number_rows(scores, [query, F.desc("score"), item], name="_position", label="ranking")
    firsts = placed.groupBy(query).agg(F.min("_position").alias("_first"))
    return (
        lookup_join(placed, firsts, query)
        .withColumn("rank", (F.col("_position") - F.col("_first") + 1).cast("int"))
        .drop("_position", "_first")
    )


def _measure(df: DataFrame, width: Column) -> tuple[int, int]:
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width.cast("long")).alias("bytes")).first()
    return row["rows"], row["bytes"] or 0


def _travelling_top_k(asked: pd.DataFrame, items: DataFrame, k: int, skip_same: bool) -> DataFrame:
    """Few queries visit the items where they lie; every task keeps the best ones of each."""
    query_ids, vectors = asked["query_id"].to_numpy(), np.stack(asked["vec"])
    more = asked["more"].to_numpy()
    own = pd.Series(k + more, index=query_ids)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for frame in frames:
            frame = frame.sort_values("doc_id", ignore_index=True)
            for at in range(0, len(frame), TILE_ROWS):
                part = frame.iloc[at : at + TILE_ROWS]
                scores = vectors @ np.stack(part["vec"]).T
                found = top_rows(scores, query_ids, part["doc_id"].to_numpy(), k + more, skip_same)
                if best is not None:
                    found = pd.concat([best, found], ignore_index=True)
                    found = found.sort_values(["query_id", "score", "doc_id"], ascending=[True, False, True])
                    place = found.groupby("query_id", sort=False).cumcount()
                    found = found[place.to_numpy() < own[found["query_id"]].to_numpy()]
                best = found
        if best is not None:
            yield best.assign(more=(own[best["query_id"]].to_numpy() - k).astype(np.int32))

    return best_rows(items.mapInPandas(run, "query_id long, doc_id long, score double, more int"), k)


def nearest(
    index: DataFrame, queries: DataFrame, k: int, skip_same: bool = False, limit: int = TRAVEL_BYTES
) -> DataFrame:
    """``(query_id, doc_id, score, rank)``: the ``k`` most similar vectors of each query.

    ``index(doc_id, vec)``, ``queries(query_id, vec[, more])``; zero vectors are left out. A query with ``more``
    gets that many rows beyond ``k``. Queries of at most ``limit`` bytes travel to the index, which
    then is not shuffled; more of them take :mod:`textweft.operators.pruned_nearest`.
    """
    _check_space(index, queries)
    items = index.select("doc_id", l2_normalize(F.col("vec")).alias("vec")).dropna()
    more = F.col("more").cast("int") if "more" in queries.columns else F.lit(0)
    asked = queries.select("query_id", l2_normalize(F.col("vec")).alias("vec"), more.alias("more")).dropna()
    asked = materialize(asked, "asked")
    n_asked, asked_bytes = _measure(asked, F.size("vec") * 8)
    if not n_asked:
        return best_rows(asked.sparkSession.createDataFrame([], "query_id long, doc_id long, score double, more int"), k)
    if asked_bytes <= limit:
        return _travelling_top_k(asked.toPandas(), items, k, skip_same)
    items = materialize(items, "items")
    n_items, item_bytes = _measure(items, F.size("vec") * 8)
    if not n_items:
        return best_rows(asked.sparkSession.createDataFrame([], "query_id long, doc_id long, score double, more int"), k)
    block_rows = max(1, BLOCK_BYTES * n_items // max(item_bytes, 1))
    clusters = wanted_clusters(n_items, item_bytes, BLOCK_BYTES)
    return nearest_by_clusters(items, asked, n_items, k, skip_same, clusters, block_rows)
