import numpy as np
import pytest
from pyspark.sql import functions as F

from textweft.operators import bags, pruned_join, pruned_nearest, similarity as s, weighting
from textweft.plans.similar_documents import most_similar_documents

# Nine documents over twelve ids, a query, and its scores.
QUICK = [
    [(0, 1.0), (1, 1.0), (2, 1.0)],
    [(2, 1.0), (3, 1.0), (4, 1.0), (5, 1.0), (6, 1.0), (8, 1.0)],
    [(1, 1.0), (3, 1.0), (4, 1.0), (7, 1.0)],
    [(0, 1.0), (4, 2.0), (7, 1.0)],
    [(3, 1.0), (5, 1.0), (6, 1.0)],
    [(9, 1.0)],
    [(9, 1.0), (10, 1.0)],
    [(9, 1.0), (10, 1.0), (11, 1.0)],
    [(8, 1.0), (10, 1.0), (11, 1.0)],
]
QUERY = [(0, 0.8075244024440723), (4, 0.5898341626740045)]
SCORES = [0.4662244, 0.19139354, 0.24600551, 0.82094586, 0.0, 0.0, 0.0, 0.0, 0.0]


def long_form(spark, rows, name="doc_id"):
    cells = [(d, i, float(w)) for d, row in enumerate(rows) for i, w in row]
    return spark.createDataFrame(cells, f"{name} long, id long, tf double")


def test_quick_example(spark):
    bow = long_form(spark, QUICK)
    model = weighting.tfidf_fit(bow, 9)
    asked = weighting.tfidf_transform(long_form(spark, [[(0, 1), (4, 1), (99, 1)]]), model)
    assert [(r["id"], pytest.approx(r["w"])) for r in asked.orderBy("id").collect()] == QUERY
    index = weighting.tfidf_transform(bow, model)
    scores = s.sparse_cosine(index, spark.range(9).withColumnRenamed("id", "doc_id"), asked.withColumnRenamed("doc_id", "query_id"))
    got = [r["score"] for r in scores.orderBy("doc_id").collect()]
    assert got == pytest.approx(SCORES, abs=2e-6)
    assert s.top1(scores).first()["doc_id"] == 3
    ranks = {r["doc_id"]: r["rank"] for r in s.rank_all(scores).collect()}
    assert [ranks[d] for d in (3, 0, 2, 1, 4, 5, 6, 7, 8)] == list(range(1, 10))


def test_no_positive_score_means_no_answer(spark):
    scores = spark.createDataFrame([(0, 1, 0.0), (0, 2, -1.0)], "query_id long, doc_id long, score double")
    assert s.top1(scores).count() == 0


def random_rows(rng, n, terms):
    """Sparse unit rows with frequent and rare terms; a third of them are copies of one row."""
    p = 1 / np.arange(1, terms + 1)
    rows = []
    for d in range(n):
        if d % 3 == 1 and d > 1:
            rows.append(rows[1])
            continue
        ids = np.unique(rng.choice(terms, 12, p=p / p.sum()))
        w = rng.random(len(ids)) + 0.1
        rows.append(list(zip(ids.tolist(), (w / np.linalg.norm(w)).tolist())))
    return rows


def brute_top(matrix, queries, k, skip_same):
    out = set()
    scores = np.round(queries @ matrix.T, 6)
    for q, row in enumerate(scores):
        order = [d for d in np.lexsort((np.arange(len(row)), -row)) if row[d] > 0 and not (skip_same and d == q)]
        out |= {(q, int(d), round(float(row[d]), 6), rank + 1) for rank, d in enumerate(order[:k])}
    return out


@pytest.mark.parametrize("tile_rows, dense_pairs, limit, block_bytes", [
    (1024, 4096, 1 << 25, 1 << 25), (37, 20, 1 << 25, 1 << 25), (1024, 4096, 0, 1 << 25), (16, 20, 0, 9000), (7, 4096, 0, 3000),
])
def test_similarity_join_matches_brute_force(spark, monkeypatch, tile_rows, dense_pairs, limit, block_bytes):
    monkeypatch.setattr(pruned_join, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(pruned_join, "GROUP_ROWS", 50)
    monkeypatch.setattr(pruned_join, "DENSE_PAIRS", dense_pairs)
    rows = random_rows(np.random.default_rng(5), 150, 400)
    rows += [rows[3], rows[3], [(i, -w) for i, w in rows[4]], [(900, 1.0)], [(0, 1.0)]]
    dense = np.zeros((155, 1000))
    for d, row in enumerate(rows):
        for i, w in row:
            dense[d, i] = w
    weights = long_form(spark, rows).withColumnRenamed("tf", "w")
    got = s.similarity_join(
        weights, weights.withColumnRenamed("doc_id", "query_id"), 4, skip_same=True, limit=limit, block_bytes=block_bytes
    )
    found = {(r["query_id"], r["doc_id"], round(r["score"], 6), r["rank"]) for r in got.collect()}
    assert found == brute_top(dense, dense, 4, True)


def topical_rows(rng, topics, each):
    """Documents of topics: eight of a topic's own twelve terms, two that all topics share."""
    rows = []
    for topic in range(topics):
        for _ in range(each):
            ids = [*rng.choice(12, 8, replace=False) + 100 + 12 * topic, *rng.choice(40, 2, replace=False)]
            w = np.array([*rng.uniform(1, 1.5, 8), *rng.uniform(0.1, 0.3, 2)])
            rows.append([(int(i), float(x)) for i, x in zip(ids, w / np.linalg.norm(w))])
    return rows


def test_blocks_and_tiles_that_cannot_win_are_left_out(spark, monkeypatch):
    rows = topical_rows(np.random.default_rng(6), 30, 20)
    weights = long_form(spark, rows).withColumnRenamed("tf", "w")
    asked = pruned_join.as_rows(weights.withColumnRenamed("doc_id", "query_id"), "query_id")
    laid = pruned_join.laid_out(pruned_join.as_rows(weights, "doc_id"), 30)
    peaks = pruned_join.term_peaks(laid)
    blocks = laid.select("block").distinct().count()
    assert blocks > 20
    home = pruned_join.homes(asked, peaks)
    every = pruned_join.further_visits(asked, peaks, home, spark.createDataFrame([], "query_id long, least double"))
    first = pruned_join.best_rows(pruned_join._visited(home, asked, laid, 3, False), 3)
    kth = first.filter("rank = 3").select("query_id", F.col("score").alias("least"))
    # terms that all topics share lead into nearly every block; a score to beat leaves few
    assert every.count() > 600 * blocks / 2 and pruned_join.further_visits(asked, peaks, home, kth).count() < 600 * 12
    monkeypatch.setattr(pruned_join, "TILE_ROWS", 20)
    cells = [np.array([i for i, _ in row]) for row in rows], [np.array([w for _, w in row]) for row in rows]
    items = pruned_join.Cells(np.arange(600), np.full(600, 10), np.concatenate(cells[0]), np.concatenate(cells[1]))
    _, scored = pruned_join.scan(items, pruned_join.tiles(items), 3, False)
    assert scored < 600 * 30 / 2


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_similarity_join_of_a_hub_and_of_nothing(spark, monkeypatch, limit):
    monkeypatch.setattr(pruned_join, "GROUP_ROWS", 30)
    rows = [[(1, 1.0)]] * 200 + [[(1, 0.6), (2, 0.8)], [(2, 1.0)], [(3, 1.0)]]
    weights = long_form(spark, rows).withColumnRenamed("tf", "w")
    asked = weights.withColumnRenamed("doc_id", "query_id")
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in s.similarity_join(weights, asked, 2, True, limit, 2000).collect()}
    assert got[0, 1] == (1, 1.0) and got[7, 2] == (1, 1.0) and got[200, 1] == (201, 0.8) and got[200, 2] == (0, 0.6)
    assert got[201, 1] == (200, 0.8) and (201, 2) not in got and (202, 1) not in got and len(got) == 403
    none = weights.filter("false")
    assert s.similarity_join(none, asked, 2, limit=limit).count() == 0
    assert s.similarity_join(weights, none.withColumnRenamed("doc_id", "query_id"), 2, limit=limit).count() == 0


@pytest.mark.parametrize("limit, block_bytes", [(1 << 20, 1 << 25), (0, 1 << 25), (0, 800), (0, 200)])
def test_nearest_matches_brute_force(spark, monkeypatch, limit, block_bytes):
    monkeypatch.setattr(s, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(pruned_nearest, "GROUP_ROWS", 10)
    vectors = np.random.default_rng(2).normal(size=(60, 5))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "doc_id long, vec array<double>")
    got = s.nearest(rows, rows.withColumnRenamed("doc_id", "query_id"), 3, limit=limit)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    found = {(r["query_id"], r["doc_id"], round(r["score"], 6), r["rank"]) for r in got.collect()}
    assert found == brute_top(unit, unit, 3, False)


def test_clusters_that_cannot_hold_a_near_vector_are_left_out(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 12))
    vectors = np.concatenate([c + 0.1 * rng.normal(size=(30, 12)) for c in centres])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(unit)], "doc_id long, vec array<double>")
    pivots = pruned_nearest.drawn_pivots(items, 1200, 60)
    laid = pruned_nearest.laid_in_clusters(items, pivots)
    radii = np.full(len(pivots), -1.0)
    for r in laid.groupBy("cluster").agg(F.max("away").alias("a")).collect():
        radii[r["cluster"]] = r["a"]
    fifth = np.sort(unit @ unit.T, axis=1)[:, -5]
    asked = spark.createDataFrame([(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(unit, fifth))], "query_id long, vec array<double>, least double")
    found = pruned_nearest.visits(asked, pivots, radii, True)
    assert found.count() < 0.2 * 1200 * len(pivots)
    # every item as near as the fifth lies in a cluster that is visited
    seen = {tuple(r) for r in found.collect()} | {tuple(r) for r in pruned_nearest.visits(asked, pivots, radii, False).collect()}
    cluster = {r["doc_id"]: r["cluster"] for r in laid.collect()}
    scores = unit @ unit.T
    assert all((q, cluster[d]) in seen for q, d in zip(*np.nonzero(scores >= fifth[:, None])))


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_a_query_may_want_more(spark, limit):
    rng = np.random.default_rng(9)
    index = spark.createDataFrame([(i, rng.normal(size=3).tolist()) for i in range(50)], "doc_id long, vec array<double>")
    asked = index.filter("doc_id < 4").select(F.col("doc_id").alias("query_id"), "vec", (F.col("doc_id") * 10).alias("more"))
    found = s.nearest(index, asked, 2, limit=limit).groupBy("query_id").agg(F.count("*").alias("n"), F.max("rank").alias("r")).collect()
    assert {(r["query_id"], r["n"], r["r"]) for r in found} == {(i, 2 + 10 * i, 2 + 10 * i) for i in range(4)}
    assert s.nearest(index.filter("false"), asked, 2, limit=limit).count() == 0
    assert s.nearest(index, asked.filter("false"), 2, limit=limit).count() == 0


def test_few_facts_travel_and_hubs_are_split(spark, monkeypatch):
    from textweft import lookup

    facts = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 99), (7, 98), (None, 97)], "id long, n long")
    table = spark.createDataFrame([(1, "hub"), (2, "b"), (3, "c")], "id long, name string")
    want = {(r["id"], r["n"], r["name"]) for r in lookup.attach(facts, table, "id").select("id", "n", "name").collect()}
    assert len(want) == 51
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    assert {(r["id"], r["n"], r["name"]) for r in lookup.attach(facts, table, "id").select("id", "n", "name").collect()} == want


def test_many_queries_take_the_block_path(spark, titles, monkeypatch):
    asked = titles.filter("doc_id in (1, 3, 7)")
    want = sorted(map(tuple, most_similar_documents(titles, asked, 3).collect()))
    monkeypatch.setattr("textweft.plans.similar_documents.fits_broadcast", lambda df: False)
    got = most_similar_documents(titles, asked, 3).select("query_id", "doc_id", "score", "rank")
    assert sorted(map(tuple, got.collect())) == want


def test_spaces_do_not_mix(spark):
    index = spark.createDataFrame([(0, [1.0], "lsi")], "doc_id long, vec array<double>, space string")
    asked = spark.createDataFrame([(0, [1.0], "lda")], "query_id long, vec array<double>, space string")
    with pytest.raises(ValueError, match="different models"):
        s.dense_cosine(index, asked)


def test_large_query_tables_are_worked_off_in_blocks(spark):
    weights = long_form(spark, QUICK).withColumnRenamed("tf", "w").withColumn("w", F.col("w") * 0.3)
    docs, asked = weights.select("doc_id").distinct(), weights.withColumnRenamed("doc_id", "query_id")
    whole, parts = (sorted(map(tuple, s.sparse_cosine(weights, docs, asked, limit=n).collect())) for n in (None, 200))
    assert whole == parts and len(whole) == 81
    rows = spark.createDataFrame([(i, [float(i), 1.0, i % 3 * 1.0]) for i in range(20)], "doc_id long, vec array<double>")
    asked = rows.withColumnRenamed("doc_id", "query_id")
    whole, parts = (sorted(map(tuple, s.dense_cosine(rows, asked, limit=n).collect())) for n in (None, 100))
    assert whole == parts and len(whole) == 400


@pytest.mark.parametrize("small", [True, False])
def test_a_score_that_rounds_to_zero_is_no_hit(spark, monkeypatch, small):
    index = spark.createDataFrame([(0, 0, 1.0), (1, 0, 1e-8), (2, 0, 6e-7)], "doc_id long, id long, w double")
    asked = spark.createDataFrame([(9, 0, 1.0)], "query_id long, id long, w double")
    if small:
        found = s.best_k(s.positive_scores(index, asked), 5)
    else:
        found = s.similarity_join(index, asked, 5)
    assert sorted((r["doc_id"], r["score"], r["rank"]) for r in found.collect()) == [(0, 1.0, 1), (2, 1e-6, 2)]


def test_nearest_takes_the_same_rows_both_ways(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(300)]
    index = spark.createDataFrame(rows, "doc_id long, vec array<double>").repartition(5)
    asked = index.filter("doc_id % 11 = 0").withColumnRenamed("doc_id", "query_id")
    few, many = (sorted(map(tuple, s.nearest(index, asked, 7, True, limit=n).collect())) for n in (1 << 20, 0))
    assert few == many and len(few) == 7 * asked.filter("aggregate(vec, 0D, (a, x) -> a + x * x) > 0").count()
    plan = s.nearest(index, asked, 7, limit=1 << 20)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" in plan and "CoGroup" not in plan


def test_term_in_every_document_has_no_weight(spark):
    rows = spark.createDataFrame([(0, ["x", "a"]), (1, ["x"])], "doc_id long, words array<string>")
    bow = bags.term_counts(rows).withColumnRenamed("word", "id")
    weights = weighting.tfidf_transform(bow, weighting.tfidf_fit(bow, 2))
    assert [tuple(r) for r in weights.collect()] == [(0, "a", 1.0)]
