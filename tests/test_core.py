import pytest
from pyspark.sql import functions as F

from textweft.functions.vectors import max_vector, mean_vector, vector_width
from textweft.lookup import lookup_join
from textweft.ordered import carry_forward, number_rows, running_total


@pytest.fixture(scope="module")
def scattered(spark):
    return spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"), (F.col("id") % 5).alias("v"))


def test_number_rows_is_dense_and_ordered(scattered):
    rows = number_rows(scattered.repartition(7), [F.desc("k")], start=3).collect()
    assert sorted(r["id"] for r in rows) == list(range(3, 1003))
    assert all(r["id"] == 3 + 999 - r["k"] for r in rows)


def test_running_total(scattered):
    rows = running_total(scattered, ["k"], "v", "before").orderBy("k").collect()
    total = 0
    for row in rows:
        assert row["before"] == total
        total += row["v"]


def test_carry_forward(scattered):
    marked = scattered.withColumn("mark", F.when(F.col("k") % 300 == 10, F.col("k")))
    for row in carry_forward(marked, ["k"], "mark", "last").collect():
        expected = None if row["k"] < 10 else (row["k"] - 10) // 300 * 300 + 10
        assert row["last"] == expected


def test_nothing_to_number(spark):
    assert number_rows(spark.range(0), ["id"], name="n").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_keys_join_like_others(spark, how):
    """A third of the facts share one key, some keys are null, some unknown."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 400)
    facts = spark.range(3000).select("id", key.alias("k"))
    table = facts.filter("k < 350").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    want = sorted(map(tuple, facts.join(table, "k", how).collect()), key=str)
    for limit in (None, 0):
        got = lookup_join(facts, table, "k", how, weight="n", limit=limit)
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_vectors_of_different_lengths_are_an_error(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (0, [1.0, 2.0, 3.0])], "g long, vec array<double>")
    with pytest.raises(ValueError, match="2 and of 3"):
        vector_width(rows)
    assert vector_width(rows.limit(0)) is None and vector_width(rows.filter("size(vec) = 3")) == 3


def test_a_missing_number_keeps_its_place(spark):
    rows = spark.createDataFrame([(0, [1.0, None, 5.0]), (1, [2.0])], "g long, vec array<double>").groupBy("g")
    for found in (rows.agg(mean_vector(F.col("vec"), width=4).alias("v")), rows.agg(max_vector(F.col("vec"), 4).alias("v"))):
        assert {r["g"]: r["v"] for r in found.collect()} == {0: [1.0, None, 5.0], 1: [2.0]}
