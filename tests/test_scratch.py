"""Written tables go when nothing reads them any more, and shuffles with the write that asked for them."""

import os
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from textweft import scratch
from textweft.operators import attention, paragraphs, topics


def _folders(spark):
    top = Path(re.sub("^file:", "", scratch.new_path(spark, "none"))).parent
    return {f.name: f for f in top.iterdir()} if top.exists() else {}


def _made(spark, before):
    return sorted(name.rsplit("-", 1)[0] for name in _folders(spark) if name not in before)


@pytest.fixture(scope="module")
def weights(spark):
    cells = F.explode(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.pmod(F.xxhash64("doc_id", i), F.lit(30)))).alias("id")
    rows = spark.range(40).withColumnRenamed("id", "doc_id").select("doc_id", cells).distinct()
    return rows.withColumn("w", 0.5 + F.pmod(F.xxhash64("doc_id", "id"), F.lit(7)) / 10)


def test_release_deletes_written_tables_only(spark):
    kept, gone = (scratch.materialize(spark.range(5), name) for name in ("kept", "gone"))
    path = re.sub("^file:", "", gone._written)
    scratch.release(gone, spark.range(3), gone)
    assert not os.path.exists(path) and not scratch.is_written(gone)
    assert kept.count() == 5 and scratch.is_written(kept) and not scratch.is_written(kept.select("id"))


def test_shuffles_go_with_the_write(spark):
    def shuffled():
        top = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath())
        return {f.name for f in top.rglob("shuffle_*.data")}

    before = shuffled()
    counted = scratch.materialize(spark.range(1000).groupBy(F.col("id") % 50).count(), "counted")
    assert not shuffled() - before and counted.count() == 50
    assert spark.conf.get(scratch._DROP_SHUFFLES) == "false"


def test_lda_fit_leaves_only_its_topics(spark, weights):
    before = _folders(spark)
    model = topics.lda_fit(weights, 3, passes=2, limit=0)
    assert _made(spark, before) == ["topics"]
    assert model.topic_term.count() == weights.select("id").distinct().count()


@pytest.mark.parametrize("limit", [None, 0])
def test_lsi_fit_leaves_only_its_loadings(spark, weights, limit):
    before = _folders(spark)
    model = topics.lsi_fit(weights, 2, limit=limit)
    assert _made(spark, before) == ["lsi-loadings"] and model.topic_term.count() == 2 * weights.select("id").distinct().count()


def test_paragraph_fits_leave_only_what_is_read(spark):
    rng = np.random.default_rng(3)
    docs = [(i, [f"w{x}" for x in rng.integers(0, 12, 30)]) for i in range(12)]
    tokens = spark.createDataFrame(docs, "doc_id long, words array<string>")
    before = _folders(spark)
    settings = paragraphs.Settings(size=4, paragraph_size=4, window=2)
    model = paragraphs.pvdm_fit(tokens, settings, min_count=1, max_iter=3)
    made = _made(spark, before)
    assert made.count("weights") == 1 and not {"changed", "needed", "needed-words", "uses", "encoded"} & set(made)
    first = model.weights.count()
    more = paragraphs.pvdm_fit(tokens, settings, max_iter=1, start=model)
    inferred = paragraphs.pvdm_infer(model, tokens, max_iter=1)
    assert first == model.weights.count() == more.weights.count()  # what a fit starts from stays
    assert inferred.paragraph_vectors().count() == model.paragraph_vectors().count() and "inferred" not in _made(spark, before)


def test_only_words_of_labelled_documents_are_grouped(spark):
    rows = spark.createDataFrame([(1, 1, 2, [0.5]), (1, 2, 1, [1.5]), (2, 1, 1, [0.5]), (None, 1, 1, [0.5])], "doc_id long, id long, tf long, vec array<double>")
    labels = spark.createDataFrame([(1, 0), (1, 1), (3, 1), (None, 1)], "doc_id long, label int")
    found = attention.attention_rows(rows, labels)
    assert sorted((r.doc_id, r.label, r.tfs, r.x) for r in found.collect()) == [(1, 0, [2.0, 1.0], [0.5, 1.5]), (1, 1, [2.0, 1.0], [0.5, 1.5])]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 1 and plan.index("Aggregate") < plan.index("LeftSemi")
