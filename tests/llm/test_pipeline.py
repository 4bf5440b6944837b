"""The pipeline's stages against a brute-force version, and their hard cases."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import check
import corpus_pipeline
from tests.llm.test_decontaminate import slow as slow_contamination
from tests.llm.test_near_copies import slow_groups
from textweft.llm.personal_data import find_spans, redacted
from textweft.llm.queries import load_llm_queries
from textweft.llm.quality_rules import rule_counts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with copies, junk, leaks, personal data, nulls and a column of a result's name."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(800)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    rows = [[i, text(rng.randint(12, 200)), "en", "s", 0, "own"] for i in range(120)]
    items = [(i, text(14)) for i in range(5)]
    for i in range(0, 120, 10):
        rows[i][1] = " ".join(w + "###" for w in rows[i][1].split())
    for i in range(1, 120, 12):
        rows[i][1] += " " + items[i % 5][1]
    for i in range(2, 120, 12):
        rows[i][1] += " mail.me@example.org 10.0.0.1"
    for i in range(3, 120, 12):  # near copies, with a word put in the place of the twelfth
        changed = rows[i][1].split()
        rows.append([400 + i, " ".join([*changed[:11], "otherword", *changed[12:]]), "en", "s", 0, "own"])
    rows += [[200 + i, rows[i][1].upper() if i % 2 else rows[i][1], "en", "s", 0, "own"] for i in range(20)]
    rows += [[300, None, None, None, None, None], [None, rows[3][1], "en", "s", 0, "own"], [4, rows[4][1], "en", "s", 0, "own"], [301, "", "", "", 0, ""]]
    labels = [(i, int(i % 10 != 0), 0) for i in range(0, 120)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows, items


def test_run_equals_brute_force(spark, folder):
    path, rows, items = folder
    good = []
    for r in rows:
        counts = rule_counts(r[1])
        if counts[0] >= 10 and 100 * counts[4] <= 20 * counts[0] and "###" not in r[1]:
            good.append(r)
    # five-word shingles and a Jaccard similarity of 0.8, all pairs compared; the least id of a group stays
    good.sort(key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for r, root in zip(good, slow_groups([r[1] for r in good])):
        first.setdefault(root, r)
    clean = [r for r in first.values() if not slow_contamination(r[1], items)[1]]
    want = {r[0]: redacted(r[1], find_spans(r[1])) for r in clean}
    got = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id: r.text for r in got} == want and len(got) == len(want)
    assert any("<EMAIL>" in t and "<IP>" in t for t in want.values())
    assert all(r.n_chars == len(r.text) and r.kept == "own" and r.n_tokens == len(r.token_ids) for r in got)


def test_stages_keep_columns_and_take_empty_tables(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert docs.count() > 150
    empty = docs.limit(0)
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, empty, path)
        assert out.count() == 0
        if place < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            once = stage(spark, docs, path)
            assert once.columns == docs.columns and once.schema == docs.schema


def test_registered():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(load_llm_queries()[1]))
def test_queries_equal_sql(spark, name):
    got = load_llm_queries()[0][name](spark, SF).toPandas()
    assert len(got) and check.difference(got, check.connect(SF).execute(load_llm_queries()[1][name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(load_llm_queries()[0]) - set(load_llm_queries()[1])))
def test_other_queries_cover_their_table(spark, name):
    got = load_llm_queries()[0][name](spark, SF)
    table = "pages" if "page_id" in got.columns else "documents"
    assert got.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert got.filter(F.col(got.columns[0]).isNull()).count() == 0
