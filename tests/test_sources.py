import gzip

import pytest
from goldens import TITLE_BOW
from pyspark.sql import functions as F

from textweft.operators import bags, vocabulary
from textweft.sources import analogies, lines, matrix_market as mm, records, snapshots, vectors


def test_read_lines_filters_bad_lines(spark, tmp_path):
    path = tmp_path / "a.txt.gz"
    with gzip.open(path, "wt") as out:
        out.write("one two\nbad | line\nx=y\n\n  three \n")
    found = [r["words"] for r in lines.read_lines(spark, str(path)).collect()]
    assert found == [["one", "two"], [], ["three"]]
    assert lines.read_lines(spark, str(path), filter_lines=False).count() == 5


def test_read_tagged_folder(spark, tmp_path):
    (tmp_path / "a").write_text("The/AT dog/NN ./.\nuntagged only\n")
    (tmp_path / "b").write_text("A/b/c Cat/NN\n")
    found = sorted(r["words"] for r in lines.read_tagged(spark, str(tmp_path)).collect())
    assert found == [["cat"], ["the", "dog", "."]]


def test_word_stream_keeps_the_order_of_a_split_file(spark, tmp_path):
    words = [f"w{i}" for i in range(5000)]
    text = "".join(f"{w} " if i % 7 else f"{w}\n" for i, w in enumerate(words))
    (tmp_path / "a").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        stream = lines.read_word_stream(spark, str(tmp_path / "a"))
        got = lines.explode_stream(stream).orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r["word"] for r in got] == words
    assert [r["pos"] for r in got] == list(range(5000))


def test_matrix_market_round_trip(spark, titles, tmp_path):
    bow = bags.doc2bow(titles, vocabulary.build_dictionary(titles, min_cf=2))
    path = str(tmp_path / "mm")
    mm.write_mm(bow, path)
    text = [r["text"] for r in lines.read_ordered_lines(spark, path).orderBy("line_order").collect()]
    assert text[:3] == [mm.BANNER, "9 12 28", "1 1 1"] and len(text) == 30 and "4 6 2" in text
    cells = {(r["doc_id"], r["id"], r["tf"]) for r in mm.read_mm(spark, path).collect()}
    assert cells == {(d, i, float(n)) for d, row in enumerate(TITLE_BOW) for i, n in row}


def test_matrix_market_works_out_its_entries_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda n: seen.add(1) or n, "long")
    rows = spark.createDataFrame([(d, d + 1, 2) for d in range(5)], "doc_id long, id long, tf long").withColumn("tf", count("tf"))
    mm.write_mm(rows, str(tmp_path / "mm"))
    assert seen.value == 5 and mm.read_mm(spark, str(tmp_path / "mm")).count() == 5


def test_matrix_market_size_line_may_look_like_an_entry(spark, tmp_path):
    (tmp_path / "m").write_text("%%MatrixMarket matrix coordinate real general\n% note\n1 1 1\n1 1 1\n")
    assert [tuple(r) for r in mm.read_mm(spark, str(tmp_path / "m")).collect()] == [(0, 0, 1.0)]


def test_reviews_and_token_lines(spark, tmp_path):
    (tmp_path / "r").write_text('{"text": "Fine.", "stars": 4}\n{"stars": 1}\nnot json\n')
    rows = records.read_reviews_jsonl(spark, str(tmp_path / "r"))
    assert [tuple(r) for r in rows.collect()] == [("Fine.", 4)]
    labelled = rows.select((F.col("stars") - 1).alias("label"), F.split("text", "\\.").alias("text"))
    records.write_tokens_jsonl(labelled, str(tmp_path / "t"))
    assert records.read_tokens_jsonl(spark, str(tmp_path / "t")).first()["text"] == ["Fine", ""]


def test_snapshot_is_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert snapshots.vocabulary_snapshot(spark, str(tmp_path / "s"), "c", 5, build).count() == 3
    assert len(calls) == 1


def test_dictionary_json(spark, titles, tmp_path):
    vocab = vocabulary.build_dictionary(titles).select("word", "id")
    snapshots.save_dictionary_json(vocab, str(tmp_path / "d"))
    assert sorted(map(tuple, snapshots.load_dictionary_json(spark, str(tmp_path / "d")).collect())) == sorted(
        map(tuple, vocab.collect())
    )


def test_a_dictionary_without_ids_counts_its_lines(spark, tmp_path):
    (tmp_path / "d").write_text('{"word": "b"}\n{"word": "a"}\n')
    assert sorted(map(tuple, snapshots.load_dictionary_json(spark, str(tmp_path / "d")).collect())) == [("a", 1), ("b", 0)]


def test_files_follow_their_part_number(spark, tmp_path):
    for name, text in (("part-99999-x.txt", "one two"), ("part-100000-x.txt", "three"), ("part-00007-x.txt", "zero")):
        (tmp_path / name).write_text(text + "\n")
    stream = lines.read_word_stream(spark, str(tmp_path)).orderBy("start").collect()
    assert [w for r in stream for w in r["words"]] == ["zero", "one", "two", "three"]


def test_pretrained(spark):
    vocab = spark.createDataFrame(
        [("a", [0.5, 0.5]), ("b", [0.1, 0.2]), ("<pad>", [9.0, 9.0])], "word string, vec array<double>"
    )
    given = spark.createDataFrame([("a", [1.0, 2.0, 3.0]), ("z", [7.0, 7.0, 7.0])], "word string, vec array<float>")
    loaded = vectors.load_pretrained(vocab, given, 2)
    assert {r["word"]: r["vec"] for r in loaded.collect()} == {"a": [1.0, 2.0], "b": [0.1, 0.2], "<pad>": [0.0, 0.0]}
    assert tuple(vectors.words_loaded(loaded).first()) == (1, 3)


def test_matrix_row_zero_is_unknown(spark):
    rows = spark.createDataFrame([(0, [1.0], "x"), (1, [2.0], "y")], "i long, m array<float>, w string")
    found = vectors.vectors_from_matrix(rows, "i", "m", "w").orderBy("id").collect()
    assert [r["word"] for r in found] == [vectors.UNKNOWN, "y"]


def test_analogies(spark, tmp_path):
    (tmp_path / "q").write_text(": capital cities\na b c d\nonly three words\n\n: plural\ne f g h\n")
    found = analogies.read_analogies(spark, str(tmp_path / "q")).orderBy("line_order").collect()
    assert [(r["section"], r["a"], r["expected"]) for r in found] == [("capital cities", "a", "d"), ("plural", "e", "h")]
    (tmp_path / "bad").write_text("a b c d\n")
    with pytest.raises(Exception, match="before the first section"):
        analogies.read_analogies(spark, str(tmp_path / "bad")).collect()
