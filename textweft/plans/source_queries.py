"""Sources, sinks, saved models and streams, on files that Spark writes from the tables."""

from pyspark.sql import functions as F

from textweft.functions import text as tx
from textweft.operators import vocabulary
from textweft.plans import sql as q
from textweft.plans import tables as t
from textweft.plans.embedding_queries import ANALOGIES, analogy_questions
from textweft.plans.registry import query
from textweft.plans.text_queries import _LINES
from textweft.scratch import materialize, new_path
from textweft.sources import analogies, lines, matrix_market, records, snapshots, vectors
from textweft.streaming import scoring
from textweft.streaming import vocabulary as streams


@query("SELECT doc_id, length(text) AS n FROM documents")
def from_documents(spark, sf):
    return lines.from_documents(spark, f"{sf}/documents.parquet").select(
        "doc_id", F.length("text").cast("long").alias("n")
    )


@query(f"""WITH {_LINES},
words AS (SELECT unnest({q.split_ws('line')}) AS word FROM lines WHERE NOT regexp_matches(line, '{tx.BAD_LINE}'))
SELECT word, count(*) AS n FROM words GROUP BY word""")
def read_lines(spark, sf):
    """Compressed text files, one sentence per line, bad lines rejected."""
    path = new_path(spark, "lines")
    t.document_lines(spark, sf).select("line").write.option("compression", "gzip").text(path)
    return vocabulary.token_counts(lines.read_lines(spark, path, filter_lines=True))


@query(f"""WITH {_LINES},
tokens AS (SELECT unnest({q.split_ws('line')}) AS token FROM lines)
SELECT lower(token) AS word, count(*) AS n FROM tokens WHERE NOT contains(token, '/') GROUP BY lower(token)""")
def read_tagged(spark, sf):
    """Every token tagged with the language; tokens that hold a slash of their own are dropped."""
    path = new_path(spark, "tagged")
    tagged = F.transform(tx.split_ws(F.col("line")), lambda w: F.concat(w, F.lit("/"), F.col("lang")))
    t.document_lines(spark, sf).select(F.array_join(tagged, " ")).write.text(path)
    return vocabulary.token_counts(lines.read_tagged(spark, path))


@query(f"""WITH stream AS (
  SELECT word, row_number() OVER (ORDER BY doc_id, place) - 1 AS pos FROM (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place
    FROM (SELECT doc_id, {q.split_ws('text')} AS w FROM documents))
)
SELECT pos // 1000 AS part, count(*) AS n, sum(pos % 1000 * length(word))::BIGINT AS checksum,
       max(word) FILTER (WHERE pos % 1000 = 0) AS first
FROM stream GROUP BY pos // 1000""")
def read_word_stream(spark, sf):
    """All documents as one text, read back as one sequence of words."""
    path = new_path(spark, "stream")
    rows = t.document_lines(spark, sf)
    ordered = rows.repartitionByRange("doc_id", "line_no").sortWithinPartitions("doc_id", "line_no")
    ordered.select("line").write.text(path)
    words = lines.explode_stream(lines.read_word_stream(spark, path))
    place = F.col("pos") % 1000
    return words.groupBy(F.floor(F.col("pos") / 1000).alias("part")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(place * F.length("word")).alias("checksum"),
        F.max(F.when(place == 0, F.col("word"))).alias("first"),
    )


def _reviews(spark, sf):
    """Labelled documents as review lines with one to four stars."""
    stars = (F.col("quality") * 2 + F.col("toxic") + 1).cast("int")
    return t.documents(spark, sf).join(t.table(spark, sf, "labels"), "doc_id").select("text", stars.alias("stars"))


@query("""SELECT quality * 2 + toxic + 1 AS stars, count(*) AS n, sum(length(text))::BIGINT AS n_chars
FROM documents JOIN labels USING (doc_id) GROUP BY stars""")
def read_reviews_jsonl(spark, sf):
    path = new_path(spark, "reviews")
    _reviews(spark, sf).write.json(path)
    return records.read_reviews_jsonl(spark, path).groupBy("stars").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars")
    )


@query(f"""WITH reviews AS (
  SELECT quality * 2 + toxic AS label,
         regexp_extract_all(lower(trim(regexp_replace(text, '{tx.SPACE}+', ' ', 'g'), ' ')), '{tx.REVIEW_TOKEN}') AS words
  FROM documents JOIN labels USING (doc_id)
)
SELECT label, count(*) AS n, sum(len(words))::BIGINT AS n_words, max(words[1]) AS last_first FROM reviews GROUP BY label""")
def tokens_jsonl(spark, sf):
    """Reviews to labelled token lines and back."""
    path = new_path(spark, "tokens")
    words = tx.tokenize_review(tx.normalize_ws(F.col("text")))
    labelled = _reviews(spark, sf).select(tx.shift_label(F.col("stars")).alias("label"), words.alias("text"))
    records.write_tokens_jsonl(labelled, path)
    return records.read_tokens_jsonl(spark, path).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.size("text")).alias("n_words"),
        F.max(F.get("text", F.lit(0))).alias("last_first"),
    )


@query(f"""WITH {q.BOW}
SELECT doc_id, count(*) AS n, sum(tf)::DOUBLE AS tf_sum, sum(id * tf)::DOUBLE AS checksum FROM bow GROUP BY doc_id""")
def matrix_market_bow(spark, sf):
    """Bag of words written as MatrixMarket text and read back."""
    path = new_path(spark, "bow-mm")
    matrix_market.write_mm(t.bow(spark, sf), path)
    return matrix_market.read_mm(spark, path).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("tf").alias("tf_sum"), F.sum(F.col("id") * F.col("tf")).alias("checksum")
    )


@query(f"""WITH {q.VOCAB} SELECT word, id, cf FROM vocab""")
def vocabulary_snapshot(spark, sf):
    """Built and saved by the first call, read by the second."""
    root = new_path(spark, "snapshots")
    for _ in range(2):
        saved = snapshots.vocabulary_snapshot(spark, root, "documents", 5, lambda: t.vocabulary(spark, sf))
    return saved


@query(f"WITH {q.DICT} SELECT word, id FROM dict")
def dictionary_json(spark, sf):
    path = new_path(spark, "dictionary-json")
    snapshots.save_dictionary_json(t.dictionary(spark, sf), path)
    return snapshots.load_dictionary_json(spark, path)


@query(f"""WITH {q.WEIGHTS}
SELECT doc_id, count(*) AS n, round(sum(w), 5) AS w_sum, round(max(w), 6) AS w_max FROM weights GROUP BY doc_id""")
def saved_weights(spark, sf):
    """A model table saved and loaded."""
    path = new_path(spark, "saved-weights")
    snapshots.save_table(t.weights(spark, sf), path)
    return snapshots.load_table(spark, path).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("w"), 5).alias("w_sum"), F.round(F.max("w"), 6).alias("w_max")
    )


@query(f"""WITH {q.VOCAB}
SELECT word, embedding IS NOT NULL AS loaded,
       round(coalesce(embedding[1]::DOUBLE, id / 1000.0), 6) AS first,
       round(coalesce(list_sum(embedding[1:32]::DOUBLE[]), 32 * id / 1000.0), 4) AS total
FROM vocab LEFT JOIN embeddings ON vec_id = id
UNION ALL SELECT '<pad>', false, 0.0, 0.0""")
def load_pretrained(spark, sf):
    """Embeddings cut to 32 numbers overwrite the starting vectors of the most frequent words."""
    vocab = t.vocabulary(spark, sf)
    given = t.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    pretrained = vocab.select("id", "word").join(given, "id")
    pad = spark.range(1).select(F.lit(vectors.PAD).alias("word"), F.lit(-1).cast("long").alias("id"))
    own = vocab.select("word", "id").unionByName(pad)
    own = own.withColumn("vec", F.array_repeat(F.col("id") / 1000.0, 32))
    loaded = vectors.load_pretrained(own, pretrained, 32)
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return loaded.select(
        "word", "loaded", F.round(F.get("vec", F.lit(0)), 6).alias("first"), F.round(total, 4).alias("total")
    )


@query(f"WITH {q.EMB} SELECT id, word, len(vec) AS n, round(list_sum(vec), 4) AS total FROM emb")
def vectors_from_matrix(spark, sf):
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return t.embedding_words(spark, sf).select(
        "id", "word", F.size("vec").cast("long").alias("n"), F.round(total, 4).alias("total")
    )


@query(f"WITH {ANALOGIES} SELECT section, a, b, c, expected FROM questions")
def read_analogies(spark, sf):
    path = new_path(spark, "questions")
    analogies.write_analogies(analogy_questions(spark, sf), path)
    return analogies.read_analogies(spark, path).drop("line_order")


# ---------------------------------------------------------------- streams


@query(f"WITH {q.TOK} SELECT word, count(*) AS n FROM tok GROUP BY word")
def stream_extend_vocabulary(spark, sf):
    """Word counts after the stream has ended equal those of the whole table."""
    arriving = streams.stream_documents(spark, sf, "documents.parquet", "doc_id long, text string")
    counts = new_path(spark, "stream-counts")
    words = tx.remove_stopwords(tx.tokenize_word(F.col("text")))
    streams.stream_extend_vocabulary(arriving, words, counts, new_path(spark, "stream-state")).awaitTermination()
    return streams.streamed_vocabulary(spark, counts)


@query(f"""WITH {q.SCORES}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
) SELECT query_id, doc_id, score, rank FROM ranked WHERE rank <= 3""")
def stream_score(spark, sf):
    """Benchmark texts arrive as a stream and meet a fixed index of the documents."""
    vocab = t.dictionary(spark, sf)
    index = materialize(t.weights(spark, sf, vocab), "index")
    arriving = streams.stream_documents(spark, sf, "benchmark.parquet", "item_id long, text string")
    queries = t.word_tokens(arriving.withColumnRenamed("item_id", "doc_id"))
    out = new_path(spark, "stream-scores")
    model = t.with_size(vocab, spark, sf)
    scoring.stream_score(queries, index, model, 3, out, new_path(spark, "stream-state")).awaitTermination()
    return scoring.scored(spark, out)
