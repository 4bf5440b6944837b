"""Vocabulary, bag-of-words, weighting, similarity and topic operators."""

from pyspark.sql import functions as F

from textweft.functions.vectors import mean_vector, vector_width
from textweft.operators import bags, similarity, topics, vocabulary, weighting
from textweft.plans import sql as q
from textweft.plans import tables as t
from textweft.plans.registry import query
from textweft.plans.similar_documents import most_similar_documents as find_similar_documents
from textweft.scratch import materialize
from textweft.sources.vectors import PADDING, UNKNOWN, UNKNOWN_CAPITAL


@query(f"WITH {q.TOK} SELECT word, count(*) AS n FROM tok GROUP BY word")
def token_counts(spark, sf):
    return vocabulary.token_counts(t.document_words(spark, sf))


@query(f"""WITH {q.TOK},
kept AS (SELECT word FROM tok GROUP BY word HAVING count(*) > 1)
SELECT words.doc_id, coalesce(string_agg(word, ' ' ORDER BY pos), '') AS words
FROM words LEFT JOIN (tok JOIN kept USING (word)) USING (doc_id) GROUP BY words.doc_id""")
def drop_rare(spark, sf):
    kept = vocabulary.drop_rare(t.document_words(spark, sf, True))
    return kept.select("doc_id", F.array_join("words", " ").alias("words"))


@query(f"""WITH {q.TOK}
SELECT word, row_number() OVER (ORDER BY min(doc_id), word) - 1 AS id,
       count(DISTINCT doc_id) AS df, count(*) AS cf FROM tok GROUP BY word""")
def build_dictionary(spark, sf):
    return vocabulary.build_dictionary(t.document_words(spark, sf))


@query(f"WITH {q.TOK} SELECT word, count(DISTINCT doc_id) AS df FROM tok GROUP BY word")
def document_frequency(spark, sf):
    return vocabulary.document_frequency(t.document_words(spark, sf))


@query(f"WITH {q.DICT} SELECT word, id, df AS freq FROM dict ORDER BY id")
def dictionary_report(spark, sf):
    return vocabulary.dictionary_report(t.dictionary(spark, sf))


@query(f"WITH {q.BOW} SELECT doc_id, id, tf FROM bow")
def doc2bow(spark, sf):
    return t.bow(spark, sf)


@query(f"""WITH {q.DICT},
top AS (
  SELECT * FROM dict WHERE df >= 20 AND df <= 0.5 * (SELECT count(*) FROM documents)
  ORDER BY df DESC, id LIMIT 1000
)
SELECT word, df, cf, row_number() OVER (ORDER BY id) - 1 AS id FROM top""")
def filter_extremes(spark, sf):
    n_docs = t.table(spark, sf, "documents").count()
    return vocabulary.filter_extremes(t.dictionary(spark, sf), n_docs, no_below=20, no_above=0.5, keep_n=1000)


@query(f"WITH {q.VOCAB} SELECT word, id, cf FROM vocab")
def min_count_vocabulary(spark, sf):
    return t.vocabulary(spark, sf)


_ARRIVING = f"""arriving AS (
  SELECT word, count(*) AS n FROM (SELECT unnest({q.content_words('text')}) AS word FROM conversations) GROUP BY word
)"""


@query(f"""WITH {q.VOCAB}, {_ARRIVING}
SELECT word, id, cf + coalesce(n, 0) AS cf FROM vocab LEFT JOIN arriving USING (word)
UNION ALL
SELECT word, (SELECT max(id) + 1 FROM vocab) + row_number() OVER (ORDER BY n DESC, word) - 1, n
FROM arriving WHERE n >= 5 AND word NOT IN (SELECT word FROM vocab)""")
def extend_vocabulary(spark, sf):
    talk = t.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    words = t.word_tokens(talk, "conv_id")
    return vocabulary.extend_vocabulary(t.vocabulary(spark, sf), words, 5)


_OOV = f"""oov AS (
  SELECT word, id, cf FROM vocab
  UNION ALL SELECT '{UNKNOWN}', (SELECT max(id) + 1 FROM vocab), 100000
  UNION ALL SELECT '{UNKNOWN_CAPITAL}', (SELECT max(id) + 2 FROM vocab), 100000
)"""


@query(f"WITH {q.VOCAB}, {_OOV} SELECT word, id, cf FROM oov")
def add_oov(spark, sf):
    return vocabulary.add_oov(t.vocabulary(spark, sf), 100_000)


@query(f"""WITH {q.VOCAB}, {_OOV}
SELECT id, count(*) AS n FROM (
  SELECT coalesce(oov.id, (SELECT id FROM oov WHERE word = '{UNKNOWN}')) AS id
  FROM (SELECT unnest({q.content_words('text')}) AS word FROM conversations) LEFT JOIN oov USING (word)
) GROUP BY id""")
def map_oov(spark, sf):
    talk = t.word_tokens(t.table(spark, sf, "conversations"), "conv_id")
    vocab = vocabulary.add_oov(t.vocabulary(spark, sf), 100_000)
    ids = vocabulary.map_oov(vocabulary.word_rows(talk), vocab)
    return ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {q.VOCAB} SELECT word, id, cf FROM vocab
UNION ALL SELECT '{PADDING}', (SELECT max(id) + 1 FROM vocab), 1000000""")
def add_padding_word(spark, sf):
    return vocabulary.add_padding_word(t.vocabulary(spark, sf))


@query(f"WITH {q.VOCAB} SELECT word, id, cf FROM vocab ORDER BY cf DESC, word LIMIT 3000")
def restrict_vocabulary(spark, sf):
    return vocabulary.restrict_vocabulary(t.vocabulary(spark, sf), 3000)


@query(f"""WITH {q.TOK},
firsts AS (SELECT word, min(doc_id) AS d, arg_min(pos, (doc_id, pos)) AS p FROM tok GROUP BY word)
SELECT word, row_number() OVER (ORDER BY d, p) AS id FROM firsts UNION ALL SELECT '<pad>', 0""")
def insertion_dictionary(spark, sf):
    return vocabulary.insertion_dictionary(t.document_words(spark, sf))


@query("""SELECT md5(text) AS text_md5, row_number() OVER (ORDER BY min(doc_id)) - 1 AS para_id, count(*) AS copies
FROM documents GROUP BY text""")
def paragraph_vocabulary(spark, sf):
    docs = t.documents(spark, sf)
    found = vocabulary.paragraph_vocabulary(docs)
    texts = vocabulary.paragraph_texts(found, docs)
    return found.join(texts, "para_id").select(F.md5("text").alias("text_md5"), "para_id", "copies")


@query("""SELECT doc_id, para_id FROM documents JOIN (
  SELECT text, row_number() OVER (ORDER BY min(doc_id)) - 1 AS para_id FROM documents GROUP BY text
) USING (text)""")
def paragraph_ids(spark, sf):
    docs = t.documents(spark, sf)
    return vocabulary.paragraph_ids(docs, vocabulary.paragraph_vocabulary(docs))


@query(f"""WITH {q.TOK}
SELECT (SELECT count(*) FROM words) AS n_sentences, count(*) AS n_words, count(DISTINCT word) AS n_word_types,
       (SELECT count(DISTINCT array_to_string(words, ' ')) FROM words) AS n_paragraph_types FROM tok""")
def corpus_statistics(spark, sf):
    return vocabulary.corpus_statistics(t.document_words(spark, sf))


@query(f"""WITH {q.TOK}
SELECT (SELECT count(*) FROM words) AS n_sentences, count(*) AS n_words, count(DISTINCT word) AS n_word_types,
       (SELECT count(DISTINCT array_to_string(words, ' ')) FROM words) AS n_paragraph_types, true AS within FROM tok""")
def corpus_statistics_approx(spark, sf):
    """The exact counts, and whether the estimates lie within five times their stated error."""
    tokens = t.document_words(spark, sf)
    guess, exact = vocabulary.corpus_statistics_approx(tokens, 0.02).first(), vocabulary.corpus_statistics(tokens)
    names = ("n_word_types", "n_paragraph_types")
    same = (F.col("n_sentences") == guess["n_sentences"]) & (F.col("n_words") == guess["n_words"])
    near = [F.abs(F.col(n) - guess[n]) <= 0.1 * F.col(n) + 1 for n in names]
    return exact.withColumn("within", same & near[0] & near[1])


@query(f"WITH {q.VOCAB} SELECT count(*) AS words_seen FROM tok JOIN vocab USING (word) WHERE pos < 1000")
def words_seen(spark, sf):
    """Sentences are cut at 1000 words, as the skip-gram trainer does."""
    return vocabulary.words_seen(t.document_words(spark, sf), t.vocabulary(spark, sf), 1000)


# ---------------------------------------------------------------- weights and scores


@query(f"""WITH {q.BOW}
SELECT id, count(*) AS df, (SELECT count(*) FROM documents) AS n_docs FROM bow GROUP BY id""")
def tfidf_fit(spark, sf):
    return weighting.tfidf_fit(t.bow(spark, sf), t.table(spark, sf, "documents").count())


@query(f"WITH {q.WEIGHTS} SELECT doc_id, id, round(w, 6) AS w FROM weights")
def tfidf_transform(spark, sf):
    return t.weights(spark, sf).withColumn("w", F.round("w", 6))


@query(f"WITH {q.QWEIGHTS} SELECT query_id, id, round(w, 6) AS w FROM qweights")
def tfidf_query(spark, sf):
    """New texts through the weights fitted on the documents."""
    return t.query_weights(spark, sf, t.dictionary(spark, sf)).withColumn("w", F.round("w", 6))


def _all_scores(spark, sf):
    vocab = t.dictionary(spark, sf)
    docs = t.documents(spark, sf).select("doc_id")
    return similarity.sparse_cosine(t.weights(spark, sf, vocab), docs, t.query_weights(spark, sf, vocab))


@query(f"WITH {q.SCORES} SELECT query_id, doc_id, score FROM scores")
def sparse_cosine(spark, sf):
    return _all_scores(spark, sf)


@query(f"""WITH {q.SCORES}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
) SELECT query_id, doc_id, score FROM ranked WHERE rank = 1""")
def top1(spark, sf):
    vocab = t.dictionary(spark, sf)
    hits = similarity.positive_scores(t.weights(spark, sf, vocab), t.query_weights(spark, sf, vocab))
    return similarity.top1(hits)


@query(f"""WITH {q.SCORES}
SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
FROM scores""")
def rank_all(spark, sf):
    return similarity.rank_all(_all_scores(spark, sf))


@query(f"""WITH {q.SCORES}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
) SELECT query_id, doc_id, score, rank FROM ranked WHERE rank <= 5""")
def most_similar_documents(spark, sf):
    """For each benchmark text the five most similar documents by TF-IDF cosine."""
    return find_similar_documents(t.document_words(spark, sf, True), t.benchmark_words(spark, sf), 5)


@query(f"""WITH {q.WEIGHTS}, pairs AS (
  SELECT a.doc_id AS query_id, b.doc_id AS doc_id, round(sum(a.w * b.w), 6) AS score
  FROM weights a JOIN weights b ON a.id = b.id AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM pairs WHERE score > 0
) SELECT query_id, doc_id, score, rank FROM ranked WHERE rank <= 5""")
def similarity_join(spark, sf):
    """The five nearest other documents of every document."""
    weights = materialize(t.weights(spark, sf), "weights")
    return similarity.similarity_join(weights, weights.withColumnRenamed("doc_id", "query_id"), 5, skip_same=True)


_CENTROIDS = """centroids AS (
  SELECT label AS query_id, list(v ORDER BY d) AS qvec FROM (
    SELECT label, d, avg(v) AS v FROM (
      SELECT label, unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings
    ) GROUP BY label, d
  ) GROUP BY label
)"""


def _centroids(spark, sf):
    rows = t.table(spark, sf, "embeddings")
    return rows.groupBy(F.col("label").cast("long").alias("query_id")).agg(
        mean_vector(F.col("embedding"), width=vector_width(rows, "embedding")).alias("vec")
    )


@query(f"""WITH {_CENTROIDS}
SELECT query_id, vec_id AS doc_id, round(list_cosine_similarity(embedding::DOUBLE[], qvec), 6) AS score
FROM embeddings CROSS JOIN centroids""")
def dense_cosine(spark, sf):
    """Every embedding against the mean of each label."""
    index = t.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec"), F.lit("embeddings").alias("space")
    )
    return similarity.dense_cosine(index, _centroids(spark, sf).withColumn("space", F.lit("embeddings")))


# ---------------------------------------------------------------- topics


@query(f"""WITH {q.WEIGHTS}
SELECT count(DISTINCT doc_id) AS n_docs, 2::BIGINT AS n_topics, count(DISTINCT id) AS n_terms,
       true AS orthonormal, true AS is_singular, true AS within FROM weights""")
def lsi_fit(spark, sf):
    """Loadings of two topics: orthonormal, eigenvectors of the term products, and no larger than the whole.

    Documents are unit vectors, so their number is the sum of all squared singular values.
    """
    weights = materialize(t.weights(spark, sf), "weights")
    model = topics.lsi_fit(weights, 2)
    a, b = model.topic_term, model.topic_term.select("id", F.col("topic").alias("other"), F.col("v").alias("u"))
    products = a.join(b, "id").groupBy("topic", "other").agg(F.sum(F.col("v") * F.col("u")).alias("p"))
    same = F.when(F.col("topic") == F.col("other"), 1.0).otherwise(0.0)
    ortho = products.agg((F.max(F.abs(F.col("p") - same)) < 1e-9).alias("o")).scalar()
    z = weights.join(a, "id").groupBy("doc_id", "topic").agg(F.sum(F.col("w") * F.col("v")).alias("z"))
    y = weights.join(z, "doc_id").groupBy("id", "topic").agg(F.sum(F.col("w") * F.col("z")).alias("y"))
    rows = y.join(a, ["id", "topic"]).join(model.singular, "topic")
    rest = rows.groupBy("topic", "s").agg(F.sqrt(F.sum(F.pow(F.col("y") - F.col("s") * F.col("s") * F.col("v"), 2))).alias("r"))
    eigen = rest.agg((F.max(F.col("r") / (F.col("s") * F.col("s"))) < 1e-3).alias("e")).scalar()
    squares = model.singular.agg(F.sum(F.col("s") * F.col("s"))).scalar()
    counted = weights.agg(F.count_distinct("doc_id").alias("n_docs"), F.sum(F.col("w") * F.col("w")).alias("all"))
    shape = a.agg(F.count_distinct("topic").alias("n_topics"), F.count_distinct("id").alias("n_terms"))
    return counted.crossJoin(shape).select(  # one row each
        "n_docs",
        "n_topics",
        "n_terms",
        ortho.alias("orthonormal"),
        eigen.alias("is_singular"),
        ((squares > 0) & (squares <= F.col("all"))).alias("within"),
    )


@query(f"""WITH {q.WEIGHTS}, loads AS (
  SELECT id, unnest(range(0, 64)) AS topic, unnest(embedding::DOUBLE[]) AS v
  FROM dict JOIN embeddings ON vec_id = id % (SELECT count(*) FROM embeddings)
)
SELECT doc_id, topic, round(sum(w * v), 6) AS x FROM weights JOIN loads USING (id) GROUP BY doc_id, topic""")
def lsi_transform(spark, sf):
    """A given table of loadings: the embeddings, dealt out in turn to the words."""
    vocab = t.dictionary(spark, sf)
    dealt = t.word_vectors(spark, sf, vocab)
    loads = dealt.select("id", F.posexplode("vec").alias("topic", "v"))
    placed = topics.lsi_transform(t.weights(spark, sf, vocab), loads)
    return placed.select("doc_id", F.posexplode("vec").alias("topic", "x")).withColumn("x", F.round("x", 6))


def _listed(top, value, every):
    """Per topic how many different words are listed, whether their strength falls by rank, whether
    it is that of the word in the model, and whether no word left out is stronger.

    ``every(topic, word, x)`` holds the strength of all words, from the model's own table.
    """
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.round(F.abs(value), 9).alias("x"))))
    listed = top.groupBy("topic").agg(F.count_distinct("word").alias("n_words"), ordered.alias("o"))
    falling = F.forall(F.sequence(F.lit(1), F.size("o") - 1), lambda i: F.get("o.x", i - 1) >= F.get("o.x", i))
    said = top.select("topic", "word", F.abs(value).alias("said"))
    marked = every.join(F.broadcast(said), ["topic", "word"], "left")
    compared = marked.groupBy("topic").agg(
        F.max(F.abs(F.col("x") - F.col("said"))).alias("apart"),
        F.min(F.when(F.col("said").isNotNull(), F.col("x"))).alias("least"),
        F.max(F.when(F.col("said").isNull(), F.col("x"))).alias("beyond"),
    )
    both = listed.join(compared, "topic")
    return both.select(
        F.col("topic").cast("long").alias("topic"),
        "n_words",
        falling.alias("falling"),
        (F.col("apart") < 1e-12).alias("same"),
        (F.col("least") >= F.col("beyond") - 1e-9).alias("strongest"),
    )


@query("SELECT t AS topic, 10::BIGINT AS n_words, true AS falling, true AS same, true AS strongest FROM range(0, 2) r(t)")
def lsi_topics(spark, sf):
    """The ten strongest words of two topics, by falling strength."""
    vocab = t.dictionary(spark, sf)
    model = topics.lsi_fit(t.weights(spark, sf, vocab), 2)
    every = model.topic_term.join(vocab.select("id", "word"), "id").select("topic", "word", F.abs("v").alias("x"))
    return _listed(topics.lsi_topics(model.topic_term, vocab, 2, 10), F.col("v"), every)


@query(f"""WITH {q.QWEIGHTS}
SELECT query_id, 5::BIGINT AS n, true AS falling, true AS best FROM (SELECT DISTINCT query_id FROM qweights)""")
def similar_by_topics(spark, sf):
    """Benchmark texts folded into the LSI space of the documents, with the five best documents.

    From words to weights to topics to the index to new texts: the best score of each text is
    the largest of all scores in a full report.
    """
    vocab = t.dictionary(spark, sf)
    weights = materialize(t.weights(spark, sf, vocab), "weights")
    model = topics.lsi_fit(weights, 4)
    index = materialize(topics.lsi_transform(weights, model.topic_term), "index")
    asked = t.query_weights(spark, sf, vocab).withColumnRenamed("query_id", "doc_id")
    asked = materialize(topics.lsi_transform(asked, model.topic_term).withColumnRenamed("doc_id", "query_id"), "asked")
    found = similarity.nearest(index, asked, 5)
    most = similarity.dense_cosine(index, asked).groupBy("query_id").agg(F.max("score").alias("most"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", "score")))
    seen = found.groupBy("query_id").agg(ordered.alias("o")).join(most, "query_id")
    falling = F.forall(F.sequence(F.lit(1), F.size("o") - 1), lambda i: F.get("o.score", i - 1) >= F.get("o.score", i))
    best = F.abs(F.get("o.score", F.lit(0)) - F.col("most")) < 2e-6
    return seen.select("query_id", F.size("o").cast("long").alias("n"), falling.alias("falling"), best.alias("best"))


def _lda(spark, sf):
    vocab = t.dictionary(spark, sf)
    weights = materialize(t.weights(spark, sf, vocab), "weights")
    return vocab, weights, topics.lda_fit(weights, k=5, passes=3)


@query(f"""WITH {q.WEIGHTS}
SELECT count(DISTINCT id) AS n_terms, 5::BIGINT AS n_topics, round(sum(w), 3) AS mass, true AS positive, true AS learns FROM weights""")
def lda_fit(spark, sf):
    """Topics over all terms: what a pass gives to them is what the documents weigh.

    The topics learn: mixed as each document asks, they make its words likelier than the shares of
    all words do, which topics drawn at random do not.
    """
    _, weights, model = _lda(spark, sf)
    total = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v)
    shares = F.zip_with("vec", F.array(*[F.lit(x) for x in model.totals]), lambda a, b: a / b)
    phi = model.topic_term.select("id", shares.alias("phi"), (total / sum(model.totals)).alias("plain"))
    mixed = topics.lda_transform(model, weights).withColumnRenamed("vec", "theta")
    rows = weights.join(phi, "id").join(mixed, "doc_id")
    likely = F.aggregate(F.zip_with("phi", "theta", lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
    gain = rows.agg(F.sum(F.col("w") * (F.log(likely) - F.log("plain")))).scalar()
    return model.topic_term.agg(
        F.max(gain > 0).alias("learns"),
        F.count(F.lit(1)).alias("n_terms"),
        F.max(F.size("vec")).cast("long").alias("n_topics"),
        F.round(F.sum(total - 1.0), 3).alias("mass"),  # without the prior, a fifth for each topic
        (F.min(F.array_min("vec")) > 0).alias("positive"),
    )


@query(f"WITH {q.WEIGHTS} SELECT doc_id, 5::BIGINT AS n_topics, true AS sums_to_one, true AS positive FROM weights GROUP BY doc_id")
def lda_transform(spark, sf):
    _, weights, model = _lda(spark, sf)
    total = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v)
    return topics.lda_transform(model, weights).select(
        "doc_id",
        F.size("vec").cast("long").alias("n_topics"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        (F.array_min("vec") > 0).alias("positive"),
    )


@query("SELECT t AS topic, 10::BIGINT AS n_words, true AS falling, true AS same, true AS strongest FROM range(0, 5) r(t)")
def lda_topics(spark, sf):
    vocab, _, model = _lda(spark, sf)
    total = F.get(F.array(*[F.lit(x) for x in model.totals]), F.col("topic"))
    every = model.topic_term.select("id", F.posexplode("vec").alias("topic", "x")).join(vocab.select("id", "word"), "id")
    every = every.select("topic", "word", (F.col("x") / total).alias("x"))
    return _listed(topics.lda_topics(model, vocab, 5, 10), F.col("weight"), every)


@query("""SELECT vec_id AS doc_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings""")
def coords2d(spark, sf):
    rows = t.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec"))
    return topics.coords2d(rows.withColumn("vec", F.col("vec").cast("array<double>")))


@query("""WITH cells AS (SELECT unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings)
SELECT (SELECT count(*) FROM embeddings) AS n, round(sum(s), 5) AS variance, true AS uncorrelated, true AS x_first, true AS above_mean
FROM (SELECT var_pop(v) AS s FROM cells GROUP BY d)""")
def pca_coords2d(spark, sf):
    """Two main axes: uncorrelated, the wider one first, and each wider than the mean axis."""
    rows = t.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec"))
    width = vector_width(rows)
    parts = rows.select([F.get("vec", F.lit(i)).cast("double").alias(f"c{i}") for i in range(width)])
    variance = parts.select(sum(F.var_pop(f"c{i}") for i in range(width)).alias("v")).scalar()
    spread = (F.var_pop("x"), F.var_pop("y"))
    return topics.pca_coords2d(rows).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.round(variance, 5)).alias("variance"),
        (F.abs(F.corr("x", "y")) < 1e-6).alias("uncorrelated"),
        (spread[0] >= spread[1]).alias("x_first"),
        (spread[1] * width >= F.max(variance)).alias("above_mean"),
    )


@query(f"""WITH {q.TOK}, plan AS (
  SELECT doc_id, len(words) AS n, (row_number() OVER (ORDER BY doc_id) - 1) // 32 AS batch_id FROM words
) SELECT batch_id, count(*) AS n_docs, sum(n)::BIGINT AS n_words FROM plan GROUP BY batch_id""")
def batch_plan(spark, sf):
    sized = t.document_words(spark, sf).select("doc_id", F.size("words").alias("n"))
    planned = bags.batch_plan(sized, 32)
    return planned.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_words"))


@query("""WITH plan AS (
  SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 32 AS batch_id FROM documents
), size AS (SELECT greatest(count(*) // 32, 1) AS n FROM documents)
SELECT step, count(*) AS n_docs, sum(doc_id)::BIGINT AS checksum
FROM size, range(0, 2 * n) steps(step) JOIN plan ON batch_id = step % n GROUP BY step""")
def cursor_batches(spark, sf):
    """A cursor that goes through all full batches of the table twice."""
    docs = t.documents(spark, sf).select("doc_id")
    n_rows = docs.count()
    taken = bags.cursor_batches(docs, 32, spark.range(2 * max(n_rows // 32, 1)).withColumnRenamed("id", "step"), n_rows)
    return taken.groupBy("step").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("doc_id").alias("checksum"))
