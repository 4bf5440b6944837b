"""Pooling, classifiers and their reports over the whole tables."""

from pyspark.sql import functions as F

from textweft.functions.vectors import dot, l2_normalize, mean_vector
from textweft.operators import attention, classify, paragraphs, pooling
from textweft.operators.bags import doc2bow
from textweft.operators.similarity import best_k, dense_cosine, nearest
from textweft.operators.vocabulary import paragraph_ids
from textweft.ordered import number_rows
from textweft.plans import sql as q
from textweft.plans import tables as t
from textweft.plans.registry import query
from textweft.scratch import materialize

HOPS, UNITS, WIDTH = 2, 10, 64


def _bag(spark, sf):
    """``(doc_id, id, tf, vec)`` of in-vocabulary words, and the word vectors; word id 0 pads."""
    vocab = t.vocabulary(spark, sf)
    vectors = t.word_vectors(spark, sf, vocab)
    bow = doc2bow(t.document_words(spark, sf, True), vocab.withColumn("df", F.col("cf")))
    return bow, vectors


_BAG = f"""{q.WORD_VECTORS},
bag AS (SELECT doc_id, id, count(*) AS tf FROM tok JOIN vocab USING (word) GROUP BY doc_id, id)"""


@query(f"""WITH {q.WORD_VECTORS}
SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE id = 0) AS pads,
       round(avg(CASE WHEN id = 0 THEN 0.0 ELSE {q.weighted("vec")} END), 5) AS weighted,
       round(avg(CASE WHEN id = 0 THEN 0.0 ELSE list_sum(vec) END * pos), 4) AS by_place
FROM tok JOIN wv USING (word) GROUP BY doc_id""")
def embed_tokens(spark, sf):
    vocab = t.vocabulary(spark, sf)
    encoded = t.encoded_documents(spark, sf, vocab)
    rows = pooling.embed_tokens(encoded, t.word_vectors(spark, sf, vocab), pad_id=0)
    total = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v)
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("id") == 0).alias("pads"),
        F.round(F.avg(t.weighted("vec")), 5).alias("weighted"),
        F.round(F.avg(total * F.col("pos")), 4).alias("by_place"),
    )


def _cells(pooled):
    cells = pooled.select("doc_id", F.posexplode("vec").alias("d", "v"))
    return cells.select("doc_id", F.col("d").cast("long").alias("d"), F.round("v", 5).alias("v"))


@query(f"""WITH {_BAG}, cells AS (
  SELECT doc_id, tf, unnest(vec) AS v, generate_subscripts(vec, 1) - 1 AS d FROM bag JOIN wv USING (id)
) SELECT doc_id, d, round(sum(v * tf) / sum(tf), 5) AS v FROM cells GROUP BY doc_id, d""")
def pool_mean(spark, sf):
    return _cells(pooling.pool_bags(*_bag(spark, sf), "mean"))


@query(f"""WITH {_BAG}, cells AS (
  SELECT doc_id, unnest(vec) AS v, generate_subscripts(vec, 1) - 1 AS d FROM bag JOIN wv USING (id)
) SELECT doc_id, d, round(max(v), 5) AS v FROM cells GROUP BY doc_id, d""")
def pool_max(spark, sf):
    return _cells(pooling.pool_bags(*_bag(spark, sf), "max"))


# Attention parameters from the embeddings: W1 has the mean vector of each label as a row,
# W2 ten numbers (one for each unit) of the mean vectors of even and of odd labels.
_ATTENTION = f"""{_BAG},
spread AS (
  SELECT label, unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings
),
w1 AS (SELECT label AS unit, list(v ORDER BY d) AS w FROM (
  SELECT label, d, avg(v) * 100 AS v FROM spread GROUP BY label, d) GROUP BY label),
w2 AS (SELECT label % {HOPS} AS hop, d - 9 AS unit, avg(v) * 100 AS w FROM spread WHERE d BETWEEN 9 AND {8 + UNITS} GROUP BY 1, 2),
hidden AS (SELECT wv.id, unit, tanh(list_dot_product(vec, w)) AS h FROM wv, w1),
logits AS (
  SELECT id, hop, sum(h * w) + CASE WHEN id = 0 THEN -10000.0 ELSE 0.0 END AS s
  FROM hidden JOIN w2 USING (unit) GROUP BY id, hop
),
powers AS (
  SELECT doc_id, hop, id, tf, exp(s - max(s) OVER (PARTITION BY doc_id, hop)) AS p FROM bag JOIN logits USING (id)
),
att AS (SELECT doc_id, hop, id, tf, p / sum(p * tf) OVER (PARTITION BY doc_id, hop) AS alpha FROM powers)"""


def _attended(spark, sf):
    """The words of each document, and the word vectors with their logits."""
    bow, vectors = _bag(spark, sf)
    given = t.table(spark, sf, "embeddings")

    def means(row, name, first, width):
        part = given.select(row.alias(name), F.slice("embedding", first, width).alias("vec"))
        mean = part.groupBy(name).agg(mean_vector(F.col("vec"), width=width).alias("vec"))
        return mean.withColumn("vec", F.transform("vec", lambda x: x * 100))

    w1 = means(F.col("label"), "unit", 1, WIDTH)
    w2 = means(F.col("label") % HOPS, "hop", 9, UNITS)
    logits = pooling.attention_logits(vectors, w1, w2)
    logits = materialize(logits.select("id", "cf", "vec", "logits"), "logits")
    return bow, logits


@query(f"""WITH {_ATTENTION}, cells AS (
  SELECT doc_id, hop, tf * alpha AS a, unnest(vec) AS v, generate_subscripts(vec, 1) - 1 AS d FROM att JOIN wv USING (id)
) SELECT doc_id, hop * {WIDTH} + d AS d, round(sum(a * v), 5) AS v FROM cells GROUP BY doc_id, hop, d""")
def pool_attention(spark, sf):
    return _cells(pooling.pool_bags(*_attended(spark, sf), "attention", HOPS))


@query(f"""WITH {_ATTENTION}, products AS (
  SELECT a.doc_id, a.hop AS i, b.hop AS j, sum(a.tf * a.alpha * b.alpha) AS m
  FROM att a JOIN att b ON a.doc_id = b.doc_id AND a.id = b.id GROUP BY a.doc_id, a.hop, b.hop
), norms AS (
  SELECT doc_id, sqrt(sum((m - CASE WHEN i = j THEN 1 ELSE 0 END) ** 2) + 1e-10) AS f FROM products GROUP BY doc_id
) SELECT round(avg(f) * 0.5, 6) AS penalty FROM norms""")
def attention_redundancy(spark, sf):
    penalty = pooling.overlap_redundancy(pooling.pool_bags(*_attended(spark, sf), "overlap", HOPS), HOPS, 0.5)
    return penalty.select(F.round("penalty", 6).alias("penalty"))


# ---------------------------------------------------------------- training


def _training_rows(spark, sf):
    """``(doc_id, vec, label)``: mean word vectors of the labelled documents."""
    pooled = pooling.pool_bags(*_bag(spark, sf), "mean")
    labels = t.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return materialize(classify.label_lookup(pooled, labels), "training-rows")


# What SQL can state of a fitted classifier: the rows it judges, and the loss of the bare share
# of each class, which it must not exceed on the rows it was fitted on.
_LABELLED = f"""WITH {q.VOCAB}, rows AS (
  SELECT doc_id, quality AS label FROM labels WHERE doc_id IN (SELECT doc_id FROM tok JOIN vocab USING (word))
), shares AS (SELECT label, count(*) / (SELECT count(*) FROM rows) AS p, count(*) AS n FROM rows GROUP BY label)"""
_FITTED = f"""{_LABELLED}
SELECT sum(n)::BIGINT AS n, round(-sum(p * ln(p)), 6) AS prior_loss, true AS beats_prior, true AS accurate FROM shares"""


def _judged(rows, model):
    """The loss of the class shares over all rows, and whether the model does better."""
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total, most = counts.agg(F.sum("n"), F.max("n")).first()
    p = F.col("n") / total
    prior = counts.agg(F.sum("n").alias("n"), F.round(-F.sum(p * F.log(p)), 6).alias("prior_loss"))
    found = classify.evaluate(classify.predict(model, rows)).first()
    return prior.withColumns(
        {"beats_prior": F.lit(found["loss"]) < F.col("prior_loss"), "accurate": F.lit(found["accuracy"] >= most / total)}
    )


@query(_FITTED)
def train_classifier(spark, sf):
    """A hidden layer and softmax, fitted on the labelled documents."""
    rows = _training_rows(spark, sf)
    return _judged(rows, classify.train_classifier(rows, 2, hidden=8, max_iter=100))


@query(_FITTED)
def train_logistic(spark, sf):
    """Logistic regression, fitted on the labelled documents."""
    rows = _training_rows(spark, sf)
    return _judged(rows, classify.train_classifier(rows, 2, max_iter=100, regularization=1e-3))


@query(f"""{_LABELLED}
SELECT doc_id, label, 2::BIGINT AS classes, true AS sums_to_one, true AS is_likeliest FROM rows""")
def predict(spark, sf):
    """Probabilities of every labelled document that sum to 1, and the likelier class."""
    rows = _training_rows(spark, sf)
    predicted = classify.predict(classify.train_classifier(rows, 2, max_iter=50), rows)
    total = F.aggregate("probability", F.lit(0.0), lambda a, p: a + p)
    likeliest = F.array_position("probability", F.array_max("probability")) - 1
    return predicted.select(
        "doc_id",
        "label",
        F.size("probability").cast("long").alias("classes"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        (F.col("prediction") == likeliest).alias("is_likeliest"),
    )


def _paragraph_rows(spark, sf):
    """Paragraph vectors of the labelled documents, from a model fitted on all documents."""
    tokens = t.document_words(spark, sf, True)
    model = paragraphs.pvdm_fit(tokens, paragraphs.Settings(size=16, paragraph_size=16, window=3), max_iter=2)
    keyed = tokens.filter(F.size("words") > 0).select("doc_id", F.array_join("words", " ").alias("text"))
    owners = paragraph_ids(keyed, model.paragraphs)
    vectors = owners.join(model.paragraph_vectors(), "para_id").select("doc_id", "vec")
    labels = t.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return materialize(classify.label_lookup(vectors, labels), "paragraph-rows")


_WITH_WORDS = f"""WITH {q.WORDS}, rows AS (
  SELECT doc_id, quality AS label FROM labels WHERE doc_id IN (SELECT doc_id FROM words WHERE len(words) > 0)
)"""


@query(f"""{_WITH_WORDS}
SELECT label::VARCHAR AS class, count(*) AS support, true AS in_range, true AS agrees FROM rows GROUP BY label
UNION ALL SELECT 'avg / total', count(*), true, true FROM rows""")
def paragraph_report(spark, sf):
    """From paragraph vectors to a classifier to its report, over the labelled documents.

    The report agrees with counts of hits made here from the same predictions, class by class.
    """
    rows = _paragraph_rows(spark, sf)
    model = classify.train_classifier(rows, 2, max_iter=50, regularization=1e-3)
    predicted = materialize(classify.predict(model, rows).select("label", "prediction"), "predicted")
    report = classify.classification_report(predicted)
    classes = [r["label"] for r in predicted.select("label").distinct().collect()]
    n = predicted.count()
    counts = predicted.agg(*[
        F.count_if((F.col("label").isin(a)) & (F.col("prediction").isin(b))).alias(f"{i}_{j}")
        for i, a in enumerate([[c] for c in classes] + [classes]) for j, b in enumerate([[c] for c in classes] + [list(range(64))])
    ]).first()
    every, want = len(classes), []
    for i, c in enumerate(classes):
        hits, support, said = counts[f"{i}_{i}"], counts[f"{i}_{every}"], counts[f"{every}_{i}"]
        want.append((str(c), hits / said if said else 0.0, hits / support, 2 * hits / (support + said), support))
    mean = [sum(w[k] * w[4] for w in want) / n for k in (1, 2, 3)]
    wanted = spark.createDataFrame([w[:4] for w in want] + [("avg / total", *mean)], "class string, p double, r double, f double")
    inside = [F.col(m).between(0, 1) for m in ("precision", "recall", "f1")]
    same = [F.abs(F.col(a) - F.col(b)) < 1e-9 for a, b in (("precision", "p"), ("recall", "r"), ("f1", "f"))]
    return report.join(F.broadcast(wanted), "class", "left").select(
        "class", "support", (inside[0] & inside[1] & inside[2]).alias("in_range"), (same[0] & same[1] & same[2]).alias("agrees")
    )


@query(f"""{_WITH_WORDS}
SELECT doc_id AS query_id, 5::BIGINT AS n, true AS falling, true AS nearest, label FROM rows""")
def paragraph_neighbours(spark, sf):
    """The five labelled documents with the nearest paragraph vectors, each with its class.

    Each score is that of the two vectors; of every fiftieth document a full report shows that no
    other document is nearer.
    """
    rows = _paragraph_rows(spark, sf)
    found = nearest(rows.select("doc_id", "vec"), rows.select(F.col("doc_id").alias("query_id"), "vec"), 5, skip_same=True)
    found = materialize(found, "nearest")
    model = classify.train_classifier(rows, 2, max_iter=50, regularization=1e-3)
    guesses = classify.predict(model, rows).withColumnRenamed("doc_id", "id")
    labelled = classify.neighbour_labels(found.withColumnRenamed("doc_id", "id"), guesses)
    unit = rows.select("doc_id", l2_normalize(F.col("vec")).alias("unit"))
    scored = labelled.join(unit.withColumnsRenamed({"doc_id": "query_id", "unit": "u"}), "query_id")
    scored = scored.join(unit.withColumnsRenamed({"doc_id": "id", "unit": "v"}), "id")
    scored = scored.withColumn("right", F.abs(dot(F.col("u"), F.col("v")) - F.col("score")) < 2e-6)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "score", "right")))
    seen = scored.groupBy("query_id").agg(ordered.alias("o"))
    falling = F.forall(F.sequence(F.lit(1), F.size("o") - 1), lambda i: F.get("o.score", i - 1) >= F.get("o.score", i))
    few = rows.filter(F.col("doc_id") % 50 == 0).select(F.col("doc_id").alias("query_id"), "vec")
    report = dense_cosine(rows.select("doc_id", "vec"), few).filter(F.col("doc_id") != F.col("query_id"))
    best = best_k(report, 5).groupBy("query_id").agg(F.min("score").alias("fifth"))
    own = rows.select(F.col("doc_id").alias("query_id"), "label")
    right = F.forall("o", lambda x: x["right"]) & F.coalesce(F.abs(F.get("o.score", F.lit(4)) - F.col("fifth")) < 2e-6, F.lit(True))
    seen = seen.join(best, "query_id", "left")
    shown = seen.select("query_id", F.size("o").cast("long").alias("n"), falling.alias("falling"), right.alias("nearest"))
    return shown.join(own, "query_id")


@query(f"""{_LABELLED}
SELECT 4::BIGINT AS n_epochs, sum(n)::BIGINT AS n, true AS falls, true AS kept_best, true AS follows_rate, true AS parts FROM shares""")
def train_attention(spark, sf):
    """Hops that learn which words of a labelled document to weigh, by epochs with a held-out part.

    The held-out loss ends below that of the weights it started from, the kept epoch is the one that
    :func:`classify.select_best` marks last in the log, rates are those it gives, and hops that are made to part
    overlap less than at first.
    """
    bow, vectors = _bag(spark, sf)
    labels = t.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    rows = attention.attention_rows(pooling.embed_bag(bow, vectors), labels)
    rows = materialize(classify.split_rows(rows, "doc_id", 0.8, 0.2), "attention-rows")
    train, held = rows.filter("part = 'train'"), rows.filter("part <> 'train'")
    s = attention.AttentionSettings(width=WIDTH, hops=HOPS, units=UNITS, rate=0.01, penalty=0.1)
    given = attention.losses(held, s, attention.start_parameters(s))
    model = attention.train_attention(train, held, s, epochs=4)
    after = attention.losses(held, s, model.parameters)
    log = classify.select_best(model.epoch_table(spark), rate=s.rate, decay=s.decay)
    best = log.filter("best_loss").agg(F.max_by("loss", "epoch")).scalar()
    return log.agg(
        F.count(F.lit(1)).alias("n_epochs"),
        F.max(F.lit(rows.count())).alias("n"),
        F.max(F.lit(after[0] < given[0])).alias("falls"),
        (F.max(F.abs(best - F.lit(after[0]))) < 1e-9).alias("kept_best"),
        (F.max(F.abs(F.col("rate") - F.col("used_rate"))) < 1e-12).alias("follows_rate"),
        (F.max_by("penalty", "epoch") < F.lit(given[2])).alias("parts"),
    )


# ---------------------------------------------------------------- judging
# Predictions that both engines can state: quality by the length of the text.

_GUESSES = """guesses AS (
  SELECT doc_id, quality AS label, source, 1 / (1 + exp(-(ln(n_chars) - 6) / 2)) AS p1
  FROM documents JOIN labels USING (doc_id)
),
predictions AS (
  SELECT *, CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END AS prediction, CASE WHEN label = 1 THEN p1 ELSE 1 - p1 END AS p
  FROM guesses
)"""


def _predictions(spark, sf):
    docs = t.table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    labels = t.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    p1 = 1 / (1 + F.exp(-(F.log("n_chars") - 6) / 2))
    return classify.label_lookup(docs, labels).withColumn("p1", p1).select(
        "doc_id",
        "source",
        "label",
        F.array(1 - F.col("p1"), F.col("p1")).alias("probability"),
        (F.col("p1") > 0.5).cast("int").alias("prediction"),
    )


@query(f"""WITH {_GUESSES}
SELECT count(*) AS n, round(avg(-ln(p)), 6) AS loss, round(avg((prediction = label)::INT), 6) AS accuracy
FROM predictions""")
def evaluate(spark, sf):
    result = classify.evaluate(_predictions(spark, sf))
    return result.select("n", F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"))


@query(f"WITH {_GUESSES} SELECT round(avg(-ln(p)), 6) AS kl FROM predictions")
def kl_divergence(spark, sf):
    truth = F.when(F.col("label") == 1, F.array(F.lit(0.0), F.lit(1.0))).otherwise(F.array(F.lit(1.0), F.lit(0.0)))
    result = classify.kl_divergence(_predictions(spark, sf).withColumn("truth", truth))
    return result.select(F.round("kl", 6).alias("kl"))


# label of the nearest other embedding as the prediction
_NEIGHBOURS = f"""{q.EMB},
scored AS (
  SELECT a.id AS query_id, b.id AS id, round(list_dot_product(a.unit, b.unit), 6) AS score
  FROM emb a JOIN emb b ON a.id <> b.id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored),
guess AS (
  SELECT query_id AS id, n.label AS prediction, o.label AS label
  FROM ranked JOIN emb n ON n.id = ranked.id JOIN emb o ON o.id = query_id WHERE rank = 1
)"""


def _neighbours(spark, sf, k):
    rows = t.table(spark, sf, "embeddings")
    index = materialize(rows.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec")), "index")
    found = nearest(index, index.withColumnRenamed("doc_id", "query_id"), k, skip_same=True)
    return found.withColumnRenamed("doc_id", "id"), rows.select(F.col("vec_id").alias("id"), "label")


def _neighbour_guess(found, labels):
    first = found.filter(F.col("rank") == 1).join(labels.withColumnRenamed("label", "prediction"), "id")
    own = labels.withColumnRenamed("id", "query_id")
    return first.join(own, "query_id").select(F.col("query_id").alias("id"), "prediction", "label")


@query(f"""WITH {_NEIGHBOURS},
counts AS (
  SELECT class, sum(is_label) AS support, sum(1 - is_label) AS predicted, sum(hit) AS hits FROM (
    SELECT label AS class, 1 AS is_label, (label = prediction)::INT AS hit FROM guess
    UNION ALL SELECT prediction, 0, 0 FROM guess
  ) GROUP BY class
),
report AS (
  SELECT class::VARCHAR AS class, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision,
         CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall, 2 * hits / (support + predicted) AS f1, support
  FROM counts
)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM report
UNION ALL SELECT 'avg / total', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM report""")
def classification_report(spark, sf):
    report = classify.classification_report(_neighbour_guess(*_neighbours(spark, sf, 1)))
    return report.select("class", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")], "support")


@query(f"""WITH {_NEIGHBOURS}
SELECT query_id, ranked.id AS id, score, rank, prediction, label FROM ranked JOIN guess ON guess.id = ranked.id WHERE rank <= 5""")
def neighbour_labels(spark, sf):
    found, labels = _neighbours(spark, sf, 5)
    found = materialize(found, "neighbours")
    return classify.neighbour_labels(found, _neighbour_guess(found, labels))


# One "epoch" per source, in order of its number.
_EPOCHS = f"""{_GUESSES},
epochs AS (
  SELECT substr(source, 4)::INT AS epoch, round(avg(-ln(p)), 6) AS loss, round(avg((prediction = label)::INT), 6) AS accuracy
  FROM predictions GROUP BY source
)"""


def _epochs(spark, sf):
    p = F.get("probability", F.col("label"))
    return _predictions(spark, sf).groupBy(F.expr("cast(substr(source, 4) AS int)").alias("epoch")).agg(
        F.round(F.avg(-F.log(p)), 6).alias("loss"),
        F.round(F.avg((F.col("prediction") == F.col("label")).cast("double")), 6).alias("accuracy"),
    )


@query(f"""WITH {_EPOCHS},
seen AS (
  SELECT *, min(loss) OVER e AS l, max(accuracy) OVER e AS a FROM epochs
  WINDOW e AS (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
flagged AS (SELECT epoch, loss, accuracy, l IS NULL OR loss < l AS best_loss, a IS NULL OR accuracy > a AS best_accuracy FROM seen)
SELECT *, round(0.001 * 0.2 ** coalesce(sum((NOT best_loss)::INT) OVER (
  ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 18) AS rate FROM flagged""")
def select_best(spark, sf):
    return classify.select_best(_epochs(spark, sf)).withColumn("rate", F.round("rate", 18))


@query(f"""WITH {_EPOCHS}
SELECT (SELECT epoch FROM epochs ORDER BY loss, epoch LIMIT 1) AS best_loss_epoch,
       (SELECT epoch FROM epochs ORDER BY accuracy DESC, epoch LIMIT 1) AS best_accuracy_epoch""")
def best_epochs(spark, sf):
    return classify.best_epochs(_epochs(spark, sf))


@query("SELECT doc_id, quality, toxic, n_chars FROM documents JOIN labels USING (doc_id)")
def label_lookup(spark, sf):
    docs = t.table(spark, sf, "documents").select("doc_id", "n_chars")
    return classify.label_lookup(docs, t.table(spark, sf, "labels"))


@query("""SELECT count(*) AS n, count(*) AS n_places, 0::BIGINT AS low, count(*) - 1 AS high, true AS parted, true AS moved
FROM conversations""")
def shuffle_rows(spark, sf):
    """A new order of the same rows: every place once, turns parted, hardly a row where it was."""
    rows = t.table(spark, sf, "conversations").select("conv_id", "turn")
    placed = materialize(classify.shuffle_rows(rows, ["conv_id", "turn"]), "placed")
    before = number_rows(rows, ["conv_id", "turn"], "before").select("conv_id", "turn", "before")
    after = placed.select(F.col("conv_id").alias("next"), (F.col("position") - 1).alias("position"))
    joined = placed.join(before, ["conv_id", "turn"]).join(after, "position", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("position").alias("n_places"),
        F.min("position").alias("low"),
        F.max("position").alias("high"),
        (F.count_if(F.col("next") == F.col("conv_id")) < 0.2 * F.count(F.lit(1))).alias("parted"),
        (F.count_if(F.col("before") == F.col("position")) < 0.1 * F.count(F.lit(1))).alias("moved"),
    )


@query("SELECT count(*) AS n, count(*) AS n_rows, 3::BIGINT AS n_parts, true AS in_bounds FROM labels")
def split_rows(spark, sf):
    """Eight, one and one tenth of the rows, each row in one part, within five standard errors."""
    split = classify.split_rows(t.table(spark, sf, "labels"), "doc_id")
    n, parts = F.count(F.lit(1)), {"train": 0.8, "validation": 0.1, "test": 0.1}
    inside = [F.abs(F.count_if(F.col("part") == p) - s * n) <= 5 * F.sqrt(n * s * (1 - s)) for p, s in parts.items()]
    return split.agg(
        n.alias("n"),
        F.count_distinct("doc_id", "part").alias("n_rows"),
        F.count_distinct("part").alias("n_parts"),
        (inside[0] & inside[1] & inside[2]).alias("in_bounds"),
    )
