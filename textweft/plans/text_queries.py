"""Text and token-array operators over the whole tables."""

from pyspark.sql import functions as F

from textweft.functions import text as tx
from textweft.operators import bags, vocabulary
from textweft.plans import sql as q
from textweft.plans import tables as t
from textweft.plans.registry import query

_WORD_PATTERN = r"[^\p{L}\p{N}_]+"


def _joined(spark, sf, words, name="documents", id="doc_id"):
    rows = t.spread(t.table(spark, sf, name).select(id, "text"))
    return rows.select(id, F.array_join(words, " ").alias("words"), F.size(words).cast("long").alias("n"))


def _joined_sql(words, name="documents", id="doc_id"):
    return f"""SELECT {id}, array_to_string(w, ' ') AS words, len(w) AS n
FROM (SELECT {id}, {words} AS w FROM {name})"""


@query(_joined_sql(q.split_ws("lower(text)")))
def tokenize_ws(spark, sf):
    return _joined(spark, sf, tx.tokenize_ws(F.col("text")))


@query(_joined_sql(q.split_words("lower(text)", _WORD_PATTERN)))
def tokenize_word(spark, sf):
    return _joined(spark, sf, tx.tokenize_word(F.col("text")))


@query(_joined_sql(q.content_words("text")))
def remove_stopwords(spark, sf):
    return _joined(spark, sf, tx.remove_stopwords(tx.tokenize_word(F.col("text"))))


@query(f"""WITH {q.TOK},
listed AS (SELECT DISTINCT unnest({q.split_words("lower(text)", _WORD_PATTERN)}) AS word FROM benchmark),
kept AS (SELECT doc_id, word, pos FROM tok WHERE word NOT IN (SELECT word FROM listed))
SELECT words.doc_id, coalesce(string_agg(word, ' ' ORDER BY pos), '') AS words
FROM words LEFT JOIN kept ON kept.doc_id = words.doc_id GROUP BY words.doc_id""")
def drop_listed_words(spark, sf):
    """A stop word list of any length, here all words of the benchmark."""
    listed = t.table(spark, sf, "benchmark").select(F.explode(tx.tokenize_word(F.col("text"))).alias("word"))
    kept = vocabulary.drop_listed_words(t.document_words(spark, sf, True), listed)
    return kept.select("doc_id", F.array_join("words", " ").alias("words"))


@query(f"""SELECT page_id, trim(regexp_replace(html, '{tx.SPACE}+', ' ', 'g'), ' ') AS html FROM pages""")
def normalize_ws(spark, sf):
    return t.table(spark, sf, "pages").select("page_id", tx.normalize_ws(F.col("html")).alias("html"))


@query(f"""SELECT conv_id, turn, array_to_string(w, ' ') AS words, len(w) AS n
FROM (SELECT conv_id, turn, regexp_extract_all(lower(text), '{tx.REVIEW_TOKEN}') AS w FROM conversations)""")
def tokenize_review(spark, sf):
    words = tx.tokenize_review(F.col("text"))
    return t.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.array_join(words, " ").alias("words"), F.size(words).cast("long").alias("n")
    )


@query(f"""SELECT item_id, array_to_string(CASE
  WHEN length(s) >= 2 THEN list_transform(range(1, length(s)), lambda i: substring(s, i, 2))
  WHEN length(s) = 1 THEN [s] ELSE [] END, ' ') AS pairs
FROM (SELECT item_id, regexp_replace(text, '{tx.SPACE}+', '', 'g') AS s FROM benchmark)""")
def tokenize_cjk(spark, sf):
    pairs = tx.tokenize_cjk(F.col("text"))
    return t.table(spark, sf, "benchmark").select("item_id", F.array_join(pairs, " ").alias("pairs"))


_LINES = rf"""lines AS (
  SELECT doc_id, lang, unnest(string_split_regex(text, '{tx.LINE_BREAK}')) AS line FROM documents
)"""


@query(f"""WITH {_LINES}
SELECT doc_id, count(*) AS n_lines FROM lines
WHERE regexp_replace(line, '{tx.SPACE}+', '', 'g') <> '' GROUP BY doc_id""")
def drop_blank(spark, sf):
    lines = tx.drop_blank(t.document_lines(spark, sf), "line")
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))


@query(f"""WITH {_LINES}
SELECT doc_id, count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars FROM lines
WHERE NOT regexp_matches(line, '{tx.BAD_LINE}') GROUP BY doc_id""")
def drop_bad_lines(spark, sf):
    lines = tx.drop_bad_lines(t.document_lines(spark, sf), "line")
    return lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars")
    )


_BLANK = f"regexp_replace(x, '{tx.SPACE}+', '', 'g') = ''"


@query(rf"""WITH split AS (
  SELECT doc_id, string_split_regex(text, '{tx.LINE_BREAK}') AS lines FROM documents
), gaps AS (
  SELECT doc_id, lines, list_position(list_transform(lines, lambda x: {_BLANK}), true) AS gap FROM split
), headed AS (
  SELECT doc_id, CASE WHEN gap > 0 AND regexp_matches(lines[1], '{tx.HEADER_LINE}')
                      THEN lines[gap + 1:] ELSE lines END AS lines FROM gaps
), unquoted AS (
  SELECT doc_id, string_split(regexp_replace(array_to_string(
    list_filter(lines, lambda x: NOT regexp_matches(x, '{tx.QUOTED_LINE}')), chr(10)),
    '\A{tx.SPACE}+|{tx.SPACE}+\z', '', 'g'), chr(10)) AS lines FROM headed
), footed AS (
  SELECT doc_id, lines, list_max(list_transform(lines, lambda x, i:
    CASE WHEN regexp_matches(x, '{tx.GAP_LINE}') THEN i - 1 ELSE 0 END)) AS gap FROM unquoted
)
SELECT doc_id, array_to_string(CASE WHEN gap > 0 THEN lines[1:gap] ELSE lines END, chr(10)) AS text FROM footed""")
def strip_mail(spark, sf):
    docs = t.spread(t.documents(spark, sf))
    return docs.select("doc_id", tx.strip_mail(F.col("text")).alias("text"))


@query(f"""WITH {q.WORDS}
SELECT doc_id, array_to_string(words[1:100], ' ') AS words, len(words) AS n_before FROM words""")
def truncate_tokens(spark, sf):
    words = t.document_words(spark, sf)
    return words.select(
        "doc_id",
        F.array_join(tx.truncate_tokens(F.col("words"), 100), " ").alias("words"),
        F.size("words").cast("long").alias("n_before"),
    )


# ids by first occurrence; the pad word is 0
_INSERTION = f"""{q.TOK},
firsts AS (SELECT word, min(doc_id) AS d, arg_min(pos, (doc_id, pos)) AS p FROM tok GROUP BY word),
ins AS (SELECT word, row_number() OVER (ORDER BY d, p) AS id FROM firsts)"""


@query(f"""WITH {_INSERTION},
plan AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 32 AS batch_id FROM documents),
enc AS (SELECT doc_id, id, pos FROM tok JOIN ins USING (word)),
sizes AS (SELECT plan.doc_id, batch_id, count(id) AS n FROM plan LEFT JOIN enc USING (doc_id) GROUP BY 1, 2),
longest AS (SELECT batch_id, least(max(n), 500) AS m FROM sizes GROUP BY batch_id)
SELECT sizes.doc_id, batch_id, any_value(m) AS width,
       coalesce(sum(id), 0)::BIGINT AS id_sum, greatest(any_value(m - n), 0) AS pads
FROM sizes JOIN longest USING (batch_id)
LEFT JOIN enc ON enc.doc_id = sizes.doc_id AND enc.pos < 500 GROUP BY sizes.doc_id, batch_id""")
def pad_batch(spark, sf):
    tokens = t.document_words(spark, sf)
    encoded = bags.encode_tokens(tokens, vocabulary.insertion_dictionary(tokens))
    padded = bags.pad_batch(bags.batch_plan(encoded, 32))
    return padded.select(
        "doc_id",
        "batch_id",
        F.size("ids").cast("long").alias("width"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"),
        F.size(F.filter("ids", lambda x: x == 0)).cast("long").alias("pads"),
    )


@query("SELECT doc_id, quality + 1 AS stars, quality AS label FROM labels")
def shift_label(spark, sf):
    stars = t.table(spark, sf, "labels").select("doc_id", (F.col("quality") + 1).alias("stars"))
    return stars.withColumn("label", tx.shift_label(F.col("stars")))


@query(f"""WITH {_INSERTION}
SELECT words.doc_id, coalesce(string_agg(id::VARCHAR, ' ' ORDER BY pos), '') AS ids
FROM words LEFT JOIN (tok JOIN ins USING (word)) USING (doc_id) GROUP BY words.doc_id""")
def encode_tokens(spark, sf):
    tokens = t.document_words(spark, sf)
    encoded = bags.encode_tokens(tokens, vocabulary.insertion_dictionary(tokens))
    return encoded.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@query(f"""WITH {q.WORDS} SELECT doc_id, array_to_string(words, ' ') AS key FROM words""")
def paragraph_key(spark, sf):
    return t.document_words(spark, sf).select("doc_id", tx.paragraph_key(F.col("words")).alias("key"))


@query(f"""WITH {q.BOW}
SELECT doc_id, string_agg(word, ' ' ORDER BY id) AS text FROM bow JOIN dict USING (id) GROUP BY doc_id""")
def render_bow(spark, sf):
    vocab = t.dictionary(spark, sf)
    return bags.render_bow(t.bow(spark, sf, vocab), vocab)


@query("""SELECT vec_id, d, round(v / sqrt(sum(v * v) OVER (PARTITION BY vec_id)), 6) AS v FROM (
  SELECT vec_id, unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) - 1 AS d FROM embeddings)""")
def l2_normalize(spark, sf):
    from textweft.functions.vectors import l2_normalize as unit

    rows = t.table(spark, sf, "embeddings")
    return rows.select("vec_id", F.posexplode(unit(F.col("embedding"))).alias("d", "v")).select(
        "vec_id", F.col("d").cast("long").alias("d"), F.round("v", 6).alias("v")
    )
