"""Building blocks of the check queries, for DuckDB."""

from textweft.functions.text import SPACE, STOPWORDS

_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)


def split_words(text: str, pattern: str) -> str:
    return f"list_filter(string_split_regex({text}, '{pattern}'), lambda x: x <> '')"


def split_ws(text: str) -> str:
    return split_words(text, SPACE + "+")


def content_words(text: str) -> str:
    words = split_words(f"lower({text})", r"[^\p{L}\p{N}_]+")
    return f"list_filter({words}, lambda w: w NOT IN ({_STOP}))"


def exploded(name: str, source: str, id: str = "doc_id", words: str = "words") -> str:
    """A CTE (id, word, pos), one row per word."""
    return (
        f"{name} AS (SELECT {id}, unnest({words}) AS word, "
        f"generate_subscripts({words}, 1) - 1 AS pos FROM {source})"
    )


# CTEs on the documents: words(doc_id, words), tok(doc_id, word, pos)
WORDS = f"words AS (SELECT doc_id, {content_words('text')} AS words FROM documents)"
TOK = f"{WORDS}, {exploded('tok', 'words')}"
# dict(word, id, df, cf) of words that occur at least twice; bow(doc_id, id, tf)
DICT = f"""{TOK},
dict AS (
  SELECT word, row_number() OVER (ORDER BY min(doc_id), word) - 1 AS id,
         count(DISTINCT doc_id) AS df, count(*) AS cf
  FROM tok GROUP BY word HAVING count(*) >= 2
)"""
BOW = f"""{DICT},
bow AS (SELECT doc_id, id, count(*) AS tf FROM tok JOIN dict USING (word) GROUP BY doc_id, id)"""
WEIGHTS = f"""{BOW},
raw AS (
  SELECT doc_id, id, tf * log2((SELECT count(*) FROM documents) / df) AS w
  FROM bow JOIN dict USING (id)
),
weights AS (
  SELECT doc_id, id, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM raw WHERE w <> 0
)"""
# the benchmark texts in the same space: qweights(query_id, id, w)
QWEIGHTS = f"""{WEIGHTS},
qwords AS (SELECT item_id AS query_id, {content_words('text')} AS words FROM benchmark),
{exploded('qtok', 'qwords', 'query_id')},
qraw AS (
  SELECT query_id, id, count(*) * log2((SELECT count(*) FROM documents) / any_value(df)) AS w
  FROM qtok JOIN dict USING (word) GROUP BY query_id, id
),
qweights AS (
  SELECT query_id, id, w / sqrt(sum(w * w) OVER (PARTITION BY query_id)) AS w FROM qraw WHERE w <> 0
)"""
# scores(query_id, doc_id, score) for every pair
SCORES = f"""{QWEIGHTS},
hits AS (
  SELECT query_id, doc_id, round(sum(weights.w * qweights.w), 6) AS score
  FROM qweights JOIN weights USING (id) GROUP BY query_id, doc_id
),
scores AS (
  SELECT item_id AS query_id, documents.doc_id, coalesce(score, 0.0) AS score
  FROM benchmark CROSS JOIN documents
  LEFT JOIN hits ON hits.query_id = item_id AND hits.doc_id = documents.doc_id
)"""
# vocab(word, id, cf) of words with five or more occurrences
VOCAB = f"""{TOK},
vocab AS (
  SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) - 1 AS id, count(*) AS cf
  FROM tok GROUP BY word HAVING count(*) >= 5
)"""
# wv(id, word, cf, vec): a vector per vocabulary word, the embeddings dealt out in turn
WORD_VECTORS = f"""{VOCAB},
wv AS (
  SELECT id, word, cf, embedding::DOUBLE[] AS vec
  FROM vocab JOIN embeddings ON vec_id = id % (SELECT count(*) FROM embeddings)
)"""


def weighted(vec: str) -> str:
    """All numbers of a vector in one: the first once, the second twice, …"""
    return f"list_dot_product({vec}, range(1, len({vec}) + 1)::DOUBLE[])"


# emb(id, word, vec, unit, label)
EMB = """emb AS (
  SELECT vec_id AS id, CASE WHEN vec_id = 0 THEN '**UNKNOWN**' ELSE 'w' || vec_id END AS word,
         embedding::DOUBLE[] AS vec,
         list_transform(embedding::DOUBLE[], lambda x:
           x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS unit,
         label
  FROM embeddings
)"""
