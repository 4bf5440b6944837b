"""Queries that audit filters, sources and language models, and their SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweft.llm.common import table
from textweft.llm.divergence import source_divergence
from textweft.llm.filter_audit import audit_filters
from textweft.llm.lm_score import fit_language_model, held_out, score_texts
from textweft.llm.registry import query

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\r\v\f]+'), lambda x: x <> '')"


@query(
    f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_WORDS} AS w FROM documents
),
f AS (
  SELECT doc_id, part,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM d
),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask
),
k(i) AS (VALUES (0), (1), (2), (3), (4)),
o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM k a, k b, k c, k d, k e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
),
s AS (
  SELECT array_to_string(list_transform(o, lambda x: substr('ABCDE', x + 1, 1)), '') AS filter_order, step, o[step] AS place,
         list_sum(list_transform(o[1:step - 1], lambda x: 1 << x)) AS before
  FROM (SELECT o, unnest(range(1, 6))::INT AS step FROM o)
),
r AS (
  SELECT part, filter_order, step, place, n, good, toxic, mask, mask & coalesce(before, 0)::INT = 0 AS there, mask >> place & 1 = 1 AS fails
  FROM c, s
),
m AS (
  SELECT part, filter_order, step, place,
         coalesce(sum(n) FILTER (there AND NOT fails), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (there AND fails), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (fails AND NOT there), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = 1 << place), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (there AND fails), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (there AND fails), 0)::BIGINT AS toxic_lost
  FROM r GROUP BY ALL
)
SELECT * EXCLUDE (place), (sum(removed) OVER (PARTITION BY part, place))::BIGINT AS shapley FROM m
"""
)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes at each place of every order, by source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit_filters(docs, table(spark, sf_dir, "labels"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    f"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT i, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
gn AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000 * (coalesce(n, 0) + 1)) // (total + v) AS p
  FROM gn JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
),
l AS (
  SELECT lang, term, 1 + (1000000000 * (sum(n) + 1)::HUGEINT) // (any_value(total) + any_value(v)) AS q
  FROM p JOIN v USING (lang) JOIN (SELECT lang, sum(total)::HUGEINT AS total FROM gn GROUP BY lang) USING (lang) GROUP BY lang, term
),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
  FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q
)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
) WHERE part = 'pair' OR rank <= 200
"""
)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ, and the terms that mark them."""
    return source_divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


@query()
def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every document, by a model taught on rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_language_model(docs)
    found = score_texts(docs, model, keep=["doc_id"])
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
