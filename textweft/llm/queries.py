"""The operators' queries over the given tables, and their SQL where SQL can state them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweft.llm import audit_queries  # noqa: F401  (registers its queries)
from textweft.llm.bpe import encode_texts
from textweft.llm.common import table
from textweft.llm.decontaminate import contamination
from textweft.llm.html_text import extract_text
from textweft.llm.personal_data import DIGEST, find_personal_data
from textweft.llm.quality_model import fit_quality_model, held_out, score_quality
from textweft.llm.quality_rules import COUNTS, fit_quality, judge_counts
from textweft.llm.registry import ORACLES, QUERIES, query
from textweft.llm.simhash import near_duplicates
from textweft.llm.substrings import remove_repeated_spans
from textweft.llm.url_filter import url_verdicts
from textweft.llm.warc import assemble, read_archives, resolve_revisits, write_archives
from textweft.scratch import materialize, new_path

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; the digests show ids and text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, tokenizer_path(), ("n_tokens", "ids_sha256", "decoded_sha256"), keep=["doc_id"])


_WORDS_10 = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS_10.format("text")}, []) AS w FROM documents),
i AS (SELECT item_id, {_WORDS_10.format("text")} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS win, least(len(w), 10) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS s FROM i WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM win),
spots AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)
),
hit AS (SELECT doc_id, item_id, s, size FROM spots JOIN win USING (win, size)),
n_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hit) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that occur in each document, and how many of its words they cover."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    covered = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


@query()
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by fingerprints at most two bits apart."""
    found = near_duplicates(table(spark, sf_dir, "documents"), size=3, reach=2)
    shown = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", shown.alias("fingerprint"), "component_id")


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, by a model taught on rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality_model(docs, table(spark, sf_dir, "labels"))
    found = score_quality(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query()
def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract_text(pages, keep=["page_id", "url"])
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query(
    """
WITH u AS (
  SELECT page_id, strpos(url, '://') AS place, url FROM pages
),
r AS (
  SELECT page_id, translate(regexp_extract(substr(url, place + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(url, place + 3), '^[^/?#]*([^?#]*)', 1) AS path
  FROM u WHERE place > 0
  UNION ALL SELECT page_id, '', '' FROM u WHERE coalesce(place, 0) = 0
),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM r
),
v AS (
  SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS by_rule FROM ruled
),
p AS (
  SELECT host, path, count(*) AS n, count(by_rule) AS labelled, count(*) FILTER (by_rule = 'block') AS bad,
         list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
           lambda s: CASE WHEN regexp_matches(s, '^[0-9]|[0-9].*[0-9].*[0-9]|^.{24,}$') THEN '*' ELSE s END) AS shapes
  FROM v GROUP BY host, path
),
lv AS (
  SELECT host, path, n, k, shapes[k] AS shape, array_to_string(shapes[1:k - 1], '/') AS above
  FROM (SELECT host, path, n, shapes, unnest(range(1, len(shapes) + 1)) AS k FROM p)
),
sg AS (SELECT host, k, above, shape, sum(n) AS own FROM lv GROUP BY ALL),
nm AS (
  SELECT *, CASE WHEN count(*) OVER node <= 20 OR own * 50 >= sum(own) OVER node THEN shape ELSE '*' END AS segment
  FROM sg WINDOW node AS (PARTITION BY host, k, above)
),
t AS (
  SELECT host, path, '/' || string_agg(segment, '/' ORDER BY k) AS template
  FROM lv JOIN nm USING (host, k, above, shape) GROUP BY host, path
  UNION ALL SELECT host, path, '/' FROM p WHERE len(shapes) = 0
),
c AS (
  SELECT host, template, regexp_replace(template, '^/[^/]+', '/*') AS family, sum(labelled) AS labelled, sum(bad) AS bad
  FROM p JOIN t USING (host, path) GROUP BY host, template
),
f AS (
  SELECT *, sum(labelled) OVER fam AS al, sum(bad) OVER fam AS ab, (SELECT sum(bad) / greatest(sum(labelled), 1) FROM c) AS prior
  FROM c WINDOW fam AS (PARTITION BY host, family)
),
g AS (
  SELECT *, labelled >= 5 AND abs(bad / labelled - ab / al) <= 1.96 * sqrt(ab / al * (1 - ab / al) / labelled) AS alike FROM f
),
m AS (
  SELECT host, template, labelled > 0 AND (
    (CASE WHEN alike THEN sum(bad) FILTER (alike) OVER fam ELSE bad END + 4 * prior)
    / (CASE WHEN alike THEN sum(labelled) FILTER (alike) OVER fam ELSE labelled END + 4)) >= 0.9 AS rejected
  FROM g WINDOW fam AS (PARTITION BY host, family)
)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict, template
FROM v JOIN t USING (host, path) JOIN m USING (host, template)
"""
)
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url judged by the rules, or else by what the tree learns from urls with a rule."""
    return url_verdicts(table(spark, sf_dir, "pages"), RULES)


@query(
    """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\r\\v\\f]+'), lambda x: x <> '') AS w FROM documents
),
wins AS (
  SELECT doc_id, s, array_to_string(w[s:s + 34], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM w WHERE len(w) >= 35)
),
rep AS (SELECT doc_id, s FROM wins WHERE win IN (SELECT win FROM wins GROUP BY win HAVING count(*) > 1)),
cov AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM rep),
tok AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM tok ANTI JOIN cov USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
)
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in passages found elsewhere too."""
    found = remove_repeated_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query(
    """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
),
d AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, 10 * (i // 8) + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31) + 1, 1)), '') AS payload_digest
  FROM p
),
l AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM l
"""
)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to archives, read them back and assemble the captures."""
    path = new_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    records = materialize(read_archives(spark, path, payloads=False), "records")  # read once, joined three times
    captures = materialize(assemble(records), "captures")
    return resolve_revisits(captures)


@query()
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of every document, and whether it stays."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    counted, judge, threshold = fit_quality(docs, labels)
    return judge_counts(counted, judge, threshold, ["doc_id", *COUNTS]).drop("anomaly")


@query()
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_personal_data(docs, DIGEST, keep=["doc_id"])


def load_llm_queries():
    """All queries of this subpackage and the SQL for those that SQL can check."""
    return dict(QUERIES), dict(ORACLES)
