"""URL filters: rules for hosts and paths, and a path-template tree for the rest.

Every host's paths form a tree. Segments that look generated, and rare segments below a
node with many children, become wildcards, so that each path falls into a template.
Templates that differ in their first segment only are siblings; those whose labelled share
of bad urls does not differ significantly from their family's are merged. A template is
rejected when its smoothed share of bad urls among the labelled ones is high enough.
Only built-in functions are used; paths are counted before anything is joined.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweft.scratch import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VARIABLE = "^[0-9]|[0-9].*[0-9].*[0-9]|^.{24,}$"  # segments that look generated
MANY = 20  # children of a node from which on rare segments become wildcards
RARE = 50  # a segment is rare when it has less than 1/RARE of its node's rows
FEWEST = 5  # labelled rows a template needs for a comparison with its family
Z = 1.96  # a difference beyond this many standard errors keeps a template apart
PRIOR_ROWS = 4  # weight of the overall share in a template's share
REJECT = 0.9


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    at = F.instr(url, "://")
    rest = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*", 0)
    return F.coalesce(F.when(at > 0, F.translate(rest, UPPER, LOWER)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.when(at > 0, rest), F.lit(""))


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits a host or its parents and the start of the path; else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def path_templates(paths: DataFrame) -> DataFrame:
    """``(host, path, template)`` for distinct paths ``(host, path, n, …)``."""
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    shapes = F.transform(parts, lambda s: F.when(s.rlike(VARIABLE), "*").otherwise(s))
    rows = paths.select("host", "path", "n", shapes.alias("shapes"))
    levels = rows.select("host", "path", "n", "shapes", F.posexplode("shapes").alias("k", "shape"))
    levels = levels.withColumn("above", F.array_join(F.slice("shapes", 1, F.col("k")), "/")).drop("shapes")
    segments = levels.groupBy("host", "k", "above", "shape").agg(F.sum("n").alias("own"))
    nodes = segments.groupBy("host", "k", "above").agg(F.sum("own").alias("total"), F.count(F.lit(1)).alias("kinds"))
    named = segments.join(nodes, ["host", "k", "above"])
    keeps = (F.col("kinds") <= MANY) | (F.col("own") * RARE >= F.col("total"))
    named = named.select("host", "k", "above", "shape", F.when(keeps, F.col("shape")).otherwise("*").alias("segment"))
    joined = levels.join(named, ["host", "k", "above", "shape"])
    ordered = F.array_sort(F.collect_list(F.struct("k", "segment")))
    built = joined.groupBy("host", "path").agg(F.concat(F.lit("/"), F.array_join(ordered["segment"], "/")).alias("template"))
    whole = rows.filter(F.size("shapes") == 0).select("host", "path", F.lit("/").alias("template"))
    return built.unionByName(whole)


def rejected_templates(paths: DataFrame, templates: DataFrame, reject: float = REJECT) -> DataFrame:
    """``(host, template)`` of templates to reject, for paths with ``labelled`` and ``bad`` counts."""
    counted = paths.join(templates, ["host", "path"]).groupBy("host", "template")
    counted = counted.agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    overall = counted.agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).first()
    prior = overall["bad"] / overall["labelled"] if overall["labelled"] else 0.0
    counted = counted.withColumn("family", F.regexp_replace("template", "^/[^/]+", "/*"))
    family = counted.groupBy("host", "family").agg(F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"))
    compared = counted.join(family, ["host", "family"])
    own, every = F.try_divide(F.col("bad"), F.col("labelled")), F.try_divide(F.col("all_bad"), F.col("all_labelled"))
    error = F.sqrt(F.try_divide(every * (1 - every), F.col("labelled")))
    alike = (F.col("labelled") >= FEWEST) & (F.abs(own - every) <= Z * error)
    compared = compared.withColumn("alike", F.coalesce(alike, F.lit(False)))
    merged = compared.filter("alike").groupBy("host", "family")
    merged = merged.agg(F.sum("labelled").alias("m_labelled"), F.sum("bad").alias("m_bad")).withColumn("alike", F.lit(True))
    judged = compared.join(merged, ["host", "family", "alike"], "left")
    labelled, bad = F.coalesce("m_labelled", "labelled"), F.coalesce("m_bad", "bad")
    purity = (bad + F.lit(PRIOR_ROWS * prior)) / (labelled + F.lit(PRIOR_ROWS))
    return judged.filter((labelled > 0) & (purity >= reject)).select("host", "template")


def url_verdicts(
    pages: DataFrame,
    rules: dict[str, str],
    id: str = "page_id",
    url: str = "url",
    bad: str | None = None,
    reject: float = REJECT,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template)`` for every row.

    ``rules`` maps ``host/path`` to ``allow`` or ``block``. Labels for the tree are the column
    ``bad`` (true, false or null) and, where it is null or not given, the rules' verdicts. A
    url without a rule is blocked if its template is rejected, else allowed. Null urls and
    urls without ``://`` have an empty host and path. Equal urls get equal verdicts, repeated
    rows stay repeated, ids may be null, other columns are not read.
    """
    label = F.col(bad).cast("boolean") if bad else F.lit(None).cast("boolean")
    rows = pages.select(F.col(id).alias("page_id"), F.col(url).alias("url"), label.alias("bad"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "bad")
    rows = rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    rows = rows.withColumn("by_rule", by_rule)
    known = F.coalesce("bad", F.col("by_rule") == "block")
    paths = rows.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count(known).alias("labelled"), F.count_if(known).alias("bad")
    )
    paths = materialize(paths, "paths")
    templates = materialize(path_templates(paths), "templates")
    rejected = rejected_templates(paths, templates, reject).withColumn("rejected", F.lit(True))
    judged = materialize(templates.join(rejected, ["host", "template"], "left"), "judged")
    joined = rows.join(judged, ["host", "path"], "left")
    verdict = F.coalesce("by_rule", F.when(F.col("rejected"), "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template")
