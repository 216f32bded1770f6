"""URL filters: host-suffix and path-prefix expressions joined on short hash prefixes with a rule list.

DataFrame functions only. A rule is (host, path, verdict); it fits a URL whose host is the rule's or a subdomain
of it and whose path starts with the rule's path. The longest fitting rule (host and path together) decides; of equally long
ones the one with the longer host, then ``block`` before ``allow``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.sizing import small_side
from driftline.llm.registry import query, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_HEX = 8          # 32 bits of the SHA-256 digest are joined on, as in public browsing lists

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def host_of(url):
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url):
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def expressions(urls: DataFrame, labels: list[int], lengths: list[int]) -> DataFrame:
    """(url, host_part, path_part) for the host suffixes of so many labels and path prefixes of so many characters.

    ``labels`` and ``lengths`` are those that occur in the rules, so a URL of any length gives few expressions.
    """
    parts = F.split("host", r"\.", -1)
    hosts = F.array_compact(F.array(*[
        F.when(F.size(parts) >= n, F.array_join(F.slice(parts, F.greatest(F.size(parts) - n + 1, F.lit(1)), n), "."))
        for n in labels]))
    paths = F.array_compact(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]))
    return urls.withColumn("host_part", F.explode(hosts)).withColumn("path_part", F.explode(paths))


def digest(host, path):
    """SHA-256 of an expression. A line feed parts host and path, so that no two rules share a text."""
    return F.sha2(F.concat_ws("\n", host, path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the deciding rule) and ``verdict``.

    Same-named columns of ``pages`` are replaced. Null urls and urls without ``://`` have empty host and path, fit no
    rule with a path and get ``default``; so does every page if there are no rules. Repeated pages stay repeated. Rules
    without host, path or verdict are left out. URLs are judged once each, so that a page crawled a million times costs one.
    """
    pages = pages.drop("host", "path", "rule", "verdict").withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rules = rules.select("host", "path", "verdict").dropna().distinct().select(
        F.concat("host", "path").alias("rule"), "verdict", digest(F.col("host"), F.col("path")).alias("digest"),
        F.length("host").alias("host_len"), F.size(F.split("host", r"\.", -1)).alias("labels"), F.length("path").alias("path_len"))
    # At most as many values as labels in a host name and characters in a path.
    shape = rules.agg(F.sort_array(F.collect_set("labels")).alias("labels"), F.sort_array(F.collect_set("path_len")).alias("lengths")).first()
    if not shape["labels"]:
        return pages.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    rules = small_side(rules.select("rule", "verdict", "digest", "host_len", F.substring("digest", 1, PREFIX_HEX).alias("prefix")))

    urls = pages.select("url", "host", "path").where("url IS NOT NULL").distinct()
    asked = expressions(urls, shape["labels"], shape["lengths"]).select(
        "url", digest(F.col("host_part"), F.col("path_part")).alias("asked"))
    hits = asked.withColumn("prefix", F.substring("asked", 1, PREFIX_HEX)).join(rules, "prefix").where("asked = digest")
    best = hits.groupBy("url").agg(F.max(F.struct(F.length("rule").alias("n"), "host_len", F.col("verdict") == "block", "rule", "verdict")).alias("best"))
    return pages.join(best, "url", "left").select(
        *pages.columns, F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)


@query(rf"""WITH rules(rhost, rpath, rverdict) AS (VALUES {VALUES}),
p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
SELECT page_id, host, path, r.rule, coalesce(r.rverdict, 'allow') AS verdict
FROM p LEFT JOIN LATERAL (
  SELECT rhost || rpath AS rule, rverdict FROM rules
  WHERE (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath)
  ORDER BY length(rhost || rpath) DESC LIMIT 1) r ON true""")
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")
