"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes, confirmed by full digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.text import apart
from earshot.operators.joins import join_unique

# The rules of the registered query, (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
PREFIX_HEX = 8
BROADCAST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(_after(url, r"(?s)^.*?://([^/?#]*)"), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return _after(url, r"(?s)^.*?://[^/?#]*([^?#]*)")


def _after(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def judge(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", broadcast_rules: int = BROADCAST_RULES
) -> DataFrame:
    """The rows of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced.

    ``rules`` has (host, path, verdict). A rule fits its host and all subdomains if the path starts with the
    rule's path. Of the rules that fit, the longest (host and path together) wins; of equally long ones a block
    before an allow, then the greater by text. Without a fitting rule ``rule`` is null and the verdict is
    ``default``. A null url, or one without ``://``, has empty host and path, which only a rule with an empty host
    and path fits. An empty host label list, repeated pages and empty tables need no special case. Rules with a
    null in any column are left out.

    Every distinct (host, path) is expanded once: host suffixes by the number of labels the rules use, times path
    prefixes of the lengths the rules use with that many labels, so any prefix is found, not just whole folders.
    Sites of very many pages, as that of null urls may be, are joined in parts.
    """
    rules = rules.dropna(subset=["host", "path", "verdict"])
    ruled = rules.select(
        F.concat("host", "path").alias("_rule"), F.length(F.concat("host", "path")).alias("_long"),
        F.col("verdict").alias("_verdict"), _digest(F.concat_ws("\n", "host", "path")).alias("_digest"),
        F.size(F.split("host", r"\.")).alias("_labels"), F.length("path").alias("_chars"),
    )
    # shapes are bounded by the lengths of host names and urls, not by the number of rules
    shapes = ruled.groupBy("_labels").agg(F.sort_array(F.collect_set("_chars")).alias("_chars")).collect()
    inside, back = apart(pages.drop("host", "path", "rule", "verdict"), url)
    rows = inside.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    labels = F.split("host", r"\.")
    made = []
    for shape in shapes:
        suffix = F.array_join(F.slice(labels, -shape["_labels"], shape["_labels"]), ".")
        for chars in shape["_chars"]:
            wanted = (F.size(labels) >= shape["_labels"]) & (F.length("path") >= chars)
            made.append(F.when(wanted, F.concat_ws("\n", suffix, F.substring("path", 1, chars))))
    expressions = F.array(*made) if made else F.array().cast("array<string>")
    sites = rows.select("host", "path").distinct()
    expanded = sites.select("host", "path", F.explode(expressions).alias("_expression")).filter(
        F.col("_expression").isNotNull()
    ).withColumn("_full", _digest(F.col("_expression"))).withColumn("_short", F.substring("_full", 1, PREFIX_HEX)).drop("_expression")
    by_prefix = ruled.groupBy(F.substring("_digest", 1, PREFIX_HEX).alias("_short")).agg(
        F.collect_set(F.struct("_digest", "_long", "_verdict", "_rule")).alias("_rules")
    )
    if rules.count() <= broadcast_rules:
        hits = expanded.join(F.broadcast(by_prefix), "_short")
    else:
        hits = join_unique(expanded, by_prefix, "_short")
    confirmed = hits.select("host", "path", "_full", F.explode("_rules").alias("_r")).filter(
        F.col("_r._digest") == F.col("_full")
    )
    best = confirmed.groupBy("host", "path").agg(
        F.max(F.struct("_r._long", F.col("_r._verdict") == "block", "_r._rule", "_r._verdict")).alias("_best")
    )
    # a host has no slash and a path begins with one, so together they still tell sites apart
    site = F.concat("host", "path")
    found = join_unique(rows.withColumn("_site", site), best.select(site.alias("_site"), "_best"), "_site", "left")
    return back(
        found, "host", "path", F.col("_best._rule").alias("rule"), F.coalesce("_best._verdict", F.lit(default)).alias("verdict")
    )


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's host, path, winning rule and verdict."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


SQL = """
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{upper}', '{lower}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(rule_host, rule_path, verdict) AS (VALUES {rules}),
f AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, verdict FROM p JOIN r
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
w AS (SELECT page_id, host, path, max((length(rule), verdict = 'block', rule)) AS best FROM f GROUP BY ALL)
SELECT p.page_id, p.host, p.path, w.best[3] AS rule, coalesce(r.verdict, 'allow') AS verdict
FROM p LEFT JOIN w USING (page_id, host, path) LEFT JOIN r ON w.best[3] = r.rule_host || r.rule_path
""".format(
    upper=UPPER, lower=LOWER, rules=", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
)
