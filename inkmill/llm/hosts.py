"""URL filters: host rules, and empirical-Bayes reputation of hosts where no rule fits.

Labelled outcomes of pages are counted by host, by registered domain and by suffix. The counts of a level shrink towards the
mean of the level above through a beta prior: all pages, then the suffix, then the registered domain, then the host. A host
is blocked if even the upper bound of its posterior share of good pages stays below a threshold, so a host with few labels
keeps its domain's reputation and one without any keeps the suffix's.

Defined results: a null url, or one without `://`, has an empty host and path, fits no rule and is judged by the prior of all
pages; repeated rows are judged alike, one row each; null ids stay null and take no label; empty tables give empty results,
and without labels everything that no rule blocks is allowed. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import table

#: (verdict, host, path): fits the host and its subdomains where the path starts with the rule's; the longest wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case, and path, by the first `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substr({0}, instr({0}, '://') + 3)".format("url")))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def matched(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct of rule text and verdict, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in reversed(ordered):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def domain(host: Column, double: Sequence[str] = ("co.uk", "com.au", "co.jp")) -> Column:
    """Registered domain: one label more than the suffix, which is the last label or one of the listed pairs."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*double), F.substring_index(host, ".", -3)).otherwise(two)


def suffix(registered: Column) -> Column:
    """What follows the first label of a registered domain."""
    return F.when(F.instr(registered, ".") > 0, F.regexp_extract(registered, r"\.(.*)$", 1)).otherwise(registered)


def posteriors(outcomes: DataFrame, strength: float = 20.0, z: float = 2.0) -> DataFrame:
    """host, domain, suffix, n, good, mean and upper (posterior bound) of each host.

    `outcomes` has host and good (0 or 1, null where not labelled). Hosts are counted once, combined before the shuffle;
    the upper levels are sums of the hosts' counts. `strength` is the weight of a prior in pages.
    """
    hosts = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    hosts = hosts.withColumn("domain", domain(F.col("host"))).withColumn("suffix", suffix(F.col("domain")))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("good").alias("dg"))
    suffixes = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dg").alias("sg"))
    all_pages = suffixes.agg(F.sum("sn").alias("an"), F.sum("sg").alias("ag"))
    joined = hosts.join(domains, ["domain", "suffix"]).join(suffixes, "suffix").join(F.broadcast(all_pages))  # one row
    joined = joined.withColumn("base", (F.col("ag") + 1) / (F.col("an") + 1))
    for good, n, prior, out in (("sg", "sn", "base", "s"), ("dg", "dn", "s", "d"), ("good", "n", "d", "mean")):
        joined = joined.withColumn(out, (F.col(good) + strength * F.col(prior)) / (F.col(n) + strength))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + strength + 1))
    return joined.select("host", "domain", "suffix", "n", "good", "mean", (F.col("mean") + z * spread).alias("upper"))


def judged(
    pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, least: float = 0.5,
    strength: float = 20.0, z: float = 2.0,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's posterior mean and upper bound.

    `labels` has doc_id, the page's id, and quality; a page labelled more than once counts as good if its best label is.
    """
    host, path = parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(F.col("quality").cast("int")).alias("good"))
    scores = posteriors(split.join(known, "page_id", "left"), strength, z).select("host", "mean", "upper")
    rule = matched(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("upper") < least, "block").otherwise("allow")
    return (
        split.join(scores, "host", "left")
        .withColumn("match", rule)
        .select("page_id", "host", "path", F.col("match.rule").alias("rule"),
                F.coalesce("match.verdict", by_method).alias("verdict"), "mean", "upper")
    )


def query(spark, folder):
    found = judged(table(spark, folder, "pages"), table(spark, folder, "labels"))
    return found.select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), p AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM u
), o AS (
  SELECT p.*, l.good FROM p LEFT JOIN (SELECT doc_id, max(quality) AS good FROM labels GROUP BY 1) l ON l.doc_id = p.page_id
), h AS (
  SELECT host, count(good) AS n, coalesce(sum(good), 0) AS g, string_split(host, '.') AS a FROM o GROUP BY host
), i AS (
  SELECT *, array_to_string(a[-(CASE WHEN array_to_string(a[-2:], '.') IN ('co.uk', 'com.au', 'co.jp') THEN 3 ELSE 2 END):], '.') AS domain FROM h
), j AS (
  SELECT *, CASE WHEN instr(domain, '.') > 0 THEN substr(domain, instr(domain, '.') + 1) ELSE domain END AS suffix FROM i
), k AS (
  SELECT *, sum(n) OVER () AS an, sum(g) OVER () AS ag, sum(n) OVER (PARTITION BY suffix) AS sn, sum(g) OVER (PARTITION BY suffix) AS sg,
         sum(n) OVER (PARTITION BY domain, suffix) AS dn, sum(g) OVER (PARTITION BY domain, suffix) AS dg
  FROM j
), m AS (SELECT host, n, g, dn, dg, (sg + 20.0::DOUBLE * ((ag + 1)::DOUBLE / (an + 1))) / (sn + 20.0::DOUBLE) AS s FROM k
), q AS (SELECT host, n, (g + 20.0::DOUBLE * ((dg + 20.0::DOUBLE * s) / (dn + 20.0::DOUBLE))) / (n + 20.0::DOUBLE) AS mean FROM m)
SELECT page_id, p.host, path, r.rule,
       coalesce(r.verdict, CASE WHEN mean + 2.0::DOUBLE * sqrt(mean * (1 - mean) / (n + 21.0::DOUBLE)) < 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN q USING (host)
LEFT JOIN LATERAL (
  SELECT rule, verdict FROM (VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
    ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')) v(rh, rp, rule, verdict)
  WHERE (p.host = rh OR suffix(p.host, '.' || rh)) AND starts_with(p.path, rp) ORDER BY length(rule) DESC LIMIT 1
) r ON true
"""
