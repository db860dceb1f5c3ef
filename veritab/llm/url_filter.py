"""Operator 2: URL allow and block rules, found through their rarest literal token.

A rule is a host and a path prefix; it fits the host and all its subdomains where the path starts
with the rule's. Each rule is turned into one regular expression and indexed under the complete
literal token (host label or path part) that the fewest distinct URLs contain. The tokens of a URL
fetch the rules indexed under them, and only those run their expression. The longest fitting rule
decides (ties: the smaller rule string, then ``allow`` before ``block``); without one the
verdict is ``default``.

DataFrame functions only. Each distinct URL is judged once, so repeated URLs cost one row; the
join back is split by adaptive execution when one URL holds many pages. Null URLs and URLs without
``://`` have an empty host and path and fit no rule. An empty rule table or page table gives the
default or no rows. Only the columns named here are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

#: Rules of the registered query: host, path, verdict (fixed values).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: Verdict without a fitting rule, and the number of rules up to which the index is broadcast.
DEFAULT, BROADCAST_RULES = "allow", 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds host (A-Z lower-cased) and path of ``url``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    raw = F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*", 0)
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.translate(raw, _UPPER, _LOWER), "path": path})


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _compiled(rules: DataFrame) -> DataFrame:
    """rule, verdict, expression over host || path, complete literal tokens.

    The last part of a path prefix is a complete token only before a final slash. The empty token,
    which every URL has, stands for rules without any other."""
    quoted = lambda c: F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    host, path = F.coalesce("host", F.lit("")), F.coalesce("path", F.lit(""))
    parts = F.split(path, "/")
    whole = F.when(F.size(parts) > 1, F.slice(parts, 1, F.size(parts) - 1)).otherwise(F.array().cast("array<string>"))
    tokens = F.concat(F.transform(F.split(host, "[.]"), lambda t: F.concat(F.lit("h:"), t)),
                      F.transform(whole, lambda t: F.concat(F.lit("p:"), t)))
    tokens = F.filter(tokens, lambda t: ~t.isin("h:", "p:"))
    return (rules.select(
        F.concat(host, path).alias("rule"), F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict"),
        F.concat(F.lit("^(?:[^/]*[.])?"), quoted(host), F.lit("(?=/|\\z)"), quoted(path)).alias("expression"),
        F.when(F.size(tokens) > 0, F.array_distinct(tokens)).otherwise(F.array(F.lit(""))).alias("tokens"))
        .dropDuplicates(["rule", "verdict"]))


def _url_tokens(urls: DataFrame) -> DataFrame:
    tokens = F.concat(F.transform(F.split("host", "[.]"), lambda t: F.concat(F.lit("h:"), t)),
                      F.transform(F.split("path", "/"), lambda t: F.concat(F.lit("p:"), t)),
                      F.array(F.lit("")))
    return urls.select("url", F.concat("host", "path").alias("target"),
                       F.explode(F.array_distinct(tokens)).alias("token"))


def rule_index(tokens: DataFrame, rules: DataFrame) -> DataFrame:
    """token, rule, verdict, expression: every rule under its rarest token."""
    literal = rules.select("rule", "verdict", "expression", F.explode("tokens").alias("token"))
    held = (tokens.join(literal.select("token").distinct(), "token", "left_semi")
            .groupBy("token").agg(F.count("*").alias("urls")))
    return (literal.join(held, "token", "left")
            .groupBy("rule", "verdict", "expression")
            .agg(F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)), "token")).alias("token")))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule (or null) and verdict of every row of ``pages`` (page_id, url)."""
    pages = with_parts(pages.select("page_id", "url"))
    compiled = _compiled(rules)
    tokens = _url_tokens(pages.where("host <> ''").select("url", "host", "path").distinct())
    index = rule_index(tokens, compiled)
    if compiled.count() <= BROADCAST_RULES:
        index = F.broadcast(index)
    fits = tokens.join(index, "token").where(F.expr("target rlike expression"))
    best = (fits.groupBy("url")
            .agg(F.min_by(F.struct("rule", "verdict"), F.struct(-F.length("rule"), "rule", "verdict")).alias("best")))
    return (pages.join(best, "url", "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


OP2_SQL = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(rh, rp, rv) AS (VALUES {', '.join(repr(r) for r in RULES)}),
fits AS (
  SELECT page_id, host, path, rh || rp AS rule, rv FROM parts, rules
  WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(rv, length(rule)) AS rv FROM fits GROUP BY 1)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.rv, '{DEFAULT}') AS verdict
FROM parts p LEFT JOIN best b USING (page_id)
"""
