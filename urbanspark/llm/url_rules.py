"""Verdicts on urls from rules on host suffixes and path prefixes.

A rule is ``host/path``: it fits its host and all subdomains if the url's path starts with the
rule's path. The longest rule wins; of equally long ones the longer host, then ``block``.

Method. Each url is expanded into host-suffix and path-prefix expressions, but only of the shapes
(number of host labels, length of path) that some rule has, so a url with thousands of labels
costs no more than another one. Expressions and rules meet in an equi-join on 32 bits of the
digest; the full digest confirms a match, then the precedence picks one rule.

Defined results: a null url or one without ``://`` has an empty host and path and no rule, which
gives the default verdict. Repeated rows are judged one by one. An empty table gives no rows; an
empty rule list gives every page the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanspark.operators.tables import broadcast_within

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_DIGITS = 8


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def url_host(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def rule_table(rules: DataFrame) -> DataFrame:
    """rule, verdict and derived columns of ``rules`` (verdict, rule); rules without a slash end at the host."""
    host = F.substring_index("rule", "/", 1)
    path = F.substring(F.col("rule"), F.length(host) + 1, F.length("rule"))
    digest = F.sha2("rule", 256)
    return rules.filter("rule IS NOT NULL").select(
        "rule",
        "verdict",
        _labels(host).alias("labels"),
        F.length(path).alias("path_length"),
        digest.alias("digest"),
        F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"),
        F.struct(F.length("rule"), F.length(host), F.col("verdict") == "block").alias("order"),
    )


def _expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """All expressions of a url that have the shape of a rule."""
    labels = F.split(host, r"\.")
    found = []
    for count, length in shapes:
        suffix = F.array_join(F.slice(labels, F.greatest(F.size(labels) - (count - 1), F.lit(1)), count), ".")
        fits = (F.size(labels) >= count) & (F.length(path) >= length)
        found.append(F.when(fits, F.concat(suffix, F.substring(path, 1, length))))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url).

    ``rules`` (verdict, rule) is broadcast if its counted size allows it and joined by shuffle otherwise.
    The shapes of rules are looked up first; there are as many as pairs of label counts and path lengths.
    """
    table = rule_table(rules)
    shapes = sorted((r[0], r[1]) for r in table.select("labels", "path_length").distinct().collect())
    n_rules = table.count()
    split = pages.select(
        F.monotonically_increasing_id().alias("row"), "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    asked = split.select("*", F.explode_outer(_expressions(F.col("host"), F.col("path"), shapes)).alias("expression"))
    digest = F.sha2("expression", 256)
    asked = asked.withColumns({"asked_digest": digest, "prefix": F.substring(digest, 1, PREFIX_DIGITS)})
    hits = asked.join(broadcast_within(table.drop("labels", "path_length"), n_rules), "prefix", "left")
    confirmed = F.when(F.col("asked_digest") == F.col("digest"), F.struct("order", "rule", "verdict"))
    best = hits.groupBy("row", "page_id", "host", "path").agg(F.max(confirmed).alias("best"))
    return best.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
