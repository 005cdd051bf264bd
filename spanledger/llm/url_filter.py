"""URL filter: rules found by their rarest literal token, regular expressions run on what the tokens fetch.

A rule has a regular expression over host + path and the literal tokens that any match must contain. How often each
of these tokens occurs is counted over all URLs, and the rule is filed under its rarest one. A URL's own tokens fetch the
rules filed under them, and only those run. Rules without a token are filed under the empty token, which every URL has.

Host rules (allow or block a host, its subdomains and a path prefix) are such rules; the longest that fits decides.
Where none fits, a URL without a host or with a matching pattern rule is blocked, any other allowed.

URLs are judged once each: equal URLs meet in a distinct, and the verdicts are joined back, where adaptive execution splits
a hot URL. Null URLs and those without "://" have an empty host and path. A very long URL is judged whole, an empty
table gives an empty result, and columns beside page_id and url are not read. An empty rule list leaves the method's verdict.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_RULES = 20_000


class HostRule(NamedTuple):
    action: str
    rule: str  # host and path, as in example.com/en/


class Pattern(NamedTuple):
    """A pattern that blocks; tokens: literal tokens (lower case, letters and digits) that every match has in it, whole."""

    pattern: str
    tokens: tuple[str, ...]


HOST_RULES = (
    HostRule("allow", "com/"), HostRule("block", "example.com/en/"), HostRule("allow", "www.example.com/en/"),
    HostRule("block", "net/es/"), HostRule("block", "net/fr/"),
)
PATTERNS = (
    Pattern(r"^(?:[^/]*[.])?spam-farm[.]", ("spam", "farm")),
    Pattern(r"^(?:[^/]*[.])?(?:ads|adserver)[.]", ()),
    Pattern(r"/wp-login[.]php$", ("wp", "login", "php")),
    Pattern(r"/cgi-bin/", ("cgi", "bin")),
)


def _host_rule(rule: HostRule) -> tuple[str, list[str]]:
    host, _, path = rule.rule.partition("/")
    path = "/" + path
    whole = re.findall(r"[a-z0-9]+(?=[^a-z0-9])", path.lower())  # the last part of a prefix may go on in the URL
    return rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", re.findall("[a-z0-9]+", host) + whole


def rule_table(spark: SparkSession, rules: Sequence[HostRule], patterns: Sequence[Pattern]) -> DataFrame:
    """rule (null for patterns), verdict, pattern, tokens."""
    rows = [(r.rule, r.action, *_host_rule(r)) for r in rules] + [(None, "block", p.pattern, list(p.tokens)) for p in patterns]
    made = [
        F.struct(
            F.lit(rule).cast("string").alias("rule"), F.lit(verdict).alias("rule_verdict"), F.lit(pattern).alias("pattern"),
            (F.array(*map(F.lit, tokens)) if tokens else F.array().cast("array<string>")).alias("tokens"),
        )
        for rule, verdict, pattern, tokens in rows
    ]
    empty = "array<struct<rule:string,rule_verdict:string,pattern:string,tokens:array<string>>>"
    return spark.range(1).select(F.inline(F.array(*made) if made else F.array().cast(empty)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens, and the empty one."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.lower(F.concat(host, path)), "[^a-z0-9]+")))


def file_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The rules, each with its token that is rarest in the URLs' column tokens; ties go to the first by name."""
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    counts = urls.select(F.explode("tokens").alias("token")).join(F.broadcast(wanted), "token", "left_semi")
    counts = counts.groupBy("token").count()
    each = rules.select("*", F.explode_outer("tokens").alias("token")).join(counts, "token", "left")
    rarest = F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), "token"))
    return each.groupBy("rule", "rule_verdict", "pattern").agg(F.coalesce(rarest, F.lit("")).alias("token"))


def judge(pages: DataFrame, rules: Sequence[HostRule] = HOST_RULES, patterns: Sequence[Pattern] = PATTERNS) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    urls = pages.select("url").distinct().select("url", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("tokens", url_tokens(F.col("host"), F.col("path")))
    table = rule_table(spark, rules, patterns)
    index = file_rules(urls, table)
    if len(rules) + len(patterns) <= BROADCAST_RULES:
        index = F.broadcast(index)
    fetched = urls.select("url", "host", "path", F.explode("tokens").alias("token")).join(index, "token")
    fits = fetched.filter(F.regexp_like(F.concat("host", "path"), F.col("pattern")))
    best = F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule"), "rule", "rule_verdict")))
    found = fits.groupBy("url").agg(best.alias("best"), F.bool_or(F.col("rule").isNull()).alias("matched"))
    verdict = (
        F.when(F.col("best").isNotNull(), F.col("best.rule_verdict"))
        .when((F.col("host") == "") | F.coalesce("matched", F.lit(False)), "block")
        .otherwise("allow")
    )
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    return rows.join(found, "url", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict")
    )
