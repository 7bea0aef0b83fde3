"""URL rules found through their rarest literal token.

A rule is a regular expression over host + path together with the literal tokens that every
match contains. Tokens are longest runs of a-z, 0-9 in the lower-cased host and path. Their
counts over all urls say which token of a rule is rarest; the rule is indexed under that one,
a url fetches the rules of its tokens, and only these run their expression. The longest
fitting rule wins (ties: the last in string order). A url without a fitting rule gets
`otherwise`.

A null url or one without `://` has empty host and path and no rule. Repeated and equal urls
get equal verdicts; pages are never dropped. Further columns are ignored; an empty rule list
or table is fine. Rules are data in a table, not a closure, so a long list is joined like any
other table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RULE = "rule string, verdict string, pattern string, tokens array<string>, named boolean"
# Fixed values of the contract: host and path of a rule, and its verdict.
HOST_RULES = [
    ("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"),
]
# The method's own patterns, for urls that no named rule fits.
PATTERNS = [(r"^(?:[^/]*\.)?spam-farm\.[^/]*(?:/|$)", ["spam", "farm"], "block")]
TOKEN = "[a-z0-9]+"


def host_rules(rules: list[tuple[str, str]]) -> list[tuple]:
    """Rules such as `example.net/en/`: the host and its subdomains, and a path prefix."""
    out = []
    for rule, verdict in rules:
        host, slash, path = rule.partition("/")
        # The last token of the path may be the start of a longer one in the url.
        inner = re.findall(TOKEN, path.lower()) if rule.endswith("/") else re.findall(TOKEN, path.lower())[:-1]
        tokens = sorted({*re.findall(TOKEN, host.lower()), *inner})
        out.append((rule, verdict, rf"^(?:[^/]*\.)?{re.escape(host.lower())}{re.escape(slash + path)}", tokens, True))
    return out


def pattern_rules(patterns: list[tuple[str, list[str], str]]) -> list[tuple]:
    return [(f"pattern:{p}", verdict, p, tokens, False) for p, tokens, verdict in patterns]


def split_url(url: str):
    """Columns host (A-Z in lower case) and path of a url column."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)"))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"(?s)^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path")


def index_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(token, rule, verdict, pattern, named): each rule under its rarest token among `urls`
    (token, ...). A token that no url has is the rarest of all: its rule can't fit."""
    own = rules.select("rule", F.explode("tokens").alias("token"))
    counts = (
        urls.join(own.select("token").distinct(), "token", "left_semi")
        .groupBy("token").agg(F.count("*").alias("n"))
    )
    rarest = (
        own.join(counts, "token", "left")
        .groupBy("rule")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("least"))
        .where("least.n > 0")
        .select("rule", F.col("least.token").alias("token"))
    )
    return rules.join(rarest, "rule").select("token", "rule", "verdict", "pattern", "named")


def judge(
    pages: DataFrame, rules: list[tuple] | None = None, otherwise: str = "allow"
) -> DataFrame:
    """page_id, host, path, rule (the named one that won, else null), verdict."""
    spark: SparkSession = pages.sparkSession
    listed = host_rules(HOST_RULES) + pattern_rules(PATTERNS) if rules is None else rules
    table = spark.createDataFrame(listed, RULE)
    parts = pages.select("page_id", *split_url("url"))
    # Equal urls are judged once; a url that a third of the pages share is one row here.
    urls = parts.where("host != ''").select("host", "path").distinct()
    tokens = urls.select(
        "host", "path",
        F.explode(
            F.array_distinct(F.regexp_extract_all(F.lower(F.concat("host", "path")), F.lit(f"({TOKEN})"), 1))
        ).alias("token"),
    )
    index = index_rules(tokens, table)
    fits = (
        tokens.join(index, "token")
        .where(F.expr("regexp_like(concat(host, path), pattern)"))
        .groupBy("host", "path")
        .agg(
            F.max(F.struct("named", F.length("rule").alias("n"), "rule", "verdict")).alias("best")
        )
    )
    return parts.join(fits, ["host", "path"], "left").select(
        "page_id", "host", "path",
        F.when(F.col("best.named"), F.col("best.rule")).alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
    )
