"""URL filters: pattern rules indexed by their rarest literal token.

A rule names a host, which stands for its subdomains too, and the beginning of a path,
or a bare pattern. It is turned into one regular expression over host and path, and the
index holds it under the rarest of its literal tokens, as counted in the URLs at hand.
The tokens of a URL fetch candidate rules; only those run their expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.operators.joins import split_join

TOKEN = "[a-z0-9]+"
#: Rules up to this number are broadcast; more are joined by token with a shuffle.
BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class Rule:
    """``host`` with ``path`` for a site and the beginning of its paths, or ``pattern`` alone with its literal words."""

    verdict: str
    host: str = ""
    path: str = ""
    pattern: str = ""
    words: tuple[str, ...] = ()

    @property
    def name(self) -> str | None:
        return None if self.pattern else self.host + self.path

    @property
    def regex(self) -> str:
        """Over host and path, which are joined as they stand."""
        return self.pattern or rf"^([^/]*\.)?{_quoted(self.host)}(?=/|$){_quoted(self.path)}"

    @property
    def tokens(self) -> list[str]:
        """Whole tokens that every URL with a match has; the end of a path may be part of a longer one."""
        if self.words:
            return list(self.words)
        inner = re.findall(rf"{TOKEN}(?=[^a-z0-9])", self.path.lower())
        return re.findall(TOKEN, self.host.lower()) + inner


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_])", r"\\\1", text)


#: Words of hosts and paths that mark junk where no rule of a site decides.
JUNK = (
    Rule("block", pattern=r"(^|[./-])spam-farm\.", words=("spam", "farm")),
    Rule("block", pattern=r"(^|[./-])casino[./-]", words=("casino",)),
    Rule("block", pattern=r"(^|[./-])viagra[./-]", words=("viagra",)),
    Rule("block", pattern=r"(^|[./-])porn[./-]", words=("porn",)),
    Rule("block", pattern=r"(^|[./-])xxx[./-]", words=("xxx",)),
    Rule("block", pattern=r"(^|[./-])warez[./-]", words=("warez",)),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased in A-Z, and path of a URL; both empty for null and where ``://`` is missing."""
    whole = F.coalesce(url, F.lit(""))
    start = F.instr(whole, "://")
    tail = F.when(start > 0, F.substr(whole, start + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(tail, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(tail, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def filter_urls(pages: DataFrame, rules: list[Rule], junk: tuple[Rule, ...] = JUNK, default: str = "allow") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages`` (page_id, url).

    The longest rule of a site (by host and path together) that fits decides; where
    none fits, a junk pattern does, and else the default. Rules of equal length
    for one URL cannot differ in text, so the first in the list counts.

    Null urls and those without ``://`` have an empty host and path and no rule.
    Repeated rows get equal results; null ids stay; other columns are ignored.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url").cast("string"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    places = judged.select("host", "path").distinct()
    tokens = places.select(
        "host",
        "path",
        F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.concat("host", "path")), F.lit(f"({TOKEN})")))).alias("token"),
    )
    index = rule_index(spark, tokens, [*rules, *junk])
    index = F.broadcast(index) if len(rules) + len(junk) <= BROADCAST_RULES else index
    best = (
        tokens.join(index, "token")
        .where(F.expr("regexp_like(concat(host, path), regex)"))
        .groupBy("host", "path")
        .agg(F.max(F.struct("by_site", "length", "order", "rule", "verdict")).alias("best"))
    )
    # A URL that fills the table, or rows without one, are split over tasks.
    found = split_join(judged, best, ["host", "path"], "left")
    return found.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def rule_index(spark: SparkSession, tokens: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rules by the rarest of their tokens; ties go to the first in the alphabet."""
    rows = [
        (r.name, r.verdict, r.regex, not r.pattern, len(r.name or ""), -i, t)
        for i, r in enumerate(rules)
        for t in r.tokens
    ]
    listed = spark.createDataFrame(
        rows, "rule string, verdict string, regex string, by_site boolean, length int, order int, token string"
    )
    known = listed.select("token").distinct()
    known = F.broadcast(known) if len(rules) <= BROADCAST_RULES else known
    counts = tokens.join(known, "token", "left_semi").groupBy("token").agg(F.count("*").alias("urls"))
    rarest = F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token"))
    return (
        listed.join(counts, "token", "left")
        .groupBy("rule", "verdict", "regex", "by_site", "length", "order")
        .agg(rarest.alias("rarest"))
        .select("rule", "verdict", "regex", "by_site", "length", "order", F.col("rarest.token").alias("token"))
    )
