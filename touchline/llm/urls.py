"""URL rules, indexed by their rarest literal token.

A rule is a regular expression over host and path together with tokens (runs of ASCII letters
and digits) that each URL it fits must contain as whole tokens. Token frequencies are
counted over all different URLs; a rule is filed under its token that the fewest of them have.
The tokens of a URL fetch the rules filed under them, and only those run their expression.
Different URLs are judged once each; a very frequent URL is one row until the last join.

Site rules say allow or block for a host with its subdomains and the start of a path; the
longest one that fits decides. Where none fits, pattern rules decide (block if any
fits), and else the default.

Nulls and edges: a URL that is null or has no ``://`` has an empty host and path and gets the
default; an empty set of pages gives no rows; repeated rows and null ids do no harm; of
site rules of one length the first by text wins; no rules means the default everywhere.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT = "allow"


@dataclass(frozen=True)
class SiteRule:
    action: str
    host: str
    path: str

    @property
    def regex(self) -> str:
        return rf"^(?:[^/?#]*\.)?{re.escape(self.host)} {re.escape(self.path)}"

    @property
    def tokens(self) -> tuple[str, ...]:
        """Whole tokens of the host, and those of the path that end inside the rule."""
        found = re.findall("[A-Za-z0-9]+", self.host)
        return tuple(found + re.findall("[A-Za-z0-9]+(?=[^A-Za-z0-9])", self.path))


@dataclass(frozen=True)
class PatternRule:
    """``regex`` sees host, a space, and path."""

    regex: str
    tokens: tuple[str, ...]


SITE_RULES = (
    SiteRule("allow", "org", "/"),
    SiteRule("block", "example.org", "/es/"),
    SiteRule("block", "example.org", "/en/1"),
    SiteRule("allow", "com", "/fr/"),
    SiteRule("block", "com", "/de/"),
)
PATTERN_RULES = (
    PatternRule(r"(?:^|\.)spam-farm\.", ("spam", "farm")),
    PatternRule(r"(?:^|\.)cheap-pills\.", ("cheap", "pills")),
    PatternRule(r"(?:^|\.)[a-z0-9-]*\bfree-money\b", ("free", "money")),
    PatternRule(r"(?:^|\.)(?:[a-z0-9]+-)*casino(?:-[a-z0-9]+)*\.", ("casino",)),
    PatternRule(r" /(?:[^/]+/)*wp-login\.php$", ("wp", "login", "php")),
    PatternRule(r" /(?:[^/]+/)*checkout/session-[0-9a-f]{8,}", ("checkout",)),
)

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    rest = F.expr(f"IF(instr({url}, '://') > 0, substring({url}, instr({url}, '://') + 3), '')")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, *_LOWER), path


def judged(
    pages: DataFrame,
    sites: tuple[SiteRule, ...] = SITE_RULES,
    patterns: tuple[PatternRule, ...] = PATTERN_RULES,
    default: str = DEFAULT,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``."""
    spark = pages.sparkSession
    host, path = host_and_path()
    urls = pages.where("url IS NOT NULL").select("url").distinct().select("url", host.alias("host"), path.alias("path"))
    rows = [(i, r.host + r.path, r.action, r.regex, list(r.tokens)) for i, r in enumerate(sites)]
    rows += [(len(sites) + i, None, "block", r.regex, list(r.tokens)) for i, r in enumerate(patterns)]
    rules = spark.createDataFrame(rows, "id int, rule string, action string, regex string, tokens array<string>")

    words = urls.select(
        "url",
        "host",
        "path",
        F.explode(F.array_distinct(F.split(F.concat("host", F.lit(" "), "path"), "[^A-Za-z0-9]+"))).alias("token"),
    )
    literals = rules.select("id", F.explode("tokens").alias("token"))
    counts = words.join(literals.select("token").distinct(), "token", "left_semi").groupBy("token").agg(
        F.count("*").alias("n")
    )
    rarest = (
        literals.join(counts, "token", "left")
        .groupBy("id")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("best"))
        .select("id", "best.token")
    )
    index = rarest.join(rules.drop("tokens"), "id")
    fits = words.join(index, "token").where(F.expr("concat(host, ' ', path) RLIKE regex"))
    best = fits.groupBy("url").agg(
        F.min(
            F.when(F.col("rule").isNotNull(), F.struct((-F.length("rule")).alias("long"), "rule", "action"))
        ).alias("site"),
        F.count(F.when(F.col("rule").isNull(), 1)).alias("patterns"),
    )
    best = best.select(
        F.col("url").alias("b_url"),
        F.col("site.rule").alias("rule"),
        F.coalesce("site.action", F.when(F.col("patterns") > 0, F.lit("block"))).alias("verdict"),
    )
    return (
        pages.select("page_id", "url")
        .join(best, F.col("url") == F.col("b_url"), "left")
        .select(
            "page_id", host.alias("host"), path.alias("path"), "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
        )
    )
