"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression over a whole url with a verdict, a priority and the
literal tokens that every matching url must contain as whole tokens. Each rule is
filed under the one of its tokens that is rarest in the urls at hand; the tokens of a
url fetch the rules filed under them, and only those run their expression. A rule
without such a token is filed under the empty token, which every url fetches.

Everything is DataFrame operations. Nulls: a null url equals no rule and gets empty
host and path. Repeated urls are judged once and joined back to their rows (Spark's skew join
splits the rows of a very common url). Ties: of rules of one priority the larger name wins. Long
urls are matched whole. An empty table gives no rows. Columns host, path, rule, verdict and
priority of the pages are replaced, all others pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import ascii_lower, own_names, table
from stratamart.llm.registry import query

TOKEN = "[a-z0-9]+"
#: Longer rule lists are joined by token instead of broadcast.
BROADCAST_RULES = 50_000


@dataclass(frozen=True)
class PatternRule:
    """``tokens``: lower-case [a-z0-9]+ runs that a match always holds with other characters (or an end) around them."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    #: Larger wins; rules of a host and path count before all patterns.
    priority: int


def host_path_rule(verdict: str, host: str, path: str) -> PatternRule:
    """Fits the host and its subdomains where the url's path starts with ``path``; the longer rule has priority."""
    pattern = r"(?s)^(?:(?!://).)*://(?:[^/?#]*\.)?" + _any_case(host) + "(?=[/?#]|$)" + re.escape(path)
    tokens = re.findall(TOKEN, host)
    # A path's last run may go on in the url, so only runs closed on both sides count.
    tokens += re.findall(r"(?<=[^A-Za-z0-9])[a-z0-9]+(?=[^A-Za-z0-9])", path)
    return PatternRule(host + path, verdict, pattern, tuple(tokens), 1000 + len(host + path))


def _any_case(text: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if "a" <= c <= "z" else re.escape(c) for c in text)


#: The rules by host and path that every caller of the query gets.
BASE_RULES = (
    host_path_rule("block", "net", "/"),
    host_path_rule("allow", "example.net", "/en/"),
    host_path_rule("block", "example.com", "/de/"),
    host_path_rule("allow", "org", "/fr/"),
)

#: Default patterns for unwanted pages: advertising, betting, spam and adult hosts, and their exception.
PATTERN_RULES = (
    PatternRule("ads-host", "block", r"(?i)://(?:[^/?#]*[.-])?ads[.-]", ("ads",), 10),
    PatternRule("ad-host", "block", r"(?i)://(?:[^/?#]*[.-])?ad[.-]", ("ad",), 10),
    PatternRule("track-host", "block", r"(?i)://(?:[^/?#]*[.-])?track[.-]", ("track",), 10),
    PatternRule("casino", "block", r"(?i)://[^/?#]*\bcasino\b", ("casino",), 10),
    PatternRule("spam", "block", r"(?i)://[^/?#]*\bspam\b", ("spam",), 10),
    PatternRule("adult-xxx", "block", r"(?i)://[^/?#]*\bxxx\b", ("xxx",), 10),
    PatternRule("adult-porn", "block", r"(?i)://[^/?#]*\bporn\b", ("porn",), 10),
    PatternRule("ads-path", "block", r"(?i)://[^/?#]*/(?:[^?#]*/)?ads/", ("ads",), 5),
    PatternRule("robots", "allow", r"(?i)://[^/?#]*/robots\.txt(?:[?#]|$)", ("robots", "txt"), 20),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?:(?!://).)*://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?:(?!://).)*://[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(ascii_lower(url), F.lit(f"({TOKEN})"), F.lit(1)))


def rule_index(spark: SparkSession, urls: DataFrame, rules: tuple[PatternRule, ...]) -> DataFrame:
    """Rules with ``token``: the rarest of their literal tokens over ``urls`` (ties by text), else empty."""
    frame = spark.range(1).select(F.inline(F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("rule_verdict"), F.lit(r.pattern).alias("pattern"),
            F.array(*map(F.lit, r.tokens)).cast("array<string>").alias("tokens"), F.lit(r.priority).alias("priority"),
        ) for r in rules
    ])))
    wanted = frame.select(F.explode("tokens").alias("token")).distinct()
    counted = (
        urls.select(F.explode(url_tokens(F.col("url"))).alias("token")).join(small(wanted, rules), "token", "left_semi")
        .groupBy("token").agg(F.count("*").alias("uses"))
    )
    filed = (
        frame.select("*", F.explode("tokens").alias("token")).join(counted, "token", "left")
        .groupBy("rule").agg(F.min(F.struct(F.coalesce("uses", F.lit(0)), "token"))["token"].alias("token"))
    )
    return frame.drop("tokens").join(filed, "rule", "left").withColumn("token", F.coalesce("token", F.lit("")))


def small(frame: DataFrame, rules: tuple[PatternRule, ...]) -> DataFrame:
    """Broadcast what has at most a few rows for each rule, while the rule list is short enough."""
    return F.broadcast(frame) if len(rules) <= BROADCAST_RULES else frame


def match_rules(urls: DataFrame, index: DataFrame) -> DataFrame:
    """(url, rule, rule_verdict): the matching rule of highest priority (ties by name) of each distinct url."""
    tokens = F.concat(F.array(F.lit("")), url_tokens(F.col("url")))
    return (
        urls.select("url", F.explode(tokens).alias("token")).join(index, "token")
        .where(F.expr("regexp_like(url, pattern)"))
        .groupBy("url")
        .agg(F.max_by(F.struct("rule", "rule_verdict", "priority"), F.struct("priority", "rule")).alias("best"))
        .select("url", "best.*")
    )


def judge_urls(pages: DataFrame, url: str = "url", rules: tuple[PatternRule, ...] = PATTERN_RULES + BASE_RULES,
               default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (of the highest priority, else null) and verdict."""
    spark = pages.sparkSession
    own, match = own_names(pages, "url", "match")
    rows = pages.withColumn(own, F.coalesce(F.col(f"`{url}`"), F.lit("")))
    urls = rows.select(F.col(own).alias("url")).distinct()
    best = match_rules(urls, small(rule_index(spark, urls, rules), rules))
    best = best.select(F.col("url").alias(own), F.struct("rule", "rule_verdict", "priority").alias(match))
    keep = [F.col(f"`{c}`") for c in pages.columns if c not in {"host", "path", "rule", "verdict", "priority"}]
    joined = rows.select(*keep, own).join(best, own, "left")
    return joined.select(
        *keep, host_of(F.col(own)).alias("host"), path_of(F.col(own)).alias("path"), F.col(f"{match}.rule").alias("rule"),
        F.coalesce(f"{match}.rule_verdict", F.lit(default)).alias("verdict"), F.col(f"{match}.priority").alias("priority"),
    )


SQL = r"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS u FROM pages
), split AS (
  SELECT page_id, u, CASE WHEN strpos(u, '://') > 0 THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM parts
), hosts AS (
  SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM split
), base(rhost, rpath, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best AS (
  SELECT page_id, u, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(b.verdict, length(rhost || rpath)) AS said
  FROM hosts LEFT JOIN base b ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id, u, host, path
)
SELECT h.page_id, h.host, h.path, b.rule,
  CASE WHEN b.rule IS NOT NULL THEN b.said
       WHEN regexp_matches(h.u, '(?i)://[^/?#]*/robots\.txt([?#]|$)') THEN 'allow'
       WHEN regexp_matches(h.u, '(?i)://([^/?#]*[.-])?(ads?|track)[.-]') OR regexp_matches(h.u, '(?i)://[^/?#]*\b(casino|spam|xxx|porn)\b')
         OR regexp_matches(h.u, '(?i)://[^/?#]*/([^?#]*/)?ads/') THEN 'block'
       ELSE 'allow' END AS verdict
FROM hosts h JOIN best b ON h.page_id IS NOT DISTINCT FROM b.page_id AND h.u = b.u
"""


@query(SQL)
def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page judged; ``rule`` names the base rule, patterns only give the verdict."""
    judged = judge_urls(table(spark, folder, "pages"))
    base = F.col("priority") >= 1000
    return judged.select("page_id", "host", "path", F.when(base, F.col("rule")).alias("rule"), "verdict")
