"""URL filters: host and path rules, found by short hash prefixes and confirmed by full digests.

A url is cut into host and path and expanded into expressions: each suffix of its host that starts a label, with each
prefix of its path. Of these only such lengths are written out as some rule has, so a url with any number of labels
or slashes makes no more expressions than the rules have lengths. Expressions and rules meet in an equi-join on the
first PREFIX bytes of their SHA-256; the full digest then confirms the rule. Of the confirmed rules the longest wins.
All of it is native expressions and joins.

Different urls with the same host and path are one address: a url that a third of all rows hold is expanded once.
The rules are a table of any size. The planner broadcasts them if they are small; else the join on the hash prefix is
one that can split a prefix that many addresses share (the one of a rule for a whole top-level domain).

Defined results: a null url, or one without "://", has the empty host and path; only A-Z are lower-cased, ports and
user names belong to the host; a rule's host is lower-cased in the same way, a rule with a null in it fits nothing; of
rules equal in host and path the greatest verdict counts (block before allow), of different ones equally long the one
with the longer host; where no rule fits, rule is null and the verdict is the default; rows are kept as often as they
come; a very long url costs in proportion to its length; no rules, or an empty table, are no special case; of further
columns only those named are kept, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import written

PREFIX = 4  # bytes of a digest that are joined
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """A few rules written out in code, as a table."""
    marks = ", ".join(f"(:host{k}, :path{k}, :verdict{k})" for k in range(len(rules)))
    values = {f"{name}{k}": value for k, rule in enumerate(rules) for name, value in zip(("host", "path", "verdict"), rule)}
    return spark.sql(f"SELECT * FROM VALUES {marks} AS rules (host, path, verdict)", args=values)


def _lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    return _lowered(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    """Of one expression. Neither part can hold the mark between them: it ends both in a url."""
    return F.unhex(F.sha2(F.concat(host, F.lit("#"), path), 256))


def digested(rules: DataFrame) -> DataFrame:
    """prefix, digest, rule, verdict and the lengths of each rule, one row for each host and path."""
    host, path = _lowered(F.col("host")), F.col("path")
    found = rules.select(host.alias("host"), path.alias("path"), "verdict").dropna()
    found = found.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    digest = _digest(F.col("host"), F.col("path"))
    return found.select(
        F.substring(digest, 1, PREFIX).alias("prefix"),
        digest.alias("digest"),
        F.concat("host", "path").alias("rule"),
        "verdict",
        F.char_length("host").alias("host_chars"),
        F.char_length("path").alias("path_chars"),
        F.endswith("path", F.lit("/")).alias("closed"),
    )


def _lengths(found: DataFrame) -> tuple[list[int], list[int], list[int]]:
    """Lengths of hosts, of paths that end in a slash and of other paths: as many as the longest rule has characters."""
    closed = F.when(F.col("closed"), F.col("path_chars"))
    other = F.when(~F.col("closed"), F.col("path_chars"))
    row = found.agg(*[F.array_sort(F.collect_set(c)) for c in (F.col("host_chars"), closed, other)]).first()
    return row[0], row[1], row[2]


def _expressions(addresses: DataFrame, hosts: list[int], closed: list[int], other: list[int]) -> DataFrame:
    """address, prefix and digest of each expression of an address that is as long as some rule."""
    chosen = lambda lengths, fits: F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), fits)
    sized = addresses.withColumns({"h": F.char_length("host"), "p": F.char_length("path")})

    def starts_label(n: Column) -> Column:
        return (n == F.col("h")) | ((n < F.col("h")) & (F.substring("host", F.col("h") - n, F.lit(1)) == "."))

    def after_slash(n: Column) -> Column:
        return (n <= F.col("p")) & (F.substring("path", n, F.lit(1)) == "/")

    paths = F.concat(chosen(closed, after_slash), chosen(other, lambda n: n <= F.col("p")))
    cut = sized.select("address", "host", "path", F.explode(chosen(hosts, starts_label)).alias("h"), paths.alias("paths"))
    cut = cut.select("address", F.right("host", F.col("h")).alias("host"), "path", F.explode(F.array_distinct("paths")).alias("p"))
    digests = cut.select("address", _digest(F.col("host"), F.left("path", F.col("p"))).alias("found"))
    return digests.select("address", F.substring("found", 1, PREFIX).alias("prefix"), "found")


def fitting(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """address, rule and verdict of the longest rule that fits, for addresses (address, host, path) that one fits."""
    found = digested(rules)
    candidates = _expressions(addresses, *_lengths(found)).join(found, "prefix")
    # Not a filter: the planner would join on the full digests as well.
    confirmed = F.col("found") == F.col("digest")
    chars = (F.col("host_chars") + F.col("path_chars")).alias("chars")
    best = F.max(F.when(confirmed, F.struct(chars, "host_chars", "rule", "verdict"))).alias("best")
    return candidates.groupBy("address").agg(best).where("best is not null").select("address", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, keep: list[str], url: str = "url", default: str = "allow") -> DataFrame:
    """The kept columns, then host, path, rule (host and path, null if none fits) and verdict of each row's url."""
    host, path = host_and_path(F.col(f"`{url}`"))
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    cut = pages.select(row, host.alias("host"), path.alias("path"))
    cut = cut.withColumn("address", _digest(F.col("host"), F.col("path")))
    addresses = cut.groupBy("address").agg(F.first("host").alias("host"), F.first("path").alias("path"))
    # Kept apart first, so that the join can split the rows of an address that comes very often.
    found = written(fitting(addresses, rules), "fitting")
    return cut.join(found, "address", "left").select(
        *[F.col(f"row.`{c}`") for c in keep], "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


ORACLE = r"""
WITH rules (rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
rests AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
),
cut AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
),
fits AS (
  SELECT page_id, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM cut JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM cut LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (page_id)
"""
