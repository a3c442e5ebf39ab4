"""Judging URLs by host and path rules, by lookups of expressions in a hashed list.

Each URL is expanded into expressions: every suffix of its host that has as many labels as some rule's
host, with every prefix of its path that is as long as some rule's path. The first ``PREFIX`` hex digits of an
expression's SHA-256 are joined with those of the rules; matches are confirmed by full digests. Of
several rules that fit, the longest wins; of equally long ones the one with the longer host, then
``block``. All of it is DataFrame functions.

Distinct (host, path) pairs are judged, so that a host with many pages is expanded once per path.
The rules are a table like any other; Spark broadcasts it only under its own size threshold.

Edge cases: a null URL, or one without ``://``, has an empty host and path and fits no rule; an empty
host or path fits no rule with one; rules with a null or empty host or a null path are ignored, and
of repeated rules with different verdicts ``block`` holds; repeated rows are all judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hex digits of a digest that are joined; the rest is only compared where these meet.
PREFIX = 8
#: The verdict where no rule fits.
DEFAULT = "allow"
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """The rules as a table of literals."""
    rules = RULES if rules is None else rules
    names = ("host", "path", "verdict")
    rows = [F.struct(*[F.lit(x).cast("string").alias(name) for x, name in zip(rule, names, strict=True)]) for rule in rules]
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast("string").alias(name) for name in names])
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # No host has a "/", so host and path can be told apart once joined.
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _labels(host: Column) -> Column:
    """How many labels a host has."""
    return F.length(host) - F.length(F.translate(host, ".", "")) + 1


def _expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Digests of all pairs of a host suffix and a path prefix."""
    ends = F.array(*[F.when(_labels(host) >= n, F.substring_index(host, ".", -n)) for n in labels])
    suffixes = F.filter(ends, lambda s: s.isNotNull())
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n)
    )
    return F.array_distinct(F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: _digest(s, p)))))


def judged(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """Columns ``page_id``, ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``."""
    usable = rules.where((F.col("host") != "") & F.col("path").isNotNull())
    hashed = (
        usable.groupBy(F.translate("host", _UPPER, _LOWER).alias("h"), F.col("path").alias("p"))
        .agg(F.max("verdict").alias("verdict"))  # block, if there are both
        .select(F.concat("h", "p").alias("rule"), F.length("h").alias("h"), "verdict", _digest(F.col("h"), F.col("p")).alias("digest"))
        .withColumn("short", F.substring("digest", 1, PREFIX))
    )
    # No more values than the longest path of a rule has characters, and the longest host labels.
    bounds = usable.agg(F.collect_set(F.length("path")).alias("lengths"), F.collect_set(_labels(F.col("host"))).alias("labels"))
    lengths, labels = (sorted(found) for found in bounds.first())
    host, path = host_and_path(F.col("url").cast("string"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not lengths:
        return split.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    expanded = split.select("host", "path").where("host != ''").distinct().select(
        "host", "path", F.explode(_expressions(F.col("host"), F.col("path"), labels, lengths)).alias("found")
    )
    fits = expanded.withColumn("short", F.substring("found", 1, PREFIX)).join(hashed, "short")
    order = F.struct(F.length("rule"), F.col("h"), F.col("verdict"), F.col("rule"))
    best = (
        fits.where("found = digest")
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    )
    both = split.join(best, ["host", "path"], "left")
    return both.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
