"""URL filter lists: host-suffix and path-prefix expressions looked up by short hash prefix.

Every distinct URL is expanded into the pairs (host suffix, path prefix) a rule could name. The pairs meet
the rules in an equi-join on the first 32 bits of a SHA-256 digest; the full digest then confirms, and the
longest confirmed rule decides.

Defined results: null URLs and URLs without ``://`` have an empty host and path and fit no rule; no rule
gives verdict ``default``; repeated rows each get their row; of rules of equal length the one with the longer
host wins, then ``block``. An empty rule table leaves every URL to the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """Text between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as a table with digests."""
    return with_digests(spark.createDataFrame(rules, "verdict string, host string, path string"))


def with_digests(rules: DataFrame) -> DataFrame:
    rule = F.concat("host", "path")
    digest = expression_digest(F.col("host"), F.col("path"))
    return rules.select(
        F.lower("host").alias("rule_host"),
        rule.alias("rule"),
        F.col("verdict").alias("rule_verdict"),
        F.length("path").alias("rule_path_length"),
        digest.alias("rule_digest"),
        F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"),
    )


def expression_digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def expanded(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """Rows (host, path, digest, prefix): each URL with each of its expressions.

    ``lengths`` are the path lengths that rules have, so no longer prefix than a rule needs is made.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    candidates = F.array(*map(F.lit, lengths)).cast("array<int>")
    by_path = urls.select(
        "host", "path", F.explode(F.filter(candidates, lambda n: n <= F.length("path"))).alias("length")
    )
    pairs = by_path.select(
        "host", "path", F.substring("path", F.lit(1), F.col("length")).alias("start"), F.explode(suffixes).alias("suffix")
    )
    digest = expression_digest(F.col("suffix"), F.col("start"))
    return pairs.select("host", "path", digest.alias("digest")).withColumn(
        "prefix", F.substring("digest", 1, PREFIX_DIGITS)
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All columns of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; clashing names give way.

    ``rules`` comes from ``rule_table`` or ``with_digests``. Only its distinct path lengths reach the driver, at
    most as many as the longest rule path has characters; Spark chooses how to join by the size of the rules.
    """
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    located = pages.select(*[F.col(f"`{c}`") for c in kept], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    distinct = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")).distinct()
    lengths = sorted(row[0] for row in rules.select("rule_path_length").distinct().collect())
    hits = expanded(distinct, lengths).join(rules, "prefix").where("digest = rule_digest")
    best = hits.groupBy("host", "path").agg(
        F.max(
            F.struct(
                F.length("rule").alias("length"),
                F.length("rule_host").alias("host_length"),
                (F.col("rule_verdict") == "block").alias("blocks"),
                "rule",
                F.col("rule_verdict").alias("verdict"),
            )
        ).alias("best")
    )
    return located.join(best, ["host", "path"], "left").select(
        *[F.col(f"`{c}`") for c in kept],
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
