"""URL filter lists by hash prefixes.

Each URL is expanded into host-suffix and path-prefix expressions. The
expressions meet the rules in an equi-join on a short prefix of their SHA-256
digest; a match counts only if the full digests agree, and the longest
matching rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the digest that the join uses (32 bits).
PREFIX_DIGITS = 8
#: Verdict of a URL that no rule fits.
DEFAULT_VERDICT = "allow"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as a table ``verdict, host, path``."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    A rule fits its host and every subdomain of it, if the path starts with
    the rule's path. The longest rule (host and path together) wins; among
    equally long ones the longer host, then ``block``. Without a fitting rule
    ``rule`` is null and the verdict is ``default``. Null URLs and URLs without
    ``://`` have an empty host and path, repeated rows each get a row, and
    rules with a null part or an empty host are ignored. Other columns of
    ``pages`` are not read, so their names cannot clash.

    Each distinct (host, path) is judged once. Expressions are made only for
    the (label count, path length) shapes that occur among the rules, which
    the driver gathers; their number follows the forms of the rules, not the
    number of rules or pages.
    """
    host, path = split_url(F.col(url))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rules = (rules.where("verdict is not null and path is not null and host <> ''")
             .select("verdict", F.translate("host", UPPER, LOWER).alias("rule_host"),
                     F.col("path").alias("rule_path")).distinct())
    shape = F.struct(F.size(F.split("rule_host", r"\.")).alias("labels"),
                     F.length("rule_path").alias("chars"))
    shapes = [r.s for r in rules.select(shape.alias("s")).distinct().collect()]
    listed = F.array(*[F.struct(F.lit(s.labels).alias("labels"), F.lit(s.chars).alias("chars"))
                       for s in sorted(shapes)] or
                     [F.struct(F.lit(2**31 - 1).alias("labels"), F.lit(0).alias("chars"))])
    known = rules.select(
        "verdict", "rule_host", "rule_path",
        F.concat("rule_host", "rule_path").alias("rule"),
        _digest(F.col("rule_host"), F.col("rule_path")).alias("rule_digest"),
    ).withColumn("prefix", F.substring("rule_digest", 1, PREFIX_DIGITS))

    labels = F.split("host", r"\.")
    fits = F.filter(listed, lambda s: (s.labels <= F.size(labels)) & (s.chars <= F.length("path")))
    digests = F.transform(fits, lambda s: _digest(
        F.array_join(F.slice(labels, F.size(labels) - s.labels + 1, s.labels), "."),
        F.col("path").substr(F.lit(1), s.chars)))
    expressions = (rows.select("host", "path").distinct()
                   .select("host", "path", F.explode(digests).alias("digest"))
                   .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS)))
    hits = expressions.join(known, "prefix").where("digest = rule_digest")
    order = F.struct(F.length("rule"), F.length("rule_host"),
                     (F.col("verdict") == "block").cast("int"), "rule", "verdict")
    best = hits.groupBy("host", "path").agg(F.max(order).alias("best")) \
        .select("host", "path", F.col("best.rule").alias("rule"),
                F.col("best.verdict").alias("verdict"))
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"))
