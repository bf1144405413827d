"""URL filters: expression expansion, hash-prefix join, digest confirmation.

A rule is a host and a path. It fits its host and all subdomains when the
url's path starts with the rule's. Each url expands into its host suffixes and
into the prefixes of its path that end at a slash; a rule is filed under its
host and the part of its path up to the last slash, so the two meet in an
equi-join on a short hash prefix. The full digest and the whole rule path then
confirm, and the longest rule wins. Up to ``BROADCAST_RULES`` rules are broadcast, so that urls don't
move to a rule that fits half of them; more rules meet the urls in a join that
Spark splits where it is skewed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abode.llm.common import col

PREFIX_HEX = 8
#: Rules that a broadcast may hold, about 200 bytes each.
BROADCAST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL_PARTS, 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def rule_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rows as a frame."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _folder(path: Column) -> Column:
    """The path up to its last slash, slash included."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 0)


def _digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), folder), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the rule that
    decides, else null) and ``verdict``.

    Null url or one without ``://``: host and path empty, which only a rule with
    an empty host and path fits. Among rules that fit, the longest
    (host and path together) wins, then the longer host, then block before
    allow. Repeated urls are judged once and joined back; an input column of a
    result's name is replaced. Empty tables give no rows or no rules.

    Hosts with many labels and paths with many slashes expand no further than
    the deepest rule, so very long urls stay cheap and nothing is lost.
    """
    known = rules.select(
        F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"),
        F.col("verdict").alias("rule_verdict"))
    known = known.withColumn("digest", _digest(F.col("rule_host"), _folder(F.col("rule_path"))))
    depth = known.agg(F.count(F.lit(1)).alias("rules"), F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
                      F.max(F.length("rule_path") - F.length(F.replace("rule_path", F.lit("/"), F.lit("")))).alias("slashes")).first()
    labels, slashes = depth["labels"] or 1, depth["slashes"] or 0

    url = F.coalesce(col(url_col), F.lit(""))
    urls = (pages.select(url.alias("judged_url")).distinct()
            .withColumn("host", url_host(F.col("judged_url"))).withColumn("path", url_path(F.col("judged_url"))))
    part = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(part), F.lit(labels))),
                           lambda n: F.concat_ws(".", F.slice(part, F.greatest(F.size(part) - n + 1, F.lit(1)), n)))
    # split() keeps what stands after the last slash; a folder needs one slash more.
    step = F.split("path", "/", slashes + 1)
    folders = F.transform(F.sequence(F.lit(0), F.size(step) - 1),
                          lambda n: F.when(n == 0, F.lit("")).otherwise(F.concat(F.concat_ws("/", F.slice(step, 1, n)), F.lit("/"))))
    expressions = (urls.withColumn("suffix", F.explode(suffixes)).withColumn("folder", F.explode(folders))
                   .withColumn("digest", _digest(F.col("suffix"), F.col("folder")))
                   .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)).drop("folder", "suffix"))
    filed = known.withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)).withColumnRenamed("digest", "rule_digest")
    if depth["rules"] <= BROADCAST_RULES:
        filed = F.broadcast(filed)
    fits = (expressions.join(filed, "prefix")
            .filter((F.col("digest") == F.col("rule_digest")) & F.startswith("path", F.col("rule_path"))))
    rank = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), (F.col("rule_verdict") == "block").cast("int"))
    judged = fits.groupBy("judged_url").agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict"), rank).alias("won"))
    own = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rows = pages.select(F.struct(*[col(c) for c in own]).alias("row"), url.alias("page_url"))
    return (rows.join(judged, F.col("page_url") == F.col("judged_url"), "left")
            .select("row.*", url_host(F.col("page_url")).alias("host"), url_path(F.col("page_url")).alias("path"),
                    F.col("won.rule").alias("rule"), F.coalesce("won.rule_verdict", F.lit(default)).alias("verdict")))
