"""URL filter: host-suffix and path-prefix expressions, hash-prefix equi-join, full-digest confirmation.

Every distinct (host, path) is expanded into the expressions a rule could be
written as: each suffix of the host (cut at dots) with each prefix of the path
whose length some rule has. Only the first PREFIX_HEX digits of an expression's
SHA-256 meet the rules in an equi-join; the whole digest then confirms, and the
longest confirmed rule wins (ties: the longer host, then block). All of it is
DataFrame expressions.

Defined cases: a null url, or one without ``://``, has an empty host and path and
matches no rule; an empty host matches no rule; a null or empty rule host, a null
path or an unknown verdict is an error of the rule list and never matches; repeated
rules count once; repeated pages each get their row; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_HEX = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _tail(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(_tail(url), r"(?s)^([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_tail(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """``a.b.c``, ``b.c``, ``c``."""
    parts = F.split(host, r"\.", -1)
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(parts, k, n), "."))


def expression(host: Column, path: Column) -> Column:
    """Host and path as one text; the separator occurs in no host."""
    return F.concat(host, F.lit("#"), path)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` (page_id, url) judged by ``rules`` (host, path, verdict): page_id, host, path, rule, verdict."""
    r = (
        rules.filter((F.col("host") != "") & F.col("path").isNotNull() & F.col("verdict").isin("allow", "block"))
        .select("host", "path", "verdict")
        .distinct()
        .withColumn("digest", F.sha2(expression(F.col("host"), F.col("path")), 256))
        .select(
            F.substring("digest", 1, PREFIX_HEX).alias("prefix"),
            F.col("digest").alias("rule_digest"),
            F.concat("host", "path").alias("rule"),
            F.length("host").alias("host_length"),
            (F.col("verdict") == "block").cast("int").alias("blocks"),
            F.col("verdict").alias("rule_verdict"),
        )
    )
    # The lengths at which a path has to be cut: one small row, at most as many as there are rules.
    lengths = [x for (x,) in rules.select(F.length("path")).distinct().collect() if x is not None]
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    cuts = F.filter(F.array(*[F.lit(x) for x in sorted(lengths)]).cast("array<int>"), lambda x: x <= F.length("path"))
    hits = (
        urls.filter(F.col("host") != "")
        .select("host", "path")
        .distinct()
        .withColumn("suffix", F.explode(host_suffixes(F.col("host"))))
        .withColumn("cut", F.explode(cuts))
        .withColumn("digest", F.sha2(expression(F.col("suffix"), F.substr("path", F.lit(1), F.col("cut"))), 256))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
        .join(r, "prefix")
        .filter(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule"), "host_length", "blocks", "rule", "rule_verdict")).alias("best"))
    )
    return urls.join(hits, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
