"""URL filters: rules on host and path, found through hash prefixes.

Each distinct (host, path) is expanded into its host suffixes and its path prefixes that
end in ``/`` (and the empty one), as deep as the deepest rule goes. The rules are keyed by host and
the part of their path up to the last ``/``. Both sides meet in an equi-join on a short prefix of the key's digest;
full digests, the rest of the rule's path and the precedence of rules are then confirmed.
Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (verdict, host, path)
Rule = tuple[str, str, str]
#: Hex digits of a digest that the join compares.
PREFIX_DIGITS = 8
#: Bytes of rules that are broadcast; larger tables are joined as Spark plans it.
BROADCAST_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def n_labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def n_slashes(path: Column) -> Column:
    return F.size(F.split(path, "/", -1)) - 1


def host_suffix(host: Column, labels: Column) -> Column:
    """The last ``labels`` labels of the host."""
    return F.call_function("substring_index", host, F.lit("."), -labels)


def path_prefix(path: Column, slashes: Column) -> Column:
    """The path up to the given one of its slashes, or the empty path."""
    found = F.call_function("substring_index", path, F.lit("/"), slashes)
    return F.when(slashes == 0, F.lit("")).otherwise(F.concat(found, F.lit("/")))


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path).cast("binary"), 256)


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The rules as rows (verdict, host, path), broadcast while they are small. Lists too long for one
    expression come as a table of these columns instead."""
    if not rules:
        return spark.createDataFrame([], "verdict string, host string, path string")
    literals = [
        F.struct(
            F.lit(v).alias("verdict"),
            F.translate(F.lit(h), UPPER, LOWER).alias("host"),
            F.lit(p).alias("path"),
        )
        for v, h, p in rules
    ]
    table = spark.range(1).select(F.inline(F.array(*literals)))
    size = sum(len(part.encode()) for rule in rules for part in rule)
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with host, path, rule and verdict of each row's url.

    Rules have the columns verdict, host and path. A rule fits its host and all subdomains if
    the path starts with the rule's. Of several the longest (host and path together) wins,
    then the longer host, then ``block``. Without a rule the verdict is ``default`` and
    ``rule`` null. A null url, or one without ``://``, has an empty host and path and
    fits no rule but those with both empty. Columns of ``pages`` named like the four new ones
    are replaced; repeated rows and null ids keep one row each; an empty table gives none.
    """
    added = ["host", "path", "rule", "verdict"]
    located = pages.drop(*added).withColumns(
        {"host": url_host(F.col(url)), "path": url_path(F.col(url))}
    )
    places = located.select("host", "path").distinct()
    # no rule fits a suffix or a prefix that is deeper than all rules
    depth = F.coalesce(F.max(n_labels(F.col("host"))), F.lit(1))
    labels = rules.agg(depth).scalar()
    depth = F.coalesce(F.max(n_slashes(F.col("path"))), F.lit(0))
    slashes = rules.agg(depth).scalar()
    known_labels = F.sequence(F.lit(1), F.least(n_labels(F.col("host")), labels))
    known_slashes = F.sequence(F.lit(0), F.least(n_slashes(F.col("path")), slashes))
    keys = places.select("host", "path", F.explode(known_labels).alias("labels"))
    keys = keys.withColumn("slashes", F.explode(known_slashes)).select(
        "host",
        "path",
        host_suffix(F.col("host"), F.col("labels")).alias("suffix"),
        path_prefix(F.col("path"), F.col("slashes")).alias("folder"),
    )
    keys = keys.withColumn("full", digest(F.col("suffix"), F.col("folder")))
    keys = keys.withColumn("short", F.substring("full", 1, PREFIX_DIGITS))
    folder = F.regexp_extract("path", r"(?s)^(.*/)", 1)
    known = rules.select(
        F.col("verdict").alias("rule_verdict"),
        F.col("host").alias("rule_host"),
        F.col("path").alias("rule_path"),
        digest(F.col("host"), folder).alias("rule_full"),
    ).distinct()
    known = known.withColumn("short", F.substring("rule_full", 1, PREFIX_DIGITS))
    fits = keys.join(known, "short").filter(
        (F.col("full") == F.col("rule_full"))
        & (F.col("suffix") == F.col("rule_host"))
        & F.col("path").startswith(F.col("rule_path"))
    )
    rank = F.struct(
        F.length(F.concat("rule_host", "rule_path")),
        F.length("rule_host"),
        (F.col("rule_verdict") == "block").cast("int"),
        F.col("rule_verdict"),
    )
    best = fits.groupBy("host", "path").agg(
        F.max_by(
            F.struct(F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict"), rank
        ).alias("best")
    )
    return located.join(best, ["host", "path"], "left").select(
        *[c for c in pages.columns if c.lower() not in added],
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
