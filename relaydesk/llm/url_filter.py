"""URL rules by hashed host-suffix and path-prefix expressions.

A rule names a host and the start of a path. It fits the host and all its
subdomains if the path of the URL starts with the rule's, and the longest rule
that fits decides. Each URL is expanded into the expressions a rule for it
could have: every suffix of the host at a dot with every prefix of the path
whose length some rule has. Expressions meet rules in an equi-join on the first
four bytes of their SHA-256 digests; the full digests confirm a meeting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# rules up to this number are broadcast; more are joined by shuffling
BROADCAST_RULES = 100_000
HASH_PREFIX = 8  # hexadecimal digits

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict)."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def judge(urls: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """Rows (key, url, host, path, rule, verdict) of ``urls``, one for each row.

    ``rules`` has host, path and verdict; rows with a null in them or an empty
    host are no rules. Of two rules for the same host and path a ``block``
    stands, else the last verdict in the order of text. Where no rule fits,
    ``rule`` is null and the verdict is ``default``. A null URL or one without
    ``://`` has an empty host and path, which no rule fits. Repeated rows are
    judged alike; other columns of ``urls`` are left out.
    """
    known = (
        rules.select(
            F.translate("host", UPPER, LOWER).alias("_host"), F.col("path").alias("_path"), F.col("verdict").alias("_v")
        )
        .where(F.col("_host").isNotNull() & (F.col("_host") != "") & F.col("_path").isNotNull() & F.col("_v").isNotNull())
        .groupBy("_host", "_path")
        .agg(F.max(F.struct((F.col("_v") == "block").alias("block"), F.col("_v").alias("v")))["v"].alias("_verdict"))
        # NUL ends the host, so that host and path can't be divided in another way
        .withColumn("_digest", F.sha2(F.concat("_host", F.lit("\0"), "_path"), 256))
        .withColumn("_prefix", F.substring("_digest", 1, HASH_PREFIX))
        .select("_digest", "_prefix", "_verdict", F.length("_path").alias("_length"))
    )
    sizes = known.agg(F.count("*").alias("n"), F.collect_set("_length").alias("lengths")).first()
    if sizes["n"] <= BROADCAST_RULES:
        known = F.broadcast(known)
    lengths = F.lit(sorted(sizes["lengths"])) if sizes["lengths"] else F.array().cast("array<int>")

    rows = urls.select(F.col(key), F.col(url).cast("string").alias(url))
    parsed = rows.select(key, url, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
    )
    met = (
        parsed.where(F.col("host") != "")
        .distinct()
        .withColumn("_suffix", F.explode(suffixes))
        .withColumn("_start", F.explode(prefixes))
        .withColumn("_full", F.sha2(F.concat("_suffix", F.lit("\0"), "_start"), 256))
        .withColumn("_prefix", F.substring("_full", 1, HASH_PREFIX))
        .join(known.select("_prefix", "_digest", "_verdict"), "_prefix")
        .where(F.col("_full") == F.col("_digest"))
        .groupBy(F.col(key).alias("_key"), F.col(url).alias("_url"))
        # host suffixes of one host and prefixes of one path: equal lengths are equal expressions
        .agg(
            F.max_by(
                F.struct(F.concat("_suffix", "_start").alias("rule"), F.col("_verdict").alias("verdict")),
                F.struct(F.length("_suffix") + F.length("_start"), F.length("_suffix")),
            ).alias("_best")
        )
    )
    return parsed.join(met, F.col(key).eqNullSafe(F.col("_key")) & (F.col(url) == F.col("_url")), "left").select(
        key, url, "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict")
    )
