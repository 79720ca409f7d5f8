"""Hosts and the domains above them: a join on suffixes that begin at a dot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.writers import staged

#: Share of all suffixes from which on one is hot; so there are fewer than its inverse.
HOT_SHARE = 1 / 1000


def plain_host(host: Column) -> Column:
    """Lower-cased, without white space around it and the dot of the root at its end."""
    return F.regexp_replace(F.lower(F.trim(host)), r"\.$", "")


def suffixes(host: Column, most: int) -> Column:
    """The host's endings of 1 to ``most`` labels, the host itself among them if it has no more."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most))), lambda n: F.array_join(F.slice(labels, -n, n), "."))


def with_domain(hosts: DataFrame, domains: DataFrame, max_broadcast_rows: int = 200_000) -> DataFrame:
    """hosts (host, other columns) with ``matched``: the longest of domains (domain) that is the host or ends it after a dot; or null.

    Case, white space around names and a last dot do not count; null and empty names match nothing, and repeated domains count
    once. The distinct hosts' endings, of no more labels than the longest domain has, meet the domains by equality. Up to
    ``max_broadcast_rows`` domains are broadcast. More of them are shuffled; then endings that make up a thousandth of all
    (``uk``, say, under a third of all hosts) meet theirs, fewer than a thousand, by broadcast, as they would fill one task.
    """
    listed = domains.select(plain_host(F.col("domain")).alias("suffix_")).where("suffix_ <> ''").distinct()
    most, n = listed.agg(F.max(F.size(F.split("suffix_", r"\."))), F.count("*")).first()
    keyed = hosts.withColumn("host_", plain_host(F.col("host")))
    ended = keyed.select("host_").where("host_ <> ''").distinct().select("host_", F.explode(suffixes(F.col("host_"), most or 1)).alias("suffix_"))
    if n <= max_broadcast_rows:
        met = ended.join(F.broadcast(listed), "suffix_")
    else:
        ended = staged(ended, "suffixes")
        counts = ended.groupBy("suffix_").agg(F.count("*").alias("n_"))
        hot = staged(counts.where(F.col("n_") > ended.count() * HOT_SHARE).select("suffix_"), "hot-suffixes")
        listed_hot = hot.join(listed, "suffix_")
        met = ended.join(F.broadcast(listed_hot), "suffix_").unionByName(ended.join(F.broadcast(hot), "suffix_", "left_anti").join(listed.hint("shuffle_hash"), "suffix_"))
    longest = met.groupBy("host_").agg(F.max_by("suffix_", F.length("suffix_")).alias("matched"))
    return keyed.join(longest, "host_", "left").drop("host_")
