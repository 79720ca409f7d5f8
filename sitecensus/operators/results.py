"""Scan results: merging, counters, roll-ups and rates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.columns import instant, site_active

COUNTERS = ["total", "processed", "remaining", "active", "inactive", "errors", "ats_traceable", "has_email", "company_number", "careers_page"]


def domains(results: DataFrame, active: bool) -> DataFrame:
    """Distinct domains with a result of that kind; a domain may be in both lists."""
    return results.where(F.col("http_active") if active else ~F.coalesce("http_active", F.lit(False))).select("domain").distinct()


def status_counts(results: DataFrame, missing: str | None = None) -> DataFrame:
    """status (text), n; rows without a status count under ``missing``, or not at all."""
    status = F.col("http_status").cast("string")
    counted = results.select((F.coalesce(status, F.lit(missing)) if missing else status).alias("status")).where("status is not null")
    return counted.groupBy("status").agg(F.count("*").alias("n"))


def summary(results: DataFrame) -> DataFrame:
    """One row: tested, dns_active, http_active, inactive, average_response_ms, status_counts. Raw rows count, not domains.

    Sums and histogram come from one grouping by status."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    parts = results.groupBy(F.col("http_status").cast("string").alias("status")).agg(
        F.count("*").alias("n"), F.count_if(flag("dns_active")).alias("dns"), F.count_if(flag("http_active")).alias("http"), F.sum(F.coalesce("response_ms", F.lit(0.0))).alias("ms")
    )
    histogram = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("status").isNotNull(), F.struct("status", "n")))))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return parts.agg(
        zero(F.sum("n")).alias("tested"),
        zero(F.sum("dns")).alias("dns_active"),
        zero(F.sum("http")).alias("http_active"),
        (zero(F.sum("n")) - zero(F.sum("http"))).alias("inactive"),
        F.coalesce(F.sum("ms") / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0)).alias("average_response_ms"),
        histogram.alias("status_counts"),
    )


def truthy(value: Column) -> Column:
    """Text that is there: not null, blank, or an empty JSON list or object. The text null is there."""
    bare = F.trim(value)
    empty_json = bare.rlike(r"^(\[\s*\]|\{\s*\})$")
    return F.coalesce((bare != "") & ~empty_json, F.lit(False))


def run_counters(records: DataFrame, *by: str) -> DataFrame:
    """Counters of extraction records (input_url, active, error, ats_traceable, email, new_emails, extra_info, careers_page,
    http_status, pos), in one row or one for each value of ``by``. A company number is in extra_info or, where there is such a
    column, in company_number."""
    flag = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    number = truthy(F.get_json_object("extra_info", "$.company_number"))
    if "company_number" in records.columns:
        number = number | truthy(F.col("company_number"))
    return records.groupBy(*by).agg(
        F.count("*").alias("processed"),
        flag(F.col("active")).alias("active"),
        (F.count("*") - flag(F.col("active"))).alias("inactive"),
        flag(truthy(F.col("error"))).alias("errors"),
        flag(F.col("ats_traceable")).alias("ats_traceable"),
        flag(truthy(F.col("email")) | truthy(F.col("new_emails"))).alias("has_email"),
        flag(number).alias("company_number"),
        flag(truthy(F.col("careers_page"))).alias("careers_page"),
        F.max_by("input_url", "pos").alias("last_domain"),
    )


def platform_histogram(records: DataFrame) -> DataFrame:
    """platform, n_any, n_primary for each known platform, 0 included. records: website_platforms, website_platform."""
    known = records.sparkSession.createDataFrame([(p,) for p in fixed.PLATFORMS], "platform string")
    used = records.select(F.explode("website_platforms").alias("platform")).groupBy("platform").agg(F.count("*").alias("n_any"))
    first = records.groupBy(F.col("website_platform").alias("platform")).agg(F.count("*").alias("n_primary"))
    return known.join(used, "platform", "left").join(first, "platform", "left").fillna(0, ["n_any", "n_primary"])


def combined(states: DataFrame) -> DataFrame:
    """One row over the machines that are available: sums, status, earliest start (of all machines), rate, time left."""
    there = F.coalesce(F.col("available"), F.lit(False))
    total = lambda c: F.coalesce(F.sum(F.when(there, F.col(c))), F.lit(0))
    rate = total("rate_per_second").cast("double")
    done = F.coalesce(F.bool_and(F.when(there, F.coalesce(F.col("status") == "complete", F.lit(False)))), F.lit(True)) & (F.count("*") > 0)
    return states.agg(
        F.coalesce(F.bool_or(there), F.lit(False)).alias("available"),
        F.when(done, "complete").otherwise("running").alias("status"),
        *(total(c).cast("long").alias(c) for c in COUNTERS if c in states.columns),
        rate.alias("rate_per_second"),
        F.min("started_at").alias("started_at"),
        (total("remaining") / F.nullif(rate, F.lit(0.0))).alias("eta_seconds"),
    )


def map_sums(states: DataFrame, column: str) -> DataFrame:
    """key, n: the maps of all available machines, added up by key."""
    return states.where("available").select(F.explode(column).alias("key", "n")).groupBy("key").agg(F.sum("n").alias("n"))


def with_rates(states: DataFrame, processed: str, total: str, seconds: str) -> DataFrame:
    """states with remaining, rate_per_second and eta_seconds (null when nothing is left or nothing moves)."""
    rate = F.col(processed) / F.greatest(F.col(seconds), F.lit(0.001))
    left = F.greatest(F.col(total) - F.col(processed), F.lit(0))
    return states.withColumns({"remaining": left, "rate_per_second": rate, "eta_seconds": F.when((left > 0) & (rate > 0), left / rate)})


def with_timing(states: DataFrame, now: Column) -> DataFrame:
    """states (started_at: text, rate_per_second, remaining) with elapsed_seconds (0 before the start, or if it is unknown),
    eta_seconds and eta_at (a timestamp; both null when nothing is left or nothing moves)."""
    at, rate, left = now.cast("double"), F.coalesce("rate_per_second", F.lit(0.0)), F.coalesce("remaining", F.lit(0))
    elapsed = F.coalesce(F.greatest(at - instant(F.col("started_at")).cast("double"), F.lit(0.0)), F.lit(0.0))
    timed = states.withColumns({"elapsed_seconds": elapsed, "eta_seconds": F.when((rate > 0) & (left > 0), left / rate)})
    return timed.withColumn("eta_at", (at + F.col("eta_seconds")).cast("timestamp"))


def shards_complete(states: DataFrame) -> DataFrame:
    """One row: shards, complete (all of them, with the expected sizes), processed, expected."""
    fine = F.coalesce((F.col("status") == "complete") & (F.col("processed") == F.col("expected")), F.lit(False))
    return states.agg(F.count("*").alias("shards"), F.coalesce(F.bool_and(fine), F.lit(False)).alias("complete"), F.sum("processed").alias("processed"), F.sum("expected").alias("expected"))


def latest_push(pushes: DataFrame, now: Column, ttl_seconds: int = 20) -> DataFrame:
    """machine, payload, fresh: the latest push of each machine and whether it is young enough to be used."""
    latest = pushes.where((F.octet_length("payload") <= 1_000_000) & F.col("payload").rlike(r"^\s*\{")).groupBy("machine").agg(F.max_by("payload", "at").alias("payload"), F.max("at").alias("at"))
    return latest.withColumn("fresh", F.unix_timestamp(now) - F.unix_timestamp("at") <= ttl_seconds).drop("at")


def conditional_status(results: DataFrame) -> DataFrame:
    """results with http_active recomputed from the status."""
    return results.withColumn("http_active", site_active(F.col("http_status")))


def union_files(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
