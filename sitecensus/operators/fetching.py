"""Fetch policies as relations: redirect chains out of single responses, and the next request of each URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.fixed import REDIRECT_STATUS
from ..sources.writers import staged
from . import site

MOST_REDIRECTS = 10
#: Milliseconds: the back-off for each try so far, and the longest times that a second and a plain-http try get.
BACK_OFF, RETRY_TIME, PLAIN_TIME = 150, 4_000, 3_000


def redirect_hops(responses: DataFrame) -> DataFrame:
    """responses: url, status, location, error (one row a URL). url and target of those that send on to another URL."""
    moved = responses.where(F.col("status").isin(*REDIRECT_STATUS) & (F.coalesce("location", F.lit("")) != ""))
    target = F.when(F.col("location").rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("location")).otherwise(site.absolute_url(F.col("location"), F.col("url")))
    return moved.select("url", target.alias("target"))


def redirect_chains(responses: DataFrame, most: int = MOST_REDIRECTS) -> DataFrame:
    """url, chain: of each URL that redirects, the URLs it leads to, in order and ``most`` at most (also around a cycle).

    Pointer doubling: each round puts behind every chain the one of its last URL, so that log2(most) joins do. Chains
    that have ended, or have their full length, take no part in a join any more; each round ends in a table."""
    chains = staged(redirect_hops(responses).select("url", F.array("target").alias("chain")), "chains")
    for _ in range((most - 1).bit_length()):
        last = F.when(F.size("chain") < most, F.element_at("chain", -1))
        more = chains.select(F.col("url").alias("last"), F.col("chain").alias("more"))
        longer = F.slice(F.concat("chain", F.coalesce("more", F.array().cast("array<string>"))), 1, most)
        chains = staged(chains.withColumn("last", last).join(more, "last", "left").select("url", longer.alias("chain")), "chains")
    return chains


def followed(urls: DataFrame, responses: DataFrame, most: int = MOST_REDIRECTS) -> DataFrame:
    """urls: url, asked with redirects followed. url, http_active, http_status, final_url, redirect_count, redirect_chain, error.

    The redirect number ``most`` is not followed: its target ends the chain, and the response that sent there counts.
    A URL without a response, at first or later, has an error and nothing else. Repeated responses: the smallest counts."""
    single = responses.groupBy("url").agg(F.min(F.struct("status", "location", "error")).alias("r")).select("url", "r.*")
    single = staged(single, "responses")
    asked = urls.join(redirect_chains(single, most), "url", "left")
    chain = F.concat(F.array("url"), F.coalesce("chain", F.array().cast("array<string>")))
    count = F.size("chain") - 1
    asked = asked.withColumn("chain", chain).withColumn("final_url", F.element_at("chain", F.when(count >= most, most).otherwise(count + 1)))
    end = single.select(F.col("url").alias("final_url"), F.col("status").alias("http_status"), "error", F.lit(True).alias("known"))
    there = F.col("http_status").isNotNull()
    return asked.join(end, "final_url", "left").select(
        "url",
        F.coalesce(C.site_active(F.col("http_status")), F.lit(False)).alias("http_active"),
        "http_status",
        F.when(there, F.col("final_url")).alias("final_url"),
        F.when(there, count).otherwise(0).alias("redirect_count"),
        F.when(there & (count > 0), F.col("chain")).alias("redirect_chain"),
        F.when(F.col("known").isNull(), "not fetched").otherwise(F.col("error")).alias("error"),
    )


TRY = "url string, seq int, via string, status int, final_url string, body string, error string"


def next_requests(urls: DataFrame, tries: DataFrame, attempts: int = 1, timeout_ms: int = 15_000, browser: str = "no") -> DataFrame:
    """The request to make next for each URL that has no outcome yet, from the tries made so far (TRY).

    url, seq, via (direct, plain, browser), request_url, timeout_ms, wait_ms (before it), fresh (on a new connection). URLs
    that need no more requests have no row: ``site.chosen_fetches`` gives their outcome. browser: no, fallback (if the
    other ways gave no page) or only. A back-off that would take the whole timeout ends the direct tries."""
    of = lambda via, x: F.when(F.col("via") == via, x)
    one = F.struct("status", "body", "error")
    so_far = tries.groupBy("url").agg(
        *(F.count_if(F.col("via") == via).alias(f"n_{via}") for via in ("direct", "plain", "browser")),
        F.max_by(of("direct", one), of("direct", F.col("seq"))).alias("direct"),
        F.max_by(of("plain", one), of("plain", F.col("seq"))).alias("plain"),
        F.count("*").alias("n"),
    )
    state = urls.select("url").distinct().join(so_far, "url", "left")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("int")
    raw, made = C.with_scheme(F.col("url")), n("n_direct")
    again = (made < attempts) & C.fetch_retry(F.col("direct.error")) & (made * BACK_OFF < timeout_ms)
    downgrade = C.http_downgrade(raw, F.col("direct.error"))
    way: Column = F.when((made == 0) | again, "direct").when(downgrade.isNotNull() & (n("n_plain") == 0), "plain")
    if browser != "no":
        got_plain = downgrade.isNotNull() & F.col("plain").isNotNull() & ((F.coalesce("plain.status", F.lit(0)) != 0) | F.col("plain.error").isNull())
        result = F.when(got_plain, F.col("plain")).otherwise(F.col("direct"))
        asked = F.when((n("n_browser") == 0) & (F.lit(browser == "only") | site.poor_fetch(result)), "browser")
        way = asked if browser == "only" else F.coalesce(way, asked)
    plan = state.select("url", n("n").alias("seq"), way.alias("via"), raw.alias("raw"), downgrade.alias("downgrade"), made.alias("made")).where("via is not null")
    direct, is_plain = F.col("via") == "direct", F.col("via") == "plain"
    second = direct & (F.col("made") > 0)
    return plan.select(
        "url",
        "seq",
        "via",
        F.when(is_plain, F.col("downgrade")).otherwise(F.col("raw")).alias("request_url"),
        F.when(second, min(timeout_ms, RETRY_TIME)).when(is_plain, min(timeout_ms, PLAIN_TIME)).otherwise(timeout_ms).alias("timeout_ms"),
        F.when(second, F.col("made") * BACK_OFF).otherwise(0).alias("wait_ms"),
        (second | is_plain).alias("fresh"),
    )


def replay(urls: DataFrame, answers: DataFrame, attempts: int = 1, timeout_ms: int = 15_000, browser: str = "no") -> DataFrame:
    """The tries (TRY) that the policy makes of urls until none has a next request.

    answers: request_url, via, n (the URL's so-manieth request by that way, from 0), status, final_url, body, error; a
    request without an answer fails. A round asks all open URLs at once; there are attempts + 2 at most."""
    tries = urls.sparkSession.createDataFrame([], TRY)
    answers = answers.select(F.col("request_url"), "via", F.col("n").cast("int").alias("n"), "status", "final_url", "body", "error", F.lit(True).alias("known"))
    for _ in range(attempts + 2):
        asked = next_requests(urls, tries, attempts, timeout_ms, browser)
        before = tries.groupBy("url", "via").agg(F.count("*").cast("int").alias("n"))
        asked = asked.join(before, ["url", "via"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
        got = asked.join(answers, ["request_url", "via", "n"], "left")
        error = F.when(F.col("known").isNull(), "not fetched").otherwise(F.col("error"))
        new = staged(got.select("url", "seq", "via", F.coalesce("status", F.lit(0)).alias("status"), "final_url", "body", error.alias("error")), "tries")
        if new.isEmpty():
            break
        tries = tries.unionByName(new)
    return tries
