"""Fetch policies, versioned tables and incremental counters."""

import time

import pytest
from pyspark.sql import functions as F

from sitecensus.functions import columns as C
from sitecensus.functions import markers
from sitecensus.operators import fetching, site
from sitecensus.plans import views
from sitecensus.sources import incremental
from sitecensus.sources.versions import LostRace, Store

RESPONSE = "url string, status int, location string, error string"


def test_redirects_are_followed_ten_times_at_most(spark):
    rows = [(f"https://a.uk/{i}", 302, f"https://a.uk/{i + 1}", None) for i in range(12)] + [("https://a.uk/12", 200, None, None)]
    rows += [("https://loop.uk/", 301, "/x", None), ("https://loop.uk/x", 308, "//loop.uk/", None), ("https://self.uk", 301, "https://self.uk", None)]
    rows += [("https://dead.uk", 301, "https://gone.uk/", None), ("https://err.uk", None, None, "tls: bad"), ("https://to-err.uk", 303, "https://err.uk", None), ("https://same.uk", 304, "https://a.uk/12", None), ("https://no.uk", 301, "", None)]
    responses = spark.createDataFrame([*rows, ("https://same.uk", 500, None, None)], RESPONSE)
    urls = spark.createDataFrame([(r[0],) for r in rows] + [("https://new.uk",)], "url string")
    found = {r.url: r for r in fetching.followed(urls, responses).collect()}
    assert len(found) == len(rows) + 1
    chain = [f"https://a.uk/{i}" for i in range(13)]
    for i in range(13):
        row, count = found[chain[i]], min(10, 12 - i)
        # the tenth redirect is not followed: the one before its target counts
        end, status = (chain[i + 9], 302) if count == 10 else (chain[12], 200)
        assert (row.redirect_count, row.redirect_chain, row.final_url, row.http_status) == (count, chain[i : i + count + 1] if count else None, end, status)
    loop = found["https://loop.uk/"]
    assert loop.redirect_chain == ["https://loop.uk/", "https://loop.uk/x"] * 5 + ["https://loop.uk/"]
    assert (loop.redirect_count, loop.final_url, loop.http_status, loop.http_active) == (10, "https://loop.uk/x", 308, True)
    assert found["https://self.uk"].redirect_chain == ["https://self.uk"] * 11
    told = {u: (found[u].http_status, found[u].final_url, found[u].redirect_count, found[u].error) for u in ("https://dead.uk", "https://err.uk", "https://to-err.uk", "https://same.uk", "https://no.uk", "https://new.uk")}
    assert told == {
        "https://dead.uk": (None, None, 0, "not fetched"),
        "https://err.uk": (None, None, 0, "tls: bad"),
        "https://to-err.uk": (None, None, 0, "tls: bad"),
        "https://same.uk": (304, "https://same.uk", 0, None),
        "https://no.uk": (301, "https://no.uk", 0, None),
        "https://new.uk": (None, None, 0, "not fetched"),
    }


@pytest.mark.parametrize("most", [1, 2, 5])
def test_other_caps(spark, most):
    rows = [(f"u{i}", 301, f"x://u{i + 1}", None) for i in range(3)]
    rows = [("x://" + u, s, t, e) for u, s, t, e in rows] + [("x://u3", 200, None, None)]
    row = next(r for r in fetching.followed(spark.createDataFrame([("x://u0",)], "url string"), spark.createDataFrame(rows, RESPONSE), most).collect())
    assert row.redirect_chain == [f"x://u{i}" for i in range(min(most, 3) + 1)]
    assert row.final_url == ("x://u3" if most > 3 else f"x://u{most - 1}")


def requests(spark, tries, **policy):
    urls = spark.createDataFrame([("b.uk",)], "url string")
    rows = [("b.uk", i, *t) for i, t in enumerate(tries)]
    found = fetching.next_requests(urls, spark.createDataFrame(rows, fetching.TRY), **policy).collect()
    return [(r.seq, r.via, r.request_url, r.timeout_ms, r.wait_ms, r.fresh) for r in found]


def test_the_next_request(spark):
    failed = lambda error, via="direct": (via, 0, None, None, error)
    page = lambda via="direct", status=200, body="x": (via, status, "https://b.uk/", body, None)
    assert requests(spark, []) == [(0, "direct", "https://b.uk", 15_000, 0, False)]
    assert requests(spark, [page()]) == []
    assert requests(spark, [failed("timeout")]) == []  # one attempt
    assert requests(spark, [failed("timeout")], attempts=3) == [(1, "direct", "https://b.uk", 4_000, 150, True)]
    assert requests(spark, [failed("timeout")] * 2, attempts=3, timeout_ms=2_000) == [(2, "direct", "https://b.uk", 2_000, 300, True)]
    assert requests(spark, [failed("timeout")] * 2, attempts=3, timeout_ms=300) == []  # the back-off takes the whole time
    assert requests(spark, [failed("certificate unknown")], attempts=3) == []
    assert requests(spark, [failed("EOF")]) == [(1, "plain", "http://b.uk", 3_000, 0, True)]
    assert requests(spark, [failed("EOF"), failed("EOF", "plain")]) == []
    assert requests(spark, [failed("no such host: eof")], browser="fallback") == [(1, "browser", "https://b.uk", 15_000, 0, False)]
    assert requests(spark, [failed("EOF"), page("plain")], browser="fallback") == []
    assert requests(spark, [failed("EOF"), page("plain", 403)], browser="fallback")[0][1] == "browser"
    assert requests(spark, [page(body=" ")], browser="fallback")[0][1] == "browser"
    assert requests(spark, [page(body=" "), failed("closed", "browser")], browser="fallback") == []
    assert requests(spark, [], browser="only") == [(0, "browser", "https://b.uk", 15_000, 0, False)]
    assert requests(spark, [failed("closed", "browser")], browser="only") == []
    urls = spark.createDataFrame([("b.uk",)], "url string")
    only = fetching.replay(urls, spark.createDataFrame([], "request_url string, via string, n int, status int, final_url string, body string, error string"), browser="only")
    assert [(r.via, r.error, r.tries) for r in site.chosen_fetches(only).collect()] == [("browser", "not fetched", 1)]


def test_replayed_tries_give_the_outcome_of_given_ones(spark):
    """The tries of the fetch queries' inline rows, asked one by one, are those rows again."""
    tries = spark.createDataFrame(views.TRIES, "url string, seq int, via string, status int, final_url string, body string, error string")
    plain = F.when(F.col("via") == "plain", F.regexp_replace("url", "^https", "http")).otherwise(F.col("url"))
    n = F.expr("row_number() over (partition by url, via order by seq) - 1").alias("n")
    answers = tries.select(plain.alias("request_url"), "via", n, "status", "final_url", "body", "error")
    urls = tries.select("url").distinct()
    outcome = lambda rows: {r.url: tuple(r)[1:6] for r in site.chosen_fetches(rows).collect()}
    for attempts, of in ((1, urls.where("url = 'https://c.uk'")), (2, urls.where("url <> 'https://c.uk'"))):  # that one was asked directly once
        found = outcome(fetching.replay(of, answers, attempts=attempts, browser="fallback"))
        assert found == outcome(tries.join(of, "url"))


def test_probe_takes_the_last_error_and_follows_redirects(spark):
    answers = {
        "https://a.uk": {"error": "tls: bad"}, "http://a.uk": {"error": "connection refused"},
        "https://b.uk": {"error": "tls: bad"}, "http://b.uk": {"status": 301, "location": "/x"}, "http://b.uk/x": {"status": 200},
        "https://c.uk": {"status": 302, "location": "https://c.uk"},
        "https://d.uk": {"status": 302, "location": "https://e.uk/"}, "https://e.uk/": {"error": "EOF"}, "http://d.uk": {"status": 204},
    }
    domains = spark.createDataFrame([(f"{c}.uk",) for c in "abcd"], "domain string")
    began = time.time()
    rows = {r.domain: r for r in site.probe(domains.coalesce(1), lambda url: answers[url], back_off=0.3).collect()}
    assert {d: (r.http_status, r.error, r.attempts) for d, r in rows.items()} == {"a.uk": (None, "connection refused", 2), "b.uk": (200, "tls: bad", 1), "c.uk": (302, None, 1), "d.uk": (204, "EOF", 1)}
    assert rows["a.uk"].response_ms >= 300 and time.time() - began >= 0.3 and rows["b.uk"].response_ms < 300
    assert (rows["b.uk"].redirect_chain, rows["b.uk"].final_url, rows["b.uk"].redirect_count) == (["http://b.uk", "http://b.uk/x"], "http://b.uk/x", 1)
    assert (rows["c.uk"].redirect_chain, rows["c.uk"].final_url, rows["c.uk"].http_active) == (["https://c.uk"] * 11, "https://c.uk", True)
    assert (rows["a.uk"].redirect_chain, rows["d.uk"].redirect_chain) == (None, None)


def keys(frame):
    return sorted(r.k for r in frame.select("k").collect())


def test_a_failed_move_changes_nothing(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    assert store.snapshot() == (0, {})
    store.commit({"queue": spark.range(10).select(F.col("id").alias("k"), F.when(F.col("id") > 0, F.col("id") % 2).alias("odd"))}, 0)
    monkeypatch.setattr(store, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost before the rename")))
    with pytest.raises(OSError, match="lost before"):
        store.move("queue", "done", F.col("odd") == 1)
    monkeypatch.undo()
    version, tables = Store(spark, str(tmp_path)).snapshot()
    assert version == 1 and set(tables) == {"queue"} and keys(tables["queue"]) == list(range(10))
    assert store.move("queue", "done", F.col("odd") == 1) == 2
    store.move("queue", "done", F.col("k") < 4)
    tables = store.snapshot()[1]
    assert keys(tables["queue"]) == [4, 6, 8] and keys(tables["done"]) == [0, 1, 2, 3, 5, 7, 9]  # a null condition does not move
    assert store.clean(keep=1) >= 3 and keys(store.snapshot()[1]["done"]) == [0, 1, 2, 3, 5, 7, 9]


def test_a_lost_race_is_seen_and_run_again(spark, tmp_path):
    one, other = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    one.commit({"t": spark.range(1).toDF("k")}, 0)
    with pytest.raises(LostRace):
        other.commit({"t": spark.range(5).toDF("k")}, 0)
    assert keys(one.snapshot()[1]["t"]) == [0]
    calls = []

    def change(tables):
        if not calls:
            one.update(lambda t: {"t": t["t"].unionByName(spark.range(10, 11).toDF("k"))})  # faster
        calls.append(1)
        return {"t": tables["t"].unionByName(spark.range(20, 21).toDF("k"))}

    assert other.update(change) == 3 and len(calls) == 2
    assert keys(one.snapshot()[1]["t"]) == [0, 10, 20]


def test_only_changed_files_are_read(spark, tmp_path):
    folder, store = tmp_path / "in", Store(spark, str(tmp_path / "store"))
    folder.mkdir()
    read = []

    def count(lines):
        seen = lines.groupBy("path").agg(F.count("*").alias("n"))
        read.extend(r.path.rsplit("/", 1)[1] for r in seen.collect())
        return seen

    def run():
        read.clear()
        counts, kinds = incremental.refresh(spark, str(folder), store, count)
        return {r.path.rsplit("/", 1)[1]: r.n for r in counts.collect()}, sorted(read), kinds

    assert run() == ({}, [], {"new": 0, "changed": 0, "same": 0, "gone": 0})
    (folder / "a").write_text("1\n2\n")
    (folder / "b").write_text("1\n")
    assert run() == ({"a": 2, "b": 1}, ["a", "b"], {"new": 2, "changed": 0, "same": 0, "gone": 0})
    assert run() == ({"a": 2, "b": 1}, [], {"new": 0, "changed": 0, "same": 2, "gone": 0})
    (folder / "a").write_text("1\n2\n3\n")
    (folder / "c").write_text("1\n")
    assert run() == ({"a": 3, "b": 1, "c": 1}, ["a", "c"], {"new": 1, "changed": 1, "same": 1, "gone": 0})
    (folder / "b").unlink()
    assert run() == ({"a": 3, "c": 1}, [], {"new": 0, "changed": 0, "same": 2, "gone": 1})


def test_markers_in_one_pass_are_those_of_each_alone(spark):
    rows = [(i, url, html) for i, url, html in views.MARKED_PAGES]
    pieces = ["WP-Content", "&lt;meta generator wordpress", "generator wordpress", "x /_dm/y", "x/_dm", "dmapi", "xdmapi", "duda-site", "GoDaddy lander", "godaddy", "renew", "parked&#32;by", "location.href='/lander'", "location.replace('/parking')", "relocation", "hs_cos_wrapper data-hs-cos-", "İwix-thunderbolt", "shopify."]
    rows += [(100 + i, "https://x.uk/", f"<p>{a} {b}</p>") for i, (a, b) in enumerate((a, b) for a in pieces for b in pieces)] + [(9_999, None, None)]
    page = site.with_marks(spark.createDataFrame(rows, "page_id long, url string, html string"))
    decoded, marks, url = F.col("decoded"), F.col("marks"), F.col("url")
    both = page.select(
        "page_id",
        (C.platform_scores(decoded) == markers.platform_scores(marks, decoded)).alias("scores"),
        (C.platforms(decoded) == markers.platforms(marks, decoded)).alias("platforms"),
        (C.parked(decoded, url) == markers.parked(marks, decoded, url)).alias("parked"),
        C.parked(decoded, url).alias("is_parked"),
    ).collect()
    assert len(both) == len(rows) and all(r.scores and r.platforms and r.parked for r in both)
    assert 0 < sum(r.is_parked for r in both) < len(both)

