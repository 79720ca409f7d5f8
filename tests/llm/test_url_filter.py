from sitecensus.llm import url_filter

URLS = [
    (1, "https://www.example.com/en/71?x"), (2, "http://EXAMPLE.com/en/8#top"), (3, "https://a.net/de/x"), (4, "https://b.example.net/de/88"), (5, "https://x.org/es/"),
    (6, "https://x.org/en/"), (7, None), (8, "no scheme"), (9, "https://com/en/"), (10, "https://notcom/en/"), (11, "https://example.com"), (12, "ftp://example.com/EN/7"), (13, "x://" + "a." * 3000 + "com/en/1"),
    (13, "https://x.org/es/"), (14, "://.com/en/"),
]


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_matches_brute_force(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").selectExpr("*", "'mine' AS fit", "1 AS key", "2 AS host")
    got = url_filter.judge_urls(pages, url_filter.RULES)
    rows = {(r.page_id, r.url): (r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    assert rows == {(i, u): brute(u, url_filter.RULES) for i, u in URLS}
    assert {"fit", "key"} <= set(got.columns)


def test_no_pages_and_no_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    assert url_filter.judge_urls(pages.where("false"), url_filter.RULES).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, []).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe_with_many_levels(spark):
    listed = [f"k{i}" for i in range(0, 600, 6)]
    keys = lambda names: spark.createDataFrame([(n,) for n in names], "key string")
    cascade = url_filter.build_cascade(keys(listed), keys([f"k{i}" for i in range(600)]), 600, min_bits=8, first_rate=0.5)
    assert len(cascade.levels) > 2
    from pyspark.sql import functions as F

    held = {r.key for r in keys([f"k{i}" for i in range(600)]).where(cascade.holds(F.col("key"))).collect()}
    assert held == set(listed)
