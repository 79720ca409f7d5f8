import os
import random
import time

import pytest

from sitecensus.llm import html_extract

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x = "</p>";</script></head><body><header><h2>Site</h2></header>
<nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Title {n} &amp; more</h1><p>First   paragraph<br>of <b>page</b> {n}.<p>Second &eacute;&#33; &lt;b&gt;<div class="ad">Buy</div><p>Shared passage of many pages.</p>
<form><input></form><section class="comments"><p>A reader says hi</p></section></article>
<aside>Side</aside><div id="sidebar"><p>More</p></div><footer>&copy; site</footer></body></html>"""


def test_article_of_a_page():
    text = html_extract.main_text(PAGE.format(n=1), lambda key: False)
    assert text == "Title 1 & more\n\nFirst paragraph of page 1.\n\nSecond é! <b>\n\nShared passage of many pages."


def test_templates_of_a_host_are_deleted_where_no_tag_marks_them(spark):
    page = "<html><body><div><p>Great offers every day</p></div><table><tr><td>Call us</table><div><p>Story number {n}</p><p>tells {n} things</p></div></body></html>"
    rows = [(i, f"https://host-a.com/{i}", page.format(n=i)) for i in range(12)] + [(100, "https://host-b.com/1", page.format(n=5))]
    rows += [(200 + i, "https://copies.com/x", page.format(n=1)) for i in range(20)]  # copies of one page are no template
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS keys", "3 AS page")
    for options in ({}, {"max_broadcast": 0}):
        got = {r.page_id: r.text for r in html_extract.extract_main_text(frame, **options).collect()}
        assert got[3] == "Story number 3\n\ntells 3 things"
        assert got[100] == "Great offers every day\n\nCall us\n\nStory number 5\n\ntells 5 things"
        assert got[203] == "Great offers every day\n\nCall us\n\nStory number 1\n\ntells 1 things"


def test_templates_are_relative_to_the_pages_of_the_host(spark):
    rows = []
    for i in range(60):  # on 10 of 60 pages by chance: a list item, a table row and a passage; on all: the line on top
        chance = "<ul><li>Free parking</li></ul><table><tr><td>Open daily</td></tr></table>" if i < 10 else ""
        rows.append((i, f"https://large.com/{i}", f"<body><div>On top</div><div>Own {i}</div>{chance}</body>"))
        rows.append((100 + i, f"https://articles.com/{i}", f"<body><article><div>On top</div><p>Own {i}</p>{chance * (i < 10)}{'<ul><li>Often</li></ul>' * (i < 25)}</article></body>"))
    rows += [(200 + i, f"https://small.com/{i}", f"<body><div>On top</div><div>Own {i}</div></body>") for i in range(4)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for options in ({}, {"max_broadcast": 0}):
        got = {r.page_id: r.text for r in html_extract.extract_main_text(frame, **options).collect()}
        assert got[3] == "Own 3\n\nFree parking\n\nOpen daily" and got[30] == "Own 30"
        assert got[103] == "Own 3\n\nFree parking\n\nOpen daily\n\nOften" and got[120] == "Own 20\n\nOften" and got[130] == "Own 30"
        assert got[202] == "Own 2"


def test_words_of_class_and_id_do_not_delete_the_article():
    body = """<h2 id="search-algorithms">Search</h2><p class="ad-hoc">Ad hoc</p><section id="related-work"><p>Related</p></section>
<div class="elementor-widget elementor-widget-text-editor"><p>Widget</p></div><div class="alert"><p>Mind this</p></div><ul id="menu"><li class="menu">Soup</ul>"""
    all_of_it = "Search\n\nAd hoc\n\nRelated\n\nWidget\n\nMind this\n\nSoup"
    none = lambda key: False
    for page in ('<body class="search"><article class="post comments-open">%s</article>', '<div class="has-sidebar"><main id="search">%s</main></div>', '<div role="main" class="widget">%s</div>'):
        assert html_extract.main_text(page % body, none) == all_of_it
    plain = """<h2 id="search-algorithms">Search</h2><p class="ad-hoc">Ad hoc</p><div class="elementor-widget-text-editor">Widget</div>"""
    assert html_extract.main_text(plain, none) == "Search\n\nAd hoc\n\nWidget"
    teaser = '<div class="has-sidebar"><article>Own</article></div><div class="related-posts"><article>Teaser</article></div>'
    assert html_extract.main_text('<div class="no-header">' + teaser.replace("has-sidebar", "x") + "</div>", none) == "Own"
    notice = '<article><p>Text</p><div class="notice">%s</div><div class="x ad">Buy</div><article class="comments">Hi</article></article>'
    recurring = html_extract.parse(notice % "Sale").children[0].children[1].key
    for text, left in (("Sale", "Text"), ("Odd", "Text\n\nOdd")):
        assert html_extract.main_text(notice % text, lambda k: k == recurring, none) == left


def test_edge_cases(spark):
    rows = [(1, None, None), (1, None, None), (2, "x", ""), (None, "u", "plain text"), (3, "u", "<p>un<b>closed &amp &nbsp; <i>tags"), (4, "u", "<" * 500), (5, "u", "<div>" * 3000 + "deep"), (6, "u", "<script>never closed"), (7, "u", "<!-- a -->b<![CDATA[c]]>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [(r.page_id, r.text, r.n_chars) for r in html_extract.extract_main_text(frame).collect()]
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    text = {i: t for i, t, _ in got}
    assert text[1] == text[2] == text[6] == "" and text[None] == "plain text" and text[3] == "unclosed & tags" and text[5] == "deep"
    assert html_extract.extract_main_text(frame.where("false")).count() == 0


def test_a_wrapper_does_not_take_the_article_with_it():
    none = lambda key: False
    article = "<article><p>hello</p></article>"
    for wrapper in ('<div class="no-comments widget">%s</div>', '<div class="widget">%s</div>', '<div id="search">%s</div>', '<div class="sidebar">%s</div>', '<form id="page"><div class="menu">%s</div></form>'):
        assert html_extract.main_text(wrapper % article, none) == "hello"
    assert html_extract.main_text("<form><h1>Title</h1><div>Text</div></form><form><input>Search</form>", none) == "Title\n\nText"
    comments = '<div>Text of the page</div><div class="comments"><article>one</article><article>two</article></div>'
    assert html_extract.main_text(comments, none) == "Text of the page"


@pytest.mark.parametrize("part", ["<div>", "<p><div><span>", "<!--", "<a ", '<a x="', "<script>", "</", "<!", "<li><ul>", "&", '<div class="no-menu">'])
@pytest.mark.parametrize("after", ["", "</b>", "<hr>"])
def test_time_is_linear_in_the_length(part, after):
    n = 200_000 // len(part)
    page = part * n + after * n  # 0.2 MB and more
    began = time.time()
    html_extract.main_text(page, lambda key: False)
    assert time.time() - began < 5


def site_tree(rng, depth, own):
    """A random element as (tag, children); some are the same on many pages of a site, others have a word of their own."""
    tag = rng.choice(["div", "section", "ul", "p", "h2"] if depth else ["p", "h2"])
    if tag in ("p", "h2"):
        return tag, [rng.choice(["about us", "call now", "our shop", f"story {own} {rng.random():.12f}", f"text {own} {rng.random():.12f}"])]
    if tag == "ul":
        return tag, [("li", [rng.choice(["home", "jobs", f"item {own} {rng.random():.12f}"])]) for _ in range(rng.randrange(1, 3))]
    return tag, [site_tree(rng, depth - 1, own) for _ in range(rng.randrange(1, 4))]


def shown(tree):
    return tree if isinstance(tree, str) else f"<{tree[0]}>" + "".join(map(shown, tree[1])) + f"</{tree[0]}>"


def subtrees(tree):
    return set() if isinstance(tree, str) else {shown(tree)}.union(*map(subtrees, tree[1]))


def plain_text(tree, gone, kept=("body",)):
    """The blocks that are left when the subtrees of gone are deleted; tags of kept stay in any case."""
    if isinstance(tree, str):
        return [tree]
    if shown(tree) in gone and tree[0] not in kept:
        return []
    return [x for child in tree[1] for x in plain_text(child, gone, kept)]


@pytest.mark.parametrize("article", [False, True])
def test_templates_and_texts_match_brute_force(spark, article):
    rng, sites = random.Random(8 + article), {}
    for host, n in (("one.com", 1), ("two.com", 9), ("many.com", 40)):
        for page in range(n):
            around = [site_tree(rng, 2, page) for _ in range(2)]
            inner = [site_tree(rng, 1, page) for _ in range(4)]
            if page % 10 == 9:  # a copy of the page before
                sites[host].append(sites[host][-1])
            else:
                sites.setdefault(host, []).append(("body", [*around, ("article", inner)] if article else around + inner))
    wanted = {}
    for host, trees in sites.items():
        different = {shown(t): t for t in trees}
        n = {}
        for tree in different.values():
            for x in subtrees(tree):
                n[x] = n.get(x, 0) + 1
        gone = {x for x, k in n.items() if k >= 3 and k >= 0.2 * len(different)}
        common = {x for x in gone if 2 * n[x] > len(different)}
        for i, tree in enumerate(trees):
            if article:  # what is around it goes, prose in it stays
                blocks = plain_text(tree[1][-1], common, ("article", "p", "h2"))
            else:
                blocks = plain_text(tree, gone)
            wanted[f"http://{host}/{i}"] = "\n\n".join(blocks)
    rows = [(i, f"http://{host}/{i}", "<html>" + shown(t)) for host, trees in sites.items() for i, t in enumerate(trees)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    for options in ({}, {"max_broadcast": 0}):
        assert {r.url: r.text for r in html_extract.extract_main_text(frame, **options).collect()} == wanted
    off = {r.url: r.text for r in html_extract.extract_main_text(frame, min_pages=10**9).collect()}
    assert sum(off[u] != t for u, t in wanted.items()) > (5 if article else 40)  # templates do the work


def test_templates_alone_on_the_supplied_pages(spark):
    """Without marks the recurring subtrees of a host are what is deleted outside the articles."""
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    pages = spark.read.parquet(f"{folder}/pages.parquet").selectExpr("page_id", "url", "replace(replace(html, '<article>', '<div>'), '</article>', '</div>') AS html")
    text = lambda **o: {r.page_id: r.text for r in html_extract.extract_main_text(pages, **o).collect()}
    right = text()
    alone, nothing = text(use_marks=False), text(use_marks=False, min_pages=10**9)
    assert sum(alone[i] != nothing[i] for i in right) > len(right) / 3  # menus, and what else a host repeats
    assert all(len(right[i]) <= len(alone[i]) <= len(nothing[i]) for i in right)


def test_menus_of_other_links_are_one_template(spark):
    menu = '<div><ul><li><a href="/{n}">to {n}</a></li><li><a>also {n}</a></li></ul></div>'
    rows = [(i, f"https://a.com/{i}", f"<body>{menu.format(n=i)}<p>Own {i}</p><ul><li>see <a>{i}</a></li><li><a>x{i}</a></li></ul><p><a>only</a> <a>{i}</a></p></body>") for i in range(6)]
    rows += [(10 + i, f"https://b.com/{i}", f"<body>{menu.format(n=i) * (i < 3)}<p>Own {i}</p></body>") for i in range(7)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for options in ({}, {"max_broadcast": 0}):
        got = {r.page_id: r.text for r in html_extract.extract_main_text(frame, **options).collect()}
        assert got[2] == "Own 2\n\nsee 2\n\nx2"  # a paragraph of links is a list of links, too
        assert got[11] == "to 1\n\nalso 1\n\nOwn 1"  # on fewer than half of the pages


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<main><h1>Title</h1><p>Lead</p><article><p>Body</p></article></main>", "Title\n\nLead\n\nBody"),
        ("<main><h1>Title</h1><p>Body of the page</p></main><section><article><a>Teaser</a></article></section>", "Title\n\nBody of the page"),
        ("<main><h1>Title</h1><p>Body of the page</p><article><a>Teaser of it</a> x</article></main>", "Title\n\nBody of the page"),
        ("<main><p>A</p><article><p>One</p></article><article><p>Two</p></article><ul><li><a>x</a></li><li><a>y</a></li></ul></main>", "A\n\nOne\n\nTwo"),
        ("<header><h1>Site</h1></header><h1>Title</h1><article><p>Body text</p></article><h1>After</h1>", "Title\n\nBody text"),
        ("<h1>Site</h1><article><h1>Title</h1><p>Body text</p></article>", "Title\n\nBody text"),
        ("<main><p>short</p></main><article><p>A long article text</p></article>", "A long article text"),
        ("<article><main><p>Body</p></main></article>", "Body"),
        ("<main><div class='sidebar'>Aside</div><article><p>Body</p></article></main>", "Body"),
        ("<p>Let <math><mi>x</mi><annotation>\\x</annotation></math> be.</p>", "Let x be."),
    ],
)
def test_the_content_root_is_what_has_the_text(page, text):
    assert html_extract.main_text(page, lambda key: False) == text
