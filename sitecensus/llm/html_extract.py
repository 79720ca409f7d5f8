"""Main text of web pages, with site templates removed.

Every page is parsed into a tree of elements, and each block element's subtree (tag and text, all the way down) is
hashed; a list of links, whose text is all in links, also by its tags alone, since menus differ from page to page. Spark counts the hashes per host over different pages; subtrees that recur on a good share of a host's pages are
its template. A second reading of the pages deletes them, as well as what a tag, class or role marks as a menu, header,
footer, sidebar, notice, advert, form or reader comment, and gives the text of what is left of the article: of the articles
that hold more text than links, together with the main element's own title and text beside them, or of the main element
alone, whichever has more text.

Pages that are equal within a host count once, so copies of a page do not make it a template. Lists of links of one shape
have to recur on most pages of the host. Inside the article (or main)
element only subtrees that recur on most pages of the host are deleted, lists and tables like any other, and paragraphs,
headings and quotations stay even then: an article may share them with others. Marks count there only as whole class
names of containers, and words with other meanings only on what recurs in the host.

The template of all hosts is broadcast as a sorted array of 64-bit keys while it has at most ``max_broadcast`` keys;
beyond that it is joined to the pages' hashes.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

# Names of HTML elements, and the words that mark boilerplate in a class, id or role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr "
    "math mfrac mi mn mo mroot mrow ms msqrt msub msubsup msup mtext semantics".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre article main body html".split())
UNSEEN = frozenset("annotation head title script style noscript template svg iframe object canvas audio video map noembed noframes".split())
ASIDE = frozenset("nav footer aside form button select textarea dialog menu fieldset".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
MARKED = frozenset(
    "ad ads adv advert advertisement adverts adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert newsletter subscribe subscription signup "
    "sidebar nav navbar navigation menu breadcrumb breadcrumbs footer comment comments commentlist disqus reply replies respond related recommended share sharing social popup "
    "modal overlay toolbar pagination pager widget skip search login".split()
)
#: Those that an article's own parts may have, too: inside it, they count only for what recurs in the host.
AMBIGUOUS = frozenset("promo promotion banner consent notice alert subscription menu comment reply replies respond recommended share social popup modal overlay toolbar widget skip search login".split())
MARKED_OUTSIDE = frozenset("header masthead topbar".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
SPACE = re.compile(r"\s+")
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)")
ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
COMMENT_END = re.compile("--!?>")
#: Elements whose content is no markup, with their ends.
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in "script style textarea title iframe noembed noframes xmp".split()}


@lru_cache(8192)
def marks_of(classes: str, name: str) -> frozenset:
    """What an element's class and id say: "sure" or "maybe" by whole class names, "name" by a whole class name or id
    (header words included), and "part" by a word inside a class name."""
    whole = frozenset(classes.lower().split())
    outside, sure = MARKED | MARKED_OUTSIDE, MARKED - AMBIGUOUS
    words = frozenset(re.split(r"[^a-z0-9]+", classes.lower()))
    found = {"sure": whole & sure, "maybe": whole & AMBIGUOUS, "name": (whole | {name.lower().strip()}) & outside, "part": words & (sure | MARKED_OUTSIDE)}
    return frozenset(mark for mark, by in found.items() if by)


class Node:
    """An element. key: hash of its subtree; shape: hash of its tags, if all its text is in links, else 0; mains, articles,
    titles, links: numbers of main, article, h1 and a elements in it."""

    __slots__ = ("articles", "children", "key", "links", "mains", "marks", "shape", "tag", "titles")

    def __init__(self, tag: str, marks: frozenset = frozenset()):
        self.tag, self.marks, self.children = tag, marks, []
        self.key = self.shape = self.mains = self.articles = self.titles = self.links = 0

    def is_list_of_links(self) -> bool:
        return self.shape != 0 and self.links > 1


def marks_in(attributes: dict[str, str]) -> frozenset:
    found = marks_of(attributes.get("class", ""), attributes.get("id", ""))
    role = attributes.get("role", "").lower()
    if role in ROLES or "hidden" in attributes:
        found |= {"unseen"}
    return found | {"role-main"} if role == "main" else found


class Tree:
    """Builds the elements of a page; ends of elements that HTML lets authors leave out are put in.

    Every character is looked at a bounded number of times, and the innermost open element of a tag is known without
    a search, so the time is linear in the length of any input."""

    def __init__(self, source: str):
        self.root = Node("html")
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}  # of the open elements, by tag
        self.read(source)

    def read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            start = source.find("<", at)
            self.text(source[at : start if start >= 0 else size])
            if start < 0:
                return
            tag = TAG.match(source, start)
            if tag:
                at, attributes = tag.end(), {}
                while found := ATTRIBUTE.match(source, at):
                    at = found.end()
                    attributes.setdefault(found[1].lower(), html.unescape(found[2] or found[3] or found[4] or ""))
                at = source.find(">", at) + 1
                if not at:
                    return  # the page ends within a tag
                name = tag[2].lower()
                if tag[1]:
                    if name not in VOID:
                        self.end((name,), ())
                    continue
                self.start(name, attributes)
                if name in RAW:  # no markup within
                    end = RAW[name].search(source, at)
                    until = end.start() if end else size
                    self.open[-1].children.append(source[at:until])
                    at = until
            elif source.startswith("<!--", start):
                end = COMMENT_END.search(source, start + 2)
                at = end.end() if end else size
            elif source.startswith(("<!", "<?", "</"), start):
                at = source.find(">", start) + 1 or size
            else:
                self.text("<")
                at = start + 1

    def text(self, data: str) -> None:
        if data:
            self.open[-1].children.append(html.unescape(data))

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "html":
            return
        if tag in ENDS_PARAGRAPH:
            self.end(("p",), ENDS_PARAGRAPH)
        if tag in SIBLINGS:
            self.end(SIBLINGS[tag], SCOPE[tag])
        node = Node(tag, marks_in(attributes) if attributes else frozenset())
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def innermost(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def end(self, tags, scope) -> None:
        """End the innermost open element of tags, if there is one within the innermost of scope."""
        place = self.innermost(tags)
        if place and place >= self.innermost(scope):
            for node in self.open[place:]:
                self.places[node.tag].pop()
            del self.open[place:]


def parse(source: str) -> Node:
    """The page's tree, with keys (64-bit hashes of tags and texts; white space and what is never shown do not count) and
    counts."""
    root = Tree(source).root
    order, stack = [], [root]
    while stack:
        order.append(n := stack.pop())
        stack += [c for c in n.children if isinstance(c, Node)]
    for n in reversed(order):
        h = hashlib.blake2b(n.tag.encode("utf-8", "replace"), digest_size=8)
        n.mains, n.articles, n.titles, n.links = int(n.tag == "main" or "role-main" in n.marks), int(n.tag == "article"), int(n.tag == "h1"), int(n.tag == "a")
        in_links, shapes = True, [n.tag]
        for c in n.children:
            if not isinstance(c, Node):
                bare = "".join(c.split())
                in_links &= not bare or n.tag == "a"
                h.update(bare.encode("utf-8", "replace"))
            elif c.tag not in UNSEEN:
                h.update(c.key.to_bytes(8, "little"))
                n.mains, n.articles, n.titles, n.links = n.mains + c.mains, n.articles + c.articles, n.titles + c.titles, n.links + c.links
                in_links &= c.shape != 0 or n.tag == "a"
                shapes.append(str(c.shape))
            h.update(b"\0")
        n.key = int.from_bytes(h.digest(), "little")
        if n.tag == "a" or in_links:
            shape = "a" if n.tag == "a" else " ".join(shapes)
            n.shape = int.from_bytes(hashlib.blake2b(shape.encode("utf-8", "replace"), digest_size=8, person=b"shape").digest(), "little") | 1
    return root


def block_keys(root: Node) -> np.ndarray:
    """The different keys of the page's block elements that have something in them, and shapes of its lists of links."""
    keys, stack = set(), list(root.children)
    while stack:
        n = stack.pop()
        if isinstance(n, Node) and n.tag not in UNSEEN:
            stack += n.children
            if n.tag not in INLINE and n.tag not in VOID and n.children:
                keys.add(n.key)
                if n.is_list_of_links():
                    keys.add(n.shape)
    return np.fromiter(keys, np.uint64, len(keys))


def main_text(page: str | Node, is_template, is_common=None, use_marks: bool = True) -> str:
    """Text of the article; is_template tells whether a subtree's key belongs to the host's template, is_common
    (or else is_template) whether it is on most pages of the host, as it has to be inside the article. use_marks: also
    delete what a tag, role, class or id marks, which is all there is to go by on a host of few pages."""
    is_common = is_common or is_template
    root = parse(page) if isinstance(page, str) else page

    def around_article(n: Node) -> bool:
        """Whether n holds a main element or all articles of the page, as <div class="has-sidebar"> may."""
        return n.mains > 0 or 0 < n.articles == root.articles

    def template(n: Node, inside: bool) -> bool:
        if n.tag in INLINE or n.tag in PROSE and (inside or n.tag in ("article", "main", "body")):
            return False
        return (is_common if inside else is_template)(n.key) or n.is_list_of_links() and is_common(n.shape)

    def marked(n: Node, inside: bool) -> bool:
        """Whether a tag, role, class or id tells that n is no text of the article."""
        if n.tag in ASIDE or n.tag == "header" and not inside:
            # some servers put the whole page into one form
            return n.tag != "form" or inside or not (around_article(n) or n.titles and not root.articles and not root.mains)
        if not n.marks or n.tag in ("body", "html", "main"):
            return False
        if "unseen" in n.marks:
            return True
        if inside:  # containers alone, and articles in the article: reader comments
            if n.tag in INLINE or n.tag in SIBLINGS or n.tag in PROSE and n.tag != "article":
                return False
            return "sure" in n.marks or "maybe" in n.marks and is_template(n.key)
        if n.tag in PROSE:
            return n.tag != "article" and "sure" in n.marks
        if "role-main" in n.marks or around_article(n) and (n.mains or n.articles == 1 or "sure" not in n.marks):
            return False  # a wrapper does not take the article with it; a list of comments or teasers goes
        return "name" in n.marks or "part" in n.marks

    def dropped(n: Node, inside: bool) -> bool:
        return n.tag in UNSEEN or template(n, inside) or use_marks and marked(n, inside)

    def found(wanted) -> list[Node]:
        """Outermost elements that are wanted and not dropped."""
        out, stack = [], [root]
        while stack:
            n = stack.pop()
            if wanted(n):
                out.append(n)
            else:
                stack += [c for c in reversed(n.children) if isinstance(c, Node) and not dropped(c, False)]
        return out

    def prose(n: Node, inside: bool) -> tuple[int, int]:
        """Characters of n's text outside of links and in them, without what is dropped and (not inside) articles."""
        plain = linked = 0
        stack = [(n, n.tag == "a")]
        while stack:
            x, in_link = stack.pop()
            for c in x.children:
                if isinstance(c, str):
                    size = len("".join(c.split()))
                    plain, linked = plain + size * (not in_link), linked + size * in_link
                elif not dropped(c, inside) and (inside or c.tag != "article"):
                    stack.append((c, in_link or c.tag == "a"))
        return plain, linked

    def outside_links(n: Node, within: bool) -> bool:
        """A list of links beside the articles of a main element."""
        return not within and bool(mains) and n.is_list_of_links()

    is_main = lambda n: n.tag == "main" or "role-main" in n.marks
    articles, teasers = [], set()
    for n in found(lambda n: n.tag == "article"):
        plain, linked = prose(n, True)
        articles.append((n, plain)) if plain > linked else teasers.add(id(n))
    mains = found(is_main)
    whole = [n for n, _ in articles]
    in_mains = sum(n.articles for n in mains) - sum(n.articles for n in mains if n.tag == "article")
    parts, inside = whole or mains or [root], bool(whole or mains)
    if mains and whole and not any(is_main(n) for n in whole):
        own = sum(prose(m, False)[0] for m in mains)
        if not in_mains:  # beside each other: what has more text
            parts = mains if own > sum(plain for _, plain in articles) else whole
        elif in_mains == root.articles and own:  # the main element's own text beside its articles, by the rules outside
            parts, inside = mains, False
    elif whole and not any(n.titles for n in whole):  # the title stands before the article
        before = found(lambda n: n.tag in ("h1", "article"))
        parts = before[: next(i for i, n in enumerate(before) if n.tag == "article")] + whole
    blocks: list[str] = []
    current: list[str] = []

    def flush() -> None:
        if text := SPACE.sub(" ", "".join(current)).strip():
            blocks.append(text)
        current.clear()

    for part in parts:
        stack: list = [(part, inside)]
        while stack:
            n, within = stack.pop()
            if n is None:
                flush()
            elif isinstance(n, str):
                current.append(n)
            elif n.tag == "br" or n.tag in ("td", "th"):
                current.append(" ")
                stack += [(c, within) for c in reversed(n.children)]
            elif n is part or not (dropped(n, within) or id(n) in teasers or outside_links(n, within)):
                block = n.tag not in INLINE
                if block:
                    flush()
                    stack.append((None, within))
                stack += [(c, within or n.tag == "article") for c in reversed(n.children)]
        flush()
    return "\n\n".join(blocks)


def _host_keys(hosts: list[str], keys: np.ndarray | None = None) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(h.encode("utf-8", "replace"), digest_size=8).digest(), "little") for h in hosts], np.uint64).view(np.int64)


def _mixed(host: int, keys: np.ndarray) -> np.ndarray:
    """One key for a host and a subtree."""
    x = (keys ^ np.uint64(host & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def _with_host(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(page_id.., html, host) with nulls as empty texts."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    return pages.withColumns({"html": F.coalesce(F.col(html_col), F.lit("")), "host": ascii_lower(F.regexp_extract(url, "^(?:[^/?#]*://)?([^/?#]*)", 1))})


def templates(pages: DataFrame, min_pages: int, min_share: float) -> DataFrame:
    """pages: html, host. (key, common): key of host and subtree, for those on min_pages different pages and min_share
    of the host's; common: on more than half of the host's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = _host_keys(batch.column(1).to_pylist())
            page_keys, keys = [], []
            for host, html in zip(hosts, batch.column(0), strict=True):
                root = parse(html.as_py())
                page_keys.append(root.key)
                keys.append(_mixed(int(host), block_keys(root)))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(k) for k in keys]), pa.int32()), pa.array(np.concatenate([*keys, np.zeros(0, np.int64)]), pa.int64()))
            pages_ = np.array(page_keys, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hosts), pa.array(pages_), lists], ["host", "page", "keys"])

    # keys of equal pages are equal: any row of them will do
    parsed = pages.select("html", "host").mapInArrow(run, "host long, page long, keys array<long>").dropDuplicates(["host", "page"])
    parsed = written(parsed, "page-keys")  # read twice
    counted = parsed.select("host", F.explode("keys").alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    sizes = parsed.groupBy("host").agg(F.count("*").alias("pages"))
    return counted.join(sizes, "host").where(F.col("n") >= F.col("pages") * min_share).select("key", (F.col("n") * 2 > F.col("pages")).alias("common"))


def extract_main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = 3,
    min_share: float = 0.2,
    max_broadcast: int = 1_000_000,
    use_marks: bool = True,
) -> DataFrame:
    """One row for each row of pages: page_id, url, text, n_chars.

    Blocks are joined by two line feeds, white space inside a block is one space; text is empty if there is none.
    A null html is an empty page; pages with a null url share the host ''. Null ids and repeated rows are rows of
    their own (copies of a page get the same text). Other columns are not read; no rows: no rows.
    A host's template is what recurs on min_share of its different pages, and on min_pages of them. use_marks: see
    ``main_text``. The templates are a table in the shared folder.
    """
    slim = _with_host(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")), "url", "html")
    found = written(templates(slim, min_pages, min_share), "templates")
    schema = "page_id long, url string, text string, n_chars long"

    def texts(batch: pa.RecordBatch, known: Iterator[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        """batch: page_id, url, html, host. known: for each page, sorted keys of its host's template, and the common ones."""
        out = []
        for html, host, both in zip(batch.column(2), _host_keys(batch.column(3).to_pylist()), known, strict=True):
            root = parse(html.as_py())
            keys = block_keys(root)
            mixed = _mixed(int(host), keys)
            own = [set(keys[_among(mixed, k)].tolist()) for k in both]
            out.append(main_text(root, own[0].__contains__, own[1].__contains__, use_marks))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    if found.count() <= max_broadcast:
        rows = found.toArrow()
        keys, common = rows.column("key").to_numpy(), rows.column("common").to_numpy()
        known = pages.sparkSession.sparkContext.broadcast((np.unique(keys), np.unique(keys[common])))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield texts(batch, [known.value] * batch.num_rows)

        return slim.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "host").mapInArrow(run, schema)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, html, host in zip(batch.column(0), batch.column(1), _host_keys(batch.column(2).to_pylist()), strict=True):
                keys = _mixed(int(host), block_keys(parse(html.as_py())))
                yield pa.RecordBatch.from_arrays([pa.array([page.as_py()] * len(keys), pa.int64()), pa.array(keys, pa.int64())], ["page", "key"])

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield texts(batch, [tuple(np.array(sorted(x.as_py() or []), np.int64) for x in both) for both in zip(batch.column(4), batch.column(5), strict=True)])

    page = F.xxhash64("url", "html")
    hits = slim.select(page.alias("page"), "html", "host").mapInArrow(collect, "page long, key long").join(found, "key").groupBy("page").agg(F.collect_set("key").alias("keys"), F.collect_set(F.when(F.col("common"), F.col("key"))).alias("common"))
    joined = slim.withColumn("page", page).join(hits, "page", "left")
    return joined.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "host", "keys", "common").mapInArrow(run_joined, schema)


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are among the known ones (sorted)."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys
