"""Column functions: everything here stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

#: White space of all of Unicode, which trim() does not know.
UNICODE_SPACE = r"[\s\u0085   -     　]"
EMAIL = r"(?i)[a-z0-9.!#$%&'*+/=?^_{|}~-]++@[a-z0-9-]++(\.[a-z0-9-]++)+"
POSTCODE = r"[A-Za-z]{1,2}[0-9][A-Za-z0-9]?[\t\n\f\r ]?[0-9][A-Za-z]{2}"
POSTCODE_LABEL = r"(?i)post[\t\n\f\r ]*code[:\t\n\f\r ]*"
COMPANY_NUMBER = (
    r"(?i)(?:company|companies house|registered|registration)[\t\n\f\r ]*(?:number|no|registration|details)?[\t\n\f\r ]*[:#-]?[\t\n\f\r ]*"
    r"((?:[a-z]{2}[\t\n\f\r ]*)?[0-9]{6,8})(?![A-Za-z0-9_])"
)
PHONE = r"(?:\+44|0)(?:[\t\n\f\r ]*[0-9]){9,10}"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def contains_any(text: Column, markers: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(m) for m in markers), F.lit(False))


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, f"^{UNICODE_SPACE}+|{UNICODE_SPACE}+$", "")


def clean_text(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"[\t\n\f\r ]+", " "))


def null_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def site_active(status: Column) -> Column:
    """2xx, 3xx, 401 and 403; a null status is not active."""
    return F.coalesce(((status >= 200) & (status < 400)) | status.isin(401, 403), F.lit(False))


def board_live(status: Column) -> Column:
    return F.coalesce((status >= 200) & (status < 400), F.lit(False))


def scan_retry(dns_active: Column, status: Column) -> Column:
    """A scan is tried again without a name, without a status, and for 408, 425, 429 and 5xx."""
    return F.coalesce(~dns_active, F.lit(True)) | status.isNull() | status.isin(408, 425, 429) | (status >= 500)


def fetch_retry(error: Column) -> Column:
    """A fetch is tried again for transport errors only: any HTTP status is final."""
    return F.coalesce(contains_any(F.lower(error), fixed.RETRY_MARKERS), F.lit(False))


def http_downgrade(url: Column, error: Column) -> Column:
    """The plain-http URL to try after an https failure, or null."""
    said = F.lower(error)
    able = F.lower(url).startswith("https://") & contains_any(said, fixed.DOWNGRADE_MARKERS) & ~contains_any(said, fixed.NAME_ERROR_MARKERS)
    return F.when(able, F.regexp_replace(F.regexp_replace(url, "^(?i)https://", "http://"), r"^(http://[^/?#]*):443(?=[/?#]|$)", "$1"))


def host_of(url: Column) -> Column:
    """Lower-cased host without user and port; '' if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.coalesce(authority, F.lit("")), r":[0-9]*$", ""))


def same_host(a: Column, b: Column) -> Column:
    return (host_of(a) != "") & (host_of(a) == host_of(b))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def with_scheme(url: Column) -> Column:
    return F.when(url.contains("://"), url).otherwise(F.concat(F.lit("https://"), url))


def without_default_port(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"^(https://[^/?#]*):443(?=[/?#]|$)", "$1"), r"^(http://[^/?#]*):80(?=[/?#]|$)", "$1")


def instant(value: Column) -> Column:
    """The time that an ISO 8601 text names (a day, or with hours and minutes at least, and a zone); null for all other texts.
    A time without a zone is one of the session's zone."""
    shape = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"
    seconds = F.regexp_replace(value, r"^(.{10}[T ][0-9]{2}:[0-9]{2})(?=$|Z|[+-])", "$1:00")  # a cast wants them
    return F.when(value.rlike(shape), seconds).try_cast("timestamp")


def url_key(url: Column) -> Column:
    """What the same page's URLs have in common: scheme and host in lower case, no default port, no fragment, and '/' for an
    empty path. A value without scheme and host stays as it is."""
    authority = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"
    origin, rest = F.regexp_extract(url, authority, 0), F.regexp_extract(url, authority + "([^#]*)", 1)
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(origin != "", F.concat(without_default_port(F.lower(origin)), path)).otherwise(url)


def in_domains(host: Column, domains: list[str]) -> Column:
    """Whether the host is one of the domains or below it: its suffixes are looked up, so one test serves any number."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.arrays_overlap(suffixes, F.array(*(F.lit(d) for d in domains)))


def distinct_fold(values: Column) -> Column:
    """Distinct without regard to case; the first spelling stays."""
    both = lambda v: F.struct(v.alias("all"), F.transform(v, F.lower).alias("folded"))
    return once(once(values, both), lambda v: F.filter(v["all"], lambda x, i: F.array_position(v["folded"], F.lower(x)) == i + 1))


def junk_email(email: Column) -> Column:
    low = F.lower(strip(email))
    return (low == "") | low.contains("example") | low.isin(fixed.JUNK_EMAILS) | F.regexp_extract(low, "@([^@]*)$", 1).isin(fixed.JUNK_EMAIL_DOMAINS)


def valid_email(email: Column) -> Column:
    return ~junk_email(email) & (F.regexp_count(email, F.lit("@")) == 1) & email.rlike(EMAIL) & ~email.rlike(r"[ \t\r\n]")


def clean_email(email: Column) -> Column:
    """Without punctuation at both ends; null if it is not valid."""
    bare = F.regexp_replace(email, r"^[ \t\r\n.,;:!?/\\)\]}-]+|[ \t\r\n.,;:!?/\\)\]}-]+$", "")
    return F.when(valid_email(bare), bare)


def emails(text: Column) -> Column:
    found = F.when(text.contains("@"), F.regexp_extract_all(text, F.lit(f"({EMAIL})"), 1)).otherwise(F.when(text.isNotNull(), F.array().cast("array<string>")))
    return distinct_fold(F.filter(F.transform(found, clean_email), lambda x: x.isNotNull()))


def clean_phone(number: Column) -> Column:
    bare = F.regexp_replace(number, r"[\t\n\f\r ().-]", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, r"^\+440+", "+44"), "^00440+", "+44"), "^0044", "+44")


def valid_phone(number: Column) -> Column:
    """A national part of 9 or 10 digits that begins with 1, 2, 3, 5, 7, 8 or 9."""
    national = F.regexp_replace(F.regexp_replace(clean_phone(number), r"^(\+44|0)", "#"), "[^0-9#]", "")
    return national.rlike("^#[1235789][0-9]{8,9}$")


def phones(text: Column) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(f"({PHONE})"), 1), clean_phone)
    return F.array_distinct(F.array_sort(F.filter(found, valid_phone)))


def postcodes(text: Column, most: int = 25) -> Column:
    """Those with a label first, then all in order; upper case, without spaces."""
    labelled = F.regexp_extract_all(text, F.lit(f"{POSTCODE_LABEL}({POSTCODE})"), 1)
    every = F.regexp_extract_all(text, F.lit(f"({POSTCODE})"), 1)
    bare = F.transform(F.concat(labelled, every), lambda x: F.upper(F.regexp_replace(x, r"[\t\n\f\r ]", "")))
    return F.slice(F.array_distinct(bare), 1, most)


def company_numbers(text: Column, most: int = 25) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(COMPANY_NUMBER), 1), lambda x: F.replace(F.upper(x), F.lit(" "), F.lit("")))
    return F.slice(F.array_distinct(F.filter(found, lambda x: F.octet_length(x).between(8, 10))), 1, most)


def language(text: Column) -> Column:
    """ZH, RU, AR or EN by the letters of the first 5000 bytes; null under 50 bytes or without letters."""
    letters = {"ZH": "一-鿿", "RU": "Ѐ-ӿ", "AR": "؀-ۿ"}
    size = lambda s, kept: F.length(s) - F.length(F.regexp_replace(s, f"[{kept}]+", ""))
    counts = lambda s: F.struct(size(s, "A-Za-z" + "".join(letters.values())).alias("all"), *(size(s, kept).alias(k) for k, kept in letters.items()))

    def kind(n: Column) -> Column:
        share = lambda k: n[k] / F.nullif(n["all"], F.lit(0)) > 0.10
        return F.when(n["all"] > 0, F.when(share("ZH"), "ZH").when(share("RU"), "RU").when(share("AR"), "AR").otherwise("EN"))

    return F.when(F.octet_length(text) >= 50, once(once(_cut(text, 5000), counts), kind))


def _cut(text: Column, most: int) -> Column:
    """At most so many bytes of the text, and no part of a character."""
    short = F.make_valid_utf8(F.substring(F.encode(text, "UTF-8"), 1, most).cast("string"))
    return F.when(F.octet_length(text) <= most, text).otherwise(F.regexp_replace(short, "\ufffd+$", ""))


def parked(body: Column, url: Column) -> Column:
    """Whether a page only holds or sells its domain. body: entities decoded."""
    return once(F.lower(F.coalesce(body, F.lit(""))), lambda low: _parked(low, url))


def parking_redirect(low: Column) -> Column:
    """Whether a lower-cased page's script goes on to a page for parked domains."""
    lander = low.rlike(r"(window\.)?location(\.href)?[\t\n\f\r ]*=[\t\n\f\r ]*[\"']/?(lander|parking|domain([-_ ]for[-_ ]sale)?)([/\t\n\f\r '\"?]|$)")
    replaced = low.rlike(r"location\.replace\([\t\n\f\r ]*[\"']/?(lander|parking|domain)([/\t\n\f\r '\"?]|$)")
    return lander | replaced


def parked_address(url: Column) -> Column:
    """Whether path or host are those of parked domains."""
    host = F.regexp_replace(host_of(url), r"\.$", "")
    return (
        path_of(url).rlike(r"(?i)(^|/)(lander|parking|parked|domain-for-sale)(/|$)")
        | host.rlike(r"^ww[0-9]+\.")
        | in_domains(F.regexp_replace(host, r"^www\.", ""), fixed.BROKER_HOSTS)
    )


def _parked(low: Column, url: Column) -> Column:
    registrar = low.contains("godaddy") & contains_any(low, fixed.REGISTRAR_WORDS)
    return F.coalesce(parked_address(url) | contains_any(low, fixed.PARKING_MARKERS) | parking_redirect(low) | registrar, F.lit(False))


def content_active(body: Column, has_parts: Column) -> Column:
    """Whether a page without a status looks alive. has_parts: it has an anchor, address or image."""
    size = F.octet_length(body)
    dead = lambda low: contains_any(low, fixed.SALE_MARKERS) | (low.contains("404 not found") & (size < 1500)) | (low.contains("403 forbidden") & (size < 200))
    return ~once(F.lower(body), dead) & ((size > 500) | has_parts)


def platform_scores(body: Column) -> Column:
    """platform and score of every platform, in their fixed order. body: entities decoded."""

    def points(low: Column) -> Column:
        hits = [(platform, n, contains_any(low, markers)) for platform, n, markers in fixed.PLATFORM_MARKERS]
        hits += [(platform, n, reduce(lambda a, b: a & b, (low.contains(m) for m in markers))) for platform, n, markers in fixed.PLATFORM_ALL_OF]
        hits += [(platform, n, low.rlike(pattern)) for platform, n, pattern in fixed.PLATFORM_PATTERNS]
        score = lambda p: sum((F.when(hit, n).otherwise(0) for platform, n, hit in hits if platform == p), F.lit(0))
        return F.array(*(F.struct(F.lit(p).alias("platform"), score(p).alias("score")) for p in fixed.PLATFORMS))

    return once(F.lower(body), points)


def platforms(body: Column, least: int = 5) -> Column:
    """Platforms with enough points, most points first, else in their fixed order."""
    return ranked_platforms(platform_scores(body), least)


def ranked_platforms(scores: Column, least: int) -> Column:
    ranked = F.transform(scores, lambda x, i: F.struct((-x["score"]).alias("s"), i.alias("i"), x["platform"].alias("p")))
    return F.transform(F.array_sort(F.filter(ranked, lambda x: x.s <= -least)), lambda x: x.p)


def identity_tokens(*values: Column) -> Column:
    text = F.lower(F.concat_ws(" ", *values))
    words = F.filter(F.regexp_extract_all(text, F.lit("([a-z0-9]+)"), 1), lambda x: F.length(x) >= 3)
    return F.array_except(words, F.array(*(F.lit(w) for w in fixed.IDENTITY_STOP_WORDS)))


def first_non_empty(*lists: Column) -> Column:
    return F.try_element_at(F.filter(F.transform(F.concat(*(F.coalesce(x, F.array().cast("array<string>")) for x in lists)), strip), lambda x: x != ""), F.lit(1))


def join_fold(values: Column) -> Column:
    return F.array_join(distinct_fold(values), ", ")


def description(title: Column, text: Column, path: Column, most: int = 500) -> Column:
    """Title and description of a root page, at most so many bytes."""
    title, text = F.coalesce(title, F.lit("")), F.coalesce(text, F.lit(""))
    more = F.when((text != "") & ~F.contains(title, text), text)
    return F.when(path.isin("", "/"), null_if_empty(_cut(strip(F.concat_ws(" — ", null_if_empty(title), more)), most)))


def page_kind(url: Column) -> Column:
    low = F.lower(url)
    kind = None
    for name, fragments in fixed.PAGE_KINDS.items():
        hit = contains_any(low, fragments.split())
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    return kind.otherwise("website")
