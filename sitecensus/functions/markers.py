"""Markers of platforms and of parked pages, all found in one pass over a page.

An Aho-Corasick automaton over every marker reads the decoded, lower-cased page once, in the Arrow batches that decode its
character references anyway; what it found is an array, on which the rules of ``columns`` are set operations. Patterns
are tried only on pages that have the text which each of their matches begins with."""

from __future__ import annotations

import html
from functools import lru_cache, reduce

import ahocorasick
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import columns as C
from . import fixed

SCHEMA = "decoded string, marks array<string>"
#: Texts of which every match of a pattern has one, in the order of fixed.PLATFORM_PATTERNS.
PATTERN_HINTS = [["/_dm", "/dmassets"], ["dmapi"], ["dmcore", "dmx", "dmmobile", "dmroot", "duda"]]
REDIRECT_HINTS = ["location"]


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Of all markers and hints; one for each Python worker."""
    made = ahocorasick.Automaton()
    lists = [m for *_, m in fixed.PLATFORM_MARKERS + fixed.PLATFORM_ALL_OF] + PATTERN_HINTS + [REDIRECT_HINTS, fixed.PARKING_MARKERS, ["godaddy", *fixed.REGISTRAR_WORDS]]
    for marker in {m for markers in lists for m in markers}:
        made.add_word(marker, marker)
    made.make_automaton()
    return made


def marked(rows: list[tuple]) -> list[dict]:
    """decoded and marks of pages (rows of one text)."""
    found = automaton()
    out = []
    for (raw,) in rows:
        decoded = html.unescape(raw or "")
        out.append({"decoded": decoded, "marks": sorted({m for _, m in found.iter(decoded.lower())})})
    return out


def has_any(marks: Column, wanted: list[str]) -> Column:
    return F.arrays_overlap(marks, F.array(*map(F.lit, wanted)))


def platform_scores(marks: Column, decoded: Column) -> Column:
    """As ``columns.platform_scores``."""
    hits = [(platform, n, has_any(marks, wanted)) for platform, n, wanted in fixed.PLATFORM_MARKERS]
    hits += [(platform, n, F.size(F.array_intersect(marks, F.array(*map(F.lit, wanted)))) == len(wanted)) for platform, n, wanted in fixed.PLATFORM_ALL_OF]
    hits += [(platform, n, has_any(marks, hints) & F.lower(decoded).rlike(pattern)) for (platform, n, pattern), hints in zip(fixed.PLATFORM_PATTERNS, PATTERN_HINTS, strict=True)]
    score = lambda p: reduce(lambda a, b: a + b, (F.when(hit, n).otherwise(0) for platform, n, hit in hits if platform == p), F.lit(0))
    return F.array(*(F.struct(F.lit(p).alias("platform"), score(p).alias("score")) for p in fixed.PLATFORMS))


def platforms(marks: Column, decoded: Column, least: int = 5) -> Column:
    """As ``columns.platforms``."""
    return C.ranked_platforms(platform_scores(marks, decoded), least)


def parked(marks: Column, decoded: Column, url: Column) -> Column:
    """As ``columns.parked``."""
    registrar = F.array_contains(marks, "godaddy") & has_any(marks, fixed.REGISTRAR_WORDS)
    redirects = has_any(marks, REDIRECT_HINTS) & C.parking_redirect(F.lower(decoded))
    return F.coalesce(C.parked_address(url) | has_any(marks, fixed.PARKING_MARKERS) | redirects | registrar, F.lit(False))
