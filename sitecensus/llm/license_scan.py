"""License scans by diagonal voting.

The hashes of a document's rolling word k-grams are joined to those of the license templates (a small fixed table,
broadcast); only k-grams of which every word is in some template are hashed, as no other can be one of theirs. A hit at word p of the document and word q of a template is on the diagonal p - q, and the words
around it are compared with the template's along that diagonal. Diagonals at most ``gap`` words apart are merged,
since inserted or missing words shift a passage to a neighbouring diagonal; and the merged span is verified: the
different words of the template that it has must be a good share of the template and of the span. Of spans that
overlap, the one with most of its template's words stays.

Document and counts stay in one row set all along (documents without hits have a row without a template), so texts
are read once and never shuffled.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fixed phrases: words, label.
BASE_PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Creative Commons licenses: label, and how notices spell its elements.
CREATIVE_COMMONS = [
    ("cc-by", ["attribution"]),
    ("cc-by-sa", ["attribution sharealike", "attribution share alike"]),
    ("cc-by-nd", ["attribution noderivatives", "attribution no derivatives", "attribution noderivs"]),
    ("cc-by-nc", ["attribution noncommercial", "attribution non commercial"]),
    ("cc-by-nc-sa", ["attribution noncommercial sharealike", "attribution non commercial share alike", "attribution noncommercial share alike"]),
    ("cc-by-nc-nd", ["attribution noncommercial noderivatives", "attribution non commercial no derivatives", "attribution noncommercial no derivatives", "attribution noncommercial noderivs"]),
]
#: Fixed public license notices: label, words; those with a star tell the license from others, and have to be there.
TEMPLATES = [
    *((label, "licensed under a creative commons " + " ".join(f"*{w}" for w in spelt.split(" ")) + " 4 0 international license") for label, spellings in CREATIVE_COMMONS for spelt in spellings),
    *((label, "licensed under " + " ".join(f"*{w}" for w in label.split("-")) + " 4 0") for label, _ in CREATIVE_COMMONS),
    ("apache", "licensed under the *apache license version 2 0"),
    ("apache", "released under the *apache license"),
    ("apache", "you may not use this file except in compliance with the license you *may *obtain a copy of the license at"),
    ("apache", "unless required by *applicable *law or *agreed to in *writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("bsd", "*redistribution and use in source and *binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "released under the *bsd license"),
    ("gpl", "this work is licensed under the gnu *general *public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu *general *public license as published by the free software foundation"),
    ("gpl", "released under the *gpl license"),
    ("lgpl", "this work is licensed under the gnu *lesser general public license version 3"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu *lesser general public license as published by the free software foundation"),
    ("agpl", "this work is licensed under the gnu *affero general public license version 3"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu *affero general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose *with or *without *fee is hereby granted"),
    ("mit", "released under the *mit license"),
    ("mit", "permission is hereby granted *free of *charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the *mozilla public license v 2 0"),
    ("unlicense", "this is free and *unencumbered software released into the *public *domain"),
]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(f"({WORD})"), 1)


def _phrase_starts(words: Column, phrase: list[str]) -> Column:
    """Words (from 0) where the phrase begins. The comparison runs only over texts that hold its last word."""
    n = len(phrase)
    fits = lambda i: F.reduce(F.array(*(F.get(words, i.cast("int") + k) == F.lit(w) for k, w in enumerate(phrase))), F.lit(True), lambda a, b: a & b)
    here = F.when(
        (F.size(words) >= n) & F.array_contains(words, phrase[-1]),
        F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0))), fits),
    )
    return F.coalesce(here, F.array().cast("array<int>"))


def template_grams(docs: DataFrame, templates: list[tuple[str, str]], k: int) -> DataFrame:
    """(gram, template, at, template_words, needed): the hash of every k-gram of every template, and the places of the
    template's words that have to be there."""
    starred = [text.split(" ") for _, text in templates]
    rows = json.dumps([{"template": i, "template_words": [w.lstrip("*") for w in words], "needed": [q for q, w in enumerate(words) if w[0] == "*"]} for i, words in enumerate(starred)])
    each = docs.sparkSession.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<template:int,template_words:array<string>,needed:array<int>>>")))
    at = F.explode(F.sequence(F.lit(0), F.size("template_words") - k)).alias("at")
    placed = each.where(F.size("template_words") >= k).select("template", at, "template_words", "needed")
    return placed.select(F.xxhash64(F.slice("template_words", F.col("at") + 1, k)).alias("gram"), "template", "at", "template_words", "needed")


def _disjoint(spans: Column) -> Column:
    """Best spans first, those that do not share half of the shorter one with a better one."""
    length = lambda s: s["last_word"] - s["first_word"] + 1
    common = lambda a, b: F.least(a["last_word"], b["last_word"]) - F.greatest(a["first_word"], b["first_word"]) + 1
    overlap = lambda a, b: common(a, b) * 2 >= F.least(length(a), length(b))
    none = F.filter(spans, lambda s: F.lit(False))
    return F.reduce(F.sort_array(spans, asc=False), none, lambda kept, s: F.when(F.exists(kept, lambda b: overlap(b, s)), kept).otherwise(F.array_append(kept, s)))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: list[tuple[str, str]] = BASE_PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    k: int = 3,
    gap: int = 3,
    least_coverage: float = 0.75,
    slack: float = 1.5,
) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    spans (array of label, first_word, last_word, coverage).

    Base labels are those of the phrases, wherever their words stand in sequence; the method adds those of
    templates of which a span has the starred words and enough others: coverage, the template's words found of the template's
    words or (if more) of the span's, is at least ``least_coverage``. score: the best coverage, 1 with a base label. Null and empty texts have no words: counts 0, positions null, labels empty, score 0. Repeated
    rows and null ids are rows of their own. Other columns are not read; an empty table gives no rows. The time is linear in
    a text's length: spans are compared with those of the same stretch, and stretches end where no span goes on.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), words_of(F.coalesce(F.col(text_col), F.lit(""))).alias("words"))
    starts = [_phrase_starts(F.col("words"), phrase.split(" ")) for phrase, _ in phrases]
    labelled = F.array_compact(F.array(*(F.when(F.size(s) > 0, F.lit(label)) for s, (_, label) in zip(starts, phrases, strict=True))))
    rows = rows.select(
        "row",
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.concat(*starts).alias("starts"),
        F.array_join(F.array_sort(F.array_distinct(labelled)), ",").alias("base_labels"),
    ).select(
        "row",
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        "base_labels",
        "words",
    )
    document = rows.columns[:-1]
    plain = [text.replace("*", "").split(" ") for _, text in templates]
    vocabulary = sorted({w for words in plain for w in words})
    around = max(map(len, plain))
    rows = rows.withColumn("known", F.transform("words", lambda w: w.isin(vocabulary)))
    all_known = lambda i: F.reduce(F.array(*(F.get("known", i + j - 1) for j in range(k))), F.lit(True), lambda a, b: a & b)
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.size("words") - (k - 1), F.lit(1))), lambda i: F.get("known", i - 1) & F.coalesce(all_known(i), F.lit(False)))
    context = lambda i: F.slice("words", F.greatest(i - around, F.lit(1)), 2 * around)
    found = F.transform(places, lambda i: F.struct((i - 1).alias("word"), F.xxhash64(F.slice("words", i, k)).alias("doc_gram"), F.greatest(i - around - 1, F.lit(0)).alias("start"), context(i).alias("context")))
    at = lambda q: F.col("hit.word") - F.col("at") + q - F.col("hit.start")
    agree = lambda q: F.get(F.col("hit.context"), at(q)) == F.get(F.col("template_words"), q)
    hits = (
        rows.select(*document, F.explode_outer(found).alias("hit"))
        .join(F.broadcast(template_grams(docs, templates, k)), F.col("hit.doc_gram") == F.col("gram"), "left")
        .select(
            *document,
            "template",
            "needed",
            F.size("template_words").alias("size"),
            (F.col("hit.word") - F.col("at")).alias("diagonal"),
            F.when(F.col("template").isNotNull(), F.filter(F.sequence(F.lit(0), F.size("template_words") - 1), agree)).alias("same"),
        )
    )
    diagonals = hits.groupBy(*document, "template", "size", "diagonal").agg(F.first("same").alias("same"), F.first("needed").alias("needed"))
    by_template = Window.partitionBy("row", "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_template) > gap, F.lit(True))
    merged = (
        diagonals.withColumn("far", far.cast("int"))
        .withColumn("span", F.sum("far").over(by_template))
        .groupBy(*document, "template", "size", "span")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("same"))).alias("places"),
            F.first("needed").alias("needed"),
            F.min(F.col("diagonal") + F.array_min("same")).alias("first"),
            F.max(F.col("diagonal") + F.array_max("same")).alias("last"),
        )
        .withColumn("covered", F.size("places"))
        .withColumn("length", F.col("last") - F.col("first") + 1)
        .withColumn("coverage", F.col("covered") / F.greatest("size", "length"))
    )
    label = F.element_at(F.array(*(F.lit(name) for name, _ in templates)), F.col("template") + 1)
    verified = (F.col("coverage") >= least_coverage) & (F.col("length") <= F.col("size") * slack + gap) & (F.size(F.array_except("needed", "places")) == 0)
    fields = {"covered": F.col("covered"), "coverage": F.col("coverage"), "label": label, "first_word": F.col("first").cast("long"), "last_word": F.col("last").cast("long")}
    spans = merged.select(*document, F.when(verified, F.struct(*(x.alias(name) for name, x in fields.items()))).alias("span"))
    # stretches of spans that follow each other without a gap; what overlaps is in one
    in_order = Window.partitionBy("row").orderBy("span.first_word", "span.last_word")
    reached = F.max("span.last_word").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("span.first_word") > reached, F.lit(True)).cast("int")
    stretches = spans.withColumn("begins", begins).withColumn("stretch", F.sum("begins").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    per_stretch = stretches.groupBy(*document, "stretch").agg(F.collect_list("span").alias("spans")).withColumn("spans", _disjoint(F.col("spans")))
    per_doc = per_stretch.groupBy(*document).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    shown = lambda s: F.struct(s["label"].alias("label"), s["first_word"].alias("first_word"), s["last_word"].alias("last_word"), s["coverage"].alias("coverage"))
    per_doc = per_doc.withColumn("spans", F.array_sort(F.transform("spans", shown)))
    base = F.when(F.col("base_labels") == "", F.array().cast("array<string>")).otherwise(F.split("base_labels", ","))
    labels = F.array_join(F.array_sort(F.array_distinct(F.concat(base, F.transform("spans", lambda s: s["label"])))), ",")
    best = F.array_max(F.transform("spans", lambda s: s["coverage"]))
    score = F.when(F.col("base_labels") != "", F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0)))
    return per_doc.select(*document[1:], labels.alias("labels"), score.alias("score"), "spans")
