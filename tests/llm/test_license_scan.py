import random
import re
import time

from sitecensus.llm import license_scan

TEXTS = [
    (1, "Released under the MIT License. More text."),
    (2, "This work is licensed under the GNU General Public License, version 3. mit license MIT LICENSE"),
    (3, "Permission is hereby granted, free of charge, to any person who is obtaining a copy of this software and associated documentation files"),
    (4, "general public  licenses and apache-license"),
    (5, None), (6, ""), (None, "Licensed under CC BY-NC 4.0."), (None, "Licensed under CC BY-NC 4.0."), (7, "a mit license " * 4000), (8, "nothing at all is here, and no more"), (8, "mit"),
]


def base(text):
    words = re.findall(license_scan.WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in license_scan.BASE_PHRASES:
        p = phrase.split(" ")
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_matches_brute_force_and_methods_labels(spark):
    frame = spark.createDataFrame(TEXTS, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS template", "3 AS words")
    rows = license_scan.scan_licenses(frame).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=str)
    assert got == sorted(((i, *base(t)) for i, t in TEXTS), key=str)
    labels = {r.doc_id: (r.labels, r.score) for r in rows}
    assert labels[1] == ("mit", 1.0) and labels[2] == ("gpl,mit", 1.0)
    assert labels[3][0] == "mit" and 0.75 <= labels[3][1] < 1  # two words were put in
    assert labels[None] == ("cc-by-nc", 1.0) and labels[8][0] == "" and labels[5] == ("", 0.0)
    spans = next(r.spans for r in rows if r.doc_id == 3)
    assert [(s.label, s.first_word, s.last_word) for s in spans] == [("mit", 0, 21)]


def test_empty_table(no_docs):
    assert license_scan.scan_licenses(no_docs).count() == 0


def test_labels_of_changed_and_overlapping_notices(spark):
    texts = {
        "licensed under the Creative Commons Attribution 4.0 International License": "cc-by",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
        "licensed under the Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
        "licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License": "cc-by-nc-nd",
        "Licensed under CC BY-NC-SA 4.0": "cc-by-nc-sa",
        "Licensed under CC BY 3.0": "cc-by",
        "This work is licensed under the GNU Lesser General Public License version 3": "gpl,lgpl",
        "creative commons attribution creative commons attribution creative commons attribution creative commons attribution": "",
        "Released under the GPL license": "gpl",
        "released under the BSD license": "bsd",
        "released under the same license": "",
        "released under the apache license": "apache",
        "GNU Free Documentation License version 3": "",
        "This work is licensed under the GNU Free Documentation License version 3": "",
        "This work is licensed under the GNU General Documentation License version 3": "",
        "subject to the terms of the Eclipse Public License v 2.0": "",
        "This source code form is subject to the terms of the Eclipse Public License, v. 2.0": "",
        "Licensed under CC BY-XX 4.0": "",
        "licensed under a Creative Commons Zero 4.0 International License": "",
        "released under the MIT licence. Then: licensed under CC BY-SA 4.0": "cc-by-sa,mit",
    }
    frame = spark.createDataFrame([(i, "x y z. " + t + ", and more words here") for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan.scan_licenses(frame).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def brute_force(text, least=0.75, k=3, gap=3, slack=1.5):
    """(labels, score): every template laid on every diagonal that has one of its k-grams."""
    words = re.findall(license_scan.WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    spans = []
    for label, notice in license_scan.TEMPLATES:
        t = notice.replace("*", "").split(" ")
        needed = {q for q, w in enumerate(notice.split(" ")) if w[0] == "*"}
        diagonals = sorted({p - q for p in range(len(words) - k + 1) for q in range(len(t) - k + 1) if words[p : p + k] == t[q : q + k]})
        runs = []
        for d in diagonals:
            if runs and d - runs[-1][-1] <= gap:
                runs[-1].append(d)
            else:
                runs.append([d])
        for run in runs:
            same = [(d, q) for d in run for q in range(len(t)) if 0 <= d + q < len(words) and words[d + q] == t[q]]
            # the span of a run goes from its first to its last agreeing word
            first, last = min(d + q for d, q in same), max(d + q for d, q in same)
            covered, length = len({q for _, q in same}), last - first + 1
            coverage = covered / max(len(t), length)
            if coverage >= least and length <= len(t) * slack + gap and needed <= {q for _, q in same}:
                spans.append((covered, coverage, label, first, last))
    kept = []
    for s in sorted(spans, reverse=True):
        if not any(2 * (min(s[4], b[4]) - max(s[3], b[3]) + 1) >= min(s[4] - s[3], b[4] - b[3]) + 1 for b in kept):
            kept.append(s)
    own = base(text)[4]
    labels = sorted({s[2] for s in kept} | set(filter(None, own.split(","))))
    return ",".join(labels), 1.0 if own else max((s[1] for s in kept), default=0.0)


def test_labels_and_scores_match_brute_force(spark):
    rng, texts = random.Random(12), ["licensed under cc licensed under cc by", "the mit license " * 3, None, ""]
    for _ in range(250):
        words = []
        for _ in range(rng.randrange(4)):
            words += [rng.choice(["the", "of", "software", "license", "x", "y"]) for _ in range(rng.randrange(12))]
            notice = rng.choice(license_scan.TEMPLATES)[1].replace("*", "").split(" ")
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                at = rng.randrange(len(notice))
                notice[at : at + rng.randrange(2)] = rng.choice([[], ["z"], ["free", "of"], ["bsd"], ["mit"], ["general"]])
            words += notice[rng.choice([0, 0, 3]) :]
        texts.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in license_scan.scan_licenses(frame).collect()}
    wanted = {i: (labels, round(score, 9)) for i, (labels, score) in enumerate(map(brute_force, texts))}
    assert got == wanted
    assert wanted[0] == ("", 0.0) and sum(bool(labels) for labels, _ in wanted.values()) > 100


def test_a_word_in_place_of_the_telling_ones_is_no_license(spark):
    """Every template with each of its telling words replaced has no label of its own."""
    texts = []
    for label, notice in license_scan.TEMPLATES:
        words = notice.split(" ")
        texts += [(label, " ".join("zork" if i == at else w.lstrip("*") for i, w in enumerate(words))) for at, w in enumerate(words) if w[0] == "*"]
    frame = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.labels.split(",") for r in license_scan.scan_licenses(frame).collect()}
    wrong = [t for i, t in enumerate(texts) if t[0] in got[i] and t[0] not in base(t[1])[4].split(",")]
    assert not wrong, wrong


def test_a_long_text_of_notices_takes_linear_time(spark):
    seconds = {}
    for n in (2_000, 30_000):
        text = "released under the MIT license. " * n + "x y z. " + "Licensed under CC BY-SA 4.0 " * n
        frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.time()
        (row,) = license_scan.scan_licenses(frame).collect()
        seconds[n] = time.time() - began
        assert (row.labels, row.score, len(row.spans)) == ("cc-by-sa,mit", 1.0, 2 * n)
    assert seconds[30_000] < 60, seconds
