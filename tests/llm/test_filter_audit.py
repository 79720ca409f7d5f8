import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np

from sitecensus.llm import filter_audit, queries

from sample_rows import DOCS, ROWS

LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 1), (3, 1, None), (7, None, 1), (20, 1, 0), (21, 1, 1), (22, 0, 1), (99, 1, 1), (None, 1, 1)]
EXTRA = [
    (20, "word" + " some more words here" * 12, "en", "s1", 1),
    (21, "word" + " some more words here" * 12, "en", "s2", 1),
    (22, " ".join(f"W{i}" for i in range(60)), "en", "s2", 1),
    (23, " ".join(f"w{i}" for i in range(60)), "en", "s2", 1),
    (24, " ".join(f"w{i}" for i in range(60)) + " # x", "en", None, 1),
    (25, "a\x0bb\x0cc\xa0d e\x1cf " + " ".join(f"w{i}" for i in range(46)), "en", "", 1),
]


def fails(text, doc_id, smallest):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search("[#$%&*|]", text)),
        "E": doc_id is not None and smallest is not None and doc_id > smallest,
    }


def brute(rows, labels):
    """Each order applied to each row, filter after filter."""
    smallest = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            smallest[r[1] or ""].append(r[0])
    ones = {k: {i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1)}
    judged = [(r[3] or "", r[0], fails(r[1] or "", r[0], min(smallest[r[1] or ""], default=None))) for r in rows]
    out = {}
    for part in {p for p, *_ in judged}:
        own = [(i, f) for p, i, f in judged if p == part]
        shapley = Counter()
        told = {}
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                removed = [x for x in left if x[1][letter]]
                left = [x for x in left if not x[1][letter]]
                shapley[letter] += len(removed)
                told["".join(order), step] = (
                    len(left),
                    len(removed),
                    sum(f[letter] for _, f in own) - len(removed),
                    sum(f[letter] and sum(f.values()) == 1 for _, f in own),
                    sum(i in ones[0] for i, _ in removed),
                    sum(i in ones[1] for i, _ in removed),
                )
        out |= {(part, order, step): (*v, shapley[order[step - 1]]) for (order, step), v in told.items()}
    return out


def test_every_order_matches_brute_force_and_sql(spark):
    rows = ROWS + EXTRA
    frame = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS mask", "2 AS part", "3 AS digest", "4 AS good")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS source", "5 AS n")
    found = {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audit(frame, labels).collect()}
    wanted = brute(rows, LABELS)
    assert found == wanted and len(found) == 600 * len({r[3] or "" for r in rows})
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    duck.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    duck.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    duck.executemany("INSERT INTO labels VALUES (?, ?, ?)", LABELS)
    columns = [c.split(" ")[0] for c in filter_audit.RESULT.split(", ")]
    told = duck.sql(f"SELECT {', '.join(columns)} FROM ({queries.OP11_SQL})").fetchall()
    assert {r[:3]: r[3:] for r in told} == wanted


def test_survivors_are_sums_over_masks_that_avoid_the_set():
    counts = np.random.default_rng(3).integers(0, 9, (3, 16, 2))
    found = filter_audit.survivors(counts)
    for chosen in range(16):
        assert (found[:, chosen] == counts[:, [m for m in range(16) if not m & chosen]].sum(axis=1)).all()


def test_other_filters_and_empty_tables(docs, no_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(no_docs, labels).count() == 0
    own = filter_audit.audit(docs, labels, {"x": lambda raw, words: not words}, "y", part_col="lang")
    rows = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant) for r in own.collect()}
    assert rows["en", "xy", 1] == (2, 2, 0) and rows["en", "xy", 2] == (1, 1, 1)
    assert rows["en", "yx", 1] == (2, 2, 0) and rows["en", "yx", 2] == (1, 1, 1)
    assert len(rows) == 4 * len({r[2] or "" for r in ROWS})


def test_a_hot_text_and_source(spark):
    rows = [(i, "the same text", "en", "hot", 1) for i in range(600)] + [(1000 + i, f"text {i}", "en", f"s{i % 3}", 1) for i in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 600, 2)], "doc_id long, quality int, toxic int")
    found = {(r.filter_order, r.step): r for r in filter_audit.audit(spark.createDataFrame(rows, DOCS), labels).where("part = 'hot'").collect()}
    first = found["EABCD", 1]
    assert (first.kept, first.removed, first.good_lost) == (1, 599, 299)
