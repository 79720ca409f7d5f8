import hashlib
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitecensus.llm import exact_dedup

from sample_rows import DOCS, ROWS


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known, default=None)
        left = 1
        for i in ids:
            stays = i == keep and left > 0
            left -= stays
            out.append((i, keep, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_matches_brute_force_on_edge_cases(docs):
    assert found(exact_dedup.exact_dedup(docs)) == brute([r[:2] for r in ROWS])


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 40), st.sampled_from(["", "a", "b", "c", None, "dd"])), min_size=1, max_size=60))
def test_matches_brute_force(spark, rows):
    assert found(exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_a_full_filter_only_costs_shuffling(spark):
    rows = [(i, f"text {i % 700}") for i in range(1000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    everything = exact_dedup._suspects(frame, F.col("text"), 128)[0]
    assert everything.where("maybe_repeated").count() < 760  # 600 rows repeat
    assert found(exact_dedup.exact_dedup(frame)) == brute(rows)


def test_empty_table(no_docs):
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    assert exact_dedup.drop_exact_copies(no_docs).count() == 0


def test_dropping_keeps_columns_and_one_row_a_text(docs, spark):
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len({r.text or "" for r in rows}) == len(rows) == 7
    assert {r.doc_id for r in rows if r.text == "a b c d e f g h i j"} == {2}
    assert spark.createDataFrame(ROWS, DOCS).count() == len(ROWS)
