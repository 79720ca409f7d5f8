"""The queries that have SQL give its rows, on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from sitecensus.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    frame = queries.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    wanted = duck.sql(queries.oracle_sql()[name]).to_arrow_table()
    assert sorted(wanted.column_names) == columns
    rows = lambda t: Counter(tuple(r[c] for c in columns) for r in t.to_pylist())
    assert rows(frame.select(*columns).toArrow()) == rows(wanted)


def test_sql_of_the_jaccard_join_on_edge_cases(spark):
    from sample_rows import ROWS
    from test_jaccard_join import brute, near_copies

    for texts in ([r[:2] for r in ROWS if r[0] is not None], near_copies(5, 120)):
        texts = list({i: t for i, t in texts}.items())
        duck = duckdb.connect()
        duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        duck.executemany("INSERT INTO documents VALUES (?, ?)", texts)
        found = duck.sql(queries.OP7_SQL).fetchall()
        assert sorted(found, key=str) == brute(texts)
