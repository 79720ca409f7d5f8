"""Every query runs, and gives the rows of its SQL."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from sitecensus.plans import catalog, census, flows, storage

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    made = duckdb.connect()
    for name in TABLES:
        made.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return made


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(table, columns):
    return Counter(tuple(plain(row[c]) for c in columns) for row in table.to_pylist())


@pytest.mark.parametrize("name", catalog.NAMES + storage.NAMES + flows.NAMES + census.NAMES)
def test_query(spark, duck, name):
    frame = entry.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    found = frame.select(*columns).toArrow()
    sql = entry.oracle_sql().get(name)
    if sql:
        wanted = duck.sql(sql).to_arrow_table()
        assert sorted(wanted.column_names) == columns
        assert rows_of(found, columns) == rows_of(wanted, columns)
    else:
        assert found.num_rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_texts_and_pages_are_read_beside_the_inline_rows(spark, tmp_path):
    spark.createDataFrame([(7, "Acme Widgets Limited is here"), (8, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    html = '<script type="application/ld+json">{"@type": "Organization", "name": "Acme"}</script>'
    spark.createDataFrame([(9, "https://acme.uk/", html), (10, None, None)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    for name, site in (("legal_form_names", "d7"), ("structured_data", "p9")):
        sites = {r.site for r in entry.queries()[name](spark, str(tmp_path)).collect()}
        assert {site, "a"} <= sites
