"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from relcast.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert "pipeline" in names and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    columns = sorted(want.columns)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    key = lambda row: tuple((x is None, str(x)) for x in row)
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=key)
    assert rows == sorted(want.project(", ".join(columns)).fetchall(), key=key)
