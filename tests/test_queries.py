"""Every query of the inventory against its DuckDB oracle on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as entry
from relcast.queries.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(rows):
    def v(x):
        return "∅" if x is None else f"{x:.12g}" if isinstance(x, float) else str(x)
    return sorted(tuple(v(x) for x in r) for r in rows)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = _norm(df.select(*[f"`{c}`" for c in cols]).collect())
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    want = _norm(con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({ORACLES[name]})").fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "_input_file_date" in df.columns
