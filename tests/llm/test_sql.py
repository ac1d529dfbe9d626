"""The queries of the subpackage against their SQL, of which most needs a running session."""

import glob
import os

import duckdb
import pytest

from foliospark.llm import oracle, queries

DATA = "/root/testdata/sf0.001"
NAMES = ["p1_form", "p1_groups", "p1_found", "p2_found", "p2_neighbours", "p4_found", "p4_clean", "p5_found", "p5_groups", "p6_cover", "p7_found", "p8_cover"]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = queries.QUERIES[name](spark, DATA)
    got = sorted(str(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())
    found = duck.execute(oracle.sql()[name])
    columns = [c[0] for c in found.description]
    order = [columns.index(c) for c in sorted(columns)]
    assert sorted(columns) == sorted(df.columns)
    assert got == sorted(str(tuple(r[i] for i in order)) for r in found.fetchall())


def test_every_sql_has_a_query(spark):
    assert set(oracle.sql()) == set(NAMES) and not set(NAMES) - queries.QUERIES.keys()
