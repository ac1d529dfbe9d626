"""The registered queries against DuckDB, and the library without its optional subpackage."""

import glob
import os
import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: "null" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v)
    return sorted(columns), sorted(tuple(show(r[i]) for i in order) for r in data)




@pytest.mark.parametrize("name", [q for q in entry.queries() if q in entry.oracle_sql()])
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    found = duck.execute(entry.oracle_sql()[name])
    want = rows([c[0] for c in found.description], found.fetchall())
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == want


KEYS = {"chunk_markdown": ["extract_id", "chunk_index"], "index_extracts": ["vector_id"]}


@pytest.mark.parametrize("name", [q for q in entry.queries() if q not in entry.oracle_sql()])
def test_query_without_sql_has_whole_rows(spark, name):
    df = entry.queries()[name](spark, DATA).cache()
    n = df.count()
    assert n > 0 and len(set(df.columns)) == len(df.columns)
    key = KEYS.get(name, df.columns)
    assert df.select(key).distinct().count() == n
    assert df.filter(df[key[0]].isNull()).count() == 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert not entry.oracle_sql().keys() - entry.queries().keys()


def test_core_does_without_the_llm_subpackage():
    code = "import sys; sys.modules['foliospark.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'document_families' in q and not [x for x in q if x.startswith('p1_')]; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
    for p in (ROOT / "foliospark").rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"^\s*(from|import)\s.*\bllm\b", p.read_text(), re.M), p
