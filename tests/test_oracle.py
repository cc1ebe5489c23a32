"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from scripts.oracle_check import rows_of
from scripts.type_check import spark_type
from tests.conftest import SF_SMALL

E.queries()
# The raster queries: each has an oracle.  The corpus queries, which SQL cannot express, are held against brute force in tests/llm.
QUERIES = dict(E.registry.QUERIES)
ORACLE = dict(E.registry.ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[key])
    d_names = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_names)
    assert rows_of(df.columns, s_rows) == rows_of(d_names, d_rows)
    s_types = {f.name: spark_type(f.dataType.simpleString()) for f in df.schema.fields}
    rel = duck.sql(ORACLE[key])
    assert s_types == {n: str(t) for n, t in zip(rel.columns, rel.types)}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["instant", "mean", "n"]
    df.collect()
