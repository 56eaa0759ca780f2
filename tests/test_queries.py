"""Every registered query against its SQL in another engine."""

import duckdb
import pytest
from conftest import plan_of

import __spark_entry__ as entry
from sortwell.plans.queries import QUERIES

TABLES = "supplier part orders lineitem events documents embeddings labels".split()


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def in_order(columns, data):
    pick = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in pick) for r in data), key=lambda r: [(v is None, str(v)) for v in r])


PIXEL_QUERIES = {"image_hash64", "image_integrity", "preprocess_eval", "preprocess_eval_long"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, oracle, name):
    """The same rows as the SQL, from a plan without pairwise joins and, but for pixels, Python workers."""
    df = entry.queries()[name](spark, sf)
    plan = plan_of(df)
    for node in ("CartesianProduct", "NestedLoop", "Python", "InPandas"):
        assert node not in plan or name in PIXEL_QUERIES
    got = in_order(df.columns, [tuple(r) for r in df.collect()])
    answer = oracle.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(answer.columns)
    assert got == in_order(answer.columns, answer.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["key_a", "key_b", "hash_distance"]
