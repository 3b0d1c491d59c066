"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMOKE

TABLES = sorted(name.removesuffix(".parquet") for name in os.listdir(SF_SMOKE))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMOKE, t)}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMOKE)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(rows, df.columns) == _canon(res.fetchall(), ocols)


def test_every_query_has_an_oracle_or_tests_of_its_own():
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert all(name.startswith("op") or name == "pipeline" for name in without)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["source_chembl_id", "target_chembl_id", "similarity_score",
                          "has_duplicates_of_last_largest_score"]
    assert df.count() >= 0


def test_refresh_fact_equals_oracle_fact(spark, con):
    """The rows and flags of a refresh must equal the SQL statement of the fact."""
    from setsim import fixtures
    from setsim.plans.oracle import with_ctes
    from setsim.plans.refresh import full_refresh
    res = full_refresh(spark, fixtures.raw_release(spark, SF_SMOKE), fk_mode="report")
    cols = "source_chembl_id, target_chembl_id, similarity_score, has_duplicates_of_last_largest_score"
    got = sorted(tuple(r) for r in res.tables["gold.fact_similarity"].selectExpr(*cols.split(", ")).collect())
    want = sorted(con.execute(with_ctes(f"SELECT {cols} FROM fact", "fact")).fetchall())
    assert got == want and len(got) == 1000
