"""Driver contract, and every oracle query against DuckDB on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["productId", "rank", "simProductId", "score"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_the_other_queries_do_without_the_training_data_subpackage(monkeypatch):
    monkeypatch.setattr(E, "find_spec", lambda name: None)
    names = set(E.queries())
    assert "itemcf_similarity_top10" in names and not any(n.startswith("op1") or n == "pipeline" for n in names)
    assert set(E.oracle_sql()) <= names


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from oracle_check import TABLES
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_match(spark, duck, name):
    from oracle_check import rows_duck, rows_spark
    sc, sr = rows_spark(E.queries()[name](spark, SF_SMALL))
    dc, dr = rows_duck(duck, E.oracle_sql()[name])
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
