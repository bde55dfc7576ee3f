"""Every query of the reference's operators against its SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from trajlake.plans.catalogue import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _canon(rows, names, order):
    at = [names.index(c) for c in order]
    return sorted(tuple(repr(r[k] + 0.0) if isinstance(r[k], float) else repr(r[k]) for k in at) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    said = duck.sql(ORACLE[name])
    names = list(said.columns)
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    assert _canon(df.collect(), df.columns, order) == _canon(said.fetchall(), names, order)


def test_every_query_without_sql_runs(spark):
    for name in sorted(set(QUERIES) - set(ORACLE)):
        assert QUERIES[name](spark, SF).count() >= 0


@pytest.mark.parametrize("name", ["release_runs", "release_findings", "release_report", "reserved_admission"])
def test_prices_between_whole_numbers_equal_sql(spark, tmp_path, name):
    """Orders at the token limit: 400000.5 and below stay within it, 400000.51 is above."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    price = "CASE o_orderkey % 4 WHEN 0 THEN 400000.5 WHEN 1 THEN 400000.51 WHEN 2 THEN 400000.99 ELSE 399999.5 END"
    con.execute(f"COPY (SELECT * REPLACE (CAST({price} AS DOUBLE) AS o_totalprice) FROM orders) TO '{tmp_path}/orders.parquet'")
    con.execute(f"CREATE OR REPLACE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet'")
    for t in TABLES:
        if t != "orders":
            os.symlink(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    df, said = QUERIES[name](spark, str(tmp_path)), con.sql(ORACLE[name])
    order = sorted(said.columns)
    assert _canon(df.collect(), df.columns, order) == _canon(said.fetchall(), list(said.columns), order)
