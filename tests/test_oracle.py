"""Every registered query against its SQL, as the driver compares them, on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    columns = sorted(frame.columns)

    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return ""
        if isinstance(v, float):
            return f"{v:.9g}" if v else "0"
        return str(v)

    return columns, sorted(tuple(cell(v) for v in r) for r in frame[columns].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, sf_dir, name):
    found = entry.queries()[name](spark, sf_dir).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(found) > 0
    else:
        assert rows(found) == rows(duck.execute(sql).fetchdf())


def test_entry(spark, sf_dir):
    assert entry.entry(spark).columns == ["chi_ordinate", "chi_id", "n"]


def test_oracles_are_of_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
