import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver

# model queries are covered by test_models; these are the ones SQL states value by value
FAST = [
    name
    for name in driver.oracle_sql()
    if not name.startswith(("als_", "indexed_als", "grid_", "cross_", "explicit_", "compare_", "evaluate_", "train_and"))
]


@pytest.fixture(scope="module")
def db(sf_dir):
    out = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        out.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return out


@pytest.mark.parametrize("name", FAST)
def test_query_equals_its_sql(spark, sf_dir, db, name):
    found, wanted = driver.queries()[name](spark, sf_dir), db.sql(driver.oracle_sql()[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    columns = sorted(found.columns)
    got = sorted(repr(tuple(row)) for row in found.select(columns).collect())
    want = sorted(repr(row) for row in wanted.select(*columns).fetchall())
    assert got == want and got


def test_flagship(spark):
    row = driver.entry(spark).first()
    assert (row.k, row.n_users) == (500, 13)
    assert 0 <= row.precision_at_k <= 1 and 0 <= row.map <= 1


def test_every_oracle_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
