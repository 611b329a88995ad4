"""Registered queries against their SQL, also with parameters that split and cut more than the data at hand would."""

import glob
import os

import duckdb
import pytest

from earshot.llm import lines, queries, sharding


@pytest.fixture(scope="module")
def db(sf_dir):
    out = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        out.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return out


def same(found, wanted):
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    got = sorted(repr(tuple(row)) for row in found.select(columns).collect())
    assert got == sorted(repr(row) for row in wanted.select(*columns).fetchall()) and got


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, db, name):
    same(queries.QUERIES[name](spark, sf_dir), db.sql(queries.ORACLES[name]))


@pytest.mark.parametrize("limit,few", [(1_000, 50_000), (1_000, 0), (20_000, 0), (300_000, 50_000)])
def test_shards_for_small_limits(spark, sf_dir, db, limit, few):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = sharding.shard(docs, limit, few=few).select("doc_id", *sharding.MADE)
    same(found, db.sql(sharding.sql(limit)))
    if few == 0 and limit == 1_000:
        # a text is moved once per lookup, not once per depth in use
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert found.select("depth").distinct().count() > 3 and plan.count("Join LeftOuter") <= 3 and "Generate" not in plan


@pytest.mark.parametrize("run_words", [1, 8, 120])
def test_lines_for_other_runs(spark, sf_dir, db, run_words):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = lines.dedup_lines(docs, run_words)
    same(
        found.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("text_md5")),
        db.sql(lines.sql(run_words)),
    )
