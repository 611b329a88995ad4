"""Interaction tables: (user_id, track_id, count) triples in parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.session import shared_dir

# Codecs every Spark build can write. Brotli needs a codec class the build lacks.
CODECS = ("gzip", "none", "snappy", "zstd", "lz4")


def read_table(spark: SparkSession, name: str, root: str = "", view: str | None = None) -> DataFrame:
    """Scan ``root + name`` (a plain prefix, so ``root`` may end in a slash or in a file prefix).

    ``view`` also registers the table for ``spark.sql``.
    """
    df = spark.read.parquet(root + name)
    if view:
        df.createOrReplaceTempView(view)
    return df


def rewrite(df: DataFrame, codec: str, path: str | None = None) -> DataFrame:
    """Write ``df`` with another parquet codec and read the copy back: same rows, other bytes."""
    if codec not in CODECS:
        raise ValueError(f"codec {codec!r} is not one of {CODECS}")
    spark = df.sparkSession
    path = path or f"{shared_dir(spark)}/codec-{codec}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def split_of(df: DataFrame, split: str) -> DataFrame:
    """One part of a table that carries its split as a column."""
    return df.filter(F.col("split") == split).drop("split")


def sum_counts(df: DataFrame, user: str = "user_id", item: str = "track_id") -> DataFrame:
    """One row per (user, item) pair with the summed count.

    A factor model takes repeated rows of a pair as separate ratings, so copies (from sampling
    with replacement, or from raw logs) have to be added up before a fit.
    """
    return df.groupBy(user, item).agg(F.sum("count").alias("count"))
