"""Interaction and vector tables derived from the given parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _held_out(after: Column, user: Column) -> Column:
    """Later rows of every tenth user are validation, of the next tenth test; the rest is train."""
    return (
        F.when(after & (user % 10 == 0), "val").when(after & (user % 10 == 1), "test").otherwise("train")
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, track_id, split, count): parts bought by customers, counted in pieces."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("track_id"),
        _held_out(F.col("o_orderdate") >= "2000-01-01", F.col("o_custkey")).alias("split"),
        "l_quantity",
    )
    return rows.groupBy("user_id", "track_id", "split").agg(
        F.sum("l_quantity").cast("bigint").alias("count")
    )


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, track_id, split, count): event keys touched by users, counted in events."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return (
        events.select(
            F.col("user_id").cast("string").alias("user_id"),
            F.get_json_object("props", "$.k").alias("track_id"),
            _held_out(F.col("ts") >= "2024-01-24", F.col("user_id")).alias("split"),
        )
        .groupBy("user_id", "track_id", "split")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, vec): the embeddings, which are unit vectors."""
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec")
    )


def scaled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings with norms 1 to 5, so that inner product and angle disagree."""
    return vectors(spark, sf_dir).withColumn(
        "vec", F.transform("vec", lambda x: x.cast("double") * (1 + F.col("id") % 5))
    )


def history_lists(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """(user_ix, item_ix, score, rank): every user's k most played training items, a list whose
    quality SQL can compute as well. The rank limit also applies before the shuffle."""
    order = W.partitionBy("user_ix").orderBy(F.desc("score"), F.asc("item_ix"))
    return (
        numbered(spark, sf_dir, "train")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
    )


def numbered(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    """(user_ix, item_ix, score): plays of one split with their ids, which are numbers, as they are."""
    return (
        plays(spark, sf_dir)
        .filter(F.col("split") == split)
        .select(
            F.col("user_id").cast("int").alias("user_ix"),
            F.col("track_id").cast("int").alias("item_ix"),
            F.col("count").cast("double").alias("score"),
        )
    )
