"""Count transforms: each takes a table with ``count`` and returns it with ``modcounts``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def identity(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("count", "modcounts")


def natural_log(df: DataFrame) -> DataFrame:
    """A count of 1 becomes 0, which an implicit model reads as no preference at all."""
    return df.withColumn("modcounts", F.log("count"))


def above(df: DataFrame, least: int) -> DataFrame:
    """Keep counts strictly above ``least``."""
    return identity(df.filter(F.col("count") > least))


TRANSFORMS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "identity": identity,
    "log": natural_log,
    "gt1": lambda df: above(df, 1),
    "gt2": lambda df: above(df, 2),
}
