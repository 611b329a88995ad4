"""Written intermediates and the load-or-build pattern."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.session import shared_dir


_INSIDE: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is materialised inside goes into a folder of its own, which is deleted at the end. Nothing that reads it may be
    used after that."""
    folder = f"{shared_dir(spark)}/{'/'.join(_INSIDE + [f'scratch-{uuid.uuid4().hex}'])}"
    _INSIDE.append(folder.rsplit("/", 1)[1])
    try:
        yield
    finally:
        _INSIDE.pop()
        delete(spark, folder)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared folder, wherever that is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str, codec: str | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder (or to ``path``), with Spark's own codec or another, and read it back.

    Cuts the lineage, survives lost executors, and unlike an RDD checkpoint keeps column pruning
    and file sizes for the planner.
    """
    path = path or "/".join([shared_dir(df.sparkSession), *_INSIDE, f"{label}-{uuid.uuid4().hex}"])
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None where there is none; any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def fingerprint(df: DataFrame, *cols: str) -> str:
    """Order-independent digest of the given columns: row count and the sum of the row hashes."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*cols).cast("decimal(20,0)")).alias("h"),
    ).first()
    return f"{row.n}_{row.h}".replace("-", "m")


def load_or_build(
    spark: SparkSession, path: str, key: str, build: Callable[[], dict[str, DataFrame]]
) -> dict[str, DataFrame]:
    """Tables saved under ``path/key``, built and saved first where they are missing.

    ``key`` is the fingerprint of the input, so tables of another input are never reused. The
    marker is written last: a half-written folder counts as missing and is rebuilt.
    """
    root = f"{path.rstrip('/')}/{key}"
    marker = read_if_present(spark, f"{root}/complete")
    if marker is None:
        tables = build()
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{root}/{name}")
        names = spark.createDataFrame([(name,) for name in tables], "name string")
        names.coalesce(1).write.mode("overwrite").parquet(f"{root}/complete")
        marker = names
    return {row.name: spark.read.parquet(f"{root}/{row.name}") for row in marker.collect()}
