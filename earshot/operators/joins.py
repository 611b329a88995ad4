"""Joins against tables with one row per key that stay balanced when single keys hold many rows."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from earshot.sources.store import materialize

SHARE_OF_TASK = 0.5
HOT_ROWS = 1_000_000
# The most that Spark's sketch of frequent values tracks and returns.
MOST_TRACKED, MOST_RETURNED = 1_000_000, 100_000
TRACKED_PER_SHARE = 32
LEAST_TRACKED = 1 << 14
_UNHASHED = re.compile('"(map|variant)"')


def default_shares(rows: DataFrame) -> int:
    """A key is hot once it fills half of a mean task: twice the number of shuffle partitions."""
    return math.ceil(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) / SHARE_OF_TASK)


def _frequent(key: str, shares: int) -> Column:
    """The ``shares`` most frequent values of a key with their numbers, from a sketch that tasks make of their rows and
    that merges: its error is some 1/18 of a share at most, and 0 for few values. It decides on balance, never on rows."""
    tracked = min(MOST_TRACKED, max(LEAST_TRACKED, TRACKED_PER_SHARE * shares))
    return F.expr(f"approx_top_k(`{key}`, {min(shares, MOST_RETURNED, tracked)}, {tracked})")


@dataclass
class Frequent:
    """Number of rows of a table, and the values that hold most of them, (value, rows) per key."""

    n_rows: int
    values: dict[str, list[tuple]]

    def hot(self, key: str, shares: int, hot_rows: int = HOT_ROWS) -> list[tuple]:
        """(value, salts) for values with more than 1/``shares`` of the rows and more than ``hot_rows``."""
        floor = max(self.n_rows / shares, hot_rows)
        return [(value, math.ceil(n / floor)) for value, n in self.values.get(key, []) if value is not None and n > floor]


def _read(row: dict, keys: Sequence[str]) -> Frequent:
    return Frequent(row["n"], {key: [(item["item"], item["count"]) for item in row[f"k{i}"] or []] for i, key in enumerate(keys)})


def frequent(rows: DataFrame, keys: Sequence[str], shares: int | None = None) -> Frequent:
    """The frequent values of ``keys`` in one pass over them, without a shuffle of the rows."""
    shares = shares or default_shares(rows)
    return _read(rows.agg(F.count(F.lit(1)).alias("n"), *[_frequent(key, shares).alias(f"k{i}") for i, key in enumerate(keys)]).first().asDict(), keys)


def materialize_counted(rows: DataFrame, label: str, keys: Sequence[str], shares: int | None = None) -> tuple[DataFrame, Frequent]:
    """``rows`` written and read back, and the frequent values of ``keys``, which the writing tasks take on the way."""
    shares, seen = shares or default_shares(rows), Observation(f"{label}-frequent")
    watched = rows.observe(seen, F.count(F.lit(1)).alias("n"), *[_frequent(key, shares).alias(f"k{i}") for i, key in enumerate(keys)])
    return materialize(watched, label), _read(seen.get, keys)


def hot_keys(
    rows: DataFrame,
    key: str,
    counts: DataFrame | Frequent | None = None,
    shares: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> list[tuple]:
    """(key, salts) for keys with more than 1/``shares`` of the rows and more than ``hot_rows``.

    By default a key is hot once it fills half of a mean task, so ``shares`` is twice the number of shuffle
    partitions and grows with it, and each salt of a hot key is at most such a half. Fewer than ``shares`` keys
    can be hot, which bounds what is fetched here and broadcast later. ``counts`` spares the pass over the rows: what
    was noted when they were written, or a table (key, n), of which only the rows that can be hot are read.
    """
    shares = shares or default_shares(rows)
    if counts is None:
        counts = frequent(rows, [key], shares)
    if isinstance(counts, Frequent):
        return counts.hot(key, shares, hot_rows)
    able = counts.filter((F.col("n") > hot_rows) & F.col(key).isNotNull())
    if able.isEmpty():
        return []
    floor = max(counts.agg(F.sum("n")).first()[0] / shares, hot_rows)
    return [(row[0], math.ceil(row[1] / floor)) for row in able.filter(F.col("n") > floor).select(key, "n").collect()]


def join_unique(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    counts: DataFrame | Frequent | None = None,
    shares: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``rows`` with ``lookup`` (one row per key); ``how`` is inner, left or left_semi.

    Rows of a hot key are spread over salts and the key's one lookup row is copied to each. The salt depends on the row
    (all of its columns that can be hashed) and its partition only, so a task that runs again gives the same one, and
    equal rows in different partitions get different ones. ``counts`` as for ``hot_keys``. Names do not clash.
    """
    salts = hot_keys(rows, key, counts, shares, hot_rows)
    if not salts:
        return rows.join(lookup, key, how)
    taken = {name.lower() for name in (*rows.columns, *lookup.columns)}
    salt, number = (next(name for name in (f"_{word}{'_' * n}" for n in range(len(taken) + 1)) if name not in taken) for word in ("salt", "salts"))
    hot = F.broadcast(
        rows.sparkSession.createDataFrame(salts, f"`{key}` {rows.schema[key].dataType.simpleString()}, {number} int")
    )
    hashed = [F.col(f"`{field.name}`") for field in rows.schema if not _UNHASHED.search(field.dataType.json())]
    spread = F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), F.col(number))
    left = rows.join(hot, key, "left").withColumn(salt, F.coalesce(spread, F.lit(0)).cast("int")).drop(number)
    right = lookup.join(hot, key, "left").withColumn(
        salt, F.explode(F.sequence(F.lit(0), F.coalesce(number, F.lit(1)) - 1))
    ).drop(number)
    return left.join(right, [key, salt], how).drop(salt)
