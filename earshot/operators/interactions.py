"""Row selection and aggregation on interaction tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.joins import join_unique


def users_union(*tables: DataFrame, user: str = "user_id") -> DataFrame:
    """Distinct users of all tables. Each table is reduced first, so hot users shrink map-side."""
    users = tables[0].select(user)
    for table in tables[1:]:
        users = users.union(table.select(user))
    return users.distinct()


def keep_users(rows: DataFrame, users: DataFrame, user: str = "user_id", **skew) -> DataFrame:
    """Rows whose user occurs in ``users`` (one row per user)."""
    return join_unique(rows, users.select(user), user, "left_semi", **skew)


def frequency(rows: DataFrame, key: str) -> DataFrame:
    """(key, n): rows per key, nulls left out."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def top_counts(rows: DataFrame, n: int = 500) -> DataFrame:
    """The ``n`` rows with the largest counts, ties by user and track."""
    return rows.orderBy(F.desc("count"), "user_id", "track_id").limit(n)


def sample_by_key(rows: DataFrame, key: str, fraction: float, salt: str = "") -> DataFrame:
    """Bernoulli sample of keys without replacement, decided by a hash of the key.

    The same keys are drawn in every run, on every partitioning and in every table, and all rows
    of a drawn key are kept.
    """
    bucket = F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col(key))), 1, 8), 16, 10).cast("bigint")
    return rows.filter(bucket < int(fraction * 2**32))


def poisson_limits(mean: float, steps: int = 2**32) -> list[int]:
    """Upper ends, in ``steps``, of the parts of [0, 1) that stand for 0, 1, 2, ... draws."""
    limits, chance, total, n = [], math.exp(-mean), 0.0, 0
    while not limits or limits[-1] < steps - 1 and n < 1000:
        total += chance
        limits.append(min(steps, int(total * steps)))
        n += 1
        chance *= mean / n
    return limits


def sample_with_copies(rows: DataFrame, mean: float, keys: list[str], salt: str = "") -> DataFrame:
    """Poisson sample with replacement, decided by a hash of ``keys``: each row as often as its hash says, ``mean``
    times on average. The same in every run and on every partitioning; rows alike in the keys get the same number."""
    text = F.concat(F.lit(salt), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    copies = sum(((place >= limit).cast("int") for limit in poisson_limits(mean)), F.lit(0))
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("_copy")


def sample_rows(rows: DataFrame, fraction: float, seed: int, replace: bool = False) -> DataFrame:
    """Row sample: Bernoulli, or Poisson where rows may repeat."""
    return rows.sample(replace, fraction, seed)
