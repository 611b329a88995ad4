"""Dense integer ids for string ids, ordered by frequency, without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.joins import HOT_ROWS, Frequent, frequent, join_unique
from earshot.sources.store import fingerprint, load_or_build, materialize

# monotonically_increasing_id keeps the row number within a partition in the lower
# 33 bits and the partition number above them; factor models take ids in the int range.
POSITION_BITS = 33
MAX_IDS = 2**31 - 1
SORT_ROWS = 500_000


def fit_indexes(rows: DataFrame, keys: Sequence[str], sort_rows: int = SORT_ROWS) -> list[DataFrame]:
    """(key, ix, n) for each of ``keys``, from one pass over the rows: ids numbered from 0 by descending frequency, ties in
    ascending id order. Nulls have no number.

    All keys are counted together, as (kind, id). The number of rows is taken first, of a written table from its
    footers: one of up to ``sort_rows`` rows, and so of at most as many ids, is
    then sorted in one task per key, whose row numbers are the ids. Beyond, range partitioning puts the order across
    partitions and a local sort puts it within them, so an id's number is its position in its partition plus the
    sizes of the partitions before. The ordered table is written before the sizes are taken: range bounds come from
    a sample, and both sides of the sum must see the same partitions.
    """
    types = {rows.schema[key].dataType for key in keys}
    if len(types) > 1:
        return [fit_indexes(rows, [key], sort_rows)[0] for key in keys]
    each = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(key).alias("id")) for kind, key in enumerate(keys)]))
    ids = rows.select(each.alias("_each")).select("_each.*").filter(F.col("id").isNotNull())
    counts = ids.groupBy("kind", "id").agg(F.count(F.lit(1)).alias("n"))
    order = ["kind", F.desc("n"), F.asc("id")]
    position = F.col("_at").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    if rows.count() <= sort_rows:
        placed = counts.repartitionById(len(keys), "kind").sortWithinPartitions(*order)
        ordered = materialize(placed.withColumn("_at", F.monotonically_increasing_id()), "index").withColumn("_start", F.lit(0))
    else:
        placed = counts.repartitionByRange(*order).sortWithinPartitions(*order)
        written = materialize(placed.withColumn("_at", F.monotonically_increasing_id()), "index")
        part = F.shiftright("_at", POSITION_BITS).cast("int").alias("_part")
        sizes = sorted(tuple(row) for row in written.groupBy("kind", part).agg(F.count(F.lit(1))).collect())
        before, ahead, starts = {}, {}, []
        for kind, number, size in sizes:
            # rows of a smaller kind stand first in a partition that holds two
            starts.append((kind, number, before.get(kind, 0) - ahead.get(number, 0)))
            before[kind] = before.get(kind, 0) + size
            ahead[number] = ahead.get(number, 0) + size
        for kind, total in before.items():
            if total > MAX_IDS:
                raise ValueError(f"more than {MAX_IDS} distinct values in {keys[kind]}")
        offsets = rows.sparkSession.createDataFrame(starts, "kind int, _part int, _start bigint")
        # a row per range partition and key, so never more than a multiple of the shuffle partition setting
        ordered = written.withColumn("_part", part).join(F.broadcast(offsets), ["kind", "_part"])
    return [
        ordered.filter(F.col("kind") == kind).select(F.col("id").alias(key), (F.col("_start") + position).cast("int").alias("ix"), "n")
        for kind, key in enumerate(keys)
    ]


def fit_index(rows: DataFrame, key: str, sort_rows: int = SORT_ROWS) -> DataFrame:
    """(key, ix, n) for one key, see ``fit_indexes``."""
    return fit_indexes(rows, [key], sort_rows)[0]


def apply_index(
    rows: DataFrame,
    users: DataFrame,
    items: DataFrame,
    user: str = "user_id",
    item: str = "track_id",
    fitted: bool = False,
    counts: Frequent | None = None,
    **skew,
) -> DataFrame:
    """Append ``user_ix`` and ``item_ix``; rows with an unseen or null id are dropped.

    ``fitted`` says that ``rows`` are the ones the maps were fitted on, whose frequencies then tell the hot ids. Of other
    rows ``counts`` (``Frequent``) tells them, or else a pass over the rows.
    """
    user_map = users.select(user, F.col("ix").alias("user_ix"))
    item_map = items.select(item, F.col("ix").alias("item_ix"))
    known = {user: counts, item: counts}
    if fitted:
        # one look at both maps: mostly no id has so many rows that it could be hot
        floor = skew.get("hot_rows", HOT_ROWS)
        few = users.filter(F.col("n") > floor).select("n").union(items.filter(F.col("n") > floor).select("n"))
        if few.isEmpty():
            return rows.join(user_map, user).join(item_map, item)
        known = {user: users.select(user, "n"), item: items.select(item, "n")}
    elif counts is None:
        known = dict.fromkeys((user, item), frequent(rows, [user, item], skew.get("shares")))
    out = join_unique(rows, user_map, user, counts=known[user], **skew)
    return join_unique(out, item_map, item, counts=known[item], **skew)


def load_or_fit_index(rows: DataFrame, path: str, user: str = "user_id", item: str = "track_id") -> tuple[DataFrame, DataFrame]:
    """User and item maps saved under ``path`` for exactly these rows, fitted and saved if missing."""
    tables = load_or_build(
        rows.sparkSession,
        path,
        fingerprint(rows, user, item),
        lambda: dict(zip(("users", "items"), fit_indexes(rows, [user, item]))),
    )
    return tables["users"], tables["items"]
