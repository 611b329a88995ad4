"""Sharding by extendible hashing: buckets of hash-prefix bits, split on one more bit while they are too large.

[native] No Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.text import apart
from earshot.operators.joins import join_unique
from earshot.sources.store import materialize

LIMIT = 16 << 20
QUERY_LIMIT = 128 << 10
BITS = 60
CONTENT_BITS = 36
STEP = 6
FEW = 50_000
MADE = ("n_bytes", "shard", "depth", "shard_bytes", "shard_rows", "oversize")


def _prefix(key: Column, depth: int) -> Column:
    """The first ``depth`` of the key's bits, as a number."""
    return F.shiftright(key, BITS - depth)


def _coarser(prefix: Column, by: Column) -> Column:
    """A prefix less its last ``by`` bits."""
    return F.call_function("shiftright", prefix, by)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Adds ``_key`` (60 bits) and ``n_bytes``: the first 36 bits are a digest of the id and, where there is no id, of the
    text; the others are 0. Rows alike in that are told apart later, where they have to be (``_told_apart``)."""
    name = F.coalesce(F.concat(F.lit("i"), F.col(doc_id).cast("string")), F.concat(F.lit("t"), F.col(text)), F.lit(""))
    content = F.conv(F.substring(F.md5(name.cast("binary")), 1, CONTENT_BITS // 4), 16, 10).cast("long")
    return docs.withColumn("n_bytes", F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")).withColumn(
        "_key", F.shiftleft(content, BITS - CONTENT_BITS)
    )


def _dealt(table: DataFrame, rows: int, few: int) -> DataFrame:
    """``table``, of at most so many rows, for a join that may send it to all tasks up to ``few`` of them. Spark's own check goes
    by the size of its files, where numbers in order take a byte or two; in a task's lookup they take a hundred."""
    return table if rows <= few else table.hint("merge")


def directory(
    keys: DataFrame, limit: int, base: int = 0, last: int = CONTENT_BITS, step: int = STEP, few: int = FEW
) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """([(depth, cells)], open cells): the directory of ``keys`` (_key, n_bytes) as lookups, each from the occupied cells
    of one depth to their shards, and the cells of ``last`` bits that are still too large.

    A bucket is split while its bytes are above ``limit`` and it has more than one row, so a row's shard is the
    shortest prefix of its key whose bucket fits. Sums of fine cells give all coarser buckets, so no level needs a
    pass of its own; only cells that are too large even so have their rows counted again, ``step`` bits deeper.
    Lookups are (cell, n, depth, prefix, shard_bytes, shard_rows, oversize); ``n`` is the number of the cell's rows, and
    ``oversize`` marks one row above the limit. Above ``base`` bits all buckets are known to be too large. What has more than
    ``few`` rows is joined by shuffle.
    """
    total = keys.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(last, max(base, math.ceil(math.log2(max(1, total / limit)))) + 2)
    lookups, rows = [], keys
    while True:
        cells = rows.groupBy(_prefix(F.col("_key"), depth).alias("cell")).agg(
            F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")
        )
        cells = materialize(cells, "shard-cells")
        levels = cells.select("*", F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("depth")).withColumn(
            "prefix", _coarser(F.col("cell"), F.lit(depth) - F.col("depth"))
        )
        buckets = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1)
        buckets = materialize(buckets.withColumn("fits", fits), "shard-buckets")
        most = buckets.count()
        # a bucket that fits is a shard where its parent does not fit (or it is the root)
        full = buckets.filter(~F.col("fits")).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        fitting = buckets.filter("fits").withColumn("parent", _coarser(F.col("prefix"), F.lit(1)))
        leaves = fitting.filter(F.col("depth") > base).join(_dealt(full, most, few), ["depth", "parent"], "left_semi")
        if base == 0:
            leaves = leaves.unionByName(fitting.filter(F.col("depth") == 0))
        open_ = buckets.filter(~F.col("fits") & (F.col("depth") == depth))
        if last == depth == BITS:
            leaves = leaves.unionByName(open_.withColumn("parent", F.lit(0).cast("bigint")))
        shards = leaves.select("depth", "prefix", "shard_bytes", "shard_rows", (F.col("shard_bytes") > limit).alias("oversize"))
        found = levels.select("cell", F.col("rows").alias("n"), "depth", "prefix").join(_dealt(shards, most, few), ["depth", "prefix"])
        lookups.append((depth, materialize(found, "shard-lookup")))
        open_ = materialize(open_.select(F.col("prefix").alias("cell"), F.col("shard_rows").alias("n")), "shard-open")
        if depth == last or open_.isEmpty():
            return lookups, open_
        celled = rows.withColumn("cell", _prefix(F.col("_key"), depth))
        able = _dealt(open_.select("cell"), open_.count(), few)
        rows = materialize(join_unique(celled, able, "cell", "left_semi", counts=open_).select("_key", "n_bytes"), "shard-rows")
        base, depth = depth, min(last, depth + step)


def _to_cells(rows: DataFrame, cells: DataFrame, own: Column, few: int) -> DataFrame:
    """Left join of ``rows`` with ``cells`` (cell, n, ...) on their own cell: sent to every task up to ``few`` rows, or
    else dealt out by cell, cells of many rows in parts."""
    keyed = rows.withColumn("cell", own)
    n, found = cells.count(), cells.drop("n")
    if n <= few:
        return keyed.join(F.broadcast(found), "cell", "left").drop("cell")
    return join_unique(keyed, _dealt(found, n, few), "cell", "left", counts=cells.select("cell", "n")).drop("cell")


def _find(rows: DataFrame, lookups: list[tuple[int, DataFrame]], few: int) -> DataFrame:
    """``rows`` with ``_found``, their shard. Each lookup is one join; a row that has its shard goes to a cell that there
    is not, so a text is moved by the large lookups alone, mostly one."""
    made = ("depth", "prefix", "shard_bytes", "shard_rows", "oversize")
    for at, (depth, cells) in enumerate(lookups):
        own = _prefix(F.col("_key"), depth)
        if at:
            own = F.when(F.col("_found").isNull(), own).otherwise(-1 - F.pmod(F.xxhash64("_key"), F.lit(1 << 30)))
        here = cells.select("cell", "n", F.struct(*made).alias("_here"))
        rows = _to_cells(rows, here, own, few)
        rows = rows.withColumn("_found", F.coalesce("_found", "_here") if at else F.col("_here")).drop("_here")
    return rows


def shard(docs: DataFrame, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text", few: int = FEW) -> DataFrame:
    """The rows of ``docs`` with ``n_bytes`` (of the text in UTF-8), ``shard`` (its prefix in bits), ``depth``,
    ``shard_bytes``, ``shard_rows`` and ``oversize``; columns of these names are replaced, others are not touched.

    No shard is above ``limit`` bytes, unless a single text is: that is a shard alone, marked ``oversize``. Null and
    empty texts have 0 bytes. Rows without id are placed by their text. Rows that share an id share 36 bits; where
    these together are above the limit they are written with a number each, whose hash gives 24 bits more, so a
    second look at them finds the same ones. An empty table gives an empty table. Lookups of up to ``few`` cells go to
    every task; larger ones are joined by cell.
    """
    inside, back = apart(docs.drop(*MADE), doc_id, text)
    keyed = _keyed(inside, doc_id, text)
    keys = materialize(keyed.select("_key", "n_bytes"), "shard-keys")
    lookups, open_ = directory(keys, limit, few=few)
    if open_.isEmpty():
        found = _find(keyed, lookups, few)
    else:
        split = _to_cells(keyed, open_.withColumn("_hot", F.lit(True)), _prefix(F.col("_key"), CONTENT_BITS), few)
        place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << (BITS - CONTENT_BITS)))
        hot = materialize(split.filter(F.col("_hot")).drop("_hot").withColumn("_key", F.col("_key") + place), "shard-alike")
        deeper, _ = directory(hot.select("_key", "n_bytes"), limit, CONTENT_BITS, BITS, few=few)
        found = _find(split.filter(F.col("_hot").isNull()).drop("_hot"), lookups, few).unionByName(_find(hot, deeper, few))
    bits = F.when(F.col("_found.depth") == 0, "").otherwise(
        F.lpad(F.conv(F.col("_found.prefix").cast("string"), 10, 2), F.col("_found.depth"), F.lit("0"))
    )
    made = {"n_bytes": F.col("n_bytes"), "shard": bits} | {c: F.col(f"_found.{c}") for c in MADE[2:]}
    kept = back(found.select("*", F.struct(*[value.alias(name) for name, value in made.items()]).alias("_made")), "_made")
    return kept.select(*[F.col(f"`{c}`") for c in kept.columns if c != "_made"], *[F.col(f"_made.{c}").alias(c) for c in MADE])


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder ``bits=b<prefix>`` per shard below ``path``; rows of a shard meet in one task, which its byte limit bounds.
    The letter keeps a reader from taking prefixes for numbers."""
    folder = F.concat(F.lit("b"), "shard")
    sharded.withColumn("bits", folder).repartition("bits").write.partitionBy("bits").mode("overwrite").parquet(path)


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    """Every document with its shard."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard(docs, QUERY_LIMIT).select("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_rows", "oversize")


def sql(limit: int = LIMIT, bits: int = 24) -> str:
    """The same rows, for ids that occur once and directories of at most ``bits`` bits."""
    return f"""
WITH k AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || md5(coalesce('i' || doc_id::VARCHAR, 't' || text, ''))[1:9])::BIGINT AS key FROM documents),
p AS (SELECT doc_id, n_bytes, d.depth::INTEGER AS depth, key >> (36 - d.depth) AS prefix
      FROM k CROSS JOIN range(0, {bits + 1}) d(depth)),
b AS (SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM p GROUP BY ALL),
f AS (SELECT p.doc_id, p.n_bytes, b.*, row_number() OVER (PARTITION BY p.doc_id ORDER BY b.depth) AS r
      FROM p JOIN b USING (depth, prefix) WHERE b.shard_bytes <= {limit} OR b.shard_rows = 1)
SELECT doc_id, n_bytes, right(lpad(bin(prefix), 64, '0'), depth) AS shard, depth, shard_bytes, shard_rows,
       shard_bytes > {limit} AS oversize
FROM f WHERE r = 1
"""


SQL = sql(QUERY_LIMIT)
