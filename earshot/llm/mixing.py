"""Mixing sources to target weights: hash-random order within each source, distributed prefix sums, exact cuts.

[native] No Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.llm.text import BLANK, word_count
from earshot.operators.joins import join_unique
from earshot.sources.store import materialize

REPEATS = 3
BUCKETS = 4096
SEED = 11


def _key(source: str) -> Column:
    """A source as a key that is never null: null and the empty string stay apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def source_targets(sizes: DataFrame, repeats: int = REPEATS, weights: DataFrame | None = None) -> DataFrame:
    """(source_key, source_size, target) from (source_key, source_size), one row per source.

    All sources share the total size by weight. A source stops at ``repeats`` times its size; what is over is
    shared by weight among the others until none is above. With sources sorted by the level (size over weight)
    at which they fill up, the full ones come first, so the common level follows from sums along that order and
    needs no rounds. Weights are 1, 2, 3, repeating, by code point, null last; ``weights`` (source_key, weight)
    replaces them. One row per source passes the two windows, not one per document.
    """
    if weights is None:
        by_name = W.orderBy((F.col("source_key") == "").asc(), "source_key")
        sized = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
    else:
        sized = sizes.join(weights, "source_key")
    level = F.col("source_size") * F.lit(float(repeats)) / F.col("weight")
    upto = W.orderBy("level", "source_key").rowsBetween(W.unboundedPreceding, 0)
    every = W.partitionBy()
    total = F.sum("source_size").over(every)
    summed = sized.withColumn("level", level).select(
        "*",
        total.alias("total"),
        (F.sum(F.col("source_size") * F.lit(float(repeats))).over(upto)).alias("full_upto"),
        (F.sum("weight").over(every) - F.sum("weight").over(upto)).alias("weight_after"),
    )
    # the common level if exactly the sources up to this one are full; the first that leaves the next one unfilled holds
    after = F.when(F.col("weight_after") > 0, (F.col("total") - F.col("full_upto")) / F.col("weight_after"))
    following = F.lead("level").over(W.orderBy("level", "source_key"))
    none_full = F.col("total") / F.sum("weight").over(every)
    found = summed.select(
        "*",
        F.when(after.isNotNull() & (after <= following), after).alias("candidate"),
        F.when(none_full <= F.min("level").over(every), none_full).alias("no_cap"),
    )
    common = F.coalesce(F.col("no_cap"), F.max("candidate").over(every))
    cap = F.col("source_size") * F.lit(float(repeats))
    return found.select("source_key", "source_size", F.least(cap, common * F.col("weight")).alias("target"))


def plan_mix(
    docs: DataFrame, repeats: int = REPEATS, buckets: int = BUCKETS, seed: int = SEED, weights: DataFrame | None = None,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """(_source_key, source_size, target, whole, rest, cut_key, cut_id, cut_text, cut_size, cut_each): one row per source.

    A document's place in its source is a hash of id and seed. ``whole`` epochs take every document; one more
    takes the documents before the cut, and of the document at the cut just the words still wanted, so that a
    source gives its rounded target exactly. Rows alike in id and text share the cut's words evenly, rounded down.

    The hash also deals each source into ``buckets`` ranges, so one huge source is many groups for the sort.
    """
    rows = docs.select(
        _key(source).alias("_source_key"), *_order_columns(doc_id, text, seed), word_count(F.col(text)).alias("_size")
    )
    # copies of a row become one before anything is dealt out by key
    grouped = rows.groupBy("_source_key", "_key", "_id", "_text").agg(
        F.first("_size").alias("_size"), F.count(F.lit(1)).alias("_n")
    ).withColumn("_bucket", F.shiftright("_key", 60 - (buckets.bit_length() - 1)))
    grouped = materialize(grouped, "mix-order")
    cells = grouped.groupBy("_source_key", "_bucket").agg(F.sum(F.col("_size") * F.col("_n")).alias("_cell"))
    before = F.sum("_cell").over(W.partitionBy("_source_key").orderBy("_bucket")) - F.col("_cell")
    cells = cells.withColumn("_before", before)
    sizes = cells.groupBy(F.col("_source_key").alias("source_key")).agg(F.sum("_cell").alias("source_size"))
    targets = source_targets(sizes, repeats, weights)
    budget = F.least(F.round("target").cast("long"), F.col("source_size") * repeats)
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    targets = targets.select(
        F.col("source_key").alias("_source_key"), "source_size", "target", whole.cast("long").alias("whole"),
        (budget - whole * F.col("source_size")).cast("long").alias("rest"),
    )
    targets = materialize(targets, "mix-targets")
    # the bucket in which a source's last epoch ends, one per source, then the document in it
    ends = cells.join(targets, "_source_key").filter(
        (F.col("_before") < F.col("rest")) & (F.col("rest") <= F.col("_before") + F.col("_cell"))
    ).select("_source_key", "_bucket", "_before", "rest")
    order = W.partitionBy("_source_key", "_bucket").orderBy("_key", "_id", "_text")
    running = F.sum(F.col("_size") * F.col("_n")).over(order.rowsBetween(W.unboundedPreceding, 0))
    inside = (
        grouped.join(ends, ["_source_key", "_bucket"])
        .withColumn("_from", F.col("_before") + running - F.col("_size") * F.col("_n"))
        .filter((F.col("_from") < F.col("rest")) & (F.col("rest") <= F.col("_from") + F.col("_size") * F.col("_n")))
        .select(
            "_source_key", F.struct("_key", "_id", "_text").alias("cut"),
            F.floor((F.col("rest") - F.col("_from")) / F.col("_n")).cast("long").alias("cut_each"),
        )
    )
    return materialize(targets.join(inside, "_source_key", "left"), "mix-plan")


def _order_columns(doc_id: str, text: str, seed: int) -> list[Column]:
    """Random place (60 bits of a digest), then id and text digest, which decide where places tie."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))
    return [
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("_key"),
        F.col(doc_id).alias("_id"),
        F.xxhash64(F.col(text)).alias("_text"),
    ]


def mix(
    docs: DataFrame, repeats: int = REPEATS, buckets: int = BUCKETS, seed: int = SEED, weights: DataFrame | None = None,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The rows of ``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` (words, repeats counted).

    Columns of these names in ``docs`` are replaced. Null and empty texts have size 0 and give no words; null
    ids take part; a null source is a source of its own, last in order. An empty table gives an empty table.
    The texts are not shuffled: each row is compared with its source's cut.
    """
    plan = plan_mix(docs, repeats, buckets, seed, weights, doc_id, text, source)
    plan = plan.select(*[F.col(c).alias(c if c.startswith("_") else f"_plan_{c}") for c in plan.columns])
    rows = docs.withColumn("_source_key", _key(source)).withColumn(
        "_place", F.struct(*_order_columns(doc_id, text, seed))
    ).withColumn("_size", word_count(F.col(text)))
    small = plan.count() <= 10_000
    joined = rows.join(F.broadcast(plan), "_source_key") if small else join_unique(rows, plan, "_source_key")
    more = (
        F.when(F.col("_plan_cut").isNull(), F.lit(0))
        .when(F.col("_place") < F.col("_plan_cut"), F.col("_size"))
        .when(F.col("_place") == F.col("_plan_cut"), F.col("_plan_cut_each"))
        .otherwise(0)
    )
    new = {
        "size": F.col("_size"), "source_size": F.col("_plan_source_size"), "target": F.col("_plan_target"),
        "taken": F.col("_plan_whole") * F.col("_size") + more,
    }
    kept = [F.col(c) for c in docs.columns if c not in new]
    return joined.select(*kept, *[value.alias(name) for name, value in new.items()])


def mixed_rows(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: each document as often as it is taken whole, and once more cut to its first words where a
    source's budget ends within it. Blanks inside the part that stays are kept. Columns as in ``mixed``, less the four."""
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    part = F.col("taken") - whole * F.col("size")
    pieces = F.split(F.col(text), "(?<=[\\x20\\x09-\\x0D])(?=[^\\x20\\x09-\\x0D])")
    lead = F.col(text).rlike(f"^{BLANK}").cast("int")
    cut = F.array_join(F.slice(pieces, 1, (part + lead).cast("int")), "")
    copies = F.when((whole == 0) & (part == 0), F.array().cast("array<int>")).otherwise(
        F.sequence(F.when(part > 0, F.lit(0)).otherwise(F.lit(1)), whole)
    )
    names = [c for c in mixed.columns if c not in ("size", "source_size", "target", "taken")]
    out = mixed.withColumn("_copy", F.explode(copies)).withColumn(
        text, F.when(F.col("_copy") == 0, cut).otherwise(F.col(text))
    )
    return out.select(*names)


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document with the words the mix takes of it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = f"""
WITH d AS (
  SELECT doc_id, source,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:15] AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, source_size * {REPEATS}.0::DOUBLE / weight AS level, sum(source_size) OVER ()::DOUBLE AS total FROM s),
levels AS (SELECT DISTINCT level FROM l UNION SELECT 0),
c AS (  -- with the sources below a level full, the rest share what is left
  SELECT (any_value(total) - coalesce(sum(source_size) FILTER (l.level <= v.level), 0) * {REPEATS}.0)
         / sum(weight) FILTER (l.level > v.level) AS common, v.level AS below, min(l.level) FILTER (l.level > v.level) AS above
  FROM l CROSS JOIN levels v GROUP BY v.level),
t AS (
  SELECT source, source_size,
         least(source_size * {REPEATS}.0::DOUBLE, weight * coalesce((SELECT max(common) FROM c WHERE common <= above), 0)) AS target
  FROM l),
b AS (
  SELECT *, least(round(target)::BIGINT, {REPEATS} * source_size) AS budget FROM t),
o AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget % source_size - (upto - size))) END::BIGINT AS taken
FROM o
"""
