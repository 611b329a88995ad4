"""Benchmark passages in training texts by spaced-seed hashing, verified with substitutions allowed.

[native] No Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.text import text_key, without
from earshot.sources.store import materialize

# The positions a seed looks at. Together they meet every alignment of 8 to 15 tokens in which at most a
# fifth of the tokens (rounded down) are substituted, wherever these are; tests go through all cases.
MASKS = ((0, 1, 4, 5), (0, 2, 4, 7))
MIN_TOKENS = 8
WINDOW = 15
SAME = 80  # per cent
BROADCAST_SEEDS = 500_000  # rows of five numbers: some 40 MB
BROADCAST_TOKENS = 1_000_000  # of all items together: some 40 MB
TOKEN_GAP = r"[^0-9a-z\x80-\x{10FFFF}]+"
# Scripts that set no blanks between words, by their ranges of code points: Thai and Lao, Burmese, Khmer,
# kana, Han. Each of their characters is a token.
UNSPACED = r"([\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{2FDF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}])"


def token_array(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order, and single characters of scripts without blanks; the last entry
    may be empty, which equals no token."""
    text = F.coalesce(text, F.lit(""))
    apart = F.when(text.rlike(UNSPACED), F.regexp_replace(text, UNSPACED, " $1 ")).otherwise(text)
    pieces = F.split(F.lower(apart), TOKEN_GAP)
    return F.when(F.get(pieces, F.lit(0)) == "", F.slice(pieces, F.lit(2), F.size(pieces))).otherwise(pieces)


def token_number(tokens: Column) -> Column:
    return F.size(tokens) - F.when(F.get(tokens, F.size(tokens) - 1) == "", 1).otherwise(0)


def _seeds(tokens: Column, at: Column) -> Column:
    """One hash per mask of the tokens it shows from a position on."""
    return F.array(*[F.xxhash64(F.lit(m), *[F.get(tokens, at + k) for k in mask]) for m, mask in enumerate(MASKS)])


def _positions(tokens: Column) -> Column:
    """Where a seed can start. Beyond the last one the wider mask would stick out and could meet nothing."""
    last = token_number(tokens) - 1 - min(m[-1] for m in MASKS)
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _followed(tokens: Column, at: Column) -> Column:
    """Whether the same mask already fits one token earlier: then that seed, of the same alignment, stands for this one."""
    earlier = F.get(_seeds(tokens, at - 1), F.col("_mask"))
    return (at > 0) & F.col("_before").isNotNull() & (earlier == F.col("_before"))


def _overlaps(hits: DataFrame, window: int, same: int) -> DataFrame:
    """Keeps alignments with a window of equal tokens enough; adds ``start``, ``n_aligned`` and ``n_equal``."""
    tokens, item, shift = F.col("_tokens"), F.col("_item"), F.col("_shift")
    n = F.size("_item")
    equal = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.when(F.get(tokens, shift + k) == F.get(item, k), 1).otherwise(0))
    width = F.least(F.lit(window), n)
    enough = F.ceil(width * same / 100)
    first = F.greatest(shift, F.lit(0))
    hits = hits.withColumn("_equal", equal).withColumn("n_equal", F.aggregate("_equal", F.lit(0), lambda a, x: a + x))
    hits = hits.filter(F.col("n_equal") >= enough)
    reach = F.exists(
        F.sequence(F.lit(0), n - width),
        lambda s: F.aggregate(F.slice(F.col("_equal"), s + 1, width), F.lit(0), lambda a, x: a + x) >= enough,
    )
    return hits.filter(reach).withColumn("start", first).withColumn("n_aligned", F.least(shift + n, token_number(tokens)) - first)


def benchmark_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """((_no, _item), (_no, item_id)): the distinct token lists that are not empty, numbered, and the ids of each."""
    rows = benchmark.select(F.col(item_id).alias("item_id"), token_array(F.col(text)).alias("_item"))
    rows = rows.withColumn("_item", F.slice("_item", F.lit(1), token_number(F.col("_item")))).filter(F.size("_item") > 0)
    rows = materialize(rows.distinct(), "items")
    items = materialize(rows.select("_item").distinct().withColumn("_no", F.monotonically_increasing_id()), "token-lists")
    return items, materialize(rows.join(items, "_item").select("_no", "item_id"), "item-ids")


def _item_seeds(items: DataFrame) -> DataFrame:
    """(_seed, _mask, _no, _item_at, _before): the seeds of the items, and that of the same mask one token earlier."""
    tokens, at = F.col("_item"), F.col("_item_at")
    rows = items.select("_no", "_item", F.explode(_positions(tokens)).alias("_item_at"))
    rows = rows.select("_no", "_item", "_item_at", F.posexplode(_seeds(tokens, at)).alias("_mask", "_seed"))
    inside = at + F.element_at(F.array(*[F.lit(m[-1]) for m in MASKS]), F.col("_mask") + 1) < F.size(tokens)
    before = F.when(at > 0, F.get(_seeds(tokens, at - 1), F.col("_mask"))).alias("_before")
    return rows.filter(inside).select("_seed", "_mask", "_no", "_item_at", before)


def _whole_items(texts: DataFrame, items: DataFrame, sizes: list[int], few: bool) -> DataFrame:
    """(_id, _text, _no, start, n_aligned, n_equal): the first place at which all tokens of a short item stand."""
    tokens = F.col("_tokens")

    def grams(n: int) -> Column:
        last = token_number(tokens) - n
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda at: F.struct(
            F.xxhash64(F.lit(n), *[F.get(tokens, at + k) for k in range(n)]).alias("_gram"), at.alias("start"), F.slice(tokens, at + 1, n).alias("_own")
        ))).otherwise(F.array().cast("array<struct<_gram:bigint,start:int,_own:array<string>>>"))

    at = texts.select("_id", "_text", F.explode(F.flatten(F.array(*[grams(n) for n in sizes]))).alias("_at")).select("_id", "_text", "_at.*")
    keyed = [F.when(F.size("_item") == n, F.xxhash64(F.lit(n), *[F.get("_item", F.lit(k)) for k in range(n)])) for n in sizes]
    short = items.select("_no", "_item", F.coalesce(*keyed).alias("_gram"))
    met = at.join(F.broadcast(short) if few else short, "_gram").filter(F.col("_own") == F.col("_item"))
    n = F.max(F.size("_item"))
    return met.groupBy("_id", "_text", "_no").agg(F.min("start").alias("start"), n.alias("n_aligned"), n.alias("n_equal"))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, same: int = SAME,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    broadcast_seeds: int = BROADCAST_SEEDS, broadcast_tokens: int = BROADCAST_TOKENS,
) -> DataFrame:
    """(_id, _text, item_id, start, n_aligned, n_equal): one row per document and benchmark item that overlap.

    An overlap is an alignment of the whole item with the text, token for token, in which some ``window`` neighbouring
    item tokens (the whole item where it is shorter) are the same in ``same`` per cent or more. Of several, the one
    with most equal tokens counts, then the first. ``start`` is the token at which the aligned part begins. Items of
    fewer than ``MIN_TOKENS`` tokens, where a substitution would leave too little, overlap where all of their tokens
    stand in the text. Items with the same tokens all have their rows.

    Null and empty texts, and items without tokens, have no rows. Rows alike in id and text are one. An empty table on
    either side gives no rows. Up to ``broadcast_seeds`` seeds, rows of numbers, go to every task, and so do the
    items' tokens where they are ``broadcast_tokens`` at most; beyond, both are joined by key.
    """
    every, ids = benchmark_items(benchmark, item_id, item_text)
    items = every.filter(F.size("_item") >= MIN_TOKENS)
    seeds = materialize(_item_seeds(items), "seeds")
    sizes = every.groupBy(F.least(F.size("_item"), F.lit(MIN_TOKENS)).alias("n")).agg(F.sum(F.size("_item")).alias("tokens")).collect()  # 8 rows at most
    few = seeds.count() <= broadcast_seeds and sum(row["tokens"] for row in sizes) <= broadcast_tokens
    texts = docs.select(*text_key(doc_id, text), token_array(F.col(text)).alias("_tokens"))
    places = texts.select("*", F.explode(_positions(F.col("_tokens"))).alias("_at"))
    seeded = places.select("*", F.explode(_seeds(F.col("_tokens"), F.col("_at"))).alias("_seed"))
    if few:
        hits = seeded.join(F.broadcast(seeds), "_seed").filter(~_followed(F.col("_tokens"), F.col("_at")))
        hits = hits.withColumn("_shift", F.col("_at") - F.col("_item_at"))
        # one row per alignment. The grouping also keeps the checks below, which are interpreted, out of the join, so
        # that positions stay in generated code and are never rows with a copy of their text
        hits = hits.groupBy("_id", "_text", "_no", "_shift").agg(F.first("_tokens").alias("_tokens")).join(F.broadcast(items), "_no")
    else:
        met = seeded.select("_id", "_text", "_at", "_seed").join(seeds, "_seed").select(
            "_id", "_text", "_no", (F.col("_at") - F.col("_item_at")).alias("_shift")
        ).distinct()
        met = met.join(items, "_no").withColumnRenamed("_id", "_hit").withColumnRenamed("_text", "_hit_text")
        same_row = F.col("_id").eqNullSafe(F.col("_hit")) & (F.col("_text") == F.col("_hit_text"))
        hits = texts.dropDuplicates(["_id", "_text"]).join(met, same_row)
    best = F.max(F.struct("n_equal", (-F.col("start")).alias("_back"), "n_aligned")).alias("_best")
    found = _overlaps(hits, window, same).groupBy("_id", "_text", "_no").agg(best).select(
        "_id", "_text", "_no", (-F.col("_best._back")).alias("start"), "_best.n_aligned", "_best.n_equal"
    )
    short = sorted(row["n"] for row in sizes if row["n"] < MIN_TOKENS)
    if short:
        found = found.unionByName(_whole_items(texts, every.filter(F.size("_item") < MIN_TOKENS), short, few))
    return found.join(ids, "_no").select("_id", "_text", "item_id", "start", "n_aligned", "n_equal")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item; all columns stay. Texts that are null or empty stay."""
    found = overlaps(docs, benchmark, **options).select("_id", "_text").distinct()
    return without(docs, materialize(found, "contaminated"), options.get("doc_id", "doc_id"), options.get("text", "text"))


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item in it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return overlaps(docs, benchmark).select(F.col("_id").alias("doc_id"), "item_id", "start", "n_aligned", "n_equal")


_KEYS = " UNION ALL ".join(
    f"SELECT *, '{m}:' || " + " || ' ' || ".join(f"t[p + {k + 1}]" for k in mask) + f" AS seed FROM {{0}} WHERE p + {mask[-1]} < n"
    for m, mask in enumerate(MASKS)
)
_TOKENS = f"list_filter(regexp_split_to_array(lower(regexp_replace(coalesce(text, ''), '{UNSPACED}', ' \\1 ', 'g')), '{TOKEN_GAP}'), lambda x: x <> '')"
SQL = f"""
WITH d AS (SELECT doc_id, t, len(t) AS n FROM (SELECT doc_id, {_TOKENS} AS t FROM documents)),
ids AS (SELECT DISTINCT item_id, t, len(t) AS n FROM (SELECT item_id, {_TOKENS} AS t FROM benchmark) WHERE len(t) > 0),
i AS (SELECT min(item_id) AS item_id, t, n FROM ids GROUP BY t, n),
dp AS (SELECT doc_id, t, n, unnest(range(n)) AS p FROM d),
ip AS (SELECT item_id, t, n, unnest(range(n)) AS p FROM i WHERE n >= {MIN_TOKENS}),
ds AS (SELECT doc_id, p, seed FROM ({_KEYS.format('dp')})),
iseeds AS (SELECT item_id, p, seed FROM ({_KEYS.format('ip')})),
h AS (SELECT DISTINCT doc_id, item_id, ds.p - iseeds.p AS shift FROM ds JOIN iseeds USING (seed)),
e AS (
  SELECT doc_id, item_id, shift, i.n, d.n AS dn, least({WINDOW}, i.n) AS w,
         list_transform(range(i.n), lambda k: CASE WHEN shift + k >= 0 AND d.t[shift + k + 1] = i.t[k + 1] THEN 1 ELSE 0 END) AS eq
  FROM h JOIN d USING (doc_id) JOIN i USING (item_id)),
v AS (
  SELECT doc_id, item_id, greatest(shift, 0) AS start, least(shift + n, dn) - greatest(shift, 0) AS n_aligned, list_sum(eq) AS n_equal
  FROM e WHERE list_max(list_transform(range(n - w + 1), lambda s: list_sum(eq[s + 1:s + w]))) >= ceil(w * {SAME} / 100.0)
  UNION ALL
  SELECT doc_id, item_id, p, i.n, i.n FROM dp JOIN i ON i.n < {MIN_TOKENS} AND dp.t[p + 1:p + i.n] = i.t),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, start, n_aligned DESC) AS place FROM v)
SELECT doc_id, ids.item_id, start::INTEGER AS start, n_aligned::INTEGER AS n_aligned, n_equal::INTEGER AS n_equal
FROM r JOIN i USING (item_id) JOIN ids ON ids.t = i.t WHERE place = 1
"""
