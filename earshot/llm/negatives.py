"""Hard negatives: for each anchor and positive the best items of other labels that score below a share of the positive.

The windows of an anchor's positives overlap. Their upper limits, in falling order, cut the scores into disjoint slots;
each slot keeps its k best, and a window's answer is read from the slots at and below its own limit.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.sources.store import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOWEST, HIGHEST = 50, 95  # per cent of the positive's score
TILE_BYTES = 64 << 20  # anchors and their lists held by a task
STRIPE_ROWS = 4096  # fewer items are not worth a task
TASKS_PER_CORE = 3
CELLS = 1 << 20  # scores held at once
_NONE = np.iinfo(np.int64).min + 1  # below all scores, and has a negative


def whole_vectors(rows: DataFrame, scale: int, id_: str, label: str, vec: str) -> DataFrame:
    """(id, label, vec): components ``floor(scale * x)`` of the rows that can take part.

    Left out are rows without id or label, null vectors, and those with a null or non-finite component; then those of
    another length than the commonest one (the shorter, of two as common). Rows that share an id are one, the one with the smallest label and then
    vector. Components beyond the range of a long become its ends.
    """
    usable = F.col("_id").isNotNull() & F.col("_label").isNotNull() & F.col("_vec").isNotNull()
    odd = F.exists("_vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = rows.select(F.col(id_).alias("_id"), F.col(label).cast("bigint").alias("_label"), F.col(vec).cast("array<double>").alias("_vec"))
    own = own.filter(usable & ~odd).select("_id", F.struct("_label", F.transform("_vec", lambda x: F.floor(x * scale)).alias("vec")).alias("_row"))
    one = own.groupBy("_id").agg(F.min("_row").alias("_row"))
    whole = materialize(one.select(F.col("_id").cast("bigint").alias("id"), F.col("_row._label").alias("label"), F.col("_row.vec").alias("vec")), "whole-vectors")
    size = whole.agg(F.mode(F.size("vec"), True).alias("dim")).first()["dim"]
    return whole.filter(F.size("vec") == (size or 0))


class _Scorer:
    """Exact integer products of blocks of vectors, in the fastest numbers that hold them."""

    def __init__(self, largest: int, dim: int):
        most = largest * largest * max(dim, 1)
        # sums of integers below these bounds are exact in any order
        self.kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object

    def rows(self, vectors: pa.Array, n: int) -> np.ndarray:
        return np.asarray(vectors.flatten()).reshape(n, -1).astype(self.kind)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        scores = a @ b.T
        if self.kind is object:
            ends = np.iinfo(np.int64)
            scores = np.clip(scores, ends.min + 3, ends.max)
        return scores.astype(np.int64)


def _first(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest entries of each row in falling order, the smaller column first where they are equal."""
    n, width = scores.shape
    if width > k:
        # the k-th largest of each row bounds what can be among them
        least = np.partition(scores, width - k, axis=1)[:, width - k]
        above = scores > least[:, None]
        ties = scores == least[:, None]
        ties &= np.cumsum(ties, axis=1) <= (k - above.sum(axis=1))[:, None]
        columns = np.nonzero(above | ties)[1].reshape(n, k)
    else:
        columns = np.broadcast_to(np.arange(width), scores.shape)
    order = np.argsort(-np.take_along_axis(scores, columns, axis=1), axis=1, kind="stable")
    return np.take_along_axis(columns, order, axis=1)


class _Lists:
    """The k best (score, id) of each of n lists. Ids come in ascending order, so of equal scores the first seen stays."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), _NONE)
        self.ids = np.zeros((n, k), np.int64)

    def see(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """One row of ``scores`` for each of the (distinct) ``lists``; entries that do not belong are ``_NONE``."""
        better = (scores > self.scores[lists, -1][:, None]).any(axis=1)
        if not better.any():
            return
        lists, scores = lists[better], scores[better]
        top = _first(scores, self.k)
        both = np.hstack([self.scores[lists], np.take_along_axis(scores, top, axis=1)])
        found = np.hstack([self.ids[lists], ids[top]])
        order = np.argsort(-both, axis=1, kind="stable")[:, : self.k]
        self.scores[lists] = np.take_along_axis(both, order, axis=1)
        self.ids[lists] = np.take_along_axis(found, order, axis=1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, id, score) of all entries."""
        at, place = np.nonzero(self.scores != _NONE)
        return at, self.ids[at, place], self.scores[at, place]


def _kernel(scorer: _Scorer, slots: int, k: int, prepare: Callable, see: Callable):
    """Runs ``see`` over all items of a block of anchors x items. The anchors come first, items by ascending id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        state = None
        for batch in batches:
            cut = int(np.searchsorted(batch["side"].to_numpy(), 1))
            if cut:
                held.append(batch.slice(0, cut))
            items = batch.slice(cut)
            if not items.num_rows or not held:
                continue
            if state is None:
                state = prepare(pa.Table.from_batches(held).combine_chunks(), scorer)
                lists = _Lists(len(state["id"]) * slots, k)
            step = max(1, min(items.num_rows, CELLS // 256))
            for at in range(0, items.num_rows, step):
                part = items.slice(at, step)
                own = {"id": part["id"].to_numpy(), "label": part["label"].to_numpy(), "vec": scorer.rows(part["vec"], part.num_rows)}
                rows = max(1, CELLS // part.num_rows)
                for first in range(0, len(state["id"]), rows):
                    see(lists, state, slice(first, first + rows), own, scorer)
        if state is not None:
            at, ids, scores = lists.rows()
            yield pa.RecordBatch.from_arrays(
                [pa.array(state["id"][at // slots]), pa.array((at % slots).astype(np.int32)), pa.array(ids), pa.array(scores)],
                ["anchor_id", "slot", "id", "score"],
            )

    return run


def _anchors(table: pa.Table, scorer: _Scorer) -> dict[str, np.ndarray]:
    vectors = table["vec"].combine_chunks()
    out = {"id": table["id"].to_numpy(), "label": table["label"].to_numpy(), "vec": scorer.rows(vectors, table.num_rows)}
    if "limits" in table.column_names:
        out["limits"] = np.asarray(table["limits"].combine_chunks().flatten()).reshape(table.num_rows, -1)
        out["least"] = table["least"].to_numpy()
    return out


def _see_alike(lists: _Lists, anchors: dict, part: slice, items: dict, scorer: _Scorer) -> None:
    """Items of the anchors' labels, other than the anchor."""
    labels = anchors["label"][part]
    for label in np.intersect1d(labels, items["label"]):
        rows = part.start + np.flatnonzero(labels == label)
        columns = np.flatnonzero(items["label"] == label)
        scores = scorer(anchors["vec"][rows], items["vec"][columns])
        scores[anchors["id"][rows][:, None] == items["id"][columns][None, :]] = _NONE
        lists.see(rows, scores, items["id"][columns])


def _see_windows(lists: _Lists, anchors: dict, part: slice, items: dict, scorer: _Scorer) -> None:
    """Items of other labels, each in the slot whose limits it lies between: the last limit that it does not exceed."""
    scores = scorer(anchors["vec"][part], items["vec"])
    limits, least = anchors["limits"][part], anchors["least"][part]
    fits = (scores <= limits[:, :1]) & (scores >= least[:, None]) & (anchors["label"][part][:, None] != items["label"][None, :])
    slots = limits.shape[1]
    for slot in range(slots):
        inside = fits & (scores <= limits[:, [slot]])
        if slot + 1 < slots:
            inside &= scores > limits[:, [slot + 1]]
        rows = np.flatnonzero(inside.any(axis=1))
        if len(rows):
            lists.see((part.start + rows) * slots + slot, np.where(inside[rows], scores[rows], _NONE), items["id"])


def _blocks(anchors: DataFrame, items: DataFrame, run: Callable, tiles: int, stripes: int) -> DataFrame:
    """(anchor_id, slot, id, score): what ``run`` finds in every block, a tile of anchors and a stripe of items."""
    def side(rows: DataFrame, number: int, own: int, other: int, first: bool) -> DataFrame:
        piece, copies = F.pmod(F.xxhash64("id"), F.lit(own)), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(other - 1).cast("bigint")))
        rows = rows.select("*", piece.alias("_own"), copies.alias("_other"))
        block = F.col("_own") * other + F.col("_other") if first else F.col("_other") * own + F.col("_own")
        return rows.withColumn("block", block.cast("int")).withColumn("side", F.lit(number)).drop("_own", "_other")

    left, right = side(anchors, 0, tiles, stripes, True), side(items, 1, stripes, tiles, False)
    rows = left.unionByName(right, allowMissingColumns=True)
    # one block per partition, whose work grows with the product of its sides
    dealt = rows.repartitionById(tiles * stripes, "block").sortWithinPartitions("side", "id")
    return dealt.mapInArrow(run, "anchor_id bigint, slot int, id bigint, score bigint")


def _best(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The k best rows of each list, with their ``place``; the limit also applies before the shuffle."""
    order = W.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _ceil_percent(score: Column, percent: int) -> Column:
    """The least whole number of which 100 times is not below ``percent`` times the score."""
    return -F.floor(-score * percent / 100)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST,
    scale: int = SCALE, id_: str = "id", label: str = "label", vec: str = "vec", tile_rows: int | None = None, stripe_rows: int | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of whole numbers, ``floor(scale * component)``, and exact: higher ones come first, of
    equal ones the smaller id. Every row for which ``is_anchor`` (an expression over ``id``) holds is compared with
    all rows. Its positives are the ``positives`` first others of its label; for each the ``negatives`` first rows of
    other labels are returned whose score is at least ``lowest`` and at most ``highest`` per cent of the positive's.
    Positives below 0 have no such scores. Anchors without positives, and positives without negatives, have no rows.

    See ``whole_vectors`` for the rows that take no part; ids are whole numbers. Copies of a vector are rows like
    others and rank by id. Scores beyond the range of a long become its ends. An empty table gives no rows.

    Anchors meet items in blocks: a task holds a tile of anchors with their lists while its items pass by, so pairs
    are never rows, and sends at most ``positives * negatives`` rows per anchor on. Tiles are as large as a task's
    memory allows, since all items are sent to each of them.
    """
    spark = rows.sparkSession
    whole = whole_vectors(rows, scale, id_, label, vec)
    size = whole.agg(
        F.count(F.lit(1)).alias("items"), F.count_if(is_anchor).alias("anchors"), F.max(F.size("vec")).alias("dim"),
        F.max(F.array_max("vec")).alias("high"), F.min(F.array_min("vec")).alias("low"),
    ).first()
    dim = size["dim"] or 0
    scorer = _Scorer(max(abs(size["high"] or 0), abs(size["low"] or 0)), dim)
    held = tile_rows or max(32, TILE_BYTES // (8 * dim + 16 * positives * (negatives + 1)))
    tiles = max(1, math.ceil(size["anchors"] / held))
    cores = spark.sparkContext.defaultParallelism
    stripes = max(1, min(math.ceil(TASKS_PER_CORE * cores / tiles), math.ceil(size["items"] / STRIPE_ROWS)))
    if stripe_rows:
        stripes = max(1, math.ceil(size["items"] / stripe_rows))

    anchors = whole.filter(is_anchor)
    alike = _blocks(anchors, whole, _kernel(scorer, 1, positives, _anchors, _see_alike), tiles, stripes)
    near = _best(alike, positives, "anchor_id")
    # whole numbers: decimals hold 100 times any long
    score = F.col("score").cast("decimal(20,0)")
    upper = F.floor(score * highest / 100).cast("bigint")
    lower = _ceil_percent(score, lowest).cast("bigint")
    pairs = near.groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), lower.alias("lower"), upper.alias("upper")))).alias("pairs")
    )
    pairs = materialize(pairs, "positives")
    # a positive below 0 has an empty window; its limit is below all scores, like that of a positive that there is not
    limit = lambda x: F.when(x["positive_score"] >= 0, x["upper"]).otherwise(F.lit(_NONE + 1))
    limits = F.concat(F.transform("pairs", limit), F.array_repeat(F.lit(_NONE + 1), F.lit(positives) - F.size("pairs")))
    bounded = pairs.select(F.col("anchor_id").alias("id"), limits.alias("limits"), F.array_min(F.transform("pairs", lambda x: x["lower"])).alias("least"))
    searched = anchors.join(bounded, "id")
    other = _blocks(searched, whole, _kernel(scorer, positives, negatives, _anchors, _see_windows), tiles, stripes)
    slots = _best(other, negatives, "anchor_id", "slot")

    # slots in falling order of their limits, each in falling order of scores, are one list in falling order; a window
    # starts at its own slot, and what is below its lower limit stands last
    listed = slots.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("slot", "place", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")))).alias("found"))
    met = pairs.join(listed, "anchor_id").select("anchor_id", "found", F.posexplode("pairs").alias("own", "pair"))
    suffix = F.filter("found", lambda x: (x["slot"] >= F.col("own")) & (x["negative_score"] >= F.col("pair.lower")))
    met = met.filter(F.col("pair.positive_score") >= 0).withColumn("_first", F.slice(suffix, 1, negatives))
    ranked = met.select("anchor_id", "pair", F.posexplode("_first").alias("at", "n"))
    return ranked.select(
        "anchor_id", F.col("pair.positive_id").alias("positive_id"), (F.col("at") + 1).alias("rank"), F.col("n.negative_id").alias("negative_id"),
        F.col("pair.positive_score").alias("positive_score"), F.col("n.negative_score").alias("negative_score"),
    )


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor and positive; every seventh id has the next label."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", moved.alias("label"), "embedding"), F.col("id") % 50 == 0, id_="vec_id", vec="embedding")


SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND {LOWEST} * positive_score <= 100 * s.score AND 100 * s.score <= {HIGHEST} * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""
