"""Top-k by inner product or cosine, exact within cells of queries and items.

A cell is whatever has to be compared: a hash bucket for approximate search, or everything for the
exact one. Cells are cut into tiles of queries and stripes of items. A task holds the queries of one
tile with their best items so far while the items of one stripe pass by in Arrow batches, so its
memory depends on the tile only and pairs are never rows.

Products of blocks of vectors only find candidates: their last bits depend on the shape of the block. What is kept and
ranked is each candidate's product summed in a fixed order, the same for equal vectors wherever they stand, so copies
tie exactly and the smaller id comes first.

In an exact search items pass by from the longest to the shortest vector. A product is at most the product of the two
lengths, so a query whose worst kept score is above that for the longest item of a batch can leave
the batch out, and with it nothing that belongs into its list.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.functions.vectors import checked_pair, matrix, norm, unit_rows
from earshot.operators.joins import join_unique
from earshot.sources.store import materialize

TILE_BYTES = 128 << 20  # queries and their best items held by a task
SCORE_CELLS = 2 << 20  # scores computed at once
COPIES = 3
DENSE = 8  # with fewer candidates than one in so many pairs, they are taken one by one
MIN_TILE, MIN_STRIPE = 32, 1024
BLOCKS_PER_CORE = 3
BROADCAST_CELLS = 500_000  # rows of four numbers: some 16 MB
SUM_ERROR = 1e-15  # of a product, per dimension and unit of length
ROUNDING = 1 + 1e-9  # products and lengths are rounded, the bound must not be
METRICS = ("dot", "cosine")
HEAD, CLASSES = 4, 16
REACH_ROWS = 20_000_000


def pick(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest scores of every row, the smaller id first where scores are equal."""
    width = scores.shape[1]
    top = np.argpartition(scores, width - k, axis=1)[:, width - k :]
    least = np.take_along_axis(scores, top, axis=1).min(axis=1)
    torn = np.flatnonzero(((scores >= least[:, None]).sum(axis=1) > k) & (least > -np.inf))
    if torn.size:
        top[torn] = np.lexsort((ids[torn], -scores[torn]), axis=1)[:, :k]
    return top


def _runs(cells: np.ndarray) -> dict[int, slice]:
    """Where each value of a sorted column begins and ends."""
    values, starts = np.unique(cells, return_index=True)
    return {
        value: slice(start, end) for value, start, end in zip(values.tolist(), starts, [*starts[1:], len(cells)])
    }


class BestSoFar:
    """The queries of a tile with their k best items among those seen."""

    def __init__(self, queries: pa.Table, k: int, cosine: bool):
        queries = queries.sort_by("cell").combine_chunks()
        # vectors are held once, as a matrix
        self.k, self.cosine, self.table = k, cosine, queries.drop_columns("vec")
        self.ids = queries["id"].to_numpy()
        self.vectors = self._vectors(queries["vec"].chunk(0))
        self.lengths = np.linalg.norm(self.vectors, axis=1)
        self.cells = _runs(queries["cell"].to_numpy())
        self.compared = 0
        self.scores = np.full((len(self.ids), k), -np.inf)
        self.items = np.full((len(self.ids), k), np.iinfo(np.int64).max)

    def _vectors(self, vectors: pa.Array) -> np.ndarray:
        rows = matrix(vectors)
        return unit_rows(rows) if self.cosine else rows

    def see(self, items: pa.RecordBatch) -> None:
        items = items.sort_by("cell")
        ids, vectors = items["id"].to_numpy(), self._vectors(items["vec"])
        lengths = np.linalg.norm(vectors, axis=1)
        for cell, columns in _runs(items["cell"].to_numpy()).items():
            held = self.cells.get(cell)
            if held is None:
                continue
            longest = lengths[columns].max()
            reach = self.lengths[held] * longest * ROUNDING
            rows = held.start + np.flatnonzero(reach >= self.scores[held].min(axis=1))
            step = max(1, SCORE_CELLS // (columns.stop - columns.start))
            for start in range(0, len(rows), step):
                self._merge(rows[start : start + step], ids[columns], vectors[columns], longest)

    def _merge(self, rows: np.ndarray, ids: np.ndarray, items: np.ndarray, longest: float) -> None:
        kept = self.scores[rows]
        rough = self.vectors[rows] @ items.T
        self.compared += rough.size
        # what may be off by rounding; candidates within it of the k-th best are summed again
        slack = self.lengths[rows] * longest * items.shape[1] * SUM_ERROR
        near = rough >= (kept.min(axis=1) - slack)[:, None]
        if np.count_nonzero(near) * DENSE > near.size:
            # lists are not full yet, or many items come near their ends: the batch's own k-th best cuts them down, which
            # holds where a pair that is held already is met again
            able = near.any(axis=0)
            rough, ids, items, near = rough[:, able], ids[able], items[able], near[:, able]
            if rough.shape[1] > self.k:
                near &= rough >= (np.partition(rough, rough.shape[1] - self.k, axis=1)[:, rough.shape[1] - self.k] - 2 * slack)[:, None]
        row, column = self._fresh(rows, ids, *np.divmod(np.flatnonzero(near), near.shape[1]))
        if len(row):
            self._add(rows[row], ids[column], self._sums(rows[row], items, column))

    def _sums(self, rows: np.ndarray, items: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Products of pairs of a query and an item, one by one, some pairs at a time."""
        out, step = np.empty(len(rows)), max(1, SCORE_CELLS // items.shape[1])
        for at in range(0, len(rows), step):
            part = slice(at, at + step)
            out[part] = (self.vectors[rows[part]] * items[column[part]]).sum(axis=1)
        return out

    def _add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scored pairs into the lists: the k best of each row, then these against what the row holds."""
        order = np.lexsort((ids, -scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        held, first = np.unique(rows, return_index=True)
        place = np.arange(len(rows)) - np.repeat(first, np.diff([*first, len(rows)]))
        kept = place < self.k
        at = np.searchsorted(held, rows[kept])
        wide = int(place[kept].max()) + 1
        step = max(1, SCORE_CELLS // (self.k + wide))
        ends = np.searchsorted(at, np.arange(0, len(held) + step, step))
        for n, (start, end) in enumerate(zip(ends[:-1], ends[1:])):
            some, part = held[n * step : (n + 1) * step], slice(start, end)
            new = np.full((len(some), wide), -np.inf)
            found = np.full((len(some), wide), np.iinfo(np.int64).max)
            cell = at[part] - n * step, place[kept][part]
            new[cell], found[cell] = scores[kept][part], ids[kept][part]
            both, items = np.hstack([self.scores[some], new]), np.hstack([self.items[some], found])
            top = pick(both, items, self.k)
            self.scores[some], self.items[some] = np.take_along_axis(both, top, axis=1), np.take_along_axis(items, top, axis=1)

    def _fresh(self, rows: np.ndarray, ids: np.ndarray, row: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The candidates that are not held yet: all, as an item passes by once."""
        return row, column

    def rows(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(query, item, score, rank), some queries at a time."""
        step = max(1, SCORE_CELLS // self.k)
        ranks = np.arange(1, self.k + 1, dtype=np.int32)
        for start in range(0, len(self.ids), step):
            part = slice(start, start + step)
            order = np.lexsort((self.items[part], -self.scores[part]), axis=1)
            scores = np.take_along_axis(self.scores[part], order, axis=1)
            items = np.take_along_axis(self.items[part], order, axis=1)
            found = scores > -np.inf
            queries = np.repeat(self.ids[part], found.sum(axis=1))
            yield queries, items[found], scores[found], np.broadcast_to(ranks, found.shape)[found]


def _search(make: Callable[[pa.Table], BestSoFar]):
    """Lists of the queries of a block, kept by what ``make`` makes of them."""
    schema = pa.schema([("query", pa.int64()), ("item", pa.int64()), ("score", pa.float64()), ("rank", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: list[pa.RecordBatch] = []
        best = None
        for batch in batches:
            cut = int(np.searchsorted(batch["_side"].to_numpy(), 1))
            if cut:
                if best is not None:
                    raise RuntimeError("a query came after the items of its block")
                queries.append(batch.slice(0, cut))
            if cut < batch.num_rows and (queries or best is not None):
                if best is None:
                    best = make(pa.Table.from_batches(queries))
                    queries.clear()
                best.see(batch.slice(cut))
        if best is not None:
            for columns in best.rows():
                yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], schema=schema)

    return run


def block_sizes(n_queries: int, n_items: int, dim: int, k: int, cores: int) -> tuple[int, int]:
    """Rows per tile and per stripe.

    A tile has to fit a task's memory. Beyond that every item is sent to every tile and every query
    to every stripe, which sends back k rows: for the wanted number of blocks the cheapest shape
    balances the two.
    """
    # vectors come in, are sorted and become a matrix, for a while all three at once
    largest = max(MIN_TILE, TILE_BYTES // (COPIES * 8 * dim + 16 * k))
    blocks = BLOCKS_PER_CORE * cores
    sent, returned = 4 * dim, 4 * dim + 20 * k
    cheapest = round(math.sqrt(blocks * max(n_queries, 1) * returned / (max(n_items, 1) * sent)))
    tiles = max(1, math.ceil(n_queries / largest), min(cheapest, math.ceil(n_queries / MIN_TILE)))
    stripes = max(1, min(round(blocks / tiles), math.ceil(n_items / MIN_STRIPE)))
    return max(1, math.ceil(n_queries / tiles)), max(1, math.ceil(n_items / stripes))


def _grid(queries: DataFrame, items: DataFrame, tile_rows: int, stripe_rows: int, packs: int) -> DataFrame:
    """(cell, _tiles, _stripes, _pack): how each cell is cut, and the blocks it goes to.

    Cells of up to an eighth of a tile and one stripe share blocks, so that small cells do not become small
    tasks. Cells without queries or without items drop out here.
    """
    counts = queries.groupBy("cell").agg(F.count(F.lit(1)).alias("_queries")).join(
        items.groupBy("cell").agg(F.count(F.lit(1)).alias("_items")), "cell"
    )
    alone = (F.col("_queries") * 8 > tile_rows) | (F.col("_items") > stripe_rows)
    shared = -1 - F.pmod(F.xxhash64("cell"), F.lit(packs))
    return counts.select(
        "cell",
        F.ceil(F.col("_queries") / tile_rows).alias("_tiles"),
        F.ceil(F.col("_items") / stripe_rows).alias("_stripes"),
        F.when(alone, F.col("cell")).otherwise(shared).alias("_pack"),
    )


def best_in_cells(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    metric: str,
    cells: int,
    n_queries: int,
    n_items: int,
    tile_rows: int,
    stripe_rows: int,
    tiles: int | None = None,
    make: Callable[[pa.Table], BestSoFar] | None = None,
    more: Sequence[str] = (),
) -> DataFrame:
    """(query, item, score, rank): for each query, cell and stripe the k best items.

    ``queries`` has (query, vec) and ``items`` (item, vec), both with a ``cell`` column that takes
    at most ``cells`` values. ``n_queries`` and ``n_items`` are their numbers of rows. Whatever is among the k best over all cells of a query is among
    the rows returned; a pair may repeat across cells. ``make`` keeps the lists of a tile in another way, with the
    columns ``more`` of both sides. With one cell, queries may bring a ``_tile`` of their own, below ``tiles``, and items
    ``_able``, the tiles they have to be sent to; else a query's tile is a hash and items go to all.
    """
    if metric not in METRICS:
        raise ValueError(f"metric {metric!r} is not one of {METRICS}")
    make = make or partial(BestSoFar, k=k, cosine=metric == "cosine")
    cores = queries.sparkSession.sparkContext.defaultParallelism
    tiles, stripes = tiles or max(1, math.ceil(n_queries / tile_rows)), max(1, math.ceil(n_items / stripe_rows))

    if cells == 1:
        blocks = tiles * stripes
        grid = {"_pack": F.lit(0), "_tiles": F.lit(tiles), "_stripes": F.lit(stripes)}
        left, right = queries.withColumns(grid), items.withColumns(grid)
        if metric == "dot":
            right = right.withColumn("_order", -norm("vec"))
    else:
        blocks = max(BLOCKS_PER_CORE * cores, 2 * tiles)
        # cells that share a block come by hash: a quarter of a tile on average, so that hardly any block exceeds one
        grid = _grid(queries, items, tile_rows, stripe_rows, max(blocks, math.ceil(n_queries / max(1, tile_rows // 4))))
        if cells <= BROADCAST_CELLS:
            left, right = queries.join(F.broadcast(grid), "cell"), items.join(F.broadcast(grid), "cell")
        else:
            left, right = join_unique(queries, grid, "cell"), join_unique(items, grid, "cell")

    def side(df: DataFrame, number: int, id_: str, own: tuple[str, str], other: tuple[str, str]) -> DataFrame:
        """Rows with their own piece of the cell, once per piece of the other side."""
        piece, count = own
        if "_order" not in df.columns:
            df = df.withColumn("_order", F.lit(0.0))
        every = F.sequence(F.lit(0).cast("bigint"), F.col(other[1]).cast("bigint") - 1)
        return df.select(
            F.col("_pack").cast("bigint").alias("_pack"),
            (F.col(piece).cast("bigint") if piece in df.columns else F.pmod(F.xxhash64(id_), F.col(count).cast("bigint"))).alias(piece),
            F.explode(F.col("_able") if "_able" in df.columns else every).alias(other[0]),
            F.lit(number).alias("_side"),
            "_order",
            F.col("cell").cast("bigint").alias("cell"),
            F.col(id_).cast("bigint").alias("id"),
            "vec",
            *more,
        )

    tile, stripe = ("_tile", "_tiles"), ("_stripe", "_stripes")
    block = ["_pack", "_tile", "_stripe"]
    rows = side(left, 0, "query", tile, stripe).unionByName(side(right, 1, "item", stripe, tile))
    # the work grows with the product of the sides, not with the bytes a partition receives, so the
    # number of partitions is set here instead of by size
    if cells == 1:
        # one block per partition: a hash would put several into one and none into others
        dealt = rows.repartitionById(blocks, (F.col("_tile") * stripes + F.col("_stripe")).cast("int"))
    else:
        dealt = rows.repartition(blocks, *block)
    found = (
        dealt.sortWithinPartitions(*block, "_side", "_order")
        .groupBy(*block)
        .applyInArrow(_search(make), "query bigint, item bigint, score double, rank int")
    )
    return found.select(
        F.col("query").cast(queries.schema["query"].dataType).alias("query"),
        F.col("item").cast(items.schema["item"].dataType).alias("item"),
        "score",
        "rank",
    )


def rank_best(scored: DataFrame, k: int) -> DataFrame:
    """(query, item, score, rank): the k best rows per query, ties by item. The rank limit is
    applied before and after the shuffle, so a query never brings more than k rows per task."""
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc("item"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _reach(queries: DataFrame, items: DataFrame, k: int, n_items: int, tile_rows: int, n_queries: int) -> tuple[DataFrame, DataFrame, int, DataFrame] | None:
    """(queries with ``_tile``, items with ``_able``, number of tiles, lists of the longest items), or None.

    The longest items, ``HEAD`` times k of them or more, are searched first. A query's k-th best score among them, over its
    length, is the length an item needs to get into its list. Queries that need alike are tiled together, and an
    item is sent to the tiles whose least need it meets: mostly to few, or to none.
    """
    head_rows = max(HEAD * k, n_items // 64)
    if n_items <= 2 * head_rows or n_queries == 0:
        return None
    sized = materialize(items.withColumn("_length", norm("vec")), "lengths")
    cut = sized.agg(F.approx_percentile("_length", 1 - head_rows / n_items, 10_000)).first()[0]
    head, rest = sized.filter(F.col("_length") >= cut), sized.filter(F.col("_length") < cut)
    n_head = head.count()
    if n_head < k or n_head > n_items // 2:
        return None  # lengths hardly differ
    tiles = max(1, math.ceil(n_queries / tile_rows))
    stripe = block_sizes(n_queries, n_head, 1, k, queries.sparkSession.sparkContext.defaultParallelism)[1]
    found = best_in_cells(queries, head.drop("_length"), k, "dot", 1, n_queries, n_head, tile_rows, max(stripe, k))
    lists = materialize(rank_best(found, k), "head-lists")
    worst = lists.filter(F.col("rank") == k).select("query", F.col("score").alias("_worst"))
    length = norm("vec")
    need = F.when(F.col("_worst").isNull(), 0.0).when(length == 0, F.when(F.col("_worst") <= 0, 0.0).otherwise(float("inf")))
    needs = queries.join(worst, "query", "left").withColumn("_need", need.otherwise(F.col("_worst") / length / ROUNDING))
    needs = materialize(needs.drop("_worst"), "needs")
    classes = min(CLASSES, tiles)
    ends = needs.agg(F.approx_percentile("_need", [c / classes for c in range(1, classes)], 10_000)).first()[0] if classes > 1 else []
    own = sum((F.when(F.col("_need") > end, 1).otherwise(0) for end in sorted(set(ends))), F.lit(0))
    sizes = {row["c"]: row for row in needs.groupBy(own.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.min("_need").alias("least")).collect()}
    before, first, able = 0, [], []
    for c in range(len(set(ends)) + 1):
        pieces = math.ceil(sizes[c]["n"] / tile_rows) if c in sizes else 0
        first.append((before, pieces))
        if pieces:
            able.append((sizes[c]["least"], before, before + pieces - 1))
        before += pieces
    tile = F.lit(0).cast("bigint")
    for c, (start, pieces) in enumerate(first):
        if pieces:
            tile = F.when(own == c, F.lit(start) + F.pmod(F.xxhash64("query"), F.lit(pieces))).otherwise(tile)
    none = F.array().cast("array<bigint>")
    # at most CLASSES ranges of tiles
    sent = F.concat(*[F.when(F.col("_length") * ROUNDING >= least, F.sequence(F.lit(a).cast("bigint"), F.lit(b).cast("bigint"))).otherwise(none) for least, a, b in able])
    return needs.withColumn("_tile", tile).drop("_need"), rest.withColumn("_able", sent).drop("_length"), before, lists


def exact_topk(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    metric: str = "dot",
    tile_rows: int | None = None,
    stripe_rows: int | None = None,
    invalid: str = "raise",
    reach: bool | None = None,
) -> DataFrame:
    """(query, item, score, rank): the k best items of every query, both given as (id, vec).

    The whole of both tables is one cell. Where the items make a single stripe, a block's lists
    are final and no shuffle follows. Equal scores rank by item, copies of a vector included.
    Vectors that cannot be scored raise, or are left out one by one, see ``checked``.

    With ``reach`` the longest items are searched first, and of the others only those are sent on, and only to the
    tiles, that can get into a list by their length (``_reach``); lists are the same. That takes jobs of its
    own, so by default it is done for inner products where items sent to all tiles were ``REACH_ROWS`` or more.
    """
    items, queries, n_items, n_queries, dim, _ = checked_pair(items, queries, invalid)
    left = queries.select(F.lit(0).alias("cell"), F.col("id").alias("query"), "vec")
    right = items.select(F.lit(0).alias("cell"), F.col("id").alias("item"), "vec")
    cores = queries.sparkSession.sparkContext.defaultParallelism
    sizes = block_sizes(n_queries, n_items, dim or 1, k, cores)
    tile_rows, stripe_rows = tile_rows or sizes[0], stripe_rows or sizes[1]
    if reach is None:
        reach = n_items * math.ceil(max(n_queries, 1) / tile_rows) >= REACH_ROWS
    parts = _reach(left, right, k, n_items, tile_rows, n_queries) if reach and metric == "dot" else None
    if parts is not None:
        left, right, tiles, lists = parts
        found = best_in_cells(left, right, k, metric, 1, n_queries, n_items, tile_rows, stripe_rows, tiles)
        return rank_best(lists.drop("rank").unionByName(found.drop("rank")), k)
    found = best_in_cells(left, right, k, metric, 1, n_queries, n_items, tile_rows, stripe_rows)
    return found if n_items <= stripe_rows else rank_best(found, k)
