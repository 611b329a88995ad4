"""Approximate nearest neighbours: random-hyperplane hash tables joined on their buckets.

A vector's bucket in a table is the sign pattern of its products with that table's planes. Queries
look into their own bucket and into the neighbouring ones that lie behind the planes they are
closest to; what they meet there is scored exactly.

For inner products items may be put into bands by their norm, each with buckets of its own: a query then looks into the
buckets, over all bands, with the largest products to be expected, so that short items are looked at last.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions.vectors import band_of, checked, checked_pair, dimension, matrix, norm, pad_items, pad_queries
from earshot.operators.joins import join_unique
from earshot.operators.topk import ROUNDING, SCORE_CELLS, BestSoFar, best_in_cells, block_sizes, exact_topk, pick, rank_best
from earshot.sources.store import materialize

MAX_BITS = 30
BAND = 0.75  # a band's upper end over that of the one before
SPREAD = 0.9  # of a half turn, that the share of differing bits stands for
BLOCK_PAIRS = 512  # per bucket, on average: from there on its vectors are multiplied as blocks
FLIP_CELLS = 1 << 20  # costs of flips held at once
MEET_CELLS = 4 << 20  # pairs looked at at once


def planes(tables: int, bits: int, dim: int, seed: int) -> np.ndarray:
    """(tables, bits, dim) normal deviates. Every table has a seed of its own, so the first tables
    of a larger set are those of a smaller one."""
    if not 1 <= bits <= MAX_BITS:
        raise ValueError(f"bits must lie between 1 and {MAX_BITS}")
    return np.stack(
        [np.random.default_rng([seed, table]).standard_normal((bits, dim)).round(6) for table in range(tables)]
    )


def check_probes(probes: int, bits: int) -> int:
    """``probes``, if there are so many other buckets: a search reports what it was asked for, or nothing."""
    if not 0 <= probes < 2**bits:
        raise ValueError(f"{probes} probes need more than {bits} bits: a table has {2**bits} buckets")
    return probes


def cheapest_flips(margins: np.ndarray, probes: int) -> np.ndarray:
    """(rows, probes + 1) bit masks: the subsets of bits with the smallest sums of ``margins``, in
    ascending order, starting with the empty one.

    Bits are taken one after the other, each time keeping the best subsets with and without the
    new bit; a subset that is not among the best so far cannot lead to one that is among the best.
    """
    rows, bits = margins.shape
    cost = np.zeros((rows, 1))
    masks = np.zeros((rows, 1), dtype=np.int64)
    for bit in range(bits):
        cost = np.concatenate([cost, cost + margins[:, [bit]]], axis=1)
        masks = np.concatenate([masks, masks | (1 << bit)], axis=1)
        order = np.argsort(cost, axis=1, kind="stable")[:, : probes + 1]
        cost = np.take_along_axis(cost, order, axis=1)
        masks = np.take_along_axis(masks, order, axis=1)
    return masks


def check_looks(probes: int, bits: int, bands: int) -> int:
    """``probes``, if all bands together have so many other buckets."""
    if not 0 <= probes < bands * 2**bits:
        raise ValueError(f"{probes} probes need more than {bits} bits and {bands} bands: a table has {bands * 2**bits} buckets")
    return probes


def grades(bits: int, bands: int) -> np.ndarray:
    """(bands, bits + 1): the order in which buckets are looked into by their band and the number of bits in which they
    differ from the query: that of the products to be expected, an upper end of the norm times the cosine of an angle."""
    expected = BAND ** np.arange(bands)[:, None] * np.cos(np.pi * SPREAD * np.arange(bits + 1) / bits)[None, :]
    order = sorted(((-round(expected[b, h], 12), b, h) for b in range(bands) for h in range(bits + 1)))
    out = np.zeros((bands, bits + 1), np.int64)
    for grade, (_, b, h) in enumerate(order):
        out[b, h] = grade
    return out


def over_bands(flips: np.ndarray, bits: int, bands: int, probes: int) -> np.ndarray:
    """(rows, probes + 1): of flips in ascending order of cost, times all bands, those with the smallest grades, then costs.
    The band is written above the ``bits`` of the flips."""
    rows, width = flips.shape
    differing = np.zeros(flips.shape, np.int64)
    for bit in range(bits):
        differing += (flips >> bit) & 1
    key = grades(bits, bands)[:, differing] * width + np.arange(width)  # (bands, rows, width)
    first = np.argsort(np.moveaxis(key, 0, 1).reshape(rows, -1), axis=1, kind="stable")[:, : probes + 1]
    return np.take_along_axis(flips, first % width, axis=1) | (first // width << bits)


def _lists(values: np.ndarray) -> pa.Array:
    """One list per row of a matrix."""
    offsets = np.arange(0, values.size + 1, max(1, values.shape[1]), dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, values.ravel())


def with_codes(
    df: DataFrame,
    tables: int,
    bits: int,
    seed: int,
    dim: int,
    probes: int = 0,
    pad: Callable[[np.ndarray], np.ndarray] | None = None,
    bands: int = 1,
    longest: float | None = None,
) -> DataFrame:
    """Append ``codes``: the bucket of ``vec`` in every table, or with ``probes`` the buckets to
    look into, own bucket first, table after table. ``pad`` changes the vectors before. With ``bands`` a bucket's number
    begins with that of its band: the row's own by its norm where ``longest`` is given, or else those to look into."""
    check_looks(probes, bits, bands)
    if pad:
        dim += 1
    normals = planes(tables, bits, dim, seed)
    flips_of = min(probes, 2**bits - 1)

    def run(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.list_(pa.int64()))
        rows = matrix(vectors)
        step = max(1, FLIP_CELLS // (tables * (bits + bands * (flips_of + 1))))
        return _lists(np.concatenate([codes(rows[at : at + step], normals) for at in range(0, len(rows), step)]))

    def codes(rows: np.ndarray, normals: np.ndarray) -> np.ndarray:
        sides = np.tensordot(pad(rows) if pad else rows, normals, axes=(1, 2))
        own = ((sides > 0) * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)
        if longest is not None and bands > 1:
            return own | (band_of(rows, longest, BAND, bands)[:, None] << bits)
        if probes or bands > 1 and longest is None:
            flips = cheapest_flips(np.abs(sides).reshape(-1, bits), flips_of)
            if bands > 1:
                flips = over_bands(flips, bits, bands, probes)
            own = own[:, :, None] ^ flips.reshape(len(rows), tables, -1)
        return own.reshape(len(rows), -1)

    return df.withColumn("codes", F.arrow_udf(run, "array<bigint>")("vec"))


def buckets(coded: DataFrame, bits: int, probes: int = 0, bands: int = 1) -> DataFrame:
    """One row per entry of ``codes``, as ``tbl``, ``probe`` and ``code``: the bucket table."""
    width = check_looks(probes, bits, bands) + 1
    others = [name for name in coded.columns if name != "codes"]
    return coded.select(*others, F.posexplode("codes").alias("_at", "code")).select(
        *others,
        F.floor(F.col("_at") / width).cast("int").alias("tbl"),
        (F.col("_at") % width).alias("probe"),
        "code",
    )


def save_buckets(bucketed: DataFrame, path: str) -> None:
    """The bucket table as parquet, one folder per hash table."""
    bucketed.write.mode("overwrite").partitionBy("tbl").parquet(path)


class BestInBuckets(BestSoFar):
    """The queries of a tile with their k best among the items that they meet in a bucket of some table.

    Items bring a code per table, queries the codes they look into. Where buckets hold few pairs, all pairs of a batch
    that meet are listed, each once however many tables it meets in, and scored one by one; where they hold
    many, the vectors of a bucket are multiplied as blocks and a pair found again is left out of the lists.
    """

    def __init__(self, queries: pa.Table, k: int, cosine: bool, tables: int):
        super().__init__(queries, k, cosine)
        looks = np.asarray(self.table["codes"].combine_chunks().flatten(), dtype=np.int64).reshape(len(self.ids), tables, -1)
        self.width = looks.shape[2]
        self.order = [looks[:, t].ravel().argsort(kind="stable") for t in range(tables)]
        self.codes = [looks[:, t].ravel()[order] for t, order in enumerate(self.order)]

    def see(self, items: pa.RecordBatch) -> None:
        ids, vectors = items["id"].to_numpy(), self._vectors(items["vec"])
        lengths = np.linalg.norm(vectors, axis=1)
        own = np.asarray(items["codes"].flatten(), dtype=np.int64).reshape(len(ids), -1)
        # queries of an item in a table: from .. to in the table's order
        starts = [np.searchsorted(codes, own[:, t], "left") for t, codes in enumerate(self.codes)]
        ends = [np.searchsorted(codes, own[:, t], "right") for t, codes in enumerate(self.codes)]
        pairs = sum(int((e - s).sum()) for s, e in zip(starts, ends))
        cells = sum(len(np.unique(s[e > s])) for s, e in zip(starts, ends))
        if pairs >= BLOCK_PAIRS * max(cells, 1):
            self._blocks(ids, vectors, lengths, own, starts, ends)
        elif pairs:
            self._singly(ids, vectors, lengths, starts, ends)

    def _blocks(self, ids, vectors, lengths, own, starts, ends) -> None:
        for t, order in enumerate(self.order):
            by_code = own[:, t].argsort(kind="stable")
            by_code = by_code[ends[t][by_code] > starts[t][by_code]]
            for columns in np.split(by_code, np.flatnonzero(np.diff(own[by_code, t])) + 1):
                if len(columns):
                    rows = order[starts[t][columns[0]] : ends[t][columns[0]]] // self.width
                    longest = lengths[columns].max()
                    rows = rows[self.lengths[rows] * longest * ROUNDING >= self.scores[rows].min(axis=1)]
                    step = max(1, SCORE_CELLS // len(columns))
                    for at in range(0, len(rows), step):
                        self._merge(rows[at : at + step], ids[columns], vectors[columns], longest)

    def _fresh(self, rows, ids, row, column):
        step = max(1, SCORE_CELLS // self.k)
        new = [~(self.items[rows[row[at : at + step]]] == ids[column[at : at + step], None]).any(axis=1) for at in range(0, len(row), step)]
        new = np.concatenate(new) if new else np.zeros(0, bool)
        return row[new], column[new]

    def _singly(self, ids, vectors, lengths, starts, ends) -> None:
        step = max(1, len(ids) * SCORE_CELLS // max(1, sum(int((e - s).sum()) for s, e in zip(starts, ends))))
        for at in range(0, len(ids), step):
            part = slice(at, at + step)
            met = [np.zeros(0, np.int64)]
            for order, s, e in zip(self.order, starts, ends):
                n = e[part] - s[part]
                columns = np.repeat(np.arange(len(n)), n)
                places = np.repeat(s[part] - (np.cumsum(n) - n), n) + np.arange(len(columns))
                met.append(order[places] // self.width * len(n) + columns)
            met = np.unique(np.concatenate(met))
            rows, columns = met // len(n), met % len(n) + at
            able = self.lengths[rows] * lengths[columns] * ROUNDING >= self.scores[rows].min(axis=1)
            rows, columns = rows[able], columns[able]
            self.compared += len(rows)
            if len(rows):
                wide = max(1, SCORE_CELLS // vectors.shape[1])
                scores = np.concatenate([(self.vectors[rows[k : k + wide]] * vectors[columns[k : k + wide]]).sum(axis=1) for k in range(0, len(rows), wide)])
                self._add(rows, ids[columns], scores)


def search_tiles(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    metric: str,
    tables: int,
    n_queries: int,
    n_items: int,
    dim: int,
    tile_rows: int | None = None,
    stripe_rows: int | None = None,
) -> DataFrame:
    """(query, item, score, rank) from (query, vec, codes) and (item, vec, codes): blocks of queries and items as in the
    exact search, within which only pairs that meet in a bucket are scored. A vector is sent once per block, not
    once per table, and no pair is scored in two blocks."""
    cores = queries.sparkSession.sparkContext.defaultParallelism
    sizes = block_sizes(n_queries, n_items, dim + tables, k, cores)
    tile_rows, stripe_rows = tile_rows or sizes[0], stripe_rows or sizes[1]
    left, right = (side.select(F.lit(0).alias("cell"), id_, "vec", "codes") for side, id_ in ((queries, "query"), (items, "item")))
    make = partial(BestInBuckets, k=k, cosine=metric == "cosine", tables=tables)
    found = best_in_cells(left, right, k, metric, 1, n_queries, n_items, tile_rows, stripe_rows, make=make, more=("codes",))
    return found if n_items <= stripe_rows else rank_best(found, k)


def search_buckets(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    metric: str,
    tables: int,
    bits: int,
    n_queries: int,
    n_items: int,
    tile_rows: int | None = None,
    stripe_rows: int | None = None,
    dim: int | None = None,
) -> DataFrame:
    """(query, item, score, rank) from bucket tables of queries (query, vec) and items (item, vec)
    with ``n_queries`` and ``n_items`` rows.

    Each bucket is searched for the k best on its own, then a pair found in several buckets is
    counted once. The k best of all candidates are among the k best of their buckets, so nothing
    is lost, and a crowded bucket is cut into tiles and stripes like any other cell.
    """
    cell = (F.col("tbl").cast("bigint") * (1 << bits) + F.col("code")).alias("cell")
    left, right = queries.select(cell, "query", "vec"), items.select(cell, "item", "vec")
    cores = queries.sparkSession.sparkContext.defaultParallelism
    sizes = block_sizes(n_queries, n_items, dim or dimension(items), k, cores)
    tile_rows, stripe_rows = tile_rows or sizes[0], stripe_rows or sizes[1]
    found = best_in_cells(left, right, k, metric, tables << bits, n_queries, n_items, tile_rows, stripe_rows)
    # a query has at most k rows per bucket and stripe, so one shuffle by query serves both steps
    once = found.repartition("query").groupBy("query", "item").agg(F.max("score").alias("score"))
    return rank_best(once, k)


def hash_pair(
    queries: DataFrame, items: DataFrame, metric: str, tables: int, bits: int, probes: int, seed: int, bands: int = 1
) -> tuple[DataFrame, DataFrame]:
    """(query, vec, codes) and (item, vec, codes) of queries and items given as (id, vec).

    ``dot`` hashes both with one more dimension, which turns the search for the largest inner
    product into one for the smallest angle; ``vec`` stays as it is. Vectors that cannot be scored raise.
    """
    items, queries, n_items, _, dim, longest = checked_pair(items, queries)
    index = SearchIndex.of(items, metric, tables, bits, seed, dim or 1, bands, n_items, longest)
    return index.hashed_queries(queries, tables, probes), index.items


def band_bits(bands: int) -> int:
    return (bands - 1).bit_length()


@dataclass
class SearchIndex:
    """Hashed items with all that is needed to hash queries alike; built once, saved, loaded and searched."""

    items: DataFrame  # (item, vec, codes)
    metric: str
    tables: int
    bits: int
    seed: int
    dim: int
    longest: float | None  # of the items, for ``dot``
    bands: int = 1
    n_items: int | None = None
    identity: str | None = None  # fingerprint of the vectors, where it was saved

    SETTINGS = "metric string, tables int, bits int, seed int, dim int, longest double, bands int, n_items bigint, identity string"

    @classmethod
    def of(
        cls, items: DataFrame, metric: str, tables: int, bits: int, seed: int, dim: int, bands: int, n_items: int, longest: float | None = None
    ) -> SearchIndex:
        """Of checked vectors (id, vec), of which ``longest`` is the largest norm; nothing is written."""
        if bands > 1 and metric != "dot":
            raise ValueError("bands of norms are for inner products")
        rows = items.select(F.col("id").alias("item"), "vec")
        if metric != "dot":
            longest = None
        elif longest is None:
            longest = rows.agg(F.max(norm("vec"))).first()[0] or 0.0
        pad = partial(pad_items, longest=longest, band=BAND if bands > 1 else None, bands=bands) if longest is not None else None
        coded = with_codes(rows, tables, bits, seed, dim, pad=pad, bands=bands, longest=longest)
        return cls(coded, metric, tables, bits, seed, dim, longest, bands, n_items)

    @classmethod
    def build(
        cls, items: DataFrame, metric: str = "cosine", tables: int = 10, bits: int = 6, seed: int = 7, bands: int = 1
    ) -> SearchIndex:
        """From (id, vec). The hashed table is written, so nothing is hashed twice. Vectors that cannot be scored raise."""
        items, n_items, dim = checked(items)
        index = cls.of(items, metric, tables, bits, seed, dim or 1, bands, n_items)
        return replace(index, items=materialize(index.items, "hashed"))

    def hashed_queries(self, queries: DataFrame, tables: int, probes: int) -> DataFrame:
        """(query, vec, codes) of checked vectors (id, vec)."""
        pad = pad_queries if self.longest is not None else None
        return with_codes(queries.select(F.col("id").alias("query"), "vec"), tables, self.bits, self.seed, self.dim, probes, pad, self.bands)

    def search(
        self, queries: DataFrame, k: int, probes: int = 0, tables: int | None = None, layout: str | None = None, n_queries: int | None = None, **sizes
    ) -> DataFrame:
        """(query, item, score, rank) for queries (id, vec), in the first ``tables`` of the index, or in all.

        ``layout`` is how vectors are dealt: in "tiles", every item to all tiles of queries, or to "buckets", every
        item once per table and every query once per look. By default the one that sends fewer vectors; lists
        are the same. ``n_queries`` says that the queries are checked.
        """
        tables = self.tables if tables is None else tables
        if tables > self.tables:
            raise ValueError(f"the index has {self.tables} tables, not {tables}")
        if layout not in (None, "tiles", "buckets"):
            raise ValueError(f"layout {layout!r} is not 'tiles' or 'buckets'")
        if n_queries is None:
            queries, n_queries, _ = checked(queries, self.dim)
        n_items = self.items.count() if self.n_items is None else self.n_items
        left = self.hashed_queries(queries, tables, probes)
        right = self.items if tables == self.tables else self.items.withColumn("codes", F.slice("codes", 1, tables))
        if layout is None:
            cores = queries.sparkSession.sparkContext.defaultParallelism
            tile, stripe = block_sizes(n_queries, n_items, self.dim + tables, k, cores)
            dealt = n_items * math.ceil(max(1, n_queries) / tile) + n_queries * math.ceil(max(1, n_items) / stripe)
            layout = "tiles" if dealt <= tables * (n_items + n_queries * (probes + 1)) else "buckets"
        if layout == "tiles":
            return search_tiles(left, right, k, self.metric, tables, n_queries, n_items, self.dim, **sizes)
        left = materialize(left, "hashed")
        looks, places = buckets(left, self.bits, probes, self.bands), buckets(right, self.bits, 0, self.bands)
        shown = self.bits + band_bits(self.bands)
        return search_buckets(
            looks, places, k, self.metric, tables, shown, n_queries * tables * (probes + 1), n_items * tables, dim=self.dim, **sizes
        )

    def save(self, path: str, identity: str | None = None) -> None:
        """``identity`` tells the vectors apart from others, see ``store.fingerprint``."""
        self.items.write.mode("overwrite").parquet(f"{path}/items")
        row = [(self.metric, self.tables, self.bits, self.seed, self.dim, self.longest, self.bands, self.n_items, identity)]
        self.items.sparkSession.createDataFrame(row, self.SETTINGS).coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SearchIndex:
        return cls(spark.read.parquet(f"{path}/items"), *spark.read.schema(cls.SETTINGS).parquet(f"{path}/settings").first())


def ann_topk(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    metric: str = "cosine",
    tables: int = 10,
    bits: int = 6,
    probes: int = 0,
    seed: int = 7,
    bands: int = 1,
    **options,
) -> DataFrame:
    """(query, item, score, rank): the k best among the items met in the buckets. ``options`` as for ``SearchIndex.search``."""
    check_looks(probes, bits, bands)
    items, queries, n_items, n_queries, dim, longest = checked_pair(items, queries)
    index = SearchIndex.of(items, metric, tables, bits, seed, dim or 1, bands, n_items, longest)
    if options.get("layout") == "buckets":  # which reads the hashed items twice
        index = replace(index, items=materialize(index.items, "hashed"))
    return index.search(queries, k, probes, n_queries=n_queries, **options)


def enough_bits(probes: int) -> int:
    """The fewest planes, 6 at least, with which a table has so many other buckets."""
    return max(6, probes.bit_length())


def _first_looks(neighbours: DataFrame, tables: Sequence[int], width: int) -> list[Column]:
    """Per number of tables the least look, from 1, in which a pair (``looks``, ``codes``) meets; a number above all where it
    does not. The arrays of a pair are compared table by table; no look is a row."""
    looks = F.transform("codes", lambda code, t: F.array_position(F.slice(F.col("looks"), t * width + 1, width), code))
    met = F.transform(looks, lambda at: F.when(at > 0, at).otherwise(F.lit(width + 1)))
    return [F.array_min(F.slice(met, 1, t)) for t in tables]


def _meet(queries: pa.Table, tables: Sequence[int], probes: Sequence[int], codes: int) -> Callable[[np.ndarray], np.ndarray]:
    """Counts the pairs of the queries and items that meet, per number of tables and of probes."""
    most = max(tables)
    looks = np.asarray(queries["codes"].combine_chunks().flatten(), dtype=np.int64).reshape(queries.num_rows, most, -1)
    n, _, width = looks.shape
    # the least look a pair meets in takes a byte for up to 254 looks, so pairs are gathered and compared as runs of bytes
    small = np.uint8 if width < 255 else np.uint16 if width < 65_535 else np.int32

    def count(own: np.ndarray) -> np.ndarray:
        out = np.zeros((len(tables), len(probes)), np.int64)
        step = max(1, MEET_CELLS // max(codes, len(own)))
        for at in range(0, n, step):
            part = looks[at : at + step]
            first = np.full((len(own), len(part)), width, small)
            for t in range(most):
                place = np.full((codes, len(part)), width, small)
                # a bucket is looked into once, so no place is written twice
                place[part[:, t].T, np.arange(len(part))] = np.arange(width, dtype=small)[:, None]
                np.minimum(first, place[own[:, t]], out=first)
                if t + 1 in tables:
                    out[tables.index(t + 1)] += [np.count_nonzero(first <= p) for p in probes]
        return out

    return count


def met_pairs(
    queries: DataFrame, items: DataFrame, tables: Sequence[int], probes: Sequence[int], codes: int, n_queries: int, n_items: int
) -> DataFrame:
    """(tables, probes, met): how many pairs of (query, codes) and (item, codes) meet at all, each counted once however often
    it meets. All pairs are looked at, in blocks, so this costs as much as a search without hashing."""
    tile, stripe = block_sizes(n_queries, n_items, max(tables) * (max(probes) + 1), 1, queries.sparkSession.sparkContext.defaultParallelism)
    tiles, stripes = max(1, math.ceil(n_queries / tile)), max(1, math.ceil(n_items / stripe))
    tables, probes = sorted(tables), list(probes)

    def side(rows: DataFrame, id_: str, number: int, own: int, other: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(other - 1).cast("bigint"))).alias("_other")
        rows = rows.select("codes", F.pmod(F.xxhash64(id_), F.lit(own)).alias("_own"), every)
        tile, stripe = ("_other", "_own") if number else ("_own", "_other")
        return rows.select("codes", (F.col(tile) * stripes + F.col(stripe)).cast("int").alias("block"), F.lit(number).alias("side"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, total = [], None, np.zeros((len(tables), len(probes)), np.int64)
        for batch in batches:
            cut = int(np.searchsorted(batch["side"].to_numpy(), 1))
            if cut:
                held.append(batch.slice(0, cut))
            if cut < batch.num_rows and held:
                if count is None:
                    count = _meet(pa.Table.from_batches(held).combine_chunks(), tables, probes, codes)
                own = batch.slice(cut)
                total += count(np.asarray(own["codes"].flatten(), dtype=np.int64).reshape(own.num_rows, -1))
        t, p = np.meshgrid(tables, probes, indexing="ij")
        columns = [pa.array(t.ravel().astype(np.int32)), pa.array(p.ravel().astype(np.int32)), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["tables", "probes", "met"])

    rows = side(queries, "query", 0, tiles, stripes).unionByName(side(items, "item", 1, stripes, tiles))
    counted = rows.repartitionById(tiles * stripes, "block").sortWithinPartitions("side").mapInArrow(run, "tables int, probes int, met bigint")
    return counted.groupBy("tables", "probes").agg(F.sum("met").alias("met"))


def sweep(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    metric: str = "cosine",
    tables: tuple[int, ...] = (10, 20, 30, 40, 50),
    probes: tuple[int, ...] = (0, 10, 50, 100),
    bits: int | None = None,
    seed: int = 7,
    exact: DataFrame | None = None,
    bands: int = 1,
    met: bool = False,
) -> DataFrame:
    """(tables, probes, recall, scored_share) for every pair of settings.

    An exact neighbour is found if and only if it is a candidate, so recall needs the exact lists
    and the codes of their members only, not a search per setting. ``scored_share`` is the
    number of items met per query over the number of items; an item met in several tables
    counts each time, so the share may exceed 1. With ``met`` there is ``met_share`` as well, in which it counts once:
    that is what a search in tiles scores. Without ``bits`` there are ``enough_bits`` for the probes.
    """
    bits = enough_bits(max(probes)) if bits is None else bits
    depth = check_looks(max(probes), bits, bands)
    if exact is None:
        exact = exact_topk(queries, items, k, metric)
    exact = materialize(exact.select("query", "item"), "exact")
    left, right = hash_pair(queries, items, metric, max(tables), bits, depth, seed, bands)
    left = materialize(left.select("query", "codes"), "looks")
    right = materialize(right.select("item", "codes"), "places")
    looks, places = buckets(left, bits, depth, bands), buckets(right, bits, 0, bands)

    # an item may be a neighbour of very many queries; a query has k neighbours at most
    neighbours = join_unique(exact, right, "item").join(left.withColumnRenamed("codes", "looks"), "query")
    firsts = neighbours.select(*[column.alias(f"first_{t}") for t, column in zip(tables, _first_looks(neighbours, tables, depth + 1))])
    counts = [F.count_if(F.col(f"first_{t}") <= p + 1) / F.count(F.lit(1)) for t in tables for p in probes]
    settings = [(t, p) for t in tables for p in probes]
    rows = F.array(*[F.struct(F.lit(t).alias("tables"), F.lit(p).alias("probes"), n.alias("recall")) for (t, p), n in zip(settings, counts)])
    recall = firsts.agg(rows.alias("at")).select(F.explode("at").alias("at")).select("at.*")

    sizes = places.groupBy("tbl", "code").agg(F.count(F.lit(1)).alias("size"))
    visits = looks.groupBy("tbl", "code", "probe").agg(F.count(F.lit(1)).alias("visits"))
    settings = F.explode(
        F.array(*[F.struct(F.lit(t).alias("tables"), F.lit(p).alias("probes")) for t in tables for p in probes])
    ).alias("at")
    n_queries, n_items = left.count(), right.count()
    n_compared = F.lit(float(n_queries) * n_items)
    scored = (
        visits.join(sizes, ["tbl", "code"])
        .groupBy("tbl", "probe")
        .agg(F.sum(F.col("visits") * F.col("size")).alias("scored"))
        .select("*", settings)
        .filter((F.col("tbl") < F.col("at.tables")) & (F.col("probe") <= F.col("at.probes")))
        .groupBy("at.tables", "at.probes")
        .agg((F.sum("scored") / n_compared).alias("scored_share"))
    )
    out = recall.join(scored, ["tables", "probes"])
    if met:
        share = met_pairs(left, right, tables, probes, 1 << (bits + band_bits(bands)), n_queries, n_items)
        out = out.join(share.select("tables", "probes", (F.col("met") / n_compared).alias("met_share")), ["tables", "probes"])
    return out
