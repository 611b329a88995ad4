"""The registered queries: each takes (spark, sf_dir) and runs over the whole of its tables.

Where a result can be stated in SQL it is, next to the query. Fitted numbers cannot: those queries
return what must hold of them (ids, list lengths, orders, ranges), and the SQL states these.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions.counts import TRANSFORMS
from earshot.functions.vectors import as_doubles
from earshot.operators import interactions as ops
from earshot.operators.indexing import apply_index, fit_index, fit_indexes, load_or_fit_index
from earshot.operators.lsh import SearchIndex, ann_topk, buckets, hash_pair, sweep
from earshot.operators.metrics import (
    as_lists,
    ground_truth,
    list_items,
    per_user_metrics,
    ranking_metrics,
    rec_truth_join,
    rmse,
    truth_lists,
)
from earshot.operators.models import Recommender, als, blocks_for, fit, recommend
from earshot.operators.topk import exact_topk
from earshot.plans import jobs, oracles as sql, tuning
from earshot.session import shared_dir
from earshot.sources import testbed
from earshot.sources.interactions import CODECS, rewrite, split_of
from earshot.sources.store import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# settings of the fits and searches below
FIT = {"reg_param": 1.0, "alpha": 10.0, "rank": 8, "max_iter": 5, "blocks": 4}
K = 500
HASH = {"tables": 10, "bits": 6, "seed": 7}
SWEEP_TABLES, SWEEP_PROBES = (2, 4, 6, 8, 10), (0, 2, 4, 8)
DIM = 64
SLICE_USERS, BLOCK_BYTES, TASKS_PER_CORE = 8192, 16 << 20, 3  # of the built-in lists, see there


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle:
            ORACLES[name] = oracle
        return query

    return add


def _path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _splits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test rows of the purchases, written once per query as the three
    tables a recommender starts from."""
    rows = materialize(testbed.purchases(spark, sf_dir), "purchases")
    return tuple(split_of(rows, name) for name in ("train", "val", "test"))


def _held_out(val: DataFrame, test: DataFrame) -> DataFrame:
    return val.withColumn("split", F.lit("val")).union(test.withColumn("split", F.lit("test")))


def _judged(train: DataFrame, val: DataFrame, test: DataFrame) -> DataFrame:
    """Training rows of the users that are judged later."""
    return materialize(ops.keep_users(train, ops.users_union(val, test)), "judged")


def _maps(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(fit_indexes(rows, ["user_id", "track_id"]))


def _fitted(spark: SparkSession, sf_dir: str, **settings) -> tuple[Recommender, DataFrame, DataFrame]:
    """A recommender for the users that are judged, and the validation and test rows."""
    parts = _splits(spark, sf_dir)
    return Recommender.train(_judged(*parts), als(**{**FIT, **settings})), *parts[1:]


def _with_maps(*more: str) -> str:
    return sql.with_(sql.PURCHASES, sql.JUDGED, sql.MAPS, *more)


def _with_plays(*more: str) -> str:
    return sql.with_(sql.PLAYS, *more)


# --- interactions ---------------------------------------------------------------------------


@register("scan_interactions", sql.with_(sql.PURCHASES) + "SELECT * FROM purchases")
def scan_interactions(spark, sf_dir):
    return testbed.purchases(spark, sf_dir)


@register("train_users_val_test", sql.with_(sql.PURCHASES, sql.JUDGED) + "SELECT * FROM judged")
def train_users_val_test(spark, sf_dir):
    return _judged(*_splits(spark, sf_dir)).select("user_id", "track_id", "count")


@register(
    "train_users_val",
    sql.with_(sql.PURCHASES)
    + """SELECT user_id, track_id, count FROM purchases
         WHERE split = 'train' AND user_id IN (SELECT user_id FROM purchases WHERE split = 'val')""",
)
def train_users_val(spark, sf_dir):
    train, val, _ = _splits(spark, sf_dir)
    return ops.keep_users(train, ops.users_union(val)).select("user_id", "track_id", "count")


@register(
    "eval_users_union",
    sql.with_(sql.PURCHASES)
    + """SELECT user_id FROM purchases WHERE split = 'val' UNION
         SELECT user_id FROM purchases WHERE split = 'test'""",
)
def eval_users_union(spark, sf_dir):
    rows = testbed.purchases(spark, sf_dir)
    return ops.users_union(split_of(rows, "val"), split_of(rows, "test"))


def _counts(name: str) -> Query:
    return lambda spark, sf_dir: TRANSFORMS[name](split_of(testbed.plays(spark, sf_dir), "train"))


for _name, _value, _where in (
    ("identity", "count", "TRUE"),
    ("gt1", "count", "count > 1"),
    ("gt2", "count", "count > 2"),
):
    register(
        f"counts_{_name}",
        _with_plays()
        + f"SELECT user_id, track_id, {_value} AS modcounts FROM plays WHERE split = 'train' AND {_where}",
    )(_counts(_name))


@register(
    "counts_log",
    _with_plays()
    + "SELECT user_id, track_id, count, round(ln(count), 9) AS modcounts FROM plays WHERE split = 'train'",
)
def counts_log(spark, sf_dir):
    return _counts("log")(spark, sf_dir).withColumn("modcounts", F.round("modcounts", 9))


_PROFILE = """SELECT '{0}' AS transform, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
    count(DISTINCT track_id) AS n_items FROM plays WHERE split = 'train' AND {1}"""


@register(
    "count_transform_profile",
    _with_plays()
    + " UNION ALL ".join(
        _PROFILE.format(name, where)
        for name, where in (("identity", "TRUE"), ("log", "TRUE"), ("gt1", "count > 1"), ("gt2", "count > 2"))
    ),
)
def count_transform_profile(spark, sf_dir):
    """What each transform leaves of the training table, from one pass: filters nest, so a row
    counts for the transforms whose bound it passes."""
    train = split_of(testbed.plays(spark, sf_dir), "train")
    kept = F.array(
        *[
            F.when(F.col("count") > least, F.lit(name))
            for name, least in (("identity", 0), ("log", 0), ("gt1", 1), ("gt2", 2))
        ]
    )
    rows = train.select("user_id", "track_id", F.explode(F.array_compact(kept)).alias("transform"))
    return rows.groupBy("transform").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("track_id").alias("n_items"),
    )


@register("project_ids", _with_plays() + "SELECT user_id, track_id FROM plays WHERE split <> 'train'")
def project_ids(spark, sf_dir):
    return testbed.plays(spark, sf_dir).filter(F.col("split") != "train").select("user_id", "track_id")


@register("distinct_users", _with_plays() + "SELECT DISTINCT user_id FROM plays")
def distinct_users(spark, sf_dir):
    return testbed.plays(spark, sf_dir).select("user_id").distinct()


@register("user_frequency", sql.with_(sql.PURCHASES) + "SELECT user_id, count(*) AS n FROM purchases GROUP BY user_id")
def user_frequency(spark, sf_dir):
    return ops.frequency(testbed.purchases(spark, sf_dir), "user_id")


@register("item_frequency", sql.with_(sql.PURCHASES) + "SELECT track_id, count(*) AS n FROM purchases GROUP BY track_id")
def item_frequency(spark, sf_dir):
    return ops.frequency(testbed.purchases(spark, sf_dir), "track_id")


@register(
    "top_counts",
    sql.with_(sql.PURCHASES)
    + """SELECT user_id, track_id, count FROM purchases WHERE split = 'train'
         ORDER BY count DESC, user_id, track_id LIMIT 500""",
)
def top_counts(spark, sf_dir):
    return ops.top_counts(split_of(testbed.purchases(spark, sf_dir), "train"), K)


@register(
    "sample_users_hash",
    sql.with_(sql.PURCHASES)
    + """SELECT * FROM purchases
         WHERE CAST('0x' || substr(md5(user_id), 1, 8) AS BIGINT) < CAST(floor(0.1 * 4294967296) AS BIGINT)""",
)
def sample_users_hash(spark, sf_dir):
    return ops.sample_by_key(testbed.purchases(spark, sf_dir), "user_id", 0.1)


_PLACE = "('0x' || md5('draw' || concat_ws('|', user_id, track_id, split))[1:8])::BIGINT"


@register(
    "sample_with_replacement",
    sql.with_(sql.PURCHASES)
    + f"""SELECT user_id, track_id, split, count FROM (SELECT *, unnest(range(
            {' + '.join(f"(place >= {limit})::INT" for limit in ops.poisson_limits(0.7))})) AS copy
          FROM (SELECT *, {_PLACE} AS place FROM purchases))""",
)
def sample_with_replacement(spark, sf_dir):
    keys = ["user_id", "track_id", "split"]
    return ops.sample_with_copies(testbed.purchases(spark, sf_dir), 0.7, keys, "draw")


@register(
    "codec_roundtrip",
    sql.with_(sql.PLAYS)
    + f"""SELECT codec, user_id, track_id, split, count
          FROM plays, (VALUES {', '.join(f"('{codec}')" for codec in CODECS)}) AS c(codec)""",
)
def codec_roundtrip(spark, sf_dir):
    rows = materialize(testbed.plays(spark, sf_dir), "plays")
    copies = [rewrite(rows, codec).withColumn("codec", F.lit(codec)) for codec in CODECS]
    out = copies[0]
    for copy in copies[1:]:
        out = out.unionByName(copy)
    return out


# --- id maps --------------------------------------------------------------------------------


@register("index_users", _with_maps() + "SELECT user_id, ix, n FROM users")
def index_users(spark, sf_dir):
    return fit_index(_judged(*_splits(spark, sf_dir)), "user_id")


@register("index_items", _with_maps() + "SELECT track_id, ix, n FROM items")
def index_items(spark, sf_dir):
    return fit_index(_judged(*_splits(spark, sf_dir)), "track_id")


@register(
    "index_train",
    _with_maps()
    + """SELECT user_id, track_id, count, u.ix AS user_ix, i.ix AS item_ix
         FROM judged JOIN users u USING (user_id) JOIN items i USING (track_id)""",
)
def index_train(spark, sf_dir):
    rows = _judged(*_splits(spark, sf_dir)).select("user_id", "track_id", "count")
    return apply_index(rows, *_maps(rows), fitted=True)


@register(
    "index_skip_unseen",
    _with_maps(sql.INDEXED) + "SELECT * FROM indexed WHERE split IN ('val', 'test')",
)
def index_skip_unseen(spark, sf_dir):
    """Held-out rows; those of tracks or users that were not in training have no number and go."""
    train, val, test = _splits(spark, sf_dir)
    return apply_index(_held_out(val, test), *_maps(_judged(train, val, test)))


_BOTH_MAPS = """SELECT 'user' AS kind, user_id AS id, ix, n FROM users UNION ALL
                SELECT 'item', track_id, ix, n FROM items"""


def _both(users: DataFrame, items: DataFrame) -> DataFrame:
    return users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), "ix", "n").union(
        items.select(F.lit("item"), "track_id", "ix", "n")
    )


@register("indexer_roundtrip", _with_maps() + _BOTH_MAPS)
def indexer_roundtrip(spark, sf_dir):
    path = _path(spark, "maps")
    for name, table in zip(("users", "items"), _maps(_judged(*_splits(spark, sf_dir)))):
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    return _both(spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/items"))


@register("load_or_fit_indexer", _with_maps() + _BOTH_MAPS)
def load_or_fit_indexer(spark, sf_dir):
    """Fitted and saved by the first call, read by the second."""
    path = _path(spark, "index")
    rows = _judged(*_splits(spark, sf_dir))
    load_or_fit_index(rows, path)
    return _both(*load_or_fit_index(rows, path))


# --- truth, lists and metrics ---------------------------------------------------------------


@register(
    "ground_truth",
    _with_maps(sql.INDEXED)
    + "SELECT user_ix, item_ix, count(*) AS n FROM indexed WHERE split IN ('val', 'test') GROUP BY 1, 2",
)
def ground_truth_bag(spark, sf_dir):
    return ground_truth(index_skip_unseen(spark, sf_dir))


@register(
    "ground_truth_lists",
    _with_plays(sql.NUMBERED, sql.TRUTH)
    + """SELECT user_ix, CAST(floor(item_ix / 4096) AS INTEGER) AS block,
                array_to_string(list_sort(list(item_ix)), ',') AS truth, count(*) AS n_rows
         FROM truth GROUP BY 1, 2""",
)
def ground_truth_lists(spark, sf_dir):
    lists = truth_lists(ground_truth(testbed.numbered(spark, sf_dir, "test")))
    return lists.withColumn("truth", F.array_join(F.col("truth").cast("array<string>"), ","))


@register(
    "rec_items_long",
    _with_plays(sql.NUMBERED, sql.history(K)) + "SELECT user_ix, rank, item_ix FROM lists",
)
def rec_items_long(spark, sf_dir):
    return list_items(as_lists(testbed.history_lists(spark, sf_dir, K)))


@register(
    "rec_truth_join",
    _with_plays(sql.NUMBERED, sql.TRUTH, sql.history(K))
    + """SELECT user_ix, n_recs, n_truth FROM (SELECT user_ix, count(*) AS n_recs FROM lists GROUP BY 1)
         JOIN (SELECT user_ix, count(*) AS n_truth FROM truth GROUP BY 1) USING (user_ix)""",
)
def rec_truth_join_(spark, sf_dir):
    truth = ground_truth(testbed.numbered(spark, sf_dir, "test"))
    return rec_truth_join(testbed.history_lists(spark, sf_dir, K), truth)


@register(
    "per_user_metrics",
    _with_plays(sql.NUMBERED, sql.TRUTH, sql.history(K), sql.metrics(10))
    + "SELECT user_ix, n_truth, hits_at_k, round(average_precision, 9) AS average_precision FROM per_user",
)
def per_user(spark, sf_dir):
    truth = testbed.numbered(spark, sf_dir, "test")
    return per_user_metrics(testbed.history_lists(spark, sf_dir, K), truth, 10).select(
        "user_ix", "n_truth", F.col("hits_at_k").cast("bigint").alias("hits_at_k"),
        F.round("average_precision", 9).alias("average_precision"),
    )


def _metrics(spark, sf_dir, k, length=K, **options):
    truth = testbed.numbered(spark, sf_dir, "test")
    return ranking_metrics(testbed.history_lists(spark, sf_dir, length), truth, k, **options)


@register(
    "precision_at_k",
    " UNION ALL ".join(
        f"SELECT * FROM ({_with_plays(sql.NUMBERED, sql.TRUTH, sql.history(K), sql.metrics(k))}"
        f"SELECT {k} AS k, count(*) AS n_users, round(sum(hits_at_k) / count(*) / {k}, 9) AS precision_at_k FROM per_user)"
        for k in (10, K)
    ),
)
def precision_at_k(spark, sf_dir):
    """At 10 and at 500, where lists are shorter and precision still divides by 500."""
    rows = _metrics(spark, sf_dir, (10, K))
    return rows.select("k", "n_users", F.round("precision_at_k", 9).alias("precision_at_k"))


@register(
    "mean_average_precision",
    _with_plays(sql.NUMBERED, sql.TRUTH, sql.history(K), sql.metrics(K))
    + "SELECT count(*) AS n_users, round(avg(average_precision), 9) AS map FROM per_user",
)
def mean_average_precision(spark, sf_dir):
    return _metrics(spark, sf_dir, K).select("n_users", F.round("map", 9).alias("map"))


_LENGTHS = (1, 2, 5, 10, 20, 50)


@register(
    "select_best",
    f"""SELECT rank, round(precision_at_k, 9) AS precision_at_k, round(map, 9) AS map FROM ("""
    + " UNION ALL ".join(
        f"SELECT * FROM ({_with_plays(sql.NUMBERED, sql.TRUTH, sql.history(length), sql.metrics(K))}"
        f"SELECT {length} AS rank, sum(hits_at_k) / count(*) / {K} AS precision_at_k, avg(average_precision) AS map FROM per_user)"
        for length in _LENGTHS
    )
    + ") ORDER BY map DESC, precision_at_k DESC, rank LIMIT 1",
)
def select_best(spark, sf_dir):
    """The best of several list lengths by MAP, chosen as the best of a grid is."""
    rows = _metrics(spark, sf_dir, K, max(_LENGTHS), lengths=_LENGTHS).withColumns(
        {"reg_param": F.lit(0.0), "alpha": F.lit(0.0), "rank": F.col("length")}
    )
    return tuning.select_best(rows).select(
        "rank", F.round("precision_at_k", 9).alias("precision_at_k"), F.round("map", 9).alias("map")
    )


@register(
    "rmse",
    _with_plays()
    + """SELECT count(*) AS n, round(sqrt(avg((count - prediction) * (count - prediction))), 9) AS rmse
         FROM plays JOIN (SELECT track_id, avg(count) AS prediction FROM plays WHERE split = 'train' GROUP BY 1)
         USING (track_id) WHERE split <> 'train'""",
)
def rmse_of_means(spark, sf_dir):
    """Held-out counts predicted by the item's mean in training."""
    plays = testbed.plays(spark, sf_dir)
    means = split_of(plays, "train").groupBy("track_id").agg(F.avg("count").alias("prediction"))
    predicted = plays.filter(F.col("split") != "train").join(means, "track_id", "left")
    return rmse(predicted).withColumn("rmse", F.round("rmse", 9))


# --- vectors --------------------------------------------------------------------------------

_BEST = "SELECT query, item, rank, round(score, 6) AS score FROM best"


def _lists(best: DataFrame) -> DataFrame:
    return best.select("query", "item", "rank", F.round("score", 6).alias("score"))


@register("vector_dim", "SELECT CAST(len(embedding) AS INTEGER) AS dim, count(*) AS n FROM embeddings GROUP BY 1")
def vector_dim(spark, sf_dir):
    return testbed.vectors(spark, sf_dir).groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))


TOP = 50


@register("exact_topk_dot", sql.with_(sql.VECTORS, sql.topk("queries", "items", TOP)) + _BEST)
def exact_topk_dot(spark, sf_dir):
    return _lists(exact_topk(testbed.vectors(spark, sf_dir), testbed.scaled_vectors(spark, sf_dir), TOP))


_COPIED = """
copied AS (SELECT id, vec FROM items UNION ALL SELECT id + 1000000000, vec FROM items UNION ALL SELECT id + 2000000000, vec FROM items)"""


@register(
    "exact_topk_copies",
    sql.with_(sql.VECTORS, _COPIED, sql.topk("queries", "items", 9))
    + f"SELECT query, item + copy * 1000000000 AS item, CAST((rank - 1) * 3 + copy + 1 AS INTEGER) AS rank, round(score, 6) AS score FROM best, range(3) c(copy) WHERE (rank - 1) * 3 + copy < 25",
)
def exact_topk_copies(spark, sf_dir):
    """Every item three times under other ids: copies tie, and rank by id."""
    items = testbed.scaled_vectors(spark, sf_dir)
    copies = items.withColumn("id", F.explode(F.array(*[F.col("id") + n * 1_000_000_000 for n in range(3)])))
    return _lists(exact_topk(testbed.vectors(spark, sf_dir), copies, 25))


@register(
    "exact_topk_unusable",
    sql.with_(sql.VECTORS, "fine AS (SELECT * FROM items WHERE id % 7 <> 3)", sql.topk("queries", "fine", 10)) + _BEST,
)
def exact_topk_unusable(spark, sf_dir):
    """Every seventh item is null, too short or not finite, and is left out alone."""
    items = testbed.scaled_vectors(spark, sf_dir)
    bad = (
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("array<double>"))
        .when(F.col("id") % 3 == 1, F.slice("vec", 1, 3))
        .otherwise(F.transform("vec", lambda x: x * float("nan")))
    )
    items = items.withColumn("vec", F.when(F.col("id") % 7 == 3, bad).otherwise(F.col("vec")))
    return _lists(exact_topk(testbed.vectors(spark, sf_dir), items, 10, invalid="skip"))


@register("exact_topk_cosine", sql.with_(sql.VECTORS, sql.topk("queries", "queries", 10, cosine=True)) + _BEST)
def exact_topk_cosine(spark, sf_dir):
    vectors = testbed.vectors(spark, sf_dir)
    return _lists(exact_topk(vectors, vectors, 10, "cosine"))


@register(
    "lsh_buckets",
    sql.with_(sql.VECTORS, sql.plane_table(HASH["tables"], HASH["bits"], DIM, HASH["seed"]), sql.codes("codes", "queries"))
    + "SELECT id, tbl, code FROM codes",
)
def lsh_buckets(spark, sf_dir):
    vectors = testbed.vectors(spark, sf_dir)
    _, coded = hash_pair(vectors, vectors, "cosine", probes=0, **HASH)
    return buckets(coded, HASH["bits"]).select(F.col("item").alias("id"), "tbl", "code")


@register(
    "ann_topk",
    sql.with_(
        sql.VECTORS,
        sql.plane_table(HASH["tables"], HASH["bits"], DIM, HASH["seed"]),
        sql.codes("codes", "queries"),
        "pairs AS (SELECT DISTINCT a.id AS query, b.id AS item FROM codes a JOIN codes b ON a.tbl = b.tbl AND a.code = b.code)",
        sql.topk("queries", "queries", 10, cosine=True, pairs="pairs"),
    )
    + _BEST,
)
def ann_neighbours(spark, sf_dir):
    vectors = testbed.vectors(spark, sf_dir)
    return _lists(ann_topk(vectors, vectors, 10, "cosine", **HASH))


def _with_hashed(probes: int, *more: str) -> str:
    return sql.with_(
        sql.VECTORS,
        sql.PADDED,
        sql.plane_table(HASH["tables"], HASH["bits"], DIM + 1, HASH["seed"]),
        sql.codes("query_codes", "hashed_queries"),
        sql.codes("item_codes", "hashed_items"),
        sql.looks("query_codes", HASH["bits"], probes),
        *more,
    )


@register(
    "ann_topk_items",
    _with_hashed(
        3,
        "pairs AS (SELECT DISTINCT l.id AS query, c.id AS item FROM looks l JOIN item_codes c ON l.tbl = c.tbl AND l.code = c.code)",
        sql.topk("queries", "items", 10, pairs="pairs"),
    )
    + _BEST,
)
def ann_topk_items(spark, sf_dir):
    """Largest inner products, looking into the own bucket and three more."""
    queries, items = testbed.vectors(spark, sf_dir), testbed.scaled_vectors(spark, sf_dir)
    return _lists(ann_topk(queries, items, 10, "dot", probes=3, **HASH))


@register("ann_index_roundtrip", ORACLES["ann_topk"])
def ann_index_roundtrip(spark, sf_dir):
    """The search of ``ann_topk`` with an index that was saved and loaded."""
    vectors = testbed.vectors(spark, sf_dir)
    path = _path(spark, "index")
    SearchIndex.build(vectors, "cosine", **HASH).save(path)
    return _lists(SearchIndex.load(spark, path).search(vectors, 10))


@register(
    "ann_sweep",
    _with_hashed(
        max(SWEEP_PROBES),
        sql.topk("queries", "items", 10),
        f"settings AS (SELECT t.tables, p.probes FROM (VALUES {', '.join(f'({t})' for t in SWEEP_TABLES)}) t(tables), "
        f"(VALUES {', '.join(f'({p})' for p in SWEEP_PROBES)}) p(probes))",
        """met AS (SELECT b.query, b.item, l.tbl, min(l.probe) AS probe FROM best b JOIN looks l ON l.id = b.query
           JOIN item_codes c ON c.id = b.item AND c.tbl = l.tbl AND c.code = l.code GROUP BY 1, 2, 3)""",
        """found AS (SELECT tables, probes, count(DISTINCT (query, item)) AS n FROM settings
           LEFT JOIN met ON met.tbl < tables AND met.probe <= probes GROUP BY 1, 2)""",
        "bucket_sizes AS (SELECT tbl, code, count(*) AS size FROM item_codes GROUP BY 1, 2)",
        """work AS (SELECT tables, probes, sum(size) AS scored FROM settings JOIN looks l ON l.tbl < tables AND l.probe <= probes
           JOIN bucket_sizes s ON s.tbl = l.tbl AND s.code = l.code GROUP BY 1, 2)""",
    )
    + """SELECT tables, probes, round(n / (SELECT count(*) FROM best), 9) AS recall,
         round(scored / (SELECT CAST(count(*) AS DOUBLE) * count(*) FROM embeddings), 9) AS scored_share
         FROM found JOIN work USING (tables, probes)""",
)
def ann_sweep(spark, sf_dir):
    queries, items = testbed.vectors(spark, sf_dir), testbed.scaled_vectors(spark, sf_dir)
    swept = sweep(queries, items, 10, "dot", SWEEP_TABLES, SWEEP_PROBES, HASH["bits"], HASH["seed"])
    return swept.select(
        "tables", "probes", F.round("recall", 9).alias("recall"), F.round("scored_share", 9).alias("scored_share")
    )


BANDS, BAND_TABLES, BAND_PROBES = 6, (10, 20), (4, 6, 8)


def _with_bands(tables: int, probes: int, *more: str) -> str:
    return sql.with_(
        sql.VECTORS,
        sql.banded(BANDS),
        sql.plane_table(tables, HASH["bits"], DIM + 1, HASH["seed"]),
        sql.codes("query_codes", "hashed_queries"),
        sql.codes("sign_codes", "hashed_items"),
        f"item_codes AS (SELECT id, tbl, (band << {HASH['bits']}) | code AS code FROM sign_codes JOIN bands USING (id))",
        sql.looks_over_bands("query_codes", HASH["bits"], BANDS, probes),
        *more,
    )


@register(
    "ann_topk_bands",
    _with_bands(
        HASH["tables"],
        8,
        "pairs AS (SELECT DISTINCT l.id AS query, c.id AS item FROM looks l JOIN item_codes c ON l.tbl = c.tbl AND l.code = c.code)",
        sql.topk("queries", "items", 10, pairs="pairs"),
    )
    + _BEST,
)
def ann_topk_bands(spark, sf_dir):
    """Largest inner products with items in bands by norm: nine looks per table, over all bands."""
    queries, items = testbed.vectors(spark, sf_dir), testbed.scaled_vectors(spark, sf_dir)
    return _lists(ann_topk(queries, items, 10, "dot", probes=8, bands=BANDS, **HASH))


@register("ann_topk_buckets", ORACLES["ann_topk_items"])
def ann_topk_buckets(spark, sf_dir):
    """The search of ``ann_topk_items`` with vectors dealt to buckets instead of tiles."""
    queries, items = testbed.vectors(spark, sf_dir), testbed.scaled_vectors(spark, sf_dir)
    return _lists(ann_topk(queries, items, 10, "dot", probes=3, layout="buckets", **HASH))


@register(
    "ann_sweep_bands",
    _with_bands(
        max(BAND_TABLES),
        max(BAND_PROBES),
        sql.topk("queries", "items", 10),
        f"settings AS (SELECT t.tables, p.probes FROM (VALUES {', '.join(f'({t})' for t in BAND_TABLES)}) t(tables), "
        f"(VALUES {', '.join(f'({p})' for p in BAND_PROBES)}) p(probes))",
        """met AS (SELECT l.id AS query, c.id AS item, s.tables, min(l.probe) AS probe FROM looks l
           JOIN item_codes c ON c.tbl = l.tbl AND c.code = l.code JOIN (SELECT DISTINCT tables FROM settings) s ON l.tbl < s.tables GROUP BY 1, 2, 3)""",
    )
    + """SELECT s.tables, s.probes, round(count(b.query) / (SELECT count(*) FROM best), 9) AS recall,
         round(count(*) / (SELECT CAST(count(*) AS DOUBLE) * count(*) FROM embeddings), 9) AS met_share,
         count(b.query) >= 0.9 * (SELECT count(*) FROM best) AND count(*) <= 0.4 * (SELECT CAST(count(*) AS DOUBLE) * count(*) FROM embeddings) AS saves
         FROM settings s JOIN met m ON m.tables = s.tables AND m.probe <= s.probes LEFT JOIN best b ON b.query = m.query AND b.item = m.item
         GROUP BY 1, 2""",
)
def ann_sweep_bands(spark, sf_dir):
    """Recall, the share of pairs that are scored, and whether nine tenths are found in four tenths of the work."""
    queries, items = testbed.vectors(spark, sf_dir), testbed.scaled_vectors(spark, sf_dir)
    swept = sweep(queries, items, 10, "dot", BAND_TABLES, BAND_PROBES, HASH["bits"], HASH["seed"], bands=BANDS, met=True)
    return swept.select(
        "tables", "probes", F.round("recall", 9).alias("recall"), F.round("met_share", 9).alias("met_share"),
        ((F.col("recall") >= 0.9) & (F.col("met_share") <= 0.4)).alias("saves"),
    )


# --- models ---------------------------------------------------------------------------------


def solved_users(model: ALSModel, ratings: DataFrame, reg_param: float, alpha: float | None) -> DataFrame:
    """(id, dim, solved): whether each user's factors satisfy the normal equations given the item factors.

    A fit solves the users last, so theirs are exact up to single precision, and other factors are not. ``ratings``
    is (user_ix, item_ix, count) with counts above 0; ``alpha`` is None for an explicit fit. The residual is compared
    with the size of the right side.
    """
    users = model.userFactors.select(F.col("id").alias("user_ix"), as_doubles("features").alias("x"))
    items = model.itemFactors.select(F.col("id").alias("item_ix"), as_doubles("features").alias("y"))
    dims = range(model.rank)
    dot = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v)
    # implicit: confidence 1 + alpha * count on the rated items, 1 on all, preference 1 or 0
    weight = F.lit(1.0) if alpha is None else alpha * F.col("count")
    goal = F.col("count") if alpha is None else 1 + alpha * F.col("count")
    rated = ratings.join(users, "user_ix").join(items, "item_ix").withColumn("_w", weight * dot).withColumn("_b", goal)
    sums = rated.groupBy("user_ix").agg(
        F.first("x").alias("x"), F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.col("_w") * F.get("y", F.lit(d))) for d in dims]).alias("left"),
        F.array(*[F.sum(F.col("_b") * F.get("y", F.lit(d))) for d in dims]).alias("right"),
    )
    left = [F.get("left", F.lit(d)) + reg_param * F.col("n") * F.get("x", F.lit(d)) for d in dims]
    if alpha is not None:
        # rank x rank sums over all items
        every = items.agg(*[F.sum(F.get("y", F.lit(i)) * F.get("y", F.lit(j))).alias(f"g{i}_{j}") for i in dims for j in dims]).first()
        left = [left[i] + sum((every[f"g{i}_{j}"] * F.get("x", F.lit(j)) for j in dims), F.lit(0.0)) for i in dims]
    off = sum(((left[d] - F.get("right", F.lit(d))) ** 2 for d in dims), F.lit(0.0))
    size = sum((F.get("right", F.lit(d)) ** 2 for d in dims), F.lit(0.0))
    return sums.select(F.col("user_ix").alias("id"), F.size("x").alias("dim"), (off <= 1e-6 * size).alias("solved"))


def _rated(spark, sf_dir: str, **settings) -> tuple[Recommender, DataFrame, DataFrame]:
    """A recommender, the indexed rows it was fitted on and the validation rows."""
    train, val, test = _splits(spark, sf_dir)
    rows = _judged(train, val, test)
    recommender = Recommender.train(rows, als(**{**FIT, **settings}))
    indexed = apply_index(rows, recommender.users, recommender.items, fitted=True)
    return recommender, indexed.select("user_ix", "item_ix", "count"), val


@register(
    "als_implicit_factors",
    _with_maps()
    + f"""SELECT 'user' AS kind, ix AS id, {FIT['rank']} AS dim, TRUE AS solved FROM users UNION ALL
          SELECT 'item', ix, {FIT['rank']}, NULL FROM items""",
)
def als_implicit_factors(spark, sf_dir):
    """One vector of the right length per indexed id; the users' solve their equations."""
    recommender, rows, _ = _rated(spark, sf_dir)
    model = recommender.model
    users = solved_users(model, rows, FIT["reg_param"], FIT["alpha"]).select(F.lit("user").alias("kind"), "id", "dim", "solved")
    items = model.itemFactors.select(
        F.lit("item").alias("kind"), "id", F.size("features").alias("dim"), F.lit(None).cast("boolean").alias("solved")
    )
    return users.union(items)


@register(
    "als_explicit_rmse",
    _with_maps(sql.INDEXED)
    + """SELECT count(*) AS n, (SELECT count(*) FROM users) AS n_solved, TRUE AS fits_better_than_mean
         FROM indexed WHERE split = 'val'""",
)
def als_explicit_rmse(spark, sf_dir):
    """Rows with a prediction, users whose factors solve their equations, and whether the fitted rows are met better
    than by their mean."""
    recommender, rows, val = _rated(spark, sf_dir, implicit=False)
    rows = materialize(rows, "rated")
    solved = solved_users(recommender.model, rows, FIT["reg_param"], None).agg(F.count_if("solved").alias("n_solved"))
    own = rmse(recommender.model.transform(rows)).select(F.col("rmse").alias("own"))
    spread = rows.agg(F.stddev_pop("count").alias("spread"))
    found = rmse(recommender.transform(val)).select("n")
    # four tables of one row
    return found.join(solved, F.lit(True)).join(own, F.lit(True)).join(spread, F.lit(True)).select(
        "n", "n_solved", (F.col("own") < F.col("spread")).alias("fits_better_than_mean")
    )


def built_in_lists(model: ALSModel, k: int, field: str, users: DataFrame | None = None) -> DataFrame:
    """(user_ix, field): one field of the entries of the built-in method's lists as an array in rank order, for all users
    with factors, or for those of ``users`` (user_ix). Written, some users at a time.

    The built-in method sorts and shuffles the k best items of every user and block of items. Larger blocks make
    fewer of them, and of ``SLICE_USERS`` users at a time they fit the disk; a slice's shuffle files go with it, so
    what stays are the lists."""
    spark = model.userFactors.sparkSession
    ids = model.userFactors.select(F.col("id").alias("user_ix")) if users is None else users.select("user_ix").distinct()
    ids = materialize(ids, "listed")
    slices = max(1, math.ceil(ids.count() / SLICE_USERS))
    path, dealt = _path(spark, "built-in"), laid_out(model)
    # blocks of users are few rows, which Spark would send to all tasks as one: then a task per block of items is all there is
    cleaned, crossed = _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"), _setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1")
    with cleaned, crossed:
        for at in range(slices):
            part = ids if slices == 1 else ids.filter(F.pmod(F.xxhash64("user_ix"), F.lit(slices)) == at)
            # some SLICE_USERS numbers; a shuffle would put their factors into one partition
            lists = dealt.recommendForUserSubset(F.broadcast(part), k).select("user_ix", F.col(f"recommendations.{field}").alias(field))
            lists.write.mode("append").parquet(path)
    return spark.read.schema(lists.schema).parquet(path)


def laid_out(model: ALSModel) -> ALSModel:
    """A saved copy of the model, the same factors in the layout in which the built-in method compares all pairs soonest: it
    has a task per partition of users and of items, and sorts and sends k rows per user and block of items. So items lie in as
    few files as there are blocks of ``BLOCK_BYTES``, in random order, and users are dealt over all cores."""
    spark = model.userFactors.sparkSession
    path = _path(spark, "laid-out")
    block = max(model.getBlockSize(), BLOCK_BYTES // (4 * model.rank))
    model.write().save(path)
    pieces = max(1, math.ceil(model.itemFactors.count() / block))
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    for name, factors, files in (("itemFactors", model.itemFactors, pieces), ("userFactors", model.userFactors, tasks)):
        factors.repartition(files, "id").write.mode("overwrite").parquet(f"{path}/{name}")
    # set on a model, the block size stays in Python; a copy takes it to where the lists are made
    return ALSModel.load(path).copy({model.blockSize: block})


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


_KNOWN_PAIRS = "SELECT user_ix, item_ix, TRUE AS is_dot_product FROM indexed WHERE split IN ('val', 'test')"


def _predicted(recommender: Recommender, val: DataFrame, test: DataFrame) -> DataFrame:
    """Predictions for held-out pairs, compared with the product of the two factor vectors."""
    predicted = recommender.transform(_held_out(val, test))
    users = recommender.model.userFactors.select(F.col("id").alias("user_ix"), as_doubles("features").alias("u"))
    items = recommender.model.itemFactors.select(F.col("id").alias("item_ix"), as_doubles("features").alias("v"))
    product = F.aggregate(F.zip_with("u", "v", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    return (
        predicted.join(users, "user_ix")
        .join(items, "item_ix")
        .select("user_ix", "item_ix", (F.abs(product - F.col("prediction")) < 1e-4).alias("is_dot_product"))
    )


@register("als_predict", _with_maps(sql.INDEXED) + _KNOWN_PAIRS)
def als_predict(spark, sf_dir):
    return _predicted(*_fitted(spark, sf_dir))


@register("indexed_als_predict", _with_maps(sql.INDEXED) + _KNOWN_PAIRS)
def indexed_als_predict(spark, sf_dir):
    """Id maps and model saved and loaded as one unit, then applied to string ids."""
    path = _path(spark, "recommender")
    recommender, *held_out = _fitted(spark, sf_dir)
    recommender.save(path)
    return _predicted(Recommender.load(spark, path), *held_out)


@register(
    "als_cold_start_drop",
    _with_maps(
        "kept AS (SELECT user_id, track_id, count FROM judged WHERE count > 10)",
        "known AS (SELECT p.split, u.ix AS user_ix, i.ix AS item_ix, p.user_id, p.track_id FROM purchases p JOIN users u USING (user_id) JOIN items i USING (track_id))",
    )
    + """SELECT user_ix, item_ix FROM known WHERE split IN ('val', 'test')
         AND user_id IN (SELECT user_id FROM kept) AND track_id IN (SELECT track_id FROM kept)""",
)
def als_cold_start_drop(spark, sf_dir):
    """A model fitted on the larger counts only has no factors for some indexed ids: pairs with
    such an id get no prediction."""
    train, val, test = _splits(spark, sf_dir)
    rows = _judged(train, val, test)
    users, items = _maps(rows)
    model = fit(apply_index(rows.filter(F.col("count") > 10), users, items), als(**FIT))
    held_out = apply_index(_held_out(val, test), users, items)
    return model.transform(held_out).select("user_ix", "item_ix")


_LISTS = """SELECT ix AS user_ix, least(500, (SELECT count(*) FROM items)) AS n_recs,
            least(500, (SELECT count(*) FROM items)) AS n_items, CAST(0 AS BIGINT) AS n_breaks,
            CAST(0 AS BIGINT) AS n_off FROM users"""


def _list_shape(recs: DataFrame, other: DataFrame) -> DataFrame:
    """Per user: entries, distinct items, places where the score rises along the list, and places whose score is not
    that of ``other``, the lists of the built-in method (user_ix, rating: an array in rank order). Both sides are dealt by
    user once, so lists meet as one row per user and entries are not shuffled again."""
    before = F.lag("score").over(W.partitionBy("user_ix").orderBy("rank"))
    recs = recs.withColumn("breaks", (F.col("score") > before).cast("int")).join(other, "user_ix", "left")
    off = F.abs(F.col("score") - F.get("rating", F.col("rank") - 1)) > 1e-4
    return (
        recs.select("user_ix", "item_ix", "breaks", F.coalesce(off, F.lit(True)).alias("off"))
        .groupBy("user_ix")
        .agg(
            F.count(F.lit(1)).alias("n_recs"),
            F.count_distinct("item_ix").alias("n_items"),
            F.coalesce(F.sum("breaks"), F.lit(0)).cast("bigint").alias("n_breaks"),
            F.count_if("off").alias("n_off"),
        )
    )


@register("als_recommend_all", _with_maps() + _LISTS)
def als_recommend_all(spark, sf_dir):
    model = _fitted(spark, sf_dir)[0].model
    return _list_shape(recommend(model, K), built_in_lists(model, K, "rating"))


@register(
    "als_recommend_subset",
    _with_maps() + _LISTS + " WHERE user_id IN (SELECT user_id FROM purchases WHERE split = 'test')",
)
def als_recommend_subset(spark, sf_dir):
    recommender, _, test = _fitted(spark, sf_dir)
    users = ops.users_union(test).join(recommender.users, "user_id").select(F.col("ix").alias("user_ix"))
    users = materialize(users, "wanted")
    return _list_shape(recommend(recommender.model, K, users), built_in_lists(recommender.model, K, "rating", users))


@register("als_model_roundtrip", _with_maps() + "SELECT ix AS user_ix, CAST(10 AS BIGINT) AS n_same FROM users")
def als_model_roundtrip(spark, sf_dir):
    """A saved and loaded model recommends the same items at the same ranks."""
    path = _path(spark, "model")
    model = _fitted(spark, sf_dir)[0].model
    model.write().overwrite().save(path)
    loaded = ALSModel.load(path)
    same = ["user_ix", "item_ix", "rank"]
    return (
        recommend(model, 10)
        .select(*same)
        .join(recommend(loaded, 10).select(*same), same)
        .groupBy("user_ix")
        .agg(F.count(F.lit(1)).alias("n_same"))
    )


@register(
    "als_params_roundtrip",
    _with_maps()
    + f"""SELECT CAST({FIT['reg_param']} AS DOUBLE) AS reg_param, CAST({FIT['alpha']} AS DOUBLE) AS alpha,
          {FIT['rank']} AS rank, {FIT['max_iter']} AS max_iter, TRUE AS implicit,
          (SELECT count(*) FROM users) AS n_users, (SELECT count(*) FROM items) AS n_items""",
)
def als_params_roundtrip(spark, sf_dir):
    """The saved parameters, read back and used for a fit."""
    loaded = jobs.save_estimator(als(**FIT), _path(spark, "estimator"))
    model = Recommender.train(_judged(*_splits(spark, sf_dir)), loaded).model
    sizes = model.userFactors.agg(F.count(F.lit(1)).alias("n_users")).withColumn("n_items", F.lit(model.itemFactors.count()))
    return sizes.select(
        F.lit(loaded.getRegParam()).alias("reg_param"),
        F.lit(loaded.getAlpha()).alias("alpha"),
        F.lit(loaded.getRank()).alias("rank"),
        F.lit(loaded.getMaxIter()).alias("max_iter"),
        F.lit(loaded.getImplicitPrefs()).alias("implicit"),
        "n_users",
        "n_items",
    )


# --- tuning and jobs ------------------------------------------------------------------------

_GRID = {"reg_param": (0.1, 1.0), "alpha": (1.0, 10.0), "rank": (4,)}
_SHORT = {"max_iter": 3, "blocks": 4}
_JUDGED_USERS = "(SELECT count(DISTINCT user_ix) FROM indexed WHERE split = '{}')"


def plain_metrics(model: ALSModel, truth: DataFrame, k: int) -> DataFrame:
    """One row (n_users, precision_at_k, map) in another way than the library's: the lists of the built-in method as
    arrays, held against arrays of the true items. ``truth`` is (user_ix, item_ix)."""
    items = truth.groupBy("user_ix").agg(F.collect_set("item_ix").alias("true"))
    lists = built_in_lists(model, k, "item_ix", items).select("user_ix", F.col("item_ix").alias("list"))

    def step(so_far: Column, item: Column) -> Column:
        """One entry further down the list: places, hits and the sum of the shares of hits at each hit."""
        at, hit = so_far["at"] + 1, F.array_contains("true", item).cast("int")
        hits = so_far["hits"] + hit
        return F.struct(at.alias("at"), hits.alias("hits"), (so_far["shares"] + hit * hits / at).alias("shares"))

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("hits"), F.lit(0.0).alias("shares"))
    both = lists.join(items, "user_ix").select(F.size("true").alias("n_true"), F.aggregate("list", start, step).alias("sums"))
    return both.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.avg(F.col("sums.hits") / k).alias("precision_at_k"),
        F.avg(F.col("sums.shares") / F.col("n_true")).alias("map"),
    )


def agrees(row: dict, model: ALSModel, truth: DataFrame, k: int) -> bool:
    """Whether metrics are those of ``plain_metrics``, to a fiftieth: lists differ where scores are alike in single precision,
    by up to a hundredth on the tables at hand. Lists of other factors differ by a tenth."""
    plain = plain_metrics(model, truth, k).first()
    near = lambda a, b: abs(a - b) <= 0.02 * max(abs(a), abs(b))
    return plain["n_users"] == row["n_users"] and near(plain["precision_at_k"], row["precision_at_k"]) and near(plain["map"], row["map"])


def _checking(flags: list[bool]):
    """The scorer of a grid, whose rows are recomputed on the way."""

    def score(model, truth, k):
        row = tuning.score(model, truth, k)
        flags.append(agrees(row, model, truth, k))
        return row

    return score


def _flagged(results: DataFrame, flags: list[bool]) -> DataFrame:
    """Rows in the order in which they were scored, with what was found of them; a row per combination tried."""
    rows = [(*row, flag) for row, flag in zip(results.collect(), flags, strict=True)]
    return results.sparkSession.createDataFrame(rows, T.StructType([*results.schema, T.StructField("agrees", T.BooleanType())]))


def _in_range(*cols: str):
    out = F.lit(True)
    for col in cols:
        out = out & F.coalesce(F.col(col).between(0.0, 1.0), F.lit(False))
    return out.alias("in_range")


@register(
    "grid_search",
    _with_maps(sql.INDEXED)
    + f"""SELECT CAST(reg_param AS DOUBLE) AS reg_param, CAST(alpha AS DOUBLE) AS alpha, 4 AS rank,
          {_JUDGED_USERS.format('val')} AS n_users, TRUE AS in_range, TRUE AS agrees
          FROM (VALUES (0.1), (1.0)) r(reg_param), (VALUES (1.0), (10.0)) a(alpha)""",
)
def grid_search(spark, sf_dir):
    flags: list[bool] = []
    _, results = jobs.train(*_splits(spark, sf_dir), grid=_GRID, k=K, scorer=_checking(flags), **_SHORT)
    results = _flagged(results, flags)
    return results.select("reg_param", "alpha", "rank", "n_users", _in_range("precision_at_k", "map"), "agrees")


def plain_cross_validation(rows: DataFrame, grid, folds: int, **settings) -> dict[tuple, float]:
    """(reg_param, rank) -> mean over the folds of the error on a fold's rows of a fit on the others, from the products of
    the factor vectors. Pairs with an id that the other folds do not have get no part, as they get no prediction."""
    parts = rows.withColumn("fold", tuning.fold_of(folds))
    settings["blocks"] = blocks_for(rows.count(), settings["blocks"])

    def error(at: tuple) -> float:
        reg_param, rank, fold = at
        model = fit(parts.filter(F.col("fold") != fold), als(reg_param, rank=rank, implicit=False, seed=42, **settings))
        users = model.userFactors.select(F.col("id").alias("user_ix"), as_doubles("features").alias("u"))
        items = model.itemFactors.select(F.col("id").alias("item_ix"), as_doubles("features").alias("v"))
        product = F.aggregate(F.zip_with("u", "v", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
        met = parts.filter(F.col("fold") == fold).join(users, "user_ix").join(items, "item_ix")
        found = met.agg(F.sqrt(F.avg((F.col("count") - product) ** 2)).alias("e")).first()["e"]
        tuning.release(model)
        return found

    tried = [(reg_param, rank) for reg_param in grid["reg_param"] for rank in grid["rank"]]
    each = [(*setting, fold) for setting in tried for fold in range(folds)]
    errors = list(tuning.at_once(error, each, tuning.side_by_side(rows, settings["blocks"])))
    return {(float(r), k): sum(errors[n * folds : (n + 1) * folds]) / folds for n, (r, k) in enumerate(tried)}


@register(
    "cross_validate_als",
    sql.with_(sql.PURCHASES)
    + """SELECT CAST(reg_param AS DOUBLE) AS reg_param, CAST(alpha AS DOUBLE) AS alpha, rank,
         (SELECT count(*) FROM purchases WHERE split = 'train') > 0 AS has_rmse, TRUE AS agrees
         FROM (VALUES (0.1), (1.0)) r(reg_param), (VALUES (1.0), (10.0)) a(alpha), (VALUES (2), (4)) k(rank)""",
)
def cross_validate_als(spark, sf_dir):
    """Each combination's mean error over the folds, held against fits on the folds' other rows, one by one, whose
    residuals are summed without the evaluator."""
    train, _, _ = _splits(spark, sf_dir)
    grid = {**_GRID, "rank": (2, 4)}
    recommender, results = jobs.cross_validation(train, grid=grid, folds=3, **_SHORT)
    rows = apply_index(train, recommender.users, recommender.items, fitted=True).select("user_ix", "item_ix", "count")
    plain = plain_cross_validation(materialize(rows, "folds"), grid, 3, **_SHORT)
    near = [(r, k, abs(found["rmse"] - plain[r, k]) <= 1e-3 * plain[r, k]) for found in results.collect() for r, k in [(found["reg_param"], found["rank"])]]
    flags = spark.createDataFrame(list(set(near)), "reg_param double, rank int, agrees boolean")
    return results.join(flags, ["reg_param", "rank"]).select("reg_param", "alpha", "rank", (F.col("rmse") > 0).alias("has_rmse"), "agrees")


@register(
    "explicit_grid",
    sql.with_(sql.PURCHASES)
    + """SELECT CAST(reg_param AS DOUBLE) AS reg_param, CAST(alpha AS DOUBLE) AS alpha, 4 AS rank, n, TRUE AS has_rmse
         FROM (VALUES (0.1), (1.0)) r(reg_param), (VALUES (1.0), (10.0)) a(alpha),
         (SELECT count(*) AS n FROM purchases WHERE split = 'val'
          AND user_id IN (SELECT user_id FROM purchases WHERE split = 'train')
          AND track_id IN (SELECT track_id FROM purchases WHERE split = 'train'))""",
)
def explicit_grid(spark, sf_dir):
    train, val, _ = _splits(spark, sf_dir)
    _, results = jobs.explicit(train, val, _GRID, **_SHORT)
    return results.select("reg_param", "alpha", "rank", "n", (F.col("rmse") > 0).alias("has_rmse"))


_LEFT = {"identity": "TRUE", "log": "TRUE", "gt1": "count > 1", "gt2": "count > 2"}


@register(
    "compare_count_transforms",
    _with_plays(
        "judged AS (SELECT * FROM plays WHERE split = 'train' AND user_id IN (SELECT user_id FROM plays WHERE split IN ('val', 'test')))"
    )
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS transform, '{split}' AS split, count(DISTINCT user_id) AS n_users, TRUE AS in_range, TRUE AS agrees FROM plays
            WHERE split = '{split}' AND user_id IN (SELECT user_id FROM judged WHERE {where})
            AND track_id IN (SELECT track_id FROM judged)"""
        for name, where in _LEFT.items()
        for split in ("val", "test")
    ),
)
def compare_count_transforms(spark, sf_dir):
    rows = materialize(testbed.plays(spark, sf_dir), "plays")
    parts = [split_of(rows, name) for name in ("train", "val", "test")]
    flags: list[bool] = []
    results = jobs.transforms(*parts, k=K, scorer=_checking(flags), **{**FIT, "rank": 2, "max_iter": 3})
    return _flagged(results, flags).select("transform", "split", "n_users", _in_range("precision_at_k", "map"), "agrees")


@register(
    "evaluate_test",
    _with_maps(sql.INDEXED) + f"SELECT {K} AS k, {_JUDGED_USERS.format('test')} AS n_users, TRUE AS in_range, TRUE AS agrees",
)
def evaluate_test(spark, sf_dir):
    """Saved id maps and model, loaded and scored on the test rows."""
    path = _path(spark, "recommender")
    recommender, _, test = _fitted(spark, sf_dir)
    recommender.save(path)
    loaded = Recommender.load(spark, path)
    row = jobs.evaluate(loaded, test, K).first()
    found = agrees(row.asDict(), loaded.model, jobs.indexed_truth(test, loaded.users, loaded.items), K)
    results = spark.createDataFrame([(row["k"], row["n_users"], row["precision_at_k"], row["map"], found)], "k int, n_users bigint, precision_at_k double, map double, agrees boolean")
    return results.select("k", "n_users", _in_range("precision_at_k", "map"), "agrees")


@register(
    "train_and_evaluate",
    _with_maps(sql.INDEXED)
    + f"""SELECT 'val' AS split, {K} AS k, {_JUDGED_USERS.format('val')} AS n_users, TRUE AS in_range, TRUE AS agrees UNION ALL
          SELECT 'test', {K}, {_JUDGED_USERS.format('test')}, TRUE, TRUE""",
)
def train_and_evaluate(spark, sf_dir):
    grid = {"reg_param": (1.0,), "alpha": (10.0,), "rank": (8,)}
    flags: list[bool] = []
    results, final = jobs.train_and_evaluate(*_splits(spark, sf_dir), k=K, grid=grid, scorer=_checking(flags), **_SHORT)
    shape = ["split", "k", "n_users", "precision_at_k", "map"]
    rows = results.withColumn("split", F.lit("val")).select(*shape).union(final.withColumn("split", F.lit("test")).select(*shape))
    return _flagged(rows, flags).select("split", "k", "n_users", _in_range("precision_at_k", "map"), "agrees")


def entry_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole path: restrict, index, fit, recommend to the test users, score."""
    recommender, _, test = _fitted(spark, sf_dir)
    return jobs.evaluate(recommender, test, K)
