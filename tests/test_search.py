import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from earshot.operators.lsh import (
    ann_topk,
    buckets,
    cheapest_flips,
    grades,
    hash_pair,
    over_bands,
    planes,
    SearchIndex,
    save_buckets,
    search_buckets,
    sweep,
)
from earshot.operators.topk import block_sizes, exact_topk, pick
from earshot.sources import testbed


def table(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(rows)], "id int, vec array<float>")


def brute(queries, items, k, cosine=False, allowed=None):
    """Ordered item numbers per query, ties by number."""
    q, v = np.asarray(queries, dtype=np.float32).astype(float), np.asarray(items, dtype=np.float32).astype(float)
    if cosine:
        q, v = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300) for m in (q, v))
    out = {}
    for i, row in enumerate(q @ v.T):
        able = range(len(v)) if allowed is None else allowed(i)
        order = sorted(able, key=lambda j: (-round(row[j], 9), j))[:k]
        if order:
            out[i] = order
    return out


def lists(found):
    out = {}
    for row in found.orderBy("query", "rank").collect():
        out.setdefault(row.query, []).append(row.item)
        assert row.rank == len(out[row.query])
    return out


def integers(seed, rows, dim):
    """Small whole numbers: products are exact, ties and copies are frequent."""
    return np.random.default_rng(seed).integers(-2, 3, (rows, dim))


@pytest.mark.parametrize("sizes", [{}, {"tile_rows": 7, "stripe_rows": 11}, {"tile_rows": 1000, "stripe_rows": 3}])
@pytest.mark.parametrize("k", [1, 5, 90])
def test_exact_dot_with_ties_and_copies(spark, sizes, k):
    q, v = integers(1, 23, 3), integers(2, 60, 3)
    v[10:30] = v[10]  # a third of the items are copies of one
    assert lists(exact_topk(table(spark, q), table(spark, v), k, **sizes)) == brute(q, v, k)


def test_exact_cosine_and_zero_vectors(spark):
    rng = np.random.default_rng(3)
    q, v = rng.normal(size=(12, 6)), rng.normal(size=(40, 6))
    v[7] = 0
    assert lists(exact_topk(table(spark, q), table(spark, v), 8, "cosine", stripe_rows=9)) == brute(q, v, 8, True)


def test_unknown_metric(spark):
    with pytest.raises(ValueError):
        exact_topk(table(spark, [[1.0]]), table(spark, [[1.0]]), 1, "euclid")


def test_exact_search_emits_no_pairs_and_holds_no_join(spark):
    one = table(spark, integers(4, 30, 4))
    plan = exact_topk(one, one, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    assert plan.count("Sort [_pack") == 1  # the one that puts queries before items


def test_short_items_are_left_out_unless_they_matter():
    import pyarrow as pa

    from earshot.operators.topk import BestSoFar

    rng = np.random.default_rng(12)
    q = rng.normal(size=(20, 6))
    v = rng.normal(size=(4000, 6)) * (1 / np.arange(1, 4001))[:, None]
    vecs = lambda rows: pa.array(rows.tolist(), pa.list_(pa.float64()))
    whole = lambda rows: {"cell": np.zeros(len(rows), np.int64), "id": np.arange(len(rows)), "vec": vecs(rows)}
    best = BestSoFar(pa.table(whole(q)), 5, False)
    for batch in pa.table(whole(v)).to_batches(max_chunksize=100):
        best.see(batch)
    assert best.compared < q.shape[0] * v.shape[0] / 10
    found = [items[np.argsort(-scores)].tolist() for items, scores in zip(best.items, best.scores)]
    assert found == np.argsort(-(q @ v.T), axis=1)[:, :5].tolist()


def test_pick_prefers_small_ids(spark):
    scores = np.array([[1.0, 3.0, 3.0, 3.0, 0.0]])
    ids = np.array([[9, 8, 2, 5, 1]])
    assert sorted(ids[0][pick(scores, ids, 2)[0]]) == [2, 5]


def test_block_sizes_follow_memory_and_balance():
    tile, stripe = block_sizes(10**8, 10**7, 100, 500, 8000)
    assert tile * (8 * 100 + 16 * 500) <= 128 << 20
    tile, stripe = block_sizes(10**5, 10**7, 100, 500, 8000)
    blocks = (10**5 / tile) * (10**7 / stripe)
    assert 0.5 * 24000 < blocks < 2 * 24000
    assert block_sizes(0, 0, 8, 10, 4) == (1, 1)


def test_flips_are_the_cheapest_subsets():
    margins = np.abs(np.random.default_rng(6).normal(size=(20, 5)))
    got = cheapest_flips(margins, 12)
    for row, masks in zip(margins, got):
        cost = lambda mask: sum(row[b] for b in range(5) if mask >> b & 1)
        best = sorted(range(32), key=cost)[:13]
        assert masks.tolist() == best
    assert cheapest_flips(margins, 31).shape == (20, 32)


def test_tables_are_shared_between_sizes():
    assert (planes(3, 4, 8, 1) == planes(7, 4, 8, 1)[:3]).all()
    with pytest.raises(ValueError):
        planes(1, 0, 8, 1)


def candidates(spark, queries, items, metric, **settings):
    """Pairs that share a bucket, joined pair by pair."""
    left, right = hash_pair(queries, items, metric, seed=7, **settings)
    l, r = buckets(left, settings["bits"], settings["probes"]), buckets(right, settings["bits"])
    pairs = l.select("tbl", "code", "query").join(r.select("tbl", "code", "item"), ["tbl", "code"])
    out = {}
    for row in pairs.select("query", "item").distinct().collect():
        out.setdefault(row.query, set()).add(row.item)
    return out


@pytest.mark.parametrize("metric", ["cosine", "dot"])
@pytest.mark.parametrize("probes", [0, 2])
@pytest.mark.parametrize("layout", ["tiles", "buckets"])
@pytest.mark.parametrize("sizes", [{}, {"tile_rows": 5, "stripe_rows": 6}])
def test_search_is_exact_among_the_candidates(spark, monkeypatch, metric, probes, sizes, layout):
    if sizes:  # the pairs of these small buckets as blocks
        monkeypatch.setattr("earshot.operators.lsh.BLOCK_PAIRS", 1)
    rng = np.random.default_rng(8)
    q, v = rng.normal(size=(30, 5)), rng.normal(size=(80, 5)) * rng.uniform(0.2, 4, (80, 1))
    v[20:50] = v[20]  # a crowded bucket of copies
    queries, items = table(spark, q), table(spark, v)
    settings = {"tables": 3, "bits": 4, "probes": probes}
    met = candidates(spark, queries, items, metric, **settings)
    found = lists(ann_topk(queries, items, 6, metric, seed=7, layout=layout, **settings, **sizes))
    assert found == brute(q, v, 6, metric == "cosine", lambda i: sorted(met.get(i, ())))


@pytest.mark.parametrize("block_pairs", [1, 10**9])
def test_a_tile_keeps_the_best_of_what_meets(monkeypatch, block_pairs):
    import pyarrow as pa

    from earshot.operators import lsh

    monkeypatch.setattr(lsh, "BLOCK_PAIRS", block_pairs)
    rng = np.random.default_rng(12)
    q, v = rng.integers(-2, 3, (40, 4)), rng.integers(-2, 3, (300, 4))
    looks = np.stack([rng.permuted(np.tile(np.arange(6), (40, 1)), axis=1)[:, :2] for _ in range(3)], axis=1)  # 3 tables, 2 looks
    codes = rng.integers(0, 6, (300, 3))

    def batch(rows, own):
        lists_ = lambda m, kind: pa.array([list(r) for r in m.reshape(len(m), -1).tolist()], pa.list_(kind))
        return pa.table({"cell": np.zeros(len(rows), np.int64), "id": np.arange(len(rows)), "vec": lists_(rows.astype(float), pa.float64()), "codes": lists_(own, pa.int64())})

    best = lsh.BestInBuckets(batch(q, looks), 7, False, 3)
    for part in batch(v, codes).to_batches(max_chunksize=77):
        if best.ids.size:
            offset = part["id"].to_numpy()
            best.see(part)
    met = lambda i: [j for j in range(300) if any(codes[j, t] in looks[i, t] for t in range(3))]
    want = brute(q, v, 7, allowed=met)
    for i in range(40):
        order = np.lexsort((best.items[i], -best.scores[i]))
        assert best.items[i][order][best.scores[i][order] > -np.inf].tolist() == want.get(i, []), offset


def test_looks_over_bands_follow_the_expected_product():
    margins = np.abs(np.random.default_rng(6).normal(size=(20, 4)))
    flips = cheapest_flips(margins, 15)
    got = over_bands(flips, 4, 3, 20)
    grade = grades(4, 3)
    for row, own, looked in zip(margins, flips, got):
        cost = {int(m): p for p, m in enumerate(own)}
        every = sorted(((grade[b, int(m).bit_count()], cost[int(m)], b << 4 | int(m)) for b in range(3) for m in own))
        assert looked.tolist() == [code for _, _, code in every[:21]] and len(set(looked.tolist())) == 21
        assert [int(m) for m in looked if m < 16 and int(m).bit_count() == 0][:1] == [looked[0]]


def test_bands_find_more_with_fewer_items_met(spark, sf_dir):
    queries, items = testbed.vectors(spark, sf_dir), testbed.scaled_vectors(spark, sf_dir)
    settings = {"tables": (10, 20), "probes": (4, 6, 8), "bits": 6, "met": True}
    good = lambda rows: [(r.tables, r.probes) for r in rows if r.recall >= 0.9 and r.met_share <= 0.4]
    banded = sweep(queries, items, 10, "dot", bands=6, **settings).collect()
    assert good(banded) and not good(sweep(queries, items, 10, "dot", **settings).collect())
    found = {layout: lists(ann_topk(queries, items, 10, "dot", 10, 6, 8, bands=6, layout=layout)) for layout in ("tiles", "buckets")}
    assert found["tiles"] == found["buckets"]
    exact = lists(exact_topk(queries, items, 10))
    hits = sum(len(set(exact[i]) & set(found["tiles"].get(i, ()))) for i in exact)
    assert next(r.recall for r in banded if (r.tables, r.probes) == (10, 8)) == pytest.approx(hits / sum(map(len, exact.values())))
    with pytest.raises(ValueError, match="inner products"):
        ann_topk(queries, items, 10, "cosine", bands=2)


def test_shares_met_count_each_pair_once(spark):
    rng = np.random.default_rng(15)
    queries, items = table(spark, rng.normal(size=(30, 5))), table(spark, rng.normal(size=(50, 5)))
    rows = sweep(queries, items, 3, "cosine", (1, 3), (0, 2), bits=3, met=True).collect()
    for r in rows:
        met = candidates(spark, queries, items, "cosine", tables=r.tables, bits=3, probes=r.probes)
        assert r.met_share == pytest.approx(sum(map(len, met.values())) / 1500)


def test_the_sweep_makes_no_rows_of_a_neighbours_looks(spark):
    one = table(spark, np.random.default_rng(3).normal(size=(40, 4)))
    plan = sweep(one, one, 2, "cosine", (2,), (0, 3), 4)._jdf.queryExecution().optimizedPlan().toString()
    recall = plan[: plan.index("visits")] if "visits" in plan else plan
    assert "array_position" in recall and recall.count("posexplode") <= 2  # those of the bucket sizes and visits


@pytest.mark.parametrize("sizes", [{}, {"tile_rows": 7, "stripe_rows": 50}, {"tile_rows": 2, "stripe_rows": 1000}, {"tile_rows": 1000, "stripe_rows": 9}])
def test_items_that_cannot_reach_a_list_are_not_sent(spark, monkeypatch, sizes):
    import earshot.operators.topk as topk

    rng = np.random.default_rng(21)
    q = rng.normal(size=(60, 5)) * rng.uniform(0.1, 3, (60, 1))
    v = rng.integers(-3, 4, (900, 5)) * (1 / (1 + np.arange(900) % 30))[:, None]
    q[3], v[5] = 0, 0
    sent = []
    plain = topk.best_in_cells
    monkeypatch.setattr(topk, "best_in_cells", lambda left, right, *a, **b: (sent.append(right), plain(left, right, *a, **b))[1])
    queries, items = table(spark, q), table(spark, v)
    assert lists(exact_topk(queries, items, 4, reach=True, **sizes)) == brute(q, v, 4) == lists(exact_topk(queries, items, 4, reach=False, **sizes))
    head, rest = sent[:2]
    if not sizes:
        return
    tiles = -(-60 // sizes["tile_rows"])
    copies = rest.select(F.sum(F.size("_able"))).first()[0] + head.count() * tiles
    # the query of length 0 wants all items, in its tile
    assert copies < 900 * tiles * (0.5 if tiles > 1 else 1.01)


def test_one_length_needs_no_reach(spark):
    v = np.random.default_rng(2).normal(size=(500, 4))
    one = table(spark, v / np.linalg.norm(v, axis=1, keepdims=True))
    assert lists(exact_topk(one, one, 3, reach=True)) == lists(exact_topk(one, one, 3, reach=False))


def test_search_with_more_cells_than_are_broadcast(spark, monkeypatch):
    import earshot.operators.topk as topk

    one = table(spark, np.random.default_rng(9).normal(size=(40, 5)))
    want = lists(ann_topk(one, one, 5, tables=2, bits=3, layout="tiles"))
    assert lists(ann_topk(one, one, 5, tables=2, bits=3, layout="buckets")) == want
    monkeypatch.setattr(topk, "BROADCAST_CELLS", 1)
    assert lists(ann_topk(one, one, 5, tables=2, bits=3, layout="buckets")) == want


def test_equal_vectors_share_all_buckets_and_find_themselves(spark):
    vectors = np.random.default_rng(10).normal(size=(25, 8))
    one = table(spark, np.vstack([vectors, vectors]))
    _, right = hash_pair(one, one, "cosine", 6, 8, 0, 7)
    codes = {row.item: row.codes for row in right.collect()}
    assert all(codes[i] == codes[i + 25] for i in range(25))
    found = lists(ann_topk(one, one, 2, tables=6, bits=8))
    assert all(found[i] == [i % 25, i % 25 + 25] for i in range(50))


def test_saved_buckets_give_the_same_lists(spark, tmp_path):
    one = table(spark, np.random.default_rng(11).normal(size=(60, 8)))
    left, right = hash_pair(one, one, "cosine", 4, 4, 0, 7)
    save_buckets(buckets(right, 4).drop("probe"), str(tmp_path / "index"))
    saved = spark.read.parquet(str(tmp_path / "index"))
    assert {path.name for path in (tmp_path / "index").glob("tbl=*")} == {f"tbl={t}" for t in range(4)}
    found = search_buckets(buckets(left, 4), saved, 5, "cosine", 4, 4, 240, 240)
    assert lists(found) == lists(ann_topk(one, one, 5, tables=4, bits=4))


@pytest.mark.parametrize("metric", ["cosine", "dot"])
def test_sweep_states_the_recall_of_the_search(spark, sf_dir, metric):
    vectors, scaled = testbed.vectors(spark, sf_dir), testbed.scaled_vectors(spark, sf_dir)
    tables, probes = (2, 6, 10), (0, 4, 63)
    rows = {(r.tables, r.probes): r for r in sweep(vectors, scaled, 10, metric, tables, probes).collect()}
    assert set(rows) == set(itertools.product(tables, probes))
    exact = exact_topk(vectors, scaled, 10, metric).select("query", "item")
    for t, p in ((2, 0), (10, 4)):
        found = ann_topk(vectors, scaled, 10, metric, t, 6, p).select("query", "item")
        assert rows[t, p].recall == pytest.approx(exact.intersect(found).count() / exact.count())
    for t in tables:
        assert rows[t, 0].recall <= rows[t, 4].recall <= rows[t, 63].recall == 1.0
        assert rows[t, 63].scored_share == pytest.approx(t)
    for p in probes:
        assert rows[2, p].recall <= rows[6, p].recall <= rows[10, p].recall
    assert rows[10, 4].recall > 0.7


def test_empty_sides(spark):
    none = table(spark, [[1.0, 2.0]]).filter(F.lit(False))
    one = table(spark, [[1.0, 2.0]])
    assert exact_topk(none, one, 3).count() == 0
    assert ann_topk(none, one, 3).count() == 0


def test_an_index_is_saved_loaded_and_searched_in_part(spark, tmp_path):
    rng = np.random.default_rng(8)
    items = spark.createDataFrame([(i, rng.standard_normal(12).tolist()) for i in range(150)], "id bigint, vec array<double>")
    queries = spark.createDataFrame([(i, rng.standard_normal(12).tolist()) for i in range(20)], "id bigint, vec array<double>")
    SearchIndex.build(items, "dot", tables=6, bits=3).save(str(tmp_path / "index"))
    index = SearchIndex.load(spark, str(tmp_path / "index"))
    for tables, probes in ((6, 0), (2, 3), (1, 7)):
        found = index.search(queries, 5, probes, tables)
        fresh = ann_topk(queries, items, 5, "dot", tables, 3, probes)
        key = lambda rows: sorted(tuple(r) for r in rows.collect())
        assert key(found) == key(fresh)
    assert key(index.search(queries, 5, 7, 1)) == key(exact_topk(queries, items, 5))
    with pytest.raises(ValueError, match="6 tables"):
        index.search(queries, 5, tables=7)


def test_all_settings_of_the_survey_run_by_default(spark):
    vectors = table(spark, np.random.default_rng(3).normal(size=(40, 4)))
    rows = sweep(vectors, vectors, 2).collect()
    assert {(r.tables, r.probes) for r in rows} == set(itertools.product((10, 20, 30, 40, 50), (0, 10, 50, 100)))


def test_a_tile_holds_its_vectors_once():
    from earshot.operators import topk

    tile, _ = block_sizes(10**9, 10**9, 64, 10, 8)
    assert tile * (3 * 8 * 64 + 16 * 10) <= topk.TILE_BYTES
    made, seen = [], []

    class Best(topk.BestSoFar):
        def __init__(self, table):
            super().__init__(table, 1, False)
            made.append(self)

        def see(self, items):
            seen.append(pa.total_allocated_bytes() - before)
            super().see(items)

    def batch(side, n):
        vec = pa.array(np.ones((n, 64)).tolist(), pa.list_(pa.float64()))
        return pa.record_batch({"_side": pa.array([side] * n), "cell": pa.array([0] * n), "id": pa.array(range(n)), "vec": vec})

    before = pa.total_allocated_bytes()
    rows = [r for b in topk._search(Best)(batch(0 if at < 8 else 1, 1000) for at in range(10)) for r in b.to_pylist()]
    assert len(rows) == 8000 and "vec" not in made[0].table.column_names
    # the 4 MB of vectors are the matrix, and not in the batches that they came in as well
    assert len(seen) == 2 and max(seen) < 1.5 * 8 * 64 * 8000


def test_cells_that_share_a_block_fill_no_more_than_a_tile(spark):
    from earshot.operators import topk

    cells = spark.range(640).select(F.col("id").alias("cell"))
    queries = cells.withColumn("query", F.explode(F.sequence(F.lit(1), F.lit(60)))).withColumn("vec", F.array(F.rand(1), F.rand(2)))
    items = cells.select(F.col("cell"), F.col("cell").alias("item")).withColumn("vec", F.array(F.rand(3), F.rand(4)))
    make = topk.BestSoFar

    def held(table):
        if table.num_rows > 500:
            raise ValueError(f"a block of {table.num_rows} queries")
        return make(table, 1, False)

    found = topk.best_in_cells(queries, items, 1, "dot", 640, 640 * 60, 640, 500, 1000, make=held)
    assert found.count() == 640 * 60


def test_meetings_are_counted_in_bytes():
    import tracemalloc

    from earshot.operators import lsh

    rng = np.random.default_rng(3)
    for width, codes in ((5, 64), (300, 400)):
        looks = np.stack([[rng.permutation(codes)[:width] for _ in range(3)] for _ in range(700)])
        own = rng.integers(0, codes, (8000, 3))
        table = pa.table({"codes": pa.array(looks.reshape(700, -1).tolist(), pa.list_(pa.int64()))})
        count = lsh._meet(table, [1, 3], [0, width - 1], codes)
        tracemalloc.start()
        found = count(own)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        met = [looks[:, t, None, :] == own[None, :64, t, None] for t in range(3)]
        few = [[(met[0][..., :p].any(2)).sum(), np.any([m[..., :p].any(2) for m in met], 0).sum()] for p in (1, width)]
        assert count(own[:64]).tolist() == np.array(few).T.tolist() and found.shape == (2, 2)
        assert peak < lsh.MEET_CELLS * (4 if width < 255 else 8)
