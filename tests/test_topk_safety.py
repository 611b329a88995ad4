"""The exact search over vectors that cannot be scored, copies of vectors and several shapes of blocks."""

import numpy as np
import pytest

from earshot.operators.lsh import ann_topk, with_codes
from earshot.operators.topk import exact_topk


def table(spark, rows):
    return spark.createDataFrame([(i, v) for i, v in rows], "id bigint, vec array<double>")


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 37))
    items = [(i, base[i % 40].tolist()) for i in range(120)]  # each vector three times
    queries = [(i, rng.standard_normal(37).tolist()) for i in range(25)]
    return queries, items


def wanted(queries, items, k):
    out = {}
    for q, u in queries:
        scored = sorted((-float((np.array(u) * np.array(v)).sum()), i) for i, v in items)
        out[q] = [i for _, i in scored[:k]]
    return out


@pytest.mark.parametrize("tile,stripe", [(None, None), (3, 7), (25, 11), (10, 120), (1, 50)])
def test_copies_rank_by_id_in_every_shape(spark, vectors, tile, stripe):
    queries, items = vectors
    found = exact_topk(table(spark, queries), table(spark, items).repartition(5), 10, tile_rows=tile, stripe_rows=stripe)
    lists = {}
    for r in found.orderBy("query", "rank").collect():
        lists.setdefault(r["query"], []).append(r["item"])
    assert lists == wanted(queries, items, 10)


@pytest.mark.parametrize("bad", [None, [1.0], [float("nan")] * 37, [float("inf")] + [0.0] * 36, [None] * 37, [0.0] * 38])
def test_a_vector_that_cannot_be_scored(spark, vectors, bad):
    queries, items = vectors
    broken = table(spark, items + [(999, bad)])
    with pytest.raises(ValueError, match="999"):
        exact_topk(table(spark, queries), broken, 5)
    with pytest.raises(ValueError, match="999"):
        ann_topk(table(spark, queries), broken, 5, "dot", 2, 3)
    with pytest.raises(ValueError, match="999"):
        exact_topk(table(spark, queries + [(999, bad)]), table(spark, items), 5)
    left = exact_topk(table(spark, queries), broken, 5, invalid="skip")
    assert {(r["query"], r["rank"]): r["item"] for r in left.collect()} == {
        (q, n + 1): i for q, own in wanted(queries, items, 5).items() for n, i in enumerate(own)
    }


def test_empty_sides(spark, vectors):
    queries, items = vectors
    none = table(spark, [])
    assert exact_topk(none, table(spark, items), 3).count() == 0
    assert exact_topk(table(spark, queries), none, 3).count() == 0


def test_too_many_probes_raise(spark, vectors):
    with pytest.raises(ValueError, match="64 probes"):
        with_codes(table(spark, vectors[1]), 2, 6, 7, 37, probes=64)


@pytest.mark.parametrize("k", [1, 10])
def test_full_lists_are_sorted_again_for_few_pairs_only(monkeypatch, k):
    import pyarrow as pa

    from earshot.operators import topk

    rng = np.random.default_rng(8)
    q, v = rng.standard_normal((40, 6)), rng.standard_normal((4000, 6)).round(1)
    v[2000:2100] = v[:100]  # copies, which tie
    v = v[np.argsort(-np.linalg.norm(v, axis=1), kind="stable")]
    rows = lambda m: pa.array(m.tolist(), pa.list_(pa.float64()))
    best = topk.BestSoFar(pa.table({"cell": pa.array([0] * 40), "id": pa.array(range(40)), "vec": rows(q)}), k, False)
    sizes, pick = [], topk.pick
    monkeypatch.setattr(topk, "pick", lambda scores, *a: sizes.append(scores.size) or pick(scores, *a))
    for at in range(0, 4000, 500):
        part = slice(at, at + 500)
        best.see(pa.record_batch({"cell": pa.array([0] * 500), "id": pa.array(range(4000)[part]), "vec": rows(v[part])}))
    assert sum(sizes) < 40 * 4000 / 10
    found = [np.concatenate(column) for column in zip(*best.rows())]
    wanted = [i for u in q for i in np.lexsort((np.arange(4000), -(u * v).sum(axis=1)))[:k]]
    assert found[1].tolist() == wanted
