"""Hard negatives against all pairs, whitening against dense eigenpairs."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.llm import negatives, whitening

SCHEMA = "id bigint, label int, vec array<double>"


def mined(rows, every, positives=5, k=3, low=50, high=95, scale=256):
    """By definition, with Python's whole numbers."""
    whole = {i: (label, [math.floor(scale * x) for x in v]) for i, label, v in rows}
    out = []
    for a in sorted(i for i in whole if i % every == 0):
        label, own = whole[a]
        scores = sorted((-sum(x * y for x, y in zip(own, v)), i, other) for i, (other, v) in whole.items() if i != a)
        for p, i, _ in [s for s in scores if s[2] == label][:positives]:
            fits = [s for s in scores if s[2] != label and low * -p <= 100 * -s[0] <= high * -p]
            out += [(a, i, rank, s[1], -p, -s[0]) for rank, s in enumerate(fits[:k], 1)]
    return sorted(out)


def vectors(seed, n, dim=6, labels=4, coarse=None):
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((n, dim))
    if coarse:  # few distinct components, so that scores tie
        rows = np.round(rows * coarse) / coarse
    return [(i, int(rng.integers(labels)), rows[i].tolist()) for i in range(n)]


@pytest.mark.parametrize("seed,coarse,tile,stripe", [(0, None, None, None), (1, 1, 7, 50), (2, 2, 3, 400), (3, 1, 500, 9)])
def test_negatives_of_all_pairs(spark, seed, coarse, tile, stripe):
    rows = vectors(seed, 300, coarse=coarse)
    found = negatives.mine(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("id") % 10 == 0, tile_rows=tile, stripe_rows=stripe)
    wanted = mined(rows, 10)
    assert sorted(map(tuple, found.collect())) == wanted and len(wanted) > 50


def test_one_vector_in_a_third_of_the_rows(spark):
    rows = [(i, l, v if i % 3 else [0.5] * 6) for i, l, v in vectors(4, 240)]
    found = negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") % 5 == 0, stripe_rows=16)
    assert sorted(map(tuple, found.collect())) == mined(rows, 5)


def test_scores_beyond_single_and_double_precision(spark):
    for size in (1e3, 1e8):
        rows = [(i, l, [x * size for x in v]) for i, l, v in vectors(5, 60, dim=3, labels=2)]
        found = negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") % 6 == 0)
        inside = lambda r: abs(r[4]) < 2**62 and abs(r[5]) < 2**62
        assert sorted(filter(inside, map(tuple, found.collect()))) == list(filter(inside, mined(rows, 6)))
    huge = spark.createDataFrame([(0, 1, [1e300]), (1, 1, [1e300]), (2, 2, [1e299])], SCHEMA)
    assert negatives.mine(huge, F.col("id") == 0).count() <= 1


def test_rows_that_take_no_part(spark):
    rows = vectors(6, 80, dim=3, labels=2)
    odd = [(100, None, [1.0, 1.0, 1.0]), (101, 1, None), (102, 1, [1.0, None, 1.0]), (103, 1, [1.0, float("nan"), 1.0]), (104, 1, [float("inf"), 1.0, 1.0]),
           (105, 1, [9.0, 9.0]), (106, 1, []), (None, 1, [9.0, 9.0, 9.0]), (0, 9, [9.0, 9.0, 9.0]), (7, rows[7][1], rows[7][2])]
    table = spark.createDataFrame(rows + odd, SCHEMA).selectExpr("*", "1 AS score", "'x' AS slot", "2 AS side", "3 AS block", "4 AS _row", "5 AS anchor_id")
    assert sorted(map(tuple, negatives.mine(table, F.col("id") % 5 == 0).collect())) == mined(rows, 5)
    assert negatives.mine(spark.createDataFrame([], SCHEMA), F.col("id") == 0).count() == 0
    assert negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") < 0).count() == 0
    zero = [(i, i % 2, [0.0, 0.0]) for i in range(8)]
    assert sorted(map(tuple, negatives.mine(spark.createDataFrame(zero, SCHEMA), F.col("id") == 0).collect())) == mined(zero, 50)


# --- whitening ------------------------------------------------------------------------------


def symmetric(kind, d, seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((d, d + 2))
    q = np.linalg.qr(a[:, :d])[0]
    return {
        "plain": a @ a.T,
        "identity": np.eye(d) * 3,
        "pairs": q @ np.diag(np.repeat(rng.uniform(1, 9, d), 2)[:d]) @ q.T,
        "one": np.outer(a[:, 0], a[:, 0]),
        "close": a @ a.T * 1e-9 + np.eye(d),
        "far": np.diag([1e8] + [1.0] * (d - 1)),
        "zero": np.zeros((d, d)),
        "mixed": q @ np.diag(rng.uniform(-5, 5, d)) @ q.T,
        "small": np.round(np.outer(a[:, 0], a[:, 0])),
    }[kind]


@pytest.mark.parametrize("kind", ["plain", "identity", "pairs", "one", "close", "far", "zero", "mixed", "small"])
def test_leading_pairs(kind):
    for d in (1, 2, 3, 5, 16, 40):
        for seed in range(3):
            matrix = symmetric(kind, d, seed)
            matrix = (matrix + matrix.T) / 2
            size, k = max(np.abs(matrix).max(), 1e-300), min(8, d)
            values, vectors = whitening.leading(matrix, 8)
            assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:k]).max() <= 1e-12 * size
            assert np.abs(vectors.T @ vectors - np.eye(k)).max() <= 1e-12
            assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-11 * size


def test_counts_of_eigenvalues_above():
    rng = np.random.default_rng(3)
    for d in (1, 2, 7, 30):
        a = rng.standard_normal((d, d))
        matrix = a + a.T
        values = np.linalg.eigvalsh(matrix)
        for shift in [*rng.uniform(-8, 8, 12), *(values[:-1] + values[1:]) / 2]:
            assert whitening.inertia(matrix, shift) == (values > shift).sum()
    assert whitening.inertia(np.array([[0.0, 2.0], [2.0, 0.0]]), 0.0) == 1 and whitening.inertia(np.zeros((3, 3)), 0.0) == 0


def by_hand(rows, scale=1024, offset=100_000):
    """(x as whole numbers, exact covariance as doubles)."""
    x = [[math.floor(scale * c) + offset for c in v] for v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    gaps = [[n * c - s for c, s in zip(r, sums)] for r in x]
    d = len(sums)
    cov = [[float(Fraction(sum(g[i] * g[j] for g in gaps), n**3)) for j in range(d)] for i in range(d)]
    return np.array(x, dtype=object), np.array(cov), [sum(g * g for g in own) for own in gaps]


@pytest.mark.parametrize("seed,n,dim,size", [(0, 200, 12, 1.0), (1, 150, 5, 1e7), (2, 60, 3, 1e11), (3, 9, 20, 1.0)])
def test_whitened_rows(spark, seed, n, dim, size):
    rng = np.random.default_rng(seed)
    # in halves, so that a sum of rows whose entries are large is a double
    rows = np.round(rng.standard_normal((n, dim)) @ np.diag(np.linspace(3, 1, dim)) * size * 2) / 2
    if size == 1.0:
        rows = rows + rng.standard_normal((n, dim))
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "id bigint, vec array<double>").repartition(3)
    found = whitening.whiten(table).collect()
    x, cov, deviations = by_hand(rows.tolist())
    k, values = min(8, dim), np.linalg.eigvalsh(cov)[::-1]
    assert len(found) == n * k and {r.n for r in found} == {n}
    assert all(int(r.deviation) == deviations[r.id] for r in found)
    white = np.zeros((n, k))
    for r in found:
        white[r.id, r.component - 1] = r.whitened
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
    wanted = np.linalg.eigh(cov)[1][:, ::-1][:, :k]
    mean = np.array([float(Fraction(sum(c), n)) for c in x.T])
    other = (x.astype(float) - mean) @ wanted / np.sqrt(values[:k])
    signs = np.sign((white * other).sum(axis=0))
    assert np.abs(white - other * signs).max() < 1e-6
    gap = np.abs(np.cov(white.T, bias=True).reshape(k, k) - np.eye(k)).max()
    assert {r.identity_error for r in found} == {found[0].identity_error} and abs(found[0].identity_error - gap) < 1e-9 and gap < 1e-6


def test_rows_that_cannot_be_whitened(spark):
    schema = "id bigint, vec array<float>"
    good = [(i, [float(i % 3), float(i % 5), 0.25]) for i in range(20)]
    odd = [(50, None), (51, [1.0, None, 2.0]), (52, [float("nan"), 1.0, 1.0]), (53, [1.0, float("-inf"), 1.0]), (54, [1.0]), (55, []), (None, [1.0, 2.0, 0.25])]
    table = spark.createDataFrame(good + odd, schema).selectExpr("*", "1 AS n", "2 AS x", "'c' AS component", "3 AS _vec")
    rows = whitening.whiten(table).collect()
    assert sorted({r.id for r in rows if r.id is not None}) == list(range(20)) and len(rows) == 21 * 3 and {r.n for r in rows} == {21}
    # the third entry never varies
    assert all((r.whitened is None) == (r.component == 3) for r in rows) and rows[0].identity_error < 1e-9
    copies = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5])] * 4, schema)).collect()
    assert len(copies) == 8 and all(r.whitened is None and r.explained == 0 and r.deviation == 0 and r.identity_error == 0 for r in copies)
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, None)], schema)).count() == 0


def test_whitening_does_not_depend_on_partitions(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    key = lambda n: sorted((r.id, r.component, r.deviation, r.whitened, r.explained) for r in whitening.whiten(table.repartition(n)).collect())
    assert key(1) == key(5)
