"""Nothing is cut, clipped or sampled unless it was asked for."""

import itertools

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from earshot.operators.indexing import apply_index, fit_index
from earshot.operators.interactions import poisson_limits, sample_with_copies
from earshot.operators.joins import hot_keys
from earshot.operators.models import als, blocks_for, fit
from earshot.plans import jobs, tuning
from earshot.plans.queries import solved_users
from earshot.sources import testbed
from earshot.sources.interactions import split_of


def test_a_report_shows_every_row(spark, capsys, tmp_path):
    rows = spark.range(245).select(F.concat(F.lit("combination-"), "id").alias("name"))
    jobs.report(spark, rows, str(tmp_path), "grid")
    shown = capsys.readouterr().out
    assert all(f"combination-{n}|" in shown.replace(" ", "") for n in range(245))
    assert spark.read.parquet(f"{tmp_path}/grid").count() == 245


def test_no_job_samples_unless_told_to():
    parse = jobs.parser().parse_args
    assert parse(["search", "--test", "t", "--model", "m", "--bits", "8"]).fraction is None
    args = parse(["cross-validate", "--train", "t", "--model", "m", "--folds", "3", "--blocks", "7", "--max-iter", "2"])
    assert (args.fraction, args.folds, args.blocks, args.max_iter) == (None, 3, 7, 2)
    assert parse(["explicit", "--train", "t", "--val", "v", "--blocks", "9"]).blocks == 9
    assert parse(["train", "--train", "t", "--val", "v", "--test", "s", "--model", "m"]).fraction is None


def test_blocks_follow_the_rows():
    assert blocks_for(0) == 10 and blocks_for(10**11) == 20_000


def test_cross_validation_cuts_large_tables_into_more_blocks(spark, monkeypatch):
    """A block's ratings are held by one task, however few blocks were asked for; both ways of validating cut alike."""
    from earshot.operators import models
    from earshot.plans import queries

    rows = spark.range(90).selectExpr("cast(id % 9 AS int) AS user_ix", "cast(id % 10 AS int) AS item_ix", "1 + id % 4 AS count")
    grid, short = {"reg_param": (0.1,), "alpha": (1.0,), "rank": (2,)}, {"max_iter": 1, "blocks": 2}
    used, fitted = [], type(als()).fit
    monkeypatch.setattr(models, "ROWS_PER_BLOCK", 15)
    monkeypatch.setattr(type(als()), "fit", lambda self, *a: used.append((self.getNumUserBlocks(), self.getNumItemBlocks())) or fitted(self, *a))
    found = tuning.cross_validate(rows, grid, 3, seed=42, **short)[0].first()["rmse"]
    assert used and set(used) == {(6, 6)}
    used.clear()
    assert found == pytest.approx(queries.plain_cross_validation(rows, grid, 3, **short)[0.1, 2], rel=1e-3)
    assert used == [(6, 6)] * 3
    used.clear()
    monkeypatch.setattr(models, "ROWS_PER_BLOCK", 1000)
    tuning.cross_validate(rows, grid, 3, seed=42, **short)
    assert set(used) == {(2, 2)}


def test_codecs_report_the_best_of_a_grid(monkeypatch, spark):
    results = spark.createDataFrame(
        [(0.1, 1.0, 2, 20, 5, 0.1, 0.1), (1.0, 1.0, 2, 20, 5, 0.3, 0.4)], tuning.GRID_SCHEMA
    )
    monkeypatch.setattr(jobs, "train", lambda *a, **b: (None, results))
    row = jobs.codecs(spark.range(3), None, names=("gzip",)).first()
    assert (row.n_rows, row.precision_at_k, row.map) == (3, 0.3, 0.4)


def test_hot_floor_is_half_a_mean_task(spark):
    rows = spark.range(10_000).select(F.when(F.col("id") < 2_000, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    floor = 10_000 / (2 * partitions)
    assert hot_keys(rows, "key", hot_rows=10) == [("hot", -(-2_000 // floor))]
    counts = spark.createDataFrame([("hot", 3 * 10**9), ("cold", 10**12 - 3 * 10**9)], "key string, n bigint")
    assert dict(hot_keys(rows, "key", counts.filter("key = 'hot'").union(spark.range(1000).selectExpr("cast(id AS string)", "997000000L")), shares=20_000))["hot"] == 60


def test_draws_follow_the_poisson_distribution(spark):
    limits = poisson_limits(0.7)
    assert limits[0] == int(2**32 * 2.718281828459045**-0.7) and limits == sorted(limits) and limits[-1] >= 2**32 - 1
    rows = spark.range(20_000).withColumn("x", F.lit("a"))
    drawn = sample_with_copies(rows, 0.7, ["id", "x"])
    sizes = {r["id"]: r["count"] for r in drawn.groupBy("id").count().collect()}
    share = [sum(n == k for n in sizes.values()) / 20_000 for k in (1, 2, 3)]
    assert share == pytest.approx([0.3476, 0.1217, 0.0284], abs=0.012) and drawn.columns == ["id", "x"]
    assert drawn.exceptAll(sample_with_copies(rows.repartition(7), 0.7, ["id", "x"])).isEmpty()


@pytest.mark.parametrize("implicit", [True, False])
def test_shuffled_factors_do_not_solve_the_equations(spark, sf_dir, implicit):
    rows = split_of(testbed.purchases(spark, sf_dir), "train").limit(400)
    users, items = fit_index(rows, "user_id"), fit_index(rows, "track_id")
    indexed = apply_index(rows, users, items).select("user_ix", "item_ix", "count").persist()
    model = fit(indexed, als(0.5, 3.0, 4, max_iter=2, blocks=2, implicit=implicit))
    alpha = 3.0 if implicit else None
    assert {r.solved for r in solved_users(model, indexed, 0.5, alpha).collect()} == {True}

    class Shuffled:
        rank, itemFactors = model.rank, model.itemFactors
        userFactors = model.userFactors.withColumn("features", F.reverse("features"))

    found = [r.solved for r in solved_users(Shuffled, indexed, 0.5, alpha).collect()]
    assert sum(found) < 0.05 * len(found)


def test_a_fit_without_a_number_is_never_chosen(spark, monkeypatch):
    class Fitted:
        avgMetrics, bestModel = [float("nan"), 2.0, 1.0], "the one without a number"

    class Validator:
        def __init__(self, **settings):
            pass

        def fit(self, rows):
            return Fitted

    chosen = []
    monkeypatch.setattr(tuning, "CrossValidator", Validator)
    monkeypatch.setattr(tuning.ALS if hasattr(tuning, "ALS") else type(als()), "fit", lambda self, rows, params: chosen.append(params) or "refitted")
    rows = spark.createDataFrame([Row(user_ix=1, item_ix=1, count=1)])
    table, best = tuning.cross_validate(rows, {"reg_param": (0.0, 0.1, 1.0), "alpha": (1.0,), "rank": (2,)})
    assert best == "refitted" and [v for p in chosen for k, v in p.items() if k.name == "regParam"] == [1.0]
    assert len(list(itertools.chain(table.collect()))) == 3


def test_fits_run_side_by_side_and_come_in_order(spark):
    import threading

    cores, meeting = spark.sparkContext.defaultParallelism, threading.Barrier(2, timeout=20)
    assert tuning.side_by_side(spark.range(1), 2) == cores // 2 and tuning.side_by_side(spark.range(1), 10**6) == 1
    # each waits for another one, so one by one they would break the barrier
    assert list(tuning.at_once(lambda n: (meeting.wait() >= 0) and n * n, [3, 1, 2, 5], 2)) == [9, 1, 4, 25]


def test_truth_has_no_partition_per_shuffle_partition(spark):
    """Every score shuffles the truth, with a block for each pair of partitions: a small truth has few."""
    part = "CASE WHEN id % 7 = 0 THEN 'val' WHEN id % 7 = 1 THEN 'test' ELSE 'train' END AS split"
    rows = spark.range(2000).selectExpr("cast(id % 50 AS string) AS user_id", "cast(id % 31 AS string) AS track_id", part, "1 + id % 4 AS count")
    parts = [split_of(rows, name) for name in ("train", "val", "test")]
    seen = []

    def scorer(model, truth, k):
        truth.count()
        seen.append((truth.rdd.getNumPartitions(), sorted(map(tuple, truth.collect()))))
        return {"k": k, "n_users": 1, "precision_at_k": 0.0, "map": 0.0}

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        jobs.transforms(*parts, k=5, scorer=scorer, rank=2, max_iter=1, blocks=2)
        jobs.train(*parts, k=5, scorer=scorer, grid={"reg_param": (1.0,), "alpha": (1.0,), "rank": (2,)}, max_iter=1, blocks=2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(seen) == 9 and all(count < 8 for count, _ in seen)
    # the same truths for all transforms, and for the grid that of validation
    val, test = seen[0][1], seen[1][1]
    assert val != test and [found for _, found in seen] == [val, test] * 4 + [val]
    assert sum(n for *_, n in val) == parts[1].count() and sum(n for *_, n in test) == parts[2].count()
