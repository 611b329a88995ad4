"""Seconds per headline query: ``BENCH_SF_DIR=... BENCH_CPUS=8 python bench.py`` prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from pyspark.ml.feature import StringIndexer
from pyspark.mllib.evaluation import RankingMetrics
from pyspark.sql import functions as F

from earshot.operators import interactions as ops
from earshot.operators.indexing import apply_index, fit_index, fit_indexes
from earshot.operators.lsh import ann_topk, sweep
from earshot.operators.metrics import ground_truth, ranking_metrics
from earshot.operators.models import als, fit, recommend
from earshot.operators.topk import exact_topk
from earshot.plans import jobs
from earshot.session import get_session
from earshot.sources import testbed
from earshot.sources.interactions import split_of
from earshot.sources.store import materialize


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, work):
        start = time.monotonic()
        out = work()
        seconds[name] = round(time.monotonic() - start, 3)
        return out

    spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count().collect()  # start the executors

    rows = timed("purchases", lambda: materialize(testbed.purchases(spark, sf_dir), "purchases"))
    train, val, test = (split_of(rows, name) for name in ("train", "val", "test"))
    kept = timed("semi_join", lambda: materialize(ops.keep_users(train, ops.users_union(val, test)), "kept"))
    users = timed("index_users", lambda: fit_index(kept, "user_id"))
    items = timed("index_items", lambda: fit_index(kept, "track_id"))
    indexed = timed(
        "index_train",
        lambda: materialize(apply_index(kept, users, items, fitted=True).select("user_ix", "item_ix", "count"), "indexed"),
    )
    truth = timed(
        "ground_truth",
        lambda: materialize(ground_truth(apply_index(test.select("user_id", "track_id"), users, items)), "truth"),
    )
    model = timed("als_fit_rank10_iter5", lambda: fit(indexed, als(rank=10, max_iter=5)))
    recs = timed("recommend_500_test_users", lambda: materialize(recommend(model, 500, truth), "recs"))
    timed("ranking_metrics", lambda: ranking_metrics(recs, truth, 500).collect())
    timed("recommend_500_all_users", lambda: recommend(model, 500).write.format("noop").mode("overwrite").save())

    history = testbed.history_lists(spark, sf_dir, 500)
    plays_truth = testbed.numbered(spark, sf_dir, "test")
    timed("ranking_metrics_plays", lambda: ranking_metrics(history, plays_truth, 500).collect())

    queries = testbed.vectors(spark, sf_dir)
    scaled = testbed.scaled_vectors(spark, sf_dir)
    timed("exact_topk_10", lambda: exact_topk(queries, scaled, 10).collect())
    timed("ann_topk_10", lambda: ann_topk(queries, scaled, 10, "dot", tables=10, bits=6).collect())
    timed("ann_sweep", lambda: sweep(queries, scaled, 10, "dot", (2, 4, 6, 8, 10), (0, 2, 4, 8)).collect())
    timed(
        "train_and_evaluate",
        lambda: jobs.train_and_evaluate(
            train, val, test, grid={"reg_param": (1.0,), "alpha": (10.0,), "rank": (10,)}, max_iter=5
        )[1].collect(),
    )

    def paired(name, ours, built_in):
        """Seconds of both after a warm-up of each, median of three, and how many times the built-in's we take."""
        taken = {}
        for label, work in ((f"{name}_ours", ours), (f"{name}_builtin", built_in)):
            work()
            runs = []
            for _ in range(3):
                start = time.monotonic()
                work()
                runs.append(time.monotonic() - start)
            taken[label] = round(statistics.median(runs), 3)
        seconds.update(taken)
        ratios[name] = round(taken[f"{name}_ours"] / max(taken[f"{name}_builtin"], 1e-3), 2)

    ratios: dict[str, float] = {}
    sink = lambda df: df.write.format("noop").mode("overwrite").save()
    wanted = materialize(truth.select("user_ix").distinct(), "wanted")
    lists = truth.groupBy("user_ix").agg(F.collect_list(F.col("item_ix").cast("double")).alias("truth"))

    def built_in_index():
        indexer = StringIndexer(inputCols=["user_id", "track_id"], outputCols=["u", "i"], handleInvalid="skip")
        sink(indexer.fit(kept).transform(kept))

    def own_index():
        sink(apply_index(kept, *fit_indexes(kept, ["user_id", "track_id"]), fitted=True))

    def built_in_metrics():
        found = model.recommendForUserSubset(wanted, 500).join(lists, "user_ix")
        pairs = found.select(F.col("recommendations.item_ix").cast("array<double>").alias("p"), "truth")
        metrics = RankingMetrics(pairs.rdd.map(tuple))
        return metrics.precisionAt(500), metrics.meanAveragePrecision

    def own_metrics():
        return ranking_metrics(recommend(model, 500, wanted), truth, 500).collect()

    paired("index", own_index, built_in_index)
    paired("recommend_test_users", lambda: sink(recommend(model, 500, wanted)), lambda: sink(model.recommendForUserSubset(wanted, 500)))
    paired("recommend_all_users", lambda: sink(recommend(model, 500)), lambda: sink(model.recommendForAllUsers(500)))
    paired("lists_and_metrics", own_metrics, built_in_metrics)

    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "times_builtin": ratios,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
