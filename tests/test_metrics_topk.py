"""Metrics equal Spark ML's evaluators; top-k tie handling."""

import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.mllib.evaluation import RankingMetrics
from pyspark.sql import Window
from pyspark.sql import functions as F

from interlens.config import Roles
from interlens.operators import metrics, topk

R = Roles(user="u", item="i", rating="rating", prediction="prediction")


def _scored(spark, seed=11, users=40):
    rnd = random.Random(seed)
    rows = []
    for u in range(users):
        n = rnd.randint(1, 14)
        for i in rnd.sample(range(60), n):
            rows.append((u, i, rnd.randint(1, 5), rnd.random() * 5))
    return spark.createDataFrame(rows, "u int, i int, rating int, prediction double")


def _lists(df, k):
    """The reference's lists: top k by prediction, items with rating rank() <= k."""
    by_user = {}
    for r in df.collect():
        by_user.setdefault(r.u, []).append((r.i, r.rating, r.prediction))
    out = []
    for u, xs in by_user.items():
        pred = [i for i, _, _ in sorted(xs, key=lambda x: (-x[2], x[0]))][:k]
        ratings = sorted((x[1] for x in xs), reverse=True)
        rank = {rt: 1 + sum(1 for y in ratings if y > rt) for rt in set(ratings)}
        actual = [i for i, rt, _ in xs if rank[rt] <= k]
        out.append((pred, actual))
    return out


@pytest.mark.parametrize("k", [1, 3, 5, 15])
def test_ranking_equals_spark_ranking_metrics(spark, k):
    df = _scored(spark)
    got = metrics.ranking_metrics(df, k, R).first()
    rm = RankingMetrics(spark.sparkContext.parallelize(_lists(df, k), 2))
    assert got.precision_at_k == pytest.approx(rm.precisionAt(k), abs=1e-12)
    assert got.map_at_k == pytest.approx(rm.meanAveragePrecisionAt(k), abs=1e-12)
    assert got.ndcg_at_k == pytest.approx(rm.ndcgAt(k), abs=1e-12)
    assert got.mean_average_precision == pytest.approx(rm.meanAveragePrecision, abs=1e-12)
    assert got.n_users == 40


@pytest.mark.parametrize("k", [None, 2, 5])
def test_regression_equals_evaluator(spark, k):
    df = _scored(spark)
    if k is not None:
        w = Window.partitionBy("u").orderBy(F.col("prediction").desc())
        ref = df.withColumn("rk", F.rank().over(w)).where(F.col("rk") <= k)
    else:
        ref = df
    got = metrics.regression_metrics(df, k, R).first()
    for name in ("rmse", "mae", "r2"):
        ev = RegressionEvaluator(metricName=name, labelCol="rating", predictionCol="prediction")
        assert getattr(got, name) == pytest.approx(ev.evaluate(ref), abs=1e-9)
    assert got.n_rows == ref.count()


@pytest.mark.parametrize("k", [1, 2, 5])
def test_map_with_tied_predictions_equals_spark(spark, k):
    """Predicted items are all with rank() <= k, ties kept, in the order (prediction, item)."""
    rnd = random.Random(k)
    rows = [(0, 1, 3, 1.0), (0, 2, 4, 1.0), (0, 3, 5, 1.0)]
    rows += [(u, i, rnd.randint(1, 5), float(rnd.randint(1, 3))) for u in range(1, 30) for i in rnd.sample(range(40), 9)]
    df = spark.createDataFrame(rows, "u int, i int, rating int, prediction double")
    lists, by = [], {}
    for u, i, r, p in rows:
        by.setdefault(u, []).append((i, r, p))
    for xs in by.values():
        rank = lambda v, col: 1 + sum(x[col] > v for x in xs)
        pred = [x[0] for x in sorted(xs, key=lambda x: (-x[2], x[0])) if rank(x[2], 2) <= k]
        actual = [x[0] for x in xs if rank(x[1], 1) <= k]
        lists.append((pred, actual))
    got = metrics.ranking_metrics(df, k, R).first()
    rm = RankingMetrics(spark.sparkContext.parallelize(lists, 2))
    assert got.mean_average_precision == pytest.approx(rm.meanAveragePrecision, abs=1e-12)
    assert got.precision_at_k == pytest.approx(rm.precisionAt(k), abs=1e-12)
    assert got.map_at_k == pytest.approx(rm.meanAveragePrecisionAt(k), abs=1e-12)
    assert got.ndcg_at_k == pytest.approx(rm.ndcgAt(k), abs=1e-12)


def test_r2_of_large_ratings(spark):
    rnd = random.Random(0)
    rows = [(u, i, 1e8 + rnd.randint(0, 1) + rnd.random(), 1e8 + rnd.random() * 2) for u in range(50) for i in range(40)]
    df = spark.createDataFrame(rows, "u int, i int, rating double, prediction double")
    for k in (None, 5):
        w = Window.partitionBy("u").orderBy(F.col("prediction").desc())
        ref = df if k is None else df.withColumn("rk", F.rank().over(w)).where(F.col("rk") <= k)
        want = RegressionEvaluator(metricName="r2", labelCol="rating", predictionCol="prediction").evaluate(ref)
        assert metrics.regression_metrics(df, k, R).first().r2 == pytest.approx(want, abs=1e-6)
    flat = spark.createDataFrame([(1, 1, 3.0, 2.0), (1, 2, 3.0, 4.0)], "u int, i int, rating double, prediction double")
    assert metrics.regression_metrics(flat, None, R).first().r2 is None


def test_ranking_result_reads_reduced_tables_only(spark, interactions):
    """The input is read by the limit and by the rating counts; what is returned reads
    their written results, so using it again costs no scan of the input."""
    from interlens.plans import baseline, catalog
    df = metrics.ranking_metrics(baseline.score_item_mean(interactions, interactions, catalog.ROLES), 5, catalog.ROLES)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("== Initial Plan")] if "== Initial Plan" in plan else plan
    assert "FileScan" not in final and final.count("Scan ExistingRDD") <= 4


def test_degenerate_when_k_covers_all_rows(spark):
    # users with n <= k items: precision n / k and ndcg 1, whatever the predictions
    rows = [(1, 1, 5, 0.1), (1, 2, 1, 0.9), (1, 3, 3, 0.5), (2, 1, 2, 0.3), (2, 4, 4, 0.2)]
    df = spark.createDataFrame(rows, "u int, i int, rating int, prediction double")
    per = {r.u: r for r in metrics.ranking_per_user(df, 10, R).collect()}
    assert per[1].precision == pytest.approx(0.3) and per[1].ndcg == pytest.approx(1.0)
    assert per[2].precision == pytest.approx(0.2) and per[2].ndcg == pytest.approx(1.0)
    assert metrics.ranking_metrics(df, 10, R).first().n_users_le_k == 2


def test_duplicate_pairs_collapse(spark):
    rows = [(1, 1, 5, 0.9), (1, 1, 5, 0.9), (1, 2, 1, 0.1)]
    df = spark.createDataFrame(rows, "u int, i int, rating int, prediction double")
    r = metrics.ranking_per_user(df, 1, R).first()
    assert r.n_items == 2 and r.precision == 1.0


def test_ties_keep_and_drop(spark):
    rows = [(1, i, 3, 1.0) for i in range(8)] + [(2, 0, 4, 2.0)]
    df = spark.createDataFrame(rows, "u int, i int, rating int, prediction double")
    keep = topk.top_k(df, 3, "rating", R, ties="keep")
    drop = topk.top_k(df, 3, "rating", R, ties="drop")
    assert keep.where("u = 1").count() == 8            # all tied at rank 1
    assert drop.where("u = 1").count() == 3            # exactly k
    assert sorted(r.i for r in drop.where("u = 1").collect()) == [0, 1, 2]


def test_top_k_keep_equals_window_rank(spark):
    df = _scored(spark, seed=5).withColumn("rating", F.col("rating") % 3)
    w = Window.partitionBy("u").orderBy(F.col("rating").desc())
    ref = sorted(tuple(r) for r in df.withColumn("rank", F.rank().over(w)).where("rank <= 4").collect())
    got = sorted(tuple(r) for r in topk.top_k(df, 4, "rating", R).select(*df.columns, "rank").collect())
    assert got == ref


def test_topk_lists_bounded(spark):
    df = _scored(spark)
    lists = topk.topk_lists(df, 3, "prediction", R).collect()
    assert all(1 <= len(r.items) <= 3 for r in lists)
    ref = {tuple(p) for p, _ in _lists(df, 3)}
    assert {tuple(r.items) for r in lists} == ref


def test_metric_dispatch(spark):
    assert metrics.metric_info("r2")[2] is True       # r2 is maximised
    assert metrics.metric_info("rmse")[2] is False
    with pytest.raises(ValueError):
        metrics.metric_info("auc")
    with pytest.raises(ValueError):
        metrics.ranking_metrics(_scored(spark), 0, R)


def test_metrics_plans_use_group_limit(spark, monkeypatch):
    """The limit per (user, partition) is applied before the shuffle (the plan that is checkpointed)."""
    from interlens.operators import topk
    plans, cut = [], topk.cut_lineage
    monkeypatch.setattr(topk, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df))
    metrics.ranking_metrics(_scored(spark), 5, R)
    plan = plans[0]
    assert "WindowGroupLimit" in plan


def test_fair_users_need_one_shuffle(spark, monkeypatch):
    """tuning_table, tuning_history, tuning_resume: lists meet in one shuffle by user,
    none where the rows are dealt by user already, and the numbers are those of the
    route for users too large for that."""
    df = spark.range(4000).selectExpr("cast(id % 90 as int) u", "cast(id % 37 as int) i", "cast(id * 7 % 5 + 1 as int) r",
                                      "cast(IF(id % 4 = 0, 0, (id * 31 % 17) / 4) as float) p")
    roles = Roles(user="u", item="i", rating="r", prediction="p")
    seen, cut = [], metrics.cut_lineage
    monkeypatch.setattr(metrics, "cut_lineage", lambda d: seen.append(d._jdf.queryExecution().executedPlan().toString()) or cut(d))
    metrics.ranking_per_user(df, 5, roles).collect()
    assert len(seen) == 1 and seen[0].count("Exchange hashpartitioning") == 1
    dealt = df.repartition("u").cache()
    dealt.count()
    metrics.ranking_per_user(dealt, 5, roles).collect()
    assert seen[1].split("InMemoryTableScan")[0].count("Exchange hashpartitioning") <= 1
    fair = sorted(map(tuple, metrics.ranking_per_user(df, 5, roles).collect()))
    large = sorted(map(tuple, metrics.ranking_per_user(df, 5, roles, limit=30).collect()))
    assert len(fair) == 90 and fair == [pytest.approx(x) for x in large]
    dealt.unpersist()
    hot = df.withColumn("u", F.when(F.col("i") < 30, 1).otherwise(F.col("u")))
    assert metrics.fair_users(df, "u") and not metrics.fair_users(df, "u", 3)
    assert not metrics.fair_users(hot.crossJoin(spark.range(20)), "u")
