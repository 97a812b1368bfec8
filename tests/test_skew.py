"""A user with a third of all rows and a large group of identical rows.

The skew-safe operators must give the same answer as a brute-force SQL over
the same rows (DuckDB).
"""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from interlens.functions.hashing import bucket, cut
from interlens.operators import filters, index, metrics, sampling, setops, topk
from interlens.plans import baseline
from interlens.sources.views import COLUMNS, ROLES

ACOLS = ", ".join(COLUMNS)


@pytest.fixture(scope="module")
def skewed(spark, interactions):
    hot = bucket(7, "hot", "l_orderkey", "l_linenumber", "l_suppkey") < F.lit(cut(1 / 3))
    moved = interactions.withColumn("user_id", F.when(hot, F.lit(0)).otherwise(F.col("user_id")))
    copy = moved.orderBy(*COLUMNS).limit(1)
    copies = copy.select("*", F.explode(F.sequence(F.lit(1), F.lit(700))).alias("_c")).drop("_c")
    df = moved.unionByName(copies).select(*COLUMNS).persist()
    pdf = df.toPandas()
    con = duckdb.connect()
    con.register("interactions", pdf)
    return df, con


def _bag(rows):
    return Counter(tuple(None if v is None else (round(v, 6) if isinstance(v, float) else v) for v in r)
                   for r in rows)


def test_fixture_is_skewed(skewed):
    df, _ = skewed
    n = df.count()
    top = df.groupBy("user_id").count().orderBy(F.desc("count")).first()
    assert top.user_id == 0 and top["count"] > n / 3


def test_frequent_rows(skewed):
    df, con = skewed
    got = filters.frequent_interactions(df, threshold=40).select(*COLUMNS).collect()
    ref = con.execute(f"SELECT {ACOLS} FROM interactions WHERE user_id IN "
                      "(SELECT user_id FROM interactions GROUP BY user_id HAVING COUNT(*) >= 40)").fetchall()
    assert _bag(got) == _bag(ref)


@pytest.mark.parametrize("order_by,limit", [("item", 1 << 20), ("item", 100), ("hash", 30)])
def test_halves(skewed, order_by, limit):
    df, con = skewed
    got = sampling.stratified_halves(df, ROLES, order=order_by, limit=limit).select(*COLUMNS, "half").collect()
    if order_by == "hash":      # exact halves of every user, all rows kept
        assert _bag(r[:-1] for r in got) == _bag(df.collect())
        per = Counter((r.user_id, r.half) for r in got)
        assert all(per[u, 1] - per[u, 0] in (0, 1) for u, _ in per)
        assert _bag(got) == _bag(sampling.stratified_halves(df, ROLES, order=order_by).select(*COLUMNS, "half").collect())
        return
    order = "item_id, l_orderkey, l_linenumber, l_suppkey, is_read, rating, is_reviewed"
    ref = con.execute(f"SELECT {ACOLS}, CAST((ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {order})) % 2 AS INT) "
                      "FROM interactions").fetchall()
    assert _bag(got) == _bag(ref)


def test_top_k_copies_survivors_only(spark):
    """What is written is about k rows per user and partition, not the input."""
    df = spark.range(0, 40_000, 1, 8).select((F.col("id") % 5).alias("user_id"), F.col("id").alias("item_id"),
                                             F.hash("id").alias("rating"))
    left = topk.survivors(df, 3, "rating", "user_id")
    assert left.count() == 5 * 8 * 3
    nulls = df.withColumn("rating", F.when(F.col("rating") % 2 == 0, F.col("rating")))
    for frame in (df, nulls):
        for up in (False, True):
            a, b = (topk.top_k(frame, 3, "rating", ROLES, ascending=up, strategy=x).collect() for x in ("spread", "window"))
            assert _bag(a) == _bag(b) and len(a) >= 15
    with pytest.raises(ValueError):
        topk.top_k(df, 3, "rating", ROLES, strategy="other")


def test_tied_hot_user_spans_many_tasks(spark):
    """A third of all rows are one user's and tie in prediction: the survivors and
    the cells of the running sums stay spread, the metrics are those of one window."""
    i = F.col("id")
    df = spark.range(0, 9000, 1, 9).select(
        F.when(i % 3 == 0, 0).otherwise(i % 50 + 1).cast("int").alias("user_id"), (i / 3).cast("int").alias("item_id"),
        (F.hash(i) % 5).alias("rating"), F.when(i % 3 == 0, 1.5).otherwise(F.hash(i) % 7).cast("double").alias("prediction"))
    pairs = df.repartition(12, "user_id", "item_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")        # so few rows would be one task's
    try:
        left = topk.survivors(pairs, 5, "prediction", "user_id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    tasks = left.where("user_id = 0").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 3000 and len(tasks) >= 3 and max(r["count"] for r in tasks) < 2400
    want = metrics.ranking_metrics(df, 5, ROLES).first().asDict()
    for limit in (1000, 37):
        got = metrics.ranking_metrics(df, 5, ROLES, limit=limit).first().asDict()
        assert got == pytest.approx(want, abs=1e-12)
    con = duckdb.connect()
    con.register("s", df.toPandas())
    ref = con.execute("""WITH p AS (SELECT user_id, item_id, MAX(rating) r, MAX(prediction) p FROM s GROUP BY ALL),
      a AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY p DESC, item_id) pos,
            RANK() OVER (PARTITION BY user_id ORDER BY p DESC) tie,
            CASE WHEN RANK() OVER (PARTITION BY user_id ORDER BY r DESC) <= 5 THEN 1 ELSE 0 END rel FROM p),
      b AS (SELECT *, SUM(rel) OVER (PARTITION BY user_id ORDER BY pos) hits, SUM(rel) OVER (PARTITION BY user_id) n FROM a)
      SELECT AVG(x) FROM (SELECT SUM(CASE WHEN tie <= 5 THEN rel * hits / pos ELSE 0 END) / MAX(n) x FROM b GROUP BY user_id)""").fetchone()[0]
    assert want["mean_average_precision"] == pytest.approx(ref, abs=1e-9)


@pytest.mark.parametrize("ties,fn,strategy", [("keep", "RANK", "spread"), ("keep", "RANK", "window"), ("drop", "ROW_NUMBER", "spread")])
def test_top_k(skewed, ties, fn, strategy):
    df, con = skewed
    got = topk.top_k(df, 4, "rating", ROLES, ties=ties, strategy=strategy).select(*COLUMNS, "rank").collect()
    tb = ", item_id, l_orderkey, l_linenumber, l_suppkey" if ties == "drop" else ""
    ref = con.execute(f"SELECT * FROM (SELECT {ACOLS}, {fn}() OVER (PARTITION BY user_id ORDER BY rating DESC{tb}) "
                      "AS rk FROM interactions) t WHERE rk <= 4").fetchall()
    assert _bag(got) == _bag(ref)


def test_ranking_metrics(skewed, spark):
    df, con = skewed
    scored = baseline.score_item_mean(df, df, ROLES)
    got = metrics.ranking_metrics(scored, 5, ROLES).first()
    ref = con.execute("""
      WITH m AS (SELECT item_id, AVG(CAST(rating AS DOUBLE)) p FROM interactions GROUP BY item_id),
      pairs AS (SELECT user_id, i.item_id, MAX(rating) r, MAX(p) p FROM interactions i JOIN m USING (item_id)
                GROUP BY user_id, i.item_id),
      ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY p DESC, item_id) pos,
                 CASE WHEN RANK() OVER (PARTITION BY user_id ORDER BY r DESC) <= 5 THEN 1 ELSE 0 END rel FROM pairs),
      sized AS (SELECT *, SUM(rel) OVER (PARTITION BY user_id) nrel,
                SUM(rel) OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) hits FROM ranked),
      pu AS (SELECT user_id, SUM(CASE WHEN pos <= 5 THEN rel ELSE 0 END) / 5.0 pr,
             SUM(CASE WHEN pos <= 5 THEN rel * hits / pos ELSE 0 END) / LEAST(MAX(nrel), 5) ap,
             SUM(CASE WHEN pos <= 5 THEN rel / LN(pos + 1.0) ELSE 0 END)
               / SUM(CASE WHEN pos <= LEAST(nrel, 5) THEN 1 / LN(pos + 1.0) ELSE 0 END) nd
             FROM sized GROUP BY user_id)
      SELECT AVG(pr), AVG(ap), AVG(nd), COUNT(*) FROM pu""").fetchone()
    assert got.precision_at_k == pytest.approx(ref[0], abs=1e-9)
    assert got.map_at_k == pytest.approx(ref[1], abs=1e-9)
    assert got.ndcg_at_k == pytest.approx(ref[2], abs=1e-9)
    assert got.n_users == ref[3]


def test_regression_metrics(skewed):
    df, con = skewed
    scored = baseline.score_item_mean(df, df, ROLES)
    got = metrics.regression_metrics(scored, 3, ROLES).first()
    ref = con.execute("""
      WITH m AS (SELECT item_id, AVG(CAST(rating AS DOUBLE)) p FROM interactions GROUP BY item_id),
      s AS (SELECT i.*, p, RANK() OVER (PARTITION BY user_id ORDER BY p DESC) rk FROM interactions i JOIN m USING (item_id))
      SELECT SQRT(AVG((p - rating) * (p - rating))), COUNT(*) FROM s WHERE rk <= 3""").fetchone()
    assert got.rmse == pytest.approx(ref[0], abs=1e-9) and got.n_rows == ref[1]


def test_except_all_and_index(skewed):
    df, con = skewed
    even = sampling.stratified_halves(df, ROLES).where("half = 0").drop("half")
    odd = sampling.stratified_halves(df, ROLES).where("half = 1").drop("half")
    assert _bag(setops.except_all(df, even).collect()) == _bag(odd.collect())
    idx, n = index.dense_index(df.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("k")), "k")
    ref = dict(con.execute("SELECT k, CAST(DENSE_RANK() OVER (ORDER BY k) - 1 AS INT) FROM "
                           "(SELECT DISTINCT 'u' || CAST(user_id AS VARCHAR) k FROM interactions)").fetchall())
    assert dict(idx.collect()) == ref and n == len(ref)


def test_hot_item_is_scored_in_many_tasks(spark, interactions):
    """One item in a third of the rows, broadcast off: the join is salted, an
    exchange follows it, and the metrics agree with DuckDB."""
    hot = bucket(7, "hot", "l_orderkey", "l_linenumber", "l_suppkey") < F.lit(cut(1 / 3))
    df = interactions.withColumn("item_id", F.when(hot, F.lit(1)).otherwise(F.col("item_id"))).persist()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = baseline.score_item_mean(df, df, ROLES)
        per = scored.groupBy("user_id", "item_id").agg(F.max("prediction").alias("p"))
        plan = per._jdf.queryExecution().executedPlan().toString()
        join = plan.index("SortMergeJoin")
        assert "Exchange hashpartitioning(user_id" in plan[:join] and "_salt" in plan[join:join + 200]
        got = metrics.ranking_metrics(scored, 5, ROLES).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    con = duckdb.connect()
    con.register("interactions", df.toPandas())
    ref = con.execute("""
      WITH m AS (SELECT item_id, AVG(CAST(rating AS DOUBLE)) p FROM interactions GROUP BY item_id),
      pairs AS (SELECT user_id, i.item_id, MAX(rating) r, MAX(p) p FROM interactions i JOIN m USING (item_id)
                GROUP BY user_id, i.item_id),
      ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY p DESC, item_id) pos,
                 CASE WHEN RANK() OVER (PARTITION BY user_id ORDER BY r DESC) <= 5 THEN 1 ELSE 0 END rel FROM pairs),
      pu AS (SELECT user_id, SUM(CASE WHEN pos <= 5 THEN rel ELSE 0 END) / 5.0 pr FROM ranked GROUP BY user_id)
      SELECT AVG(pr), COUNT(*) FROM pu""").fetchone()
    df.unpersist()
    assert got.precision_at_k == pytest.approx(ref[0], abs=1e-9) and got.n_users == ref[1]
