"""Heavy hitters: the sketch that finds them, exact counts, salts for them alone."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from interlens.operators import joins


@pytest.fixture(scope="module")
def hot(spark):
    """30,000 rows: key 7 holds a third, key 8 a tenth as one repeated row, 17,000 keys one row each."""
    i = F.col("id")
    k = F.when(i % 3 == 0, 7).when(i % 10 == 1, 8).otherwise(i + 100)
    return spark.range(0, 30_000, 1, 12).select(k.alias("k"), F.when(k == 8, 0).otherwise(i).alias("v")).persist()


def test_sketch_finds_every_heavy_key(hot):
    counts = Counter(r.k for r in hot.select("k").collect())
    for parts in (5, 20, 100, 3000):
        want = {k: n for k, n in counts.items() if n * parts >= 30_000}
        got = {r.k: r.n_rows for r in joins.hot_keys(hot, "k", parts).collect()}
        assert got == want
        assert len(joins.frequent_hashes(hot, ["k"], parts)[0]) <= 4 * parts


def test_hot_keys_of_nulls_pairs_and_nothing(spark, hot):
    d = spark.createDataFrame([(None, "a")] * 6 + [(1, "a"), (1, None)] + [(2, "b")] * 2, "k int, s string")
    rows = {(r.k, r.s): (r.n_rows, r.n_total) for r in joins.hot_keys(d, ["k", "s"], 4).collect()}
    assert rows == {(None, "a"): (6, 10)}
    assert joins.hot_keys(d.limit(0), "k", 10).collect() == []
    assert joins.salts(d.limit(0), ["k"]) is None
    assert joins.salts(hot.where("k > 100"), ["k"], 50) is None
    assert len(dict(joins.salts(hot, ["k"], 10**6).collect())) >= 2         # more than the sketch can tell apart: its most
    with pytest.raises(ValueError):
        joins.hot_keys(hot, "k", 10**6)


def test_key_side_grows_by_the_hot_keys_only(spark, hot):
    keys = hot.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    parts = 30
    table = joins.salts(hot, ["k"], parts)
    salts = dict(table.collect())
    assert len(salts) == 2 and sum(salts.values()) <= 2 * parts + len(salts)
    grown = joins.copied(keys, ["k"], table).groupBy("k").count().where("count > 1").collect()
    assert {r.k for r in grown} == {7, 8}
    # rows of both hot keys, copies included, are dealt over their salts
    pieces = joins.dealt(hot, ["k"], table).groupBy("k", "_salt").count().where("k in (7, 8)").collect()
    assert max(r["count"] for r in pieces if r.k == 7) < 30_000 / parts
    assert len([r for r in pieces if r.k == 8]) > 3
    assert joins.dealt(hot, ["k"], table).where("k > 100 and _salt > 0").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("safe", [False, True])
def test_salted_join_equals_plain(spark, hot, how, safe):
    big = hot.withColumn("k", F.when(F.col("k") % 7 == 0, None).otherwise(F.col("k")))
    small = spark.createDataFrame([(None, 1), (8, 2), (8, 3), (104, 4), (5, 5)], "k long, w int")
    got = joins.join_small(big, small, "k", how, limit=0, null_safe=safe)
    want = joins.join_small(big, small, "k", how, limit=1 << 30, null_safe=safe)
    assert "_salt" in got._jdf.queryExecution().optimizedPlan().toString()
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_keys_of_two_types_and_plain_joins_carry_no_salt(spark, hot):
    small = spark.createDataFrame([(7, 1), (8, 2)], "k int, w int")
    for big in (hot, hot.where("k > 100").withColumn("k", F.col("k").cast("int"))):
        got = joins.join_small(big, small, "k", limit=0)
        assert "_salt" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert joins.join_small(hot, small, "k", limit=0).count() == hot.where("k in (7, 8)").count()


def test_heavy_hitters_of_several_indexes_need_no_join(spark, monkeypatch):
    from interlens.operators import index, joins
    seen, salts = [], joins.salts
    monkeypatch.setattr(joins, "salts", lambda df, *a: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or salts(df, *a))
    df = spark.range(3000).selectExpr("concat('u', if(id % 3 = 0, 1, id)) k", "concat('b', id % 50) v")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = index.attach_indexes(df, ["k", "v"]).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(seen) == 2 and not any("Join" in p for p in seen)
    ks, vs = ({x: n for n, x in enumerate(sorted({r[c] for r in rows}))} for c in ("k", "v"))
    assert len(rows) == 3000 and all((r.k_index, r.v_index) == (ks[r.k], vs[r.v]) for r in rows)
