"""Filters, reports and readers: edge cases of FIXTURES §4."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from interlens.operators import filters, index, setops
from interlens.sources import io, schema, views
from interlens.session import scratch_path

from conftest import SF001


def _df(spark, rows):
    return spark.createDataFrame(rows, "user_id int, item_id int, rating int")


def test_threshold_inclusive_and_strict(spark):
    rows = [(1, i, 1) for i in range(3)] + [(2, i, 1) for i in range(2)]
    df = _df(spark, rows)
    assert {r[0] for r in filters.frequent_users(df, threshold=3).collect()} == {1}
    assert filters.frequent_users(df, threshold=3, inclusive=False).count() == 0
    assert filters.frequent_interactions(df, threshold=2).count() == 5
    assert filters.frequent_interactions(df, threshold=2, inclusive=False).count() == 3


def test_report_with_null_user_and_empty(spark):
    df = _df(spark, [(None, 1, 1), (None, 2, 1), (1, 1, 1), (2, 1, 1), (2, 2, 1)])
    r = filters.removal_report(df, threshold=2).first()
    assert (r.n_users, r.n_rows, r.null_user_rows, r.users_kept, r.rows_kept) == (2, 5, 2, 1, 2)
    assert r.pct_users_removed == 50.0 and r.pct_rows_removed == 60.0
    assert filters.frequent_users(df, threshold=1).count() == 2     # the null user is never kept
    e = filters.removal_report(_df(spark, []), threshold=2).first()
    assert (e.n_users, e.n_rows, e.users_kept) == (0, 0, 0) and e.pct_users_removed is None


def test_semi_join_plan_broadcasts_small_keys(spark, interactions):
    out = filters.frequent_interactions(interactions, threshold=20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_subtract_and_except_all(spark):
    a = _df(spark, [(1, 1, 1), (1, 1, 1), (2, 2, 2), (3, 3, 3)])
    b = _df(spark, [(1, 1, 1), (3, 3, 3)])
    assert sorted(tuple(r) for r in setops.subtract_distinct(a, b).collect()) == [(2, 2, 2)]
    assert sorted(tuple(r) for r in setops.except_all(a, b).collect()) == [(1, 1, 1), (2, 2, 2)]


def test_dense_index_and_lookup(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "k string")
    idx, n = index.dense_index(df, "k", start=1)
    assert n == 3 and dict(idx.collect()) == {"a": 1, "b": 2, "c": 3}
    q = spark.createDataFrame([("a",), ("z",)], "k string")
    got = dict(index.lookup_index(q, idx, "k").collect())
    assert got == {"a": 1, "z": None}
    with_row = index.row_index(df)
    assert with_row.schema["row_index"].dataType == T.LongType()
    assert with_row.select("row_index").distinct().count() == 5


def test_csv_strict_and_permissive(spark):
    d = tempfile.mkdtemp(prefix="interlens-csv-")
    p = os.path.join(d, "x.csv")
    with open(p, "w") as f:
        f.write("user_id,book_id,is_read,rating,is_reviewed\n1,2,1,5,0\n3,x,1,4,1\n5,6\n")
    with pytest.raises(Exception):
        io.read_csv(spark, p, schema.INTERACTIONS, strict=True).collect()
    df = io.read_csv(spark, p, schema.INTERACTIONS, strict=False)
    rows = df.collect()
    assert len(rows) == 3
    assert rows[1].book_id is None and io.count_corrupt(df) == 2
    q = os.path.join(d, "bad_header.csv")
    with open(q, "w") as f:
        f.write("user_id,item,is_read,rating,is_reviewed\n1,2,1,5,0\n")
    with pytest.raises(Exception):
        io.read_csv(spark, q, schema.INTERACTIONS, strict=True).collect()


def test_json_missing_text_and_malformed(spark):
    d = tempfile.mkdtemp(prefix="interlens-json-")
    p = os.path.join(d, "g.json")
    with open(p, "w") as f:
        f.write('{"user_id": "u1", "book_id": "b1", "is_read": true, "rating": 4, "review_text_incomplete": "ok"}\n')
        f.write('{"user_id": "u2", "book_id": "b2", "is_read": false, "rating": 0}\n')
        f.write('{"user_id": "u3", "book_id": "b3", "is_read": false, "rating": 0, "review_text_incomplete": ""}\n')
        f.write('{not json\n')
    raw = io.read_json(spark, p, schema.GENRE_JSON)
    assert io.count_corrupt(raw) == 1
    out = {r.user_id: r for r in io.genre_to_interactions(raw).collect() if r.user_id}
    assert out["u1"].is_reviewed == 1 and out["u2"].is_reviewed == 0 and out["u3"].is_reviewed == 0
    assert out["u1"].is_read == 1 and out["u2"].is_read == 0
    assert io.read_json(spark, p, schema.GENRE_JSON, head=2).count() == 2


def test_parquet_schema_cast_and_modes(spark):
    path = f"{SF001}/orders.parquet"
    s = T.StructType([T.StructField("o_orderkey", T.IntegerType()), T.StructField("o_custkey", T.IntegerType())])
    df = io.read_parquet(spark, path, s)
    assert [f.dataType for f in df.schema.fields] == [T.IntegerType(), T.IntegerType()]
    out = scratch_path(spark, "modes")
    io.write_parquet(df.limit(3), out)
    io.write_parquet(df.limit(5), out, mode="ignore")          # present: left as is
    assert spark.read.parquet(out).count() == 3
    io.write_parquet(df.limit(5), out, mode="overwrite")
    assert spark.read.parquet(out).count() == 5


def test_history_is_idempotent(spark):
    """Written twice, a record is there once; runs do not touch each other's."""
    p = scratch_path(spark, "history")
    assert io.read_history(spark, p).collect() == []
    config = {"run_id": "r1", "kind": "config", "rank": 5, "regParam": 0.1, "fold": 2, "metric": "rmse", "value": 1.2, "seconds": 3.0}
    other = {**config, "run_id": "007", "value": 9.0}
    final = {"run_id": "r1", "kind": "final", "rank": 5, "regParam": 0.1, "metric": "rmse", "value": 1.1, "note": "refit"}
    io.write_history(spark, p, [config, {**config, "fold": None}])
    io.write_history(spark, p, [other])
    io.write_history(spark, p, [{**config, "value": 1.3}, final])        # the retry, with another value
    io.write_history(spark, p, [{**final, "rank": 10}])                  # a run has one final record a metric
    rows = io.read_history(spark, p).collect()
    assert sorted((r.run_id, r.kind, r.fold, r["rank"], r.value) for r in rows if r.fold is not None) == [
        ("007", "config", 2, 5, 9.0), ("r1", "config", 2, 5, 1.3)]
    assert len(rows) == 4 and [r["rank"] for r in rows if r.kind == "final"] == [10]
    assert io.read_history(spark, p, "007").count() == 1
    with pytest.raises(ValueError):
        io.write_history(spark, p, [{"kind": "config"}])


def test_quarantine(spark, tmp_path):
    lines = ["a,b,c", "1,2,x", "bad,2,y", "3,,z", "4", "5,6,7,8", "", '6,7,"q, r"']
    (tmp_path / "in.csv").write_text("\n".join(lines))
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.StringType())])
    good, bad, counts = io.quarantine_csv(spark, str(tmp_path / "in.csv"), schema, str(tmp_path / "out"))
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 2, "x"), (3, None, "z"), (6, 7, 'q, r')]
    assert sorted(r.line for r in bad.collect()) == ["4", "5,6,7,8", "bad,2,y"]
    assert counts == {"n_good": 3, "n_bad": 3} and good.columns == ["a", "b", "c"]
    (tmp_path / "none.csv").write_text("a,b,c\n")
    good, bad, counts = io.quarantine_csv(spark, str(tmp_path / "none.csv"), schema, str(tmp_path / "out2"))
    assert good.count() == bad.count() == 0 and counts == {"n_good": 0, "n_bad": 0}


def test_event_view_and_reviews(spark):
    b = views.event_interactions(spark, SF001)
    assert b.count() == spark.read.parquet(f"{SF001}/events.parquet").count()
    g = views.genre_records(spark, SF001)
    assert g.count() == spark.read.parquet(f"{SF001}/documents.parquet").count()


def test_sample_report_approx(spark, interactions):
    from interlens.operators import sampling
    s = sampling.sample_users(interactions, percentage=0.5)
    exact = sampling.sample_report(s).first()
    approx = sampling.sample_report(s, approx_rsd=0.01).first()
    assert abs(approx.users_kept - exact.users_kept) <= max(3, 0.05 * exact.users_kept)
    assert approx.rows_kept == exact.rows_kept


def test_join_small_above_cap_same_rows(spark, interactions):
    from interlens.operators.joins import join_small, restrict_to_keys
    keys = filters.frequent_users(interactions, threshold=40)
    small = restrict_to_keys(interactions, keys, "user_id")
    big = restrict_to_keys(interactions, keys, "user_id", limit=0)
    assert sorted(tuple(r) for r in small.collect()) == sorted(tuple(r) for r in big.collect())
    means = interactions.groupBy("item_id").count()
    a = join_small(interactions, means, "item_id", limit=0).count()
    assert a == interactions.count()


def test_attach_indexes_concurrent(spark):
    df = spark.createDataFrame([("b", 3), ("a", 1), ("c", 3), ("a", 2)], "k string, v int")
    out = index.attach_indexes(df, ["k", "v"], start=1)
    got = sorted((r.k, r.v, r.k_index, r.v_index) for r in out.collect())
    assert got == [("a", 1, 1, 1), ("a", 2, 1, 2), ("b", 3, 2, 3), ("c", 3, 3, 3)]


def test_frequency_index(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("b",), ("c",), ("c",), (None,)], "k string")
    idx, n = index.dense_index(df, "k", order="frequency")
    assert n == 3 and dict(idx.collect()) == {"c": 0, "b": 1, "a": 2}
    with pytest.raises(ValueError):
        index.dense_index(df, "k", order="random")


def test_key_table_is_broadcast_by_bytes(spark):
    """300 keys of 100 kB each: few rows, but too large to broadcast."""
    wide = spark.range(300).select(F.concat(F.lpad(F.col("id").cast("string"), 4, "0"), F.repeat(F.lit("x"), 100_000)).alias("k"))
    idx, n = index.dense_index(wide, "k")
    narrow = spark.range(300).select(F.col("id").cast("string").alias("k"))
    idx2, _ = index.dense_index(narrow, "k")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert n == 300
    assert "strategy=broadcast" not in plan(index.attach_index(wide, "k", index=idx))
    assert "strategy=broadcast" in plan(index.attach_index(narrow, "k", index=idx2))
    assert index.attach_index(wide, "k", index=idx).select("k_index").distinct().count() == 300


def test_salted_join_keeps_left_rows(spark):
    from interlens.operators.joins import join_small
    big = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (9, "d")], "k int, v string")
    small = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, w int")
    for how, safe, want in (("inner", False, [(1, "a", 10), (1, "a", 10), (2, "b", 20)]),
                            ("inner", True, [(1, "a", 10), (1, "a", 10), (2, "b", 20), (None, "c", 30)]),
                            ("left", False, [(1, "a", 10), (1, "a", 10), (2, "b", 20), (9, "d", None), (None, "c", None)])):
        for limit in (0, 1 << 20):
            got = join_small(big, small, "k", how, limit, safe).collect()
            assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_stored_view_follows_its_files(spark, tmp_path):
    from interlens.session import release_scratch
    from interlens.sources import views
    for t, n in (("lineitem", 100), ("orders", 1500)):
        spark.read.parquet(f"{SF001}/{t}.parquet").limit(n).write.parquet(f"{tmp_path}/{t}.parquet")
    first = views.stored_interactions(spark, str(tmp_path)).count()
    spark.read.parquet(f"{SF001}/lineitem.parquet").limit(300).write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    assert views.stored_interactions(spark, str(tmp_path)).count() == 300 != first
    mine = [v for k, v in views._STORED.items() if str(tmp_path) in k]
    assert len(mine) == 2 and release_scratch(spark, *mine) == 2
    assert views.stored_interactions(spark, str(tmp_path)).count() == 300


def test_distinct_sketches_merge(spark):
    """Sketches stored per part and merged by union estimate the union's users."""
    d = spark.range(0, 60_000, 1, 6).select((F.col("id") % 3).cast("int").alias("g"), (F.col("id") % 7).cast("int").alias("part"),
                                            F.when(F.col("id") % 1000 > 0, F.col("id") % 20_001).alias("user_id"))
    path = scratch_path(spark, "sketches")
    filters.distinct_sketches(d, ["g", "part"], "user_id").write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 21
    exact = {r.g: r.n for r in d.groupBy("g").agg(F.countDistinct("user_id").alias("n")).collect()}
    for r in filters.merged_distinct(stored, ["g"]).collect():
        assert abs(r.n_distinct - exact[r.g]) <= 3 * filters.sketch_error() * exact[r.g]
    one = filters.merged_distinct(stored).first()
    n = d.agg(F.countDistinct("user_id")).first()[0]
    assert abs(one.n_distinct - n) <= 3 * filters.sketch_error() * n
    none = filters.distinct_sketches(d.limit(0), ["g"], "user_id")
    assert filters.merged_distinct(none, ["g"]).collect() == []
    nulls = filters.distinct_sketches(spark.createDataFrame([(1, None), (1, None)], "g int, user_id long"), ["g"], "user_id")
    assert filters.merged_distinct(nulls, ["g"]).first().n_distinct == 0


def test_counted_bags(spark):
    """Bags stay counted through a chain of operations and are expanded once."""
    a = spark.createDataFrame([(1, "x")] * 5 + [(2, None)] * 2 + [(None, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x")] * 3 + [(2, None)] * 4 + [(9, "z")], "k int, v string")
    net = setops.except_counted(setops.counted(a), setops.counted(b))
    assert sorted((str(r.k), r.v, r[setops.COPIES]) for r in net.collect()) == [("1", "x", 2), ("None", "y", 1)]
    both = setops.union_counted(net, setops.counted(b))
    assert {(r.k, r.v): r[setops.COPIES] for r in both.collect()} == {(1, "x"): 5, (None, "y"): 1, (2, None): 4, (9, "z"): 1}
    assert sorted(map(tuple, setops.expanded(net).collect()), key=str) == sorted([(1, "x"), (1, "x"), (None, "y")], key=str)
    assert sorted(map(tuple, setops.except_all(a, b).collect()), key=str) == sorted([(1, "x"), (1, "x"), (None, "y")], key=str)
    plan = setops.expanded(setops.except_counted(setops.counted(a), setops.counted(b)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") <= 3        # one expansion: small counts, chunks of large ones, their rows


def test_history_retry_makes_its_table_once(spark, monkeypatch):
    from interlens.plans import catalog
    seen, record = [], catalog.recommend.record_history
    monkeypatch.setattr(catalog.recommend, "record_history", lambda s, p, t, *a, **kw: seen.append(t) or record(s, p, t, *a, **kw))
    rows = catalog.history_retry(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 2 * len(catalog.DAMPING) * catalog.FOLDS and len(seen) == 3
    assert not any("md5" in t._jdf.queryExecution().optimizedPlan().toString() for t in seen)


def test_folds_are_labelled_once(spark):
    from interlens.plans import catalog
    plan = catalog._cv(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan
