"""Properties of samples, splits, folds and halves."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from interlens.functions.hashing import cumulative_cuts, cut
from interlens.operators import sampling, split
from interlens.sources.views import COLUMNS, ROLES


def _bag(df, cols=COLUMNS):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def test_cuts():
    assert cut(0.6) == 2576980378
    assert cumulative_cuts((0.6, 0.2, 0.2))[:2] == [2576980378, 3435973837]
    with pytest.raises(ValueError):
        cut(1.5)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_sample_and_split_ignore_partitioning(spark, interactions, parts):
    base = sampling.sample_users(interactions, percentage=0.25)
    again = sampling.sample_users(interactions.repartition(parts), percentage=0.25)
    assert _bag(base) == _bag(again)
    lab1 = split.label_roles(interactions, ROLES).select(*COLUMNS, "role")
    lab2 = split.label_roles(interactions.repartition(parts), ROLES).select(*COLUMNS, "role")
    assert _bag(lab1, COLUMNS + ("role",)) == _bag(lab2, COLUMNS + ("role",))
    h1 = sampling.stratified_halves(interactions, ROLES)
    h2 = sampling.stratified_halves(interactions.repartition(parts), ROLES)
    assert _bag(h1, COLUMNS + ("half",)) == _bag(h2, COLUMNS + ("half",))


def test_sample_p_zero_one_and_monotone(spark, interactions):
    users = lambda p: {r[0] for r in sampling.sample_users(interactions, percentage=p).select("user_id").collect()}
    assert users(0.0) == set()
    assert users(1.0) == {r[0] for r in interactions.select("user_id").distinct().collect()}
    assert users(0.1) <= users(0.3) <= users(0.6)


def test_roles_disjoint_cover_no_pair_leak(spark, interactions):
    lab = split.label_roles(interactions, ROLES)
    assert lab.count() == interactions.count()
    held = lab.where(F.col("role") != "train").select("user_id", "item_id").distinct()
    train = lab.where(F.col("role") == "train").select("user_id", "item_id").distinct()
    assert held.join(train, ["user_id", "item_id"]).count() == 0
    # a user's held rows are all of one split, and train-split users hold nothing out
    bad = lab.where((F.col("split") == "train") & (F.col("role") != "train")).count()
    assert bad == 0
    t, v, s = split.train_val_test_split(interactions, ROLES)
    assert t.count() + v.count() + s.count() == interactions.count()


def test_folds_partition_users(spark, interactions):
    lab = split.kfold_labels(interactions, ROLES, k=4)
    per_user = lab.groupBy("user_id").agg(F.countDistinct("user_fold").alias("n")).where("n > 1")
    assert per_user.count() == 0
    folds = {r[0] for r in lab.select("user_fold").distinct().collect()}
    assert folds <= {-1, 0, 1, 2, 3}
    sets = split.kfold_split(interactions, ROLES, k=4)
    n = interactions.count()
    for f, (tr, va, te) in sets.items():
        assert tr.count() + va.count() + te.count() == n
    tests = [_bag(sets[f][2]) for f in range(4)]
    assert all(t == tests[0] for t in tests)          # the test rows are the same in every fold
    vals = [set(r[0] for r in sets[f][1].select("user_id").distinct().collect()) for f in range(4)]
    assert sum(len(x) for x in vals) == len(set().union(*vals))   # validation users are disjoint


def test_one_fold_is_an_error(spark, interactions):
    with pytest.raises(ValueError):
        split.kfold_labels(interactions, ROLES, k=1)


def test_union_all(spark, interactions):
    with pytest.raises(ValueError):
        split.union_all()
    tr, va, _ = split.train_val_test_split(interactions, ROLES)
    assert split.union_all(tr, va).count() == tr.count() + va.count()


def test_halves_exact_and_copies_split(spark):
    rows = [(1, 10, 5)] * 5 + [(1, 11, 3), (2, 10, 1)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating int")
    roles = ROLES.with_(tiebreak=())
    h = sampling.stratified_halves(df, roles)
    c = Counter((r.user_id, r.half) for r in h.collect())
    assert c[(1, 0)] == 3 and c[(1, 1)] == 3       # 6 rows: numbers 2, 4, 6 are even
    assert c[(2, 1)] == 1 and c[(2, 0)] == 0        # one row: number 1 is odd, even side empty
    assert len(h.collect()) == len(rows)


def test_null_user_dropped(spark):
    df = spark.createDataFrame([(None, 1, 3), (1, 2, 4)], "user_id int, item_id int, rating int")
    assert split.label_roles(df, ROLES).count() == 1
    assert sampling.sample_users(df, percentage=1.0).count() == 1
    assert sampling.stratified_halves(df, ROLES.with_(tiebreak=())).count() == 1


def test_empty_input(spark):
    df = spark.createDataFrame([], "user_id int, item_id int, rating int")
    assert split.label_roles(df, ROLES).count() == 0
    assert sampling.stratified_halves(df, ROLES.with_(tiebreak=())).count() == 0


def test_halves_keep_every_type_and_value(spark):
    """One user holds most rows; nulls, NaN, large integers, decimals and times pass untouched."""
    import datetime
    import decimal

    import duckdb
    import pandas as pd
    import pyarrow as pa
    n = 400
    big = (1 << 53) + 1
    table = pa.table({
        "user_id": pa.array([7 if i % 3 else i for i in range(n)], pa.int64()),
        "item_id": pa.array([i % 11 for i in range(n)], pa.int64()),
        "a": pa.array([None if i % 5 == 0 else big + i for i in range(n)], pa.int64()),
        "b": pa.array([None if i % 7 == 0 else float("nan") if i % 7 == 1 else i / 3 for i in range(n)], pa.float64()),
        "c": pa.array([None if i % 6 == 0 else decimal.Decimal(i).scaleb(-2) + 10 ** 20 for i in range(n)],
                      pa.decimal128(30, 2)),
        "d": pa.array([None if i % 4 == 0 else datetime.datetime(2020, 1, 1, 0, 0, 0, i) for i in range(n)],
                      pa.timestamp("us"))})
    table = pa.concat_tables([table, table.slice(0, 90)])
    df = spark.createDataFrame(table).repartition(5)
    got = sampling.stratified_halves(df, ROLES.with_(tiebreak=()))
    con = duckdb.connect()
    con.register("t", table)
    order = ", ".join(f"{c} NULLS FIRST" for c in ("item_id", "a", "b", "c", "d"))
    ref = con.execute(f"SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {order}) % 2 AS INT) AS half "
                      "FROM t").fetchall()
    same = lambda rows: Counter(tuple("nan" if isinstance(v, float) and v != v else v for v in r) for r in rows)
    assert same(tuple(r) for r in got.collect()) == same(ref)
    assert pd.notna(got.first().half)


def test_fast_hash_argument(spark, interactions):
    from interlens.functions.hashing import bucket
    lab = split.label_roles(interactions, ROLES, method="xxhash64")
    shares = {r.split: r["count"] for r in lab.select("user_id", "split").distinct().groupBy("split").count().collect()}
    assert set(shares) == {"train", "val", "test"} and shares["train"] > shares["val"]
    b = interactions.select(bucket(1, "x", "user_id", method="xxhash64").alias("b")).agg(F.min("b"), F.max("b")).first()
    assert 0 <= b[0] and b[1] < 1 << 32
    with pytest.raises(ValueError):
        bucket(1, "x", "user_id", method="sha1")


def test_null_items_are_dropped_and_counted(spark):
    df = spark.createDataFrame([(None, 1, 3), (1, None, 4), (1, 2, 4), (None, None, 1)],
                               "user_id int, item_id int, rating int")
    assert split.label_roles(df, ROLES).count() == 1 and split.kfold_labels(df, ROLES, 2).count() == 1
    assert tuple(split.null_keys(df, ROLES).first()) == (4, 2, 2, 3)


def test_final_split_is_fold_zero_train_plus_val(spark, interactions):
    train, test = split.final_split(interactions, ROLES, k=4, fold=0)
    tr0, va0, te0 = split.kfold_split(interactions, ROLES, k=4)[0]
    assert _bag(train) == _bag(tr0) + _bag(va0)
    assert _bag(test) == _bag(te0)
    assert train.count() + test.count() == interactions.count()
