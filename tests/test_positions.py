"""Positions inside groups and count expansion, against brute force.

Small partition counts, on data with one hot group and groups of copies.
"""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from interlens.operators.positions import (cell_positions, expand_counts, global_positions, group_positions, order_codes,
                                           refined_cells)


def _rows(seed=7, n=3000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = 0 if rnd.random() < 0.4 else rnd.randint(1, 40)   # group 0 holds ~40 % of rows
        rows.append((g, rnd.randint(0, 500), i, rnd.randint(1, 4)))
    return rows


def _brute(rows):
    out = {}
    by = {}
    for g, o, i, w in rows:
        by.setdefault(g, []).append((o, i, w))
    for g, lst in by.items():
        acc = 0
        for o, i, w in sorted(lst):
            out[i] = acc
            acc += w
    return out


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_group_positions_match_brute_force(spark, parts):
    rows = _rows()
    df = spark.createDataFrame(rows, "g int, o int, i int, w int").repartition(5)
    pos, total = group_positions(df, ["g"], ["o", "i"], weight="w", out="p",
                                 num_partitions=parts)
    got = {r.i: r.p for r in pos.select("i", "p").collect()}
    assert got == _brute(rows)
    assert total == sum(r[3] for r in rows)


def test_group_positions_null_group(spark):
    rows = [(None, 1, 0, 1), (None, 2, 1, 1), (1, 1, 2, 1)]
    df = spark.createDataFrame(rows, "g int, o int, i int, w int")
    pos, _ = group_positions(df, ["g"], ["o"], weight="w", out="p", num_partitions=2)
    assert sorted((r.i, r.p) for r in pos.collect()) == [(0, 0), (1, 1), (2, 0)]


def test_group_positions_empty(spark):
    df = spark.createDataFrame([], "g int, o int")
    pos, total = group_positions(df, ["g"], ["o"], out="p")
    assert total == 0 and pos.count() == 0


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_global_positions_bijection(spark, parts):
    keys = [f"k{i:05d}" for i in random.Random(3).sample(range(100000), 2000)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    pos, n = global_positions(df, ["k"], out="p", num_partitions=parts)
    got = dict(pos.select("k", "p").collect())
    assert n == 2000
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_expand_counts_chunks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 25), ("d", 0)], "k string, n long")
    out = expand_counts(df, "n", chunk=4, num_partitions=3)
    assert Counter(r.k for r in out.collect()) == Counter({"a": 1, "b": 7, "c": 25})
    assert out.columns == ["k"]


def test_distributed_plan_has_no_one_task_window(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    pos, _ = group_positions(df, ["g"], ["id"], out="p", num_partitions=4)
    plan = pos._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


@pytest.mark.parametrize("limit", [1 << 20, 200, 7, 1])
def test_cell_positions_match_brute_force(spark, limit):
    rows = _rows()
    df = spark.createDataFrame(rows, "g int, o int, i int, w int").repartition(5)
    weighed = cell_positions(df, ["g"], ["o", "i"], weight="w", out="p", limit=limit)
    assert weighed.columns == ["g", "o", "i", "w", "p"]
    assert {r.i: r.p for r in weighed.collect()} == _brute(rows)
    plain = cell_positions(df, ["g"], ["o", "i"], out="p", limit=limit)
    assert {r.i: r.p for r in plain.collect()} == _brute([(g, o, i, 1) for g, o, i, _ in rows])


def test_cells_hold_at_most_the_limit(spark):
    """A lopsided group (almost all rows in a sliver of a huge range, many ties in
    the first column) ends in cells within the limit; small groups are not cut."""
    rnd = random.Random(5)
    rows = [(1, rnd.choice([-2**63, 2**63 - 1, 5, rnd.randint(0, 300), None]), i, rnd.random() < 0.5) for i in range(2000)]
    rows += [(2, i, i, True) for i in range(50)]
    df = spark.createDataFrame(rows, "g int, o long, i long, b boolean").repartition(4)
    codes = [x for c in ("o", "b", "i") for x in order_codes(df, c)]
    cells = refined_cells(df, ["g"], codes, limit=60)
    sizes = cells.groupBy("g", "_cell").count().collect()
    assert max(r["count"] for r in sizes) <= 60
    assert [r["_cell"] for r in sizes if r.g == 2] == [[]]
    got = {(r.g, r.i): r.p for r in cell_positions(df, ["g"], ["o", "b", "i"], out="p", limit=60).collect()}
    for g in (1, 2):
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[3], r[2]))
        assert [got[g, r[2]] for r in mine] == list(range(len(mine)))


def test_cell_positions_of_dates_text_nulls_and_ties(spark):
    df = spark.sql("SELECT CAST(id % 2 AS INT) AS g, date_add(DATE'1969-12-20', CAST(id % 40 AS INT)) AS d, "
                   "timestamp_micros((id - 50) * 1000003) AS t, CAST(id AS STRING) AS s FROM range(100)")
    for order in (["d", "s"], ["t"], ["s"]):
        want = {r.s: r.p for r in cell_positions(df, ["g"], order, out="p").collect()}
        assert {r.s: r.p for r in cell_positions(df, ["g"], order, out="p", limit=9).collect()} == want
    null = spark.createDataFrame([(None, None), (None, 3), (1, None)], "g int, o int")
    assert sorted((str(r.g), str(r.o), r.p) for r in cell_positions(null, ["g"], ["o"], out="p", limit=1).collect()) == [
        ("1", "None", 0), ("None", "3", 1), ("None", "None", 0)]
    same = spark.createDataFrame([(1, 1, "x")] * 9, "g int, o int, s string")       # rows that no column tells apart
    assert sorted(r.p for r in cell_positions(same, ["g"], ["o"], out="p", limit=2).collect()) == list(range(9))
    assert cell_positions(null.limit(0), ["g"], ["o"], limit=1).collect() == []


def test_no_group_is_sorted_by_range_or_python(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    for limit in (1 << 20, 50):
        plan = cell_positions(df, ["g"], ["id"], out="p", limit=limit)._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "InArrow" not in plan and "SinglePartition" not in plan


def test_group_positions_tell_colliding_groups_apart(spark, monkeypatch):
    """Groups are compared by their columns too, not by their hash alone."""
    from interlens.operators import positions
    rows = _rows(n=400)
    df = spark.createDataFrame([(g if g % 2 else None, str(g), o, i, w) for g, o, i, w in rows], "g int, h string, o int, i int, w int")
    want = _brute(rows)
    monkeypatch.setattr(positions.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    pos, _ = group_positions(df, ["g", "h"], ["o", "i"], weight="w", out="p", num_partitions=5)
    assert {r.i: r.p for r in pos.select("i", "p").collect()} == want
