import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from interlens.llm import common


def test_merges_hold_few_vectors(spark, monkeypatch):
    """5,000 tasks' vectors: no group holds more than the fan-in of its size."""
    n, size = 5000, 8 * 64
    rows = spark.range(0, n, 1, 8).select(F.col("id").alias("task"), (F.col("id") % 2).cast("int").alias("slice"))
    vectors = rows.mapInPandas(lambda it: (p.assign(v=[np.full(64, t, np.int64).tobytes() for t in p["task"]]) for p in it),
                               "task long, slice int, v binary")
    for most in (64, 8, 2):
        monkeypatch.setattr(common, "MERGE_BYTES", most * size)
        assert common.fan_in(size) == most

        def add(blobs):
            if len(blobs) > most:
                raise ValueError("too many vectors in one group")
            return common._sum_vectors(blobs)

        got = {r["slice"]: np.frombuffer(r["v"], np.int64)[0] for r in common.merged(vectors, "v", size, add, ("slice",), n).collect()}
        assert got == {0: sum(range(0, n, 2)), 1: sum(range(1, n, 2))}
        assert common.merged(vectors.drop("slice"), "v", size, add, tasks=n).count() == 1


def test_fan_in_is_bounded():
    assert common.fan_in(1) == 64 and common.fan_in(8 << 20) == 8 and common.fan_in(1 << 40) == 2


def test_tasks_are_counted_without_running(spark):
    d = spark.range(0, 100, 1, 7)
    assert common.n_tasks(common.numbered(d)) == 7 and common.n_tasks(common.numbered(d.repartition(3))) == 4     # the session's


def test_summed_and_filter(spark):
    d = spark.range(0, 1000, 1, 7)
    ones = d.mapInPandas(lambda it: (p.iloc[:1].assign(count=[np.arange(5).tobytes()])[["count"]] for p in it), "count binary")
    assert common.summed(ones, 5).tolist() == [7 * i for i in range(5)]
    assert common.summed(ones.limit(0), 5).tolist() == [0] * 5
    known = common.id_filter(d.where("id % 10 = 0"), "id", 100)
    passed = {r.id for r in known.rows(d, "id").collect()}
    assert passed >= set(range(0, 1000, 10)) and len(passed) < 300


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    """Long chains, a hub with the largest id, scattered links, both directions, repeats."""
    rnd = random.Random(seed)
    links = [(i, i + 1) for i in range(0, 40)] + [(9999, i) for i in range(100, 160)] + [(160, 161), (161, 9999)]
    links += [(rnd.randint(200, 400), rnd.randint(200, 400)) for _ in range(80)] + [(7, 7), (3, 2), (3, 2)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    rnd.shuffle(links)
    got = {r.node: r.component for r in common.connected(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert got == {x: find(x) for x in up}
    assert common.connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_workers_give_memory_back_when_a_task_ends(monkeypatch):
    seen = []
    monkeypatch.setattr(common, "_give_back", lambda: seen.append("back"))
    assert list(common.lean(lambda batches: (seen.append(b) or 2 * b for b in batches))(iter([1, 2]))) == [2, 4]
    assert seen == [1, 2, "back"]
    monkeypatch.undo()
    common._give_back()     # also where there is nothing to give back
