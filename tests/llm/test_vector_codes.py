import hashlib
import math

import numpy as np
import pytest

from helpers_llm import SF001
from interlens.llm import vector_codes as vc

TABLE = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    """The contract's columns by all distances, in Python integers."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    lead = sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[1]))
    kept = [r for r in kept if len(r[1]) == len(lead[0][1])]
    lead = [r for r in lead if len(r[1]) == len(lead[0][1])][:entries]
    w = len(lead[0][1]) // parts
    cut = lambda v: [v[p * w:(p + 1) * w] for p in range(parts)]
    books = [[cut(r[1])[p] for r in lead] for p in range(parts)]
    x = [cut(r[1]) for r in kept]
    dist = lambda a, b: sum((i - j) ** 2 for i, j in zip(a, b))
    near = lambda p, v: min(range(len(books[p])), key=lambda j: (dist(v, books[p][j]), j))
    for t in range(rounds + 1):
        at = [[near(p, v[p]) for p in range(parts)] for v in x]
        if t == rounds:
            break
        for p in range(parts):
            for j in range(len(books[p])):
                own = [v[p] for v, a in zip(x, at) if a[p] == j]
                if own:
                    books[p][j] = [sum(c) // len(own) for c in zip(*own)]
    error = [sum(dist(v[p], books[p][a[p]]) for p in range(parts)) for v, a in zip(x, at)]
    by = {}
    for (_, _, label), e in zip(kept, error):
        by[label] = by.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{j:02x}" for j in a), e, by[r[2]], digest) for r, a, e in zip(kept, at, error)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_embeddings(spark):
    d = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in d.collect()]
    assert got(vc.compress(d)) == brute(rows)


def test_odd_rows(spark):
    rnd = np.random.default_rng(5)
    v = rnd.normal(0, 2, (150, 8)).astype(np.float32).tolist()
    rows = [(int(i), x, int(i) % 3 if i % 5 else None) for i, x in zip(rnd.permutation(400)[:150] - 50, v)]
    rows += [(0, v[3], 1)] * 4 + [(rows[7][0], v[8], 9)]                                    # repeated rows, a shared id
    rows += [(None, v[0], 1), (None, [0.0] * 8, None), (-400, v[1][:7] + [None], 1), (-401, v[1][:7] + [float("nan")], 1),
             (-402, v[1][:7] + [float("-inf")], 2), (-403, None, 2), (-404, [], 2), (500, v[0][:4], 2)]
    rows += [(600 + i, [1.0] * 8, 0) for i in range(70)]                                    # ties and copies
    d = spark.createDataFrame([(*r, b"x", "y", 3, 4) for r in rows], TABLE + ", ints binary, near string, cell long, bound int")
    for entries in (256, 20, 1):
        assert got(vc.compress(d.repartition(4), entries=entries)) == brute(rows, entries=entries)


def test_large_components(spark):
    """Beyond what doubles hold exactly; farther still there is an error, not a wrong code."""
    rnd = np.random.default_rng(6)
    rows = [(i, (rnd.normal(0, 1, 8) * 60_000).astype(np.float32).tolist(), 0) for i in range(60)]
    assert got(vc.compress(spark.createDataFrame(rows, TABLE), entries=16)) == brute(rows, entries=16)
    with pytest.raises(Exception, match="too large"):
        vc.compress(spark.createDataFrame([(1, [1e30] * 8, 0)], TABLE))


def test_empty(spark):
    for rows in ([], [(1, None, 2)], [(None, [1.0] * 4, 2)]):
        assert vc.compress(spark.createDataFrame(rows, TABLE)).collect() == []
    with pytest.raises(ValueError):
        vc.compress(spark.createDataFrame([(1, [1.0] * 5, 2)], TABLE))


def test_bounds_hold_and_save_scans():
    """Through all rounds: no bound exceeds the true distance, assignments equal
    those by all distances, groups are passed over, and displacement between two
    rounds is below the sum of the moves between them."""
    rnd = np.random.default_rng(7)
    centres = rnd.integers(-40_000, 40_000, (40, 6))
    x = (centres[rnd.integers(0, 40, 3000)] + rnd.integers(-1500, 1500, (3000, 6))).astype(np.int64)
    h = vc.History(x[:64][None])
    state, scanned, swung = (), [], 0
    for t in range(6):
        near, d, bound, stamp, n = vc.assign(x, 0, h, *state)
        full = ((x[:, None, :] - h.books[-1][0][None]) ** 2).sum(2)
        assert (near == full.argmin(1)).all() and (d == full.min(1)).all()
        others = full.astype(float)
        others[np.arange(len(x)), near] = np.inf
        drift = np.stack([m[0] for m in h.moved])
        for g, entries in enumerate(h.groups[0]):
            now = bound[:, g] - drift[stamp[:, g], g]
            assert (now <= np.sqrt(others[:, entries].min(1))).all()
        scanned.append(n)
        state = near, bound, stamp
        book = h.books[-1].copy()
        for j in np.unique(near):
            book[0, j] = x[near == j].sum(0) // (near == j).sum()
        h.add(book)
        steps = [np.array([np.sqrt(((b[0][g] - a[0][g]) ** 2).sum(1)).max() for g in h.groups[0]]) for a, b in zip(h.books, h.books[1:])]
        assert (h.moved[0][0] <= sum(steps) * (1 + 1e-6)).all()
        swung += (h.moved[0][0] < 0.99 * sum(steps)).sum()
    assert scanned[0] == 3000 * vc.GROUPS and max(scanned[1:]) < 0.8 * scanned[0] and swung > 0


def test_entry_groups_cover():
    c = np.random.default_rng(1).integers(0, 9, (37, 3))
    for n in (1, 2, 8, 64):
        groups = vc.entry_groups(c, n)
        assert sorted(np.concatenate(groups)) == list(range(37)) and len(groups) == min(n, 37)
