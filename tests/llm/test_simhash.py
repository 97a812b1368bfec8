import random

import numpy as np
import pytest
import xxhash

from helpers_llm import DOCS, SF01, words
from interlens.llm import simhash as sh


def finger(text, k=3):
    w = words(text, lower=True)
    g = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps):
    """Smallest reachable place of every fingerprint, by all pairs."""
    low = list(range(len(fps)))
    a = np.array(fps, np.uint64)
    near = [np.flatnonzero(np.bitwise_count(a ^ x) <= 2) for x in a]
    changed = True
    while changed:
        changed = False
        for i, js in enumerate(near):
            m = min(low[j] for j in js)
            if m < low[i]:
                low[i], changed = m, True
    return low


def check(spark, texts, df):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in sh.near_duplicates(df).collect()}
    fps = [finger(t) for t in texts]
    assert got == {i: (f"{f:016x}", low) for i, (f, low) in enumerate(zip(fps, groups(fps)))}
    return fps


def test_documents(spark):
    d = spark.read.parquet(f"{SF01}/documents.parquet").orderBy("doc_id")
    texts = [r.text for r in d.collect()]
    fps = check(spark, texts, d)
    assert len(set(groups(fps))) <= len(set(fps)) < len(texts)


def test_odd_texts(spark, frame):
    texts = [None, "", " \t\n", "a", "A", "a b", "a  B", "a b c", "a\nb\x0bc", "a b", "É é", "日本 語 x y", "a a a a a a",
             "x " * 300_000 + "end", "b" * 1_500_000, "w1 w2 w3 w4"] + ["same old text here"] * 20
    check(spark, texts, frame(texts))


def test_long_text_in_steps(monkeypatch):
    text = " ".join(str(i * i % 9973) for i in range(5000))
    want = finger(text).to_bytes(8)
    for step in (1 << 17, 256, 1000):
        monkeypatch.setattr(sh, "_STEP", step)
        assert sh.fingerprint(text.encode()) == want


def test_empty_null_ids_and_repeats(spark):
    assert sh.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    d = spark.createDataFrame([(None, "a b"), (2, "a b"), (2, "a b"), (3, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in sh.near_duplicates(d).collect()) == [(2, 2), (2, 2), (3, 3)]


def planted(n, seed):
    """Scattered fingerprints, chains and dense clusters a few bits wide."""
    rnd = random.Random(seed)
    out = {rnd.getrandbits(64) for _ in range(n)}
    for c in list(out)[:n // 4]:
        for _ in range(3):
            c ^= 1 << rnd.randrange(64) | 1 << rnd.randrange(64)
            out.add(c)
    hub = rnd.getrandbits(64)
    out |= {hub ^ 1 << i ^ 1 << j for i in range(20) for j in range(20)}
    return sorted(out)


def roots(pairs, fps):
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("families,cell", [(None, sh.CELL), (3, 16), (6, 8), (16, 4)])
def test_links_equal_all_pairs(spark, families, cell):
    """Also where every cell is over its limit and is dealt out again."""
    fps = planted(800, 4)
    a = np.array(fps, np.uint64)
    i, j = np.nonzero(np.triu(np.bitwise_count(a[:, None] ^ a[None, :]) <= 2, 1))
    signed = lambda x: int(np.uint64(x).astype(np.int64))
    points = spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(4)
    got = sh.links(points, len(fps), families=families, cell_size=cell).collect()
    same = [signed(f) for f in fps]
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") >= 1 for r in got)
    assert roots([(r.a, r.b) for r in got], same) == roots([(same[x], same[y]) for x, y in zip(i, j)], same)


def test_start_grows_with_the_points():
    assert sh.start_families(10**5) == 3 and sh.start_families(10**9) >= 6
    assert [len(sh.routes(f)) for f in sh.FAMILIES] == [3, 15, 45, 120]
