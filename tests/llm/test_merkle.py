import hashlib
import random
import zlib

from helpers_llm import DOCS, SF001
from interlens.llm import merkle as mk


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    values = [r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1]]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root and, by node, the steps (left digest, right digest or alone) to it."""
    steps = [[] for _ in nodes]
    level = [(n, [i]) for i, n in enumerate(nodes)]
    while len(level) > 1:
        up = []
        for i in range(0, len(level), 2):
            run = level[i:i + 2]
            for j, (_, members) in enumerate(run):
                for m in members:
                    steps[m].append([x for k, (x, _) in enumerate(run) if k != j] + [j])
            up.append((h(*(x for x, _ in run)), [m for _, ms in run for m in ms]))
        level = up
    return level[0][0], steps


def brute(rows):
    """The contract's columns, straight from its words."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    sub, own = {}, {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        sub[lang], steps = tree([leaf(r) for r in mine])
        own[lang] = list(zip(mine, steps))
    root, far = tree([sub[x] for x in langs])
    out = []
    for lang, outer in zip(langs, far):
        for r, steps in own[lang]:
            steps = steps + outer
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf(r, int(hit))
            for *others, place in steps:
                node = h(node) if not others else h(others[0], node) if place else h(node, others[0])
            out.append((r[0], leaf(r), sub[lang], root, h(*(o for *others, _ in steps for o in others)), node, node == root))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_documents(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in d.collect()]
    want = brute(rows)
    assert got(mk.audit(d)) == want                 # one block a language
    assert got(mk.audit(d, bits=2)) == want         # blocks of blocks of blocks
    assert {w[6] for w in want} == {True, False}


def test_odd_rows(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, many
    small groups, extra columns with clashing names."""
    rnd = random.Random(3)
    rows = [(rnd.choice([None, i, 5]), rnd.choice([None, "", "a\nb", "é" * 2_000_000 if i == 9 else "x"]),
             rnd.choice([None, "", "en", "fr", "é", "zz", "Z"]), rnd.choice([None, "s"]), rnd.choice([None, 7, 2**62])) for i in range(90)]
    rows += [rows[0]] * 9 + [(1000 + i, "t", f"lang {i}", "s", i) for i in range(37)]
    d = spark.createDataFrame([(*r, 1, "x", b"y", 2) for r in rows],
                              DOCS + ", pos int, tree string, node binary, has int").repartition(5)
    want = brute(rows)
    assert got(mk.audit(d)) == want
    assert got(mk.audit(d, bits=1)) == want


def test_every_size(spark):
    for n in (1, 2, 3, 5, 8, 9, 17):
        rows = [(i, "t", "en", "s", i) for i in range(n)]
        assert got(mk.audit(spark.createDataFrame(rows, DOCS), bits=2)) == brute(rows)


def test_empty(spark):
    out = mk.audit(spark.createDataFrame([], DOCS))
    assert out.collect() == [] and out.columns[0] == "doc_id"


def test_manifest_carries_witnesses(spark):
    """The operator returns the siblings themselves: a reader folds any row alone."""
    rows = [(i, "t", "en" if i % 3 else "fr", "s", i) for i in range(50)]
    for r in mk.manifest(spark.createDataFrame(rows, DOCS), bits=3).collect():
        sub = mk.fold(r.leaf.hex().encode(), r.pos, r.height, r.has, r.siblings)
        assert sub == r.subroot.hex().encode() and len(r.siblings) == 32 * bin(r.has).count("1")
        assert mk.fold(sub, r.group_pos, r.group_height, r.group_has, r.group_siblings) == r.root.hex().encode()


def test_frontier_is_a_merkle_tree():
    for n in range(1, 40):
        nodes = [h(str(i)) for i in range(n)]
        f = mk.Frontier(n, 6)
        for x in nodes:
            f.append(x.encode())
        assert f.close(0)[0].decode() == tree(nodes)[0]
