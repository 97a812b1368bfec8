import random
import time
import zlib

import numpy as np
import pyarrow as pa

from helpers_llm import DOCS
from interlens.llm import textvec as tv
from interlens.llm import toxicity as tx
from test_quality_model import auc

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{base}/labels.parquet")
    out = {r.doc_id: r for r in tx.score(spark.read.parquet(f"{base}/documents.parquet"), labels).collect()}
    assert len(out) == 10000
    rows = [(r.toxic, out[r.doc_id]) for r in labels.collect()]
    assert all(o.held_out == (zlib.crc32(str(o.doc_id).encode()) % 5 == 0) for _, o in rows)
    held = [(t, o) for t, o in rows if o.held_out]
    y, s = np.array([t for t, _ in held]), np.array([o.score for _, o in held])
    p = s >= 0.5
    print("held-out", len(y), "auc", auc(y, s), "recall", p[y == 1].mean(), "precision", y[p].mean())
    print([(o.doc_id, t, round(o.score, 3), round(o.evidence, 2), len(o.passages)) for t, o in held if (o.score >= .5) != t][:20])
    assert auc(y, s) > 0.95 and p[y == 1].mean() > 0.9 and y[p].mean() > 0.9


def maximal(scores):
    """Ruzzo and Tompa's definition, by recursion: the best segment first."""
    def inside(lo, hi):
        best = max(((sum(scores[a:b]), -(b - a), a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)),
                   default=(0, 0, 0, 0))
        if best[0] <= 0:
            return []
        _, _, a, b = best
        return inside(lo, a) + [(a, b)] + inside(b, hi)
    return inside(0, len(scores))


def test_segments_equal_definition():
    rnd = random.Random(3)
    for _ in range(300):
        n = rnd.randint(0, 14)
        at = sorted(rnd.sample(range(n), rnd.randint(0, n)))
        score = [rnd.choice([1.01, 2.03, 3.07, 0.53]) + rnd.random() / 100 for _ in at]
        full = [-0.9] * n
        for p, s in zip(at, score):
            full[p] = s
        got = tx.segments(np.array(at, int), np.array(score), n, -0.9)
        assert [(a, b + 1) for _, a, b in got] == maximal(full)
        assert all(np.isclose(s, sum(full[a:b + 1])) for s, a, b in got)


def test_segments_take_linear_time():
    """Mild words far apart, rising and falling runs: no hit looks back over all others."""
    n = 200_000
    for score in (np.ones(n), np.linspace(0.1, 3, n), np.linspace(3, 0.1, n), np.where(np.arange(n) % 3, 0.2, 2.5)):
        start = time.perf_counter()
        got = tx.segments(np.arange(n) * 20, score, 20 * n, -0.1)
        assert got and time.perf_counter() - start < 3


def test_very_long_text(spark, frame):
    """A document of 20 MB with a mild word now and then is scored like any other."""
    rnd = random.Random(1)
    plain = [" ".join(rnd.choices("alpha beta gamma delta".split(), k=30)) for _ in range(200)]
    texts = [t.replace("beta", "vileword", 3) if i % 3 == 0 else t for i, t in enumerate(plain)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(200)], LABELS)
    long = ("alpha gamma delta " * 40 + "vileword ") * 27_000
    out = {r.doc_id: r for r in tx.score(frame([*texts, long, long.replace("vileword ", "")]), labels).collect()}
    assert out[201].predicted == 0 and 0 <= out[200].score <= 1 and out[200].score >= out[201].score


def test_repeated_rows_and_rows_without_id(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choices("alpha beta gamma delta".split(), k=30) + ["vileword"] * (i % 3 == 0) * 4)) for i in range(150)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(150)] * 2, LABELS)
    d = spark.createDataFrame(rows + rows[:20] + [(None, rows[0][1])], "doc_id long, text string")
    out = tx.score(d, labels).collect()
    assert len(out) == 170 and len({(r.doc_id, r.score) for r in out}) == 150
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in out)


def test_folding_and_prefixes():
    c = next(tv.chunks(pa.array(["ÉCOLE école Straße STRASSE ×"])))
    assert tx.folded(c).bytes_of(0).decode() == "école école straße strasse ×"
    w = tv.words(tx.folded(c), separator=tx._PART)
    assert w.hash[0] == w.hash[1]
    a, b = (next(tv.chunks(pa.array([t]))) for t in ("xx prefixed", "prefixes yy"))
    wa, wb = (tv.words(x, separator=tx._PART) for x in (a, b))
    for size in (4, 6, 7):
        assert tv.prefix_hash(wa, size)[1][-1] == tv.prefix_hash(wb, size)[1][0]
    assert tv.prefix_hash(wa, 8)[0].tolist() == []


def test_odd_tables(spark, frame):
    labels = spark.createDataFrame([], LABELS)
    out = tx.score(frame([None, "", "some text"]), labels).collect()
    assert len(out) == 3 and all(0 <= r.score <= 1 and r.evidence == 0 for r in out)
    assert tx.score(spark.createDataFrame([], DOCS), labels).collect() == []
    rnd = random.Random(1)
    plain = [" ".join(rnd.choices("alpha beta gamma delta".split(), k=30)) for _ in range(200)]
    texts = [t.replace("beta", "vileword", 3) if i % 3 == 0 else t for i, t in enumerate(plain)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(200)] + [(None, 1, 1), (5, None, None)], LABELS)
    out = {r.doc_id: r for r in tx.score(frame(texts + [None]), labels).collect()}
    assert all(out[i].predicted == int("vileword" in texts[i]) for i in range(200)) and out[200].predicted == 0
    toxic = next(r for r in out.values() if r.predicted)
    assert toxic.evidence > 0


def plain_score(m, text):
    """Score and passages of one text by the definition: words by an expression,
    the best token of each from a dictionary, all segments by recursion."""
    import math
    import re
    raw = (text or "").encode()
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in raw)
    raw = b"".join(bytes([raw[i] + 32 if i and raw[i - 1] == 0xC3 and 0x80 <= raw[i] <= 0x9E and raw[i] != 0x97 else raw[i]])
                   for i in range(len(raw)))
    words = re.findall(rb"[0-9a-z\x80-\xff]+", raw)
    entry = {int(t): k for k, t in enumerate(m.lexicon.token)}
    full = [m.other] * len(words)
    for i, w in enumerate(words):
        one = next(tv.chunks(pa.array([w.decode("utf-8", "surrogateescape").encode("utf-8", "surrogateescape")], pa.binary()).cast(
            pa.string(), safe=False)))
        here = [entry[int(h)] for _, hs in tx.tokens(tv.words(one, separator=tx._PART)) for h in hs if int(h) in entry]
        if here:
            full[i] = m.score[max(here, key=lambda k: m.lexicon.odds[k])]
    cum = np.concatenate([[0], np.cumsum(full)])

    def inside(lo, hi):
        hits = [p for p in range(lo, hi) if full[p] > 0]
        best = max(((cum[b + 1] - cum[a], -(b - a), a, b) for a in hits for b in hits if a <= b), default=(0, 0, 0, 0))
        return [] if best[0] <= 0 else inside(lo, best[2]) + [(best[0], best[2], best[3])] + inside(best[3] + 1, hi)

    found = inside(0, len(full))
    out = total = 0.0
    for r, (s, _, _) in enumerate(sorted(found, reverse=True), 1):
        x = m.lam * s - m.log_k - math.log(max(len(words), 1))
        if r > 1 and x <= 0:
            break
        total += x
        if total > 0:
            out = max(out, total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r) - r * math.log(2))
    passages = [(a, b) for s, a, b in found if s >= (math.log(1e6) + m.log_k) / m.lam]
    return 1 / (1 + math.exp(-(m.bias + m.slope * math.log1p(out)))), passages


def test_whole_result_equals_plain_python(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    from interlens.llm.common import id_text
    m = tx.train(id_text(docs), labels, "toxic", 20_000, 3.0, 1.5, 3, 100.0)
    assert len(m.lexicon.token)
    got = {r.doc_id: r for r in tx.score(docs, labels).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert len(got) == len(rows)
    toxic = {r.doc_id for r in labels.collect() if r.toxic}
    for i, text in [r for r in rows if r[0] in toxic or r[0] % 6 == 0]:
        want, passages = plain_score(m, text)
        assert abs(got[i].score - want) < 1e-9, i
        assert [(p["first"], p["last"]) for p in got[i].passages] == passages
        assert got[i].predicted == int(want >= 0.5) and got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
