import hashlib
import random

import pytest

from helpers_llm import DOCS, SF001, W
from interlens.llm import substring_dedup as sd



def brute(rows, size):
    first = {}
    ws = {i: W.findall(t or "") for i, t in rows}
    for i in sorted(ws):
        for p in range(len(ws[i]) - size + 1):
            first.setdefault(tuple(ws[i][p:p + size]), (i, p))
    out = {}
    for i, w in ws.items():
        gone = set()
        for p in range(len(w) - size + 1):
            if first[tuple(w[p:p + size])] != (i, p):
                gone.update(range(p, p + size))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def result(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in df.collect()}


@pytest.mark.parametrize("sketch_bytes,chunk_bytes", [(64 << 20, 4 << 20), (16, 4 << 20), (None, 300), (16, 1)])
def test_equals_brute_force(spark, frame, sketch_bytes, chunk_bytes):
    rnd = random.Random(1)
    part = [" ".join(rnd.choices("abcdefgh", k=9)) for _ in range(5)]
    texts = [None, "", "  ", "a b c", "x " * 60, part[0]]
    texts += [" \n".join(rnd.choices(part, k=rnd.randint(1, 5)) + ["é" + str(rnd.random())]) for _ in range(60)]
    texts += [texts[10]] * 4 + ["word " * 3000]
    got = result(sd.substring_dedup(frame(texts), 5, sketch_bytes, chunk_bytes=chunk_bytes))
    assert got == brute(list(enumerate(texts)), 5)


def test_documents_equal_brute_force(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    assert result(sd.substring_dedup(d)) == brute([(r.doc_id, r.text) for r in d.collect()], 20)


def test_empty_null_ids_and_repeated_rows(spark, frame):
    assert sd.substring_dedup(spark.createDataFrame([], DOCS)).collect() == []
    t = "a b c d e f"
    d = spark.createDataFrame([(None, t), (1, t), (1, t), (2, t + " g")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed) for r in sd.substring_dedup(d, 3).collect())
    assert got == [(1, 0), (1, 0), (2, 6)]
    # two texts under one id: each row loses its own words, by start
    d = spark.createDataFrame([(1, "z a b c d"), (1, t), (2, "q r s"), (2, "b c d")], "doc_id long, text string")
    for size in (1 << 20, 1):
        got = sorted((r.doc_id, r.kept_text) for r in sd.substring_dedup(d.coalesce(1), 3, chunk_bytes=size).collect())
        assert got == [(1, "a b c d e f"), (1, "z"), (2, ""), (2, "q r s")]


def test_cells_round_trip():
    import numpy as np
    for cells in ([], [0], [254], [255], [0, 1, 255, 510, 1021, 70000], [765], [7, 1 << 20, 1 << 33], [65535, 131071]):
        a = np.array(cells, np.int64)
        assert sd.decode_cells(sd.encode_cells(a)).tolist() == cells


def test_steps_round_trip():
    import numpy as np
    for kind in (np.uint32, np.int64):
        for a in ([], [5], [7, 3, 3, 900, 0]):
            a = np.array(a, kind)
            assert sd.unpack_steps(sd.pack_steps(a), kind).tolist() == a.tolist()


def test_very_long_text(spark, frame):
    """A text of 3 MB whose second half repeats its first, longer than a chunk."""
    half = " ".join(f"w{i * 7919 % 1000003}" for i in range(200_000))
    got = result(sd.substring_dedup(frame([half + " " + half, "w0 w7919"]), 20, chunk_bytes=1 << 20))
    assert got[0][:2] == (400_000, 200_000) and got[0][3] == half and got[1][1] == 0


def test_prefilter_passes_few_unrepeated_windows(spark, frame):
    """Without a cap the sketch grows with the input, so the share stays."""
    for n in (300, 3000):
        texts = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(n)]
        chunks = sd.chunked(frame(texts).select("doc_id", "text").withColumnRenamed("doc_id", "id"), 1 << 20)
        plan = sd.Plan(chunks.agg({"n_bytes": "sum"}).first()[0], 20)
        passed = sum(len(r.pos) // 4 for r in sd.marked_windows(chunks, plan).collect())
        assert passed < 0.08 * n * 41
