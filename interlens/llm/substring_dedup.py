"""Substring deduplication by a distributed count-min prefilter.

Texts are written once as *chunks* (one row of some whole documents each), so that
whatever is sent about a chunk later meets exactly the same documents again.

Pass 1: every chunk names the cells of its word windows in a sketch of two rows,
by slice of the sketch; a task merges the messages of one slice, each cell counted
up to 2, and answers every message with **one bit for each cell that it named**.
The sketch is never in one place and never broadcast: it has about ``CELLS`` cells
a window however large the input is.  A merged sketch can only overestimate, so no
repeated window is lost.

Pass 2: a chunk joins its answers, hashes its texts again and sends only windows
whose two cells were both counted twice or more.  Each is grouped by 96 hash bits
of its 20 words; every occurrence after the first one, in the order (document id,
start), covers words that are removed.

A chunk sends one occurrence for each distinct window (its first); the later ones
inside the chunk are known to be removed at once.  So a window that a third of all
rows share costs one entry per chunk, not one per row.

At last every chunk joins the places of its repeats and gives out what is left.
The chunks lie in buckets of their number, so both joins move the small side only:
no text is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import bucketed, id_text, slices_for, stored

CHUNK = 4 << 20         # bytes of text in a chunk; a longer document is one of its own
ROWS = 2
CELLS = 4               # cells a window in each row of the sketch
_TEXTS = pa.schema([("id", pa.int64()), ("text", pa.large_string())])


def encode_cells(cells: np.ndarray) -> bytes:
    """Sorted distinct cell numbers as gaps, in byte planes of the narrowest type."""
    gap = np.diff(cells, prepend=0)
    top = int(gap.max(initial=0))
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64
    return bytes([np.dtype(kind).itemsize]) + tv.pack(gap.astype(kind))


def decode_cells(blob: bytes) -> np.ndarray:
    size = blob[0]
    planes = np.frombuffer(blob, np.uint8, offset=1).reshape(size, -1).T
    return np.cumsum(np.ascontiguousarray(planes).view(f"<u{size}").ravel(), dtype=np.int64)


def pack_steps(a: np.ndarray) -> bytes:
    """Byte planes of the steps between neighbours: places in text order take next
    to nothing once compressed."""
    return tv.pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_steps(blob: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    steps = np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).view(dtype).ravel()
    return np.cumsum(steps, dtype=dtype)


def _pack_chunk(ids: list, texts: list) -> bytes:
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.large_string())], schema=_TEXTS)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _TEXTS, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _open_chunk(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_next_batch()


def chunked(texts: DataFrame, limit: int) -> DataFrame:
    """(chunk, payload, n_bytes): the rows of (id, text) in chunks of about ``limit``
    bytes, written once, in buckets of the chunk: answers and repeats come to them."""
    def run(batches):
        ids, held, size = [], [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array([_pack_chunk(ids, held)], pa.binary()), pa.array([size], pa.int64())],
                                              ["payload", "n_bytes"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = len(t.encode())
                if held and size + n > limit:
                    yield out()
                    ids, held, size = [], [], 0
                ids.append(i)
                held.append(t)
                size += n
        if held:
            yield out()

    return bucketed(texts.mapInArrow(run, "payload binary, n_bytes long").withColumn("chunk", F.monotonically_increasing_id()),
                    "chunks", "chunk")


class Plan:
    """Sizes of the sketch and of the messages, from the bytes of all texts."""

    def __init__(self, n_bytes: int, window: int, sketch_bytes: int | None = None):
        self.window = window
        windows = max(n_bytes // 6, 1 << 14)        # words of six bytes
        # messages of one slice are about 8 MB; slices are whole numbers of cells
        self.slices = slices_for(windows, 4 << 20, least=16)
        width = CELLS * windows if sketch_bytes is None else max(sketch_bytes * 8 // ROWS, 1)
        self.span = -(-width // self.slices)
        self.width = self.span * self.slices
        self.groups = slices_for(n_bytes, 16 << 20)

    def cells(self, h: np.ndarray, row: int) -> np.ndarray:
        """Cell of each window in a row of the sketch."""
        return (tv.mix(h + tv.U64(row + 1)) % tv.U64(self.width)).astype(np.int64)


def _windows(chunk: pa.RecordBatch, window: int, second: bool = False):
    """(row of the chunk, start, hash, second hash) of all windows, piece by piece."""
    parts = []
    for c in tv.chunks(chunk.column(1)):
        w = tv.words(c)
        at, h = tv.windows(w, window)
        doc = w.doc[at]
        g = (tv.windows(w, window, second=True)[1] >> tv.U64(32)).astype(np.uint32) if second else None
        parts.append(((c.first + doc).astype(np.uint32), (at - w.first[doc]).astype(np.uint32), h, g))
    if not parts:
        return (np.zeros(0, np.uint32),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.uint32))
    return tuple(np.concatenate([p[k] for p in parts]) if parts[0][k] is not None else None for k in range(4))


def _messages(plan: Plan):
    """A chunk's cells by slice of the sketch: distinct, sorted, and which it has
    twice or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column(0), batch.column(1)):
                _, _, h, _ = _windows(_open_chunk(payload.as_py()), plan.window)
                for row in range(ROWS):
                    cell, n = np.unique(plan.cells(h, row), return_counts=True)
                    part = cell // plan.span
                    cut = np.flatnonzero(np.diff(part, prepend=-1))
                    ends = [*cut[1:], len(cell)]
                    if not len(cut):
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((row * plan.slices + part[cut]).astype(np.int32)), pa.array([chunk.as_py()] * len(cut), pa.int64()),
                         pa.array([encode_cells(cell[a:b] - part[a] * plan.span) for a, b in zip(cut, ends)], pa.binary()),
                         pa.array([np.packbits(n[a:b] > 1).tobytes() for a, b in zip(cut, ends)], pa.binary())],
                        ["slice", "chunk", "cells", "twice"])
    return run


def _answers(span: int):
    """Merge the messages of one slice and answer each: a bit a cell, set where the
    merged count is two or more."""
    def run(group: pa.Table) -> pa.Table:
        count = np.zeros(span, np.uint8)
        for cells, twice in zip(group["cells"], group["twice"]):
            at = decode_cells(cells.as_py())
            more = np.unpackbits(np.frombuffer(twice.as_py(), np.uint8), count=len(at))
            count[at] = np.minimum(count[at] + 1 + more, 2)
        bits = [np.packbits(count[decode_cells(x.as_py())] > 1).tobytes() for x in group["cells"]]
        return pa.table({"chunk": group["chunk"].cast(pa.int64()), "slice": group["slice"].cast(pa.int32()),
                         "bits": pa.array(bits, pa.binary())})
    return run


def _marked(h: np.ndarray, answers: pa.Table, plan: Plan) -> np.ndarray:
    """Windows of a chunk whose cells were answered with ones in every row."""
    order = np.argsort(answers["slice"].to_numpy())
    slices, bits = answers["slice"].to_numpy()[order], answers["bits"].to_pylist()
    ok = np.ones(len(h), bool)
    for row in range(ROWS):
        cell, back = np.unique(plan.cells(h, row), return_inverse=True)
        part, n = np.unique(cell // plan.span, return_counts=True)
        mine = order[(slices >= row * plan.slices) & (slices < (row + 1) * plan.slices)]
        if len(mine) != len(part):
            raise RuntimeError("a chunk's answers do not match its messages")
        mark = np.concatenate([np.unpackbits(np.frombuffer(bits[k], np.uint8), count=c) for k, c in zip(mine, n)]) if len(n) else cell
        ok &= mark.astype(bool)[back]
    return ok


_ENTRY = "slice int, chunk long, known boolean, h binary, g binary, id binary, row binary, pos binary"
_ENTRY_PA = pa.schema([("slice", pa.int32()), ("chunk", pa.int64()), ("known", pa.bool_()),
                       *((c, pa.binary()) for c in ("h", "g", "id", "row", "pos"))])


def _candidates(plan: Plan):
    """Occurrences of the marked windows of one chunk: the first of each distinct
    window, by hash group, and the later ones, already known as repeats."""
    def run(key, chunk: pa.Table, answers: pa.Table) -> pa.Table:
        docs = _open_chunk(chunk["payload"][0].as_py())
        ids = docs.column(0).to_numpy()
        row, pos, h, g = _windows(docs, plan.window, second=True)
        keep = np.flatnonzero(_marked(h, answers, plan))
        row, pos, h, g = row[keep], pos[keep], h[keep], g[keep]
        did = ids[row.astype(np.int64)]
        order = np.lexsort((row, pos, did, g, h))
        same = (h[order][1:] == h[order][:-1]) & (g[order][1:] == g[order][:-1])
        lead = np.concatenate([[True], ~same])[:len(order)]
        head = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
        later = np.zeros(len(order), bool)
        later[order] = (did[order] != did[head]) | (pos[order] != pos[head])
        # rows of one id may hold the same window at the same place: neither is later
        rows = []
        own = key[0].as_py()
        for known, pick in ((False, np.flatnonzero(~later)), (True, np.flatnonzero(later))):
            slot = np.full(len(pick), own % plan.groups) if known else (h[pick] >> tv.U64(20)) % tv.U64(plan.groups)
            slot = slot.astype(np.int32)
            by = np.argsort(slot, kind="stable")
            pick, slot = pick[by], slot[by]
            cut = np.flatnonzero(np.diff(slot, prepend=-1))
            for a, b in zip(cut, [*cut[1:], len(pick)]):
                p = pick[a:b]
                rows.append((int(slot[a]), own, known, b"" if known else tv.pack(h[p]), b"" if known else tv.pack(g[p]),
                             b"" if known else tv.pack(did[p]), pack_steps(row[p]), pack_steps(pos[p])))
        cols = list(zip(*rows)) if rows else [[]] * len(_ENTRY_PA)
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, _ENTRY_PA)], schema=_ENTRY_PA)
    return run


_FOUND = "chunk long, row binary, pos binary"


def _repeats(group: pa.Table) -> pa.Table:
    """Occurrences after the first one, by chunk."""
    sent = group.filter(pc.invert(group["known"]))
    known = group.filter(group["known"])
    out = [(c, r, p) for c, r, p in zip(known["chunk"].to_pylist(), known["row"].to_pylist(), known["pos"].to_pylist())]
    h, g, did = tv.unpack(sent["h"], np.uint64), tv.unpack(sent["g"], np.uint32), tv.unpack(sent["id"], np.int64)
    if len(h):
        rows = [unpack_steps(x.as_py(), np.uint32) for x in sent["row"]]
        row, pos = np.concatenate(rows), np.concatenate([unpack_steps(x.as_py(), np.uint32) for x in sent["pos"]])
        chunk = np.repeat(sent["chunk"].to_numpy(), [len(r) for r in rows])
        order = np.lexsort((pos, did, g, h))
        h, g, did, pos, row, chunk = (x[order] for x in (h, g, did, pos, row, chunk))
        lead = np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
        head = np.maximum.accumulate(np.where(lead, np.arange(len(h)), 0))
        later = (did != did[head]) | (pos != pos[head])
        chunk, row, pos = chunk[later], row[later], pos[later]
        order = np.lexsort((pos, row, chunk))
        chunk, row, pos = chunk[order], row[order], pos[order]
        cut = np.flatnonzero(np.diff(chunk, prepend=-1))
        out += [(int(chunk[a]), pack_steps(row[a:b]), pack_steps(pos[a:b])) for a, b in zip(cut, [*cut[1:], len(chunk)])]
    cols = list(zip(*out)) if out else [[]] * 3
    return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
                    names=["chunk", "row", "pos"])


_REST = "id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
_REST_PA = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                      ("kept_text", pa.string())])


def _rest(window: int):
    """What is left of each text of a chunk."""
    def run(chunk: pa.Table, found: pa.Table) -> pa.Table:
        docs = _open_chunk(chunk["payload"][0].as_py())
        row, pos = ([unpack_steps(x.as_py(), np.uint32) for x in found[c]] for c in ("row", "pos"))
        row, pos = (np.concatenate(x) if x else np.zeros(0, np.uint32) for x in (row, pos))
        order = np.lexsort((pos, row))
        row, pos = row[order], pos[order].astype(np.int64)
        first = np.searchsorted(row, np.arange(docs.num_rows + 1))
        out = []
        for i, (doc, text) in enumerate(zip(docs.column(0), docs.column(1))):
            words = text.as_py().encode().split()
            n = len(words)
            at = np.unique(pos[first[i]:first[i + 1]])
            if len(at):
                gone = np.zeros(n + 1, np.int32)
                gone[at] += 1
                np.subtract.at(gone, at + window, 1)
                words = [words[k] for k in np.flatnonzero(np.cumsum(gone[:n]) == 0)]
            kept = b" ".join(words)
            out.append((doc.as_py(), n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode()))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _REST_PA)], schema=_REST_PA)
    return run


def marked_windows(chunks: DataFrame, plan: Plan) -> DataFrame:
    """Entries of the windows that pass the prefilter (columns of ``_ENTRY``)."""
    answers = (chunks.select("chunk", "payload").mapInArrow(_messages(plan), "slice int, chunk long, cells binary, twice binary")
               .groupBy("slice").applyInArrow(lambda g: _answers(plan.span)(g), "chunk long, slice int, bits binary"))
    return (chunks.select("chunk", "payload").groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(lambda k, a, b: _candidates(plan)(k, a, b), _ENTRY))


def substring_dedup(docs: DataFrame, window: int = 20, sketch_bytes: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK) -> DataFrame:
    """Remove every word covered by a window of ``window`` words that also starts
    earlier (smaller id, or same document and earlier start).

    Returns one row per input row: doc_id, n_words, n_removed, kept_sha256,
    kept_text.  Null text: no words.  Rows without an id are left out.  Texts
    shorter than a window lose nothing; texts of any length are read whole.  Rows
    repeated with one id are no copies of each other (neither starts earlier); a
    different text under that id is compared by start alone.  Empty table: empty
    result.  Extra columns are not read.  ``sketch_bytes`` fixes the size of the
    whole sketch; left out, it grows with the input.  ``chunk_bytes``: text in a
    chunk; every chunk is a row and a file of its own, so tables of many terabytes
    want larger ones, at about 40 bytes of a task's memory per byte.
    """
    chunks = chunked(id_text(docs, id_col, text_col), chunk_bytes)
    n = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    plan = Plan(n, window, sketch_bytes)
    found = marked_windows(chunks, plan).groupBy("slice").applyInArrow(_repeats, _FOUND)
    rest = (chunks.select("chunk", "payload").groupBy("chunk").cogroup(stored(found, "repeats").groupBy("chunk"))
            .applyInArrow(lambda a, b: _rest(window)(a, b), _REST))
    return rest.withColumnRenamed("id", "doc_id")
