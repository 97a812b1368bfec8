"""Near duplicates by SimHash fingerprints and pivot distance tables.

A document's fingerprint has the majority bits of its shingles' hashes.  Two
fingerprints link when at most two bits differ.  Equal fingerprints are one
point, so copies, however many, are searched once.

*Pivot table*: every point's Hamming distances to fixed reference fingerprints
are computed once.  Two points that differ in d bits have distances to any
reference that differ by at most d, so a pair with a larger coordinate
difference is discarded unseen.  The references are the zero fingerprint, one
mask for each segment of two neighbouring bits, and ``SPREAD`` scattered ones.

The first two kinds route points to cells.  Distance to zero less distance to a
segment's mask gives the ones inside the segment; two differing bits touch at
most two segments, so of ``f`` families of segments a linking pair agrees on all
of at least f - 2.  A cell holds the points that agree on such a choice of
families.  More points take more families (finer cells, more copies of a point),
and cells that still hold over ``CELL`` points are dealt out again by the next
finer choice, so no cell is hot.  In a cell, points are ordered by their first
scattered coordinate: only those within two of it are paired, the other
coordinates discard most pairs, and the fingerprints themselves decide.

A task sends a spanning forest of the links it finds, not the links: points of a
dense cluster cost one edge each.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_small
from . import textvec as tv
from .common import connected, id_text, slices_for, stored

SEGMENTS = 32
SPREAD = 16
CELL = 8192
FAMILIES = (3, 6, 10, 16)
_STEP = 1 << 17

# reference fingerprints: zero, segment masks, scattered constants
_MASKS = np.uint64(3) << (np.uint64(2) * np.arange(SEGMENTS, dtype=np.uint64))
_SCATTERED = tv.mix(np.arange(1, SPREAD + 1, dtype=np.uint64))
PIVOTS = np.concatenate([np.zeros(1, np.uint64), _MASKS, _SCATTERED])


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> bytes:
    """Fingerprint (8 bytes, high first) of a text with A-Z already lowered."""
    words = text.split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    del words
    end = np.cumsum(size + 1) - 1
    start = end - size
    if len(end) > shingle:
        start, end = start[:1 - shingle], end[shingle - 1:]
    else:
        start, end = start[:1], end[-1:]
    n, ones, hashed = len(start), np.zeros(64, np.int64), xxhash.xxh64_digest
    for lo in range(0, n, _STEP):
        h = b"".join([hashed(joined[a:b], seed) for a, b in zip(start[lo:lo + _STEP].tolist(), end[lo:lo + _STEP].tolist())])
        # 64 one-byte counters a row, eight to a machine word, added 255 rows at a time
        lanes = np.unpackbits(np.frombuffer(h, np.uint8)).view(np.uint64).reshape(-1, 8)
        ones += np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0).view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(texts: DataFrame, shingle: int, seed: int) -> DataFrame:
    """(id, fp) of (id, text); fp as a signed long."""
    def run(batches):
        for batch in batches:
            raw = b"".join(fingerprint(t.as_py().lower(), shingle, seed) for t in batch.column(1).cast(pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.frombuffer(raw, ">i8").astype(np.int64))], ["id", "fp"])

    return texts.mapInArrow(run, "id long, fp long")


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """Hamming distances (points x pivots) to the reference fingerprints."""
    return np.bitwise_count(fp[:, None] ^ PIVOTS[None, :])


def routes(families: int) -> list[np.ndarray]:
    """The segments on which a linking pair may agree: all but two families."""
    part = np.array_split(np.arange(SEGMENTS), families)
    return [np.concatenate(c) for c in combinations(part, families - 2)]


def cells(points: DataFrame, families: int) -> DataFrame:
    """(cell, fp, spread) for every cell of every point."""
    def run(batches):
        chosen = routes(families)
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for lo in range(0, len(fp), 4096):
                part = fp[lo:lo + 4096]
                table = pivot_table(part)
                ones = (table[:, :1].astype(np.int64) + 2 - table[:, 1:1 + SEGMENTS]) // 2
                spread = table[:, 1 + SEGMENTS:].astype(np.uint8)
                blob = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(SPREAD), len(part), [None, pa.py_buffer(np.ascontiguousarray(spread).tobytes())]).cast(pa.binary())
                ids = pa.array(part.view(np.int64))
                for r, segments in enumerate(chosen):
                    code = (ones[:, segments].astype(np.uint64) << (np.uint64(2) * np.arange(len(segments), dtype=np.uint64))).sum(
                        1, dtype=np.uint64)
                    cell = tv.mix(code + np.uint64((r + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
                    yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), ids, blob], ["cell", "fp", "spread"])

    return points.mapInArrow(run, "cell long, fp long, spread binary")


def start_families(n: int) -> int:
    """Fewest families at which ``n`` scattered points meet at most a thousand
    others each (two random segments have equally many ones 3 times in 8)."""
    for f in FAMILIES:
        if n * sum((3 / 8) ** len(r) for r in routes(f)) <= 1000:
            return f
    return FAMILIES[-1]


def near(cell: np.ndarray, fp: np.ndarray, spread: np.ndarray, bits: int, block: int = 1 << 21):
    """Links (a, b) between the points of each cell, block by block of pairs."""
    order = np.lexsort((spread[:, 0], cell))
    cell, fp, spread = cell[order], fp[order], spread[order].astype(np.int16)
    place = np.cumsum(np.concatenate([[0], cell[1:] != cell[:-1]])) * 512 + spread[:, 0]
    n = len(place)
    last = np.searchsorted(place, place + bits, "right")
    before = np.concatenate([[0], np.cumsum(last - np.arange(n) - 1)])
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(before, before[lo] + block, "right")) - 1)
        count = last[lo:hi] - np.arange(lo, hi) - 1
        i = np.repeat(np.arange(lo, hi), count)
        j = np.arange(len(i)) - np.repeat(before[lo:hi] - before[lo], count) + i + 1
        for k in range(1, spread.shape[1]):
            if not len(i):
                break
            ok = np.abs(spread[i, k] - spread[j, k]) <= bits
            i, j = i[ok], j[ok]
        ok = np.bitwise_count(fp[i] ^ fp[j]) <= bits
        yield fp[i[ok]].view(np.int64), fp[j[ok]].view(np.int64)
        lo = hi


def _links(bits: int):
    def run(group: pa.Table) -> pa.Table:
        cell, fp = group["cell"].to_numpy(), group["fp"].to_numpy().view(np.uint64)
        spread = np.frombuffer(b"".join(group["spread"].to_pylist()), np.uint8).reshape(-1, SPREAD)
        a, b, held = [], [], 0
        for x, y in near(cell, fp, spread, bits):
            a.append(x)
            b.append(y)
            held += len(x)
            if held > 1 << 20:      # keep a spanning forest only
                node, root = tv.components(np.concatenate(a), np.concatenate(b))
                a, b, held = [node], [root], 0
        node, root = tv.components(np.concatenate(a), np.concatenate(b)) if held or a else (np.zeros(0, np.int64),) * 2
        edge = node != root
        return pa.table({"a": pa.array(node[edge], pa.int64()), "b": pa.array(root[edge], pa.int64())})
    return run


def links(points: DataFrame, n: int, bits: int = 2, families: int | None = None, cell_size: int = CELL) -> DataFrame:
    """Spanning links (a, b) of the ``n`` distinct fingerprints in (fp)."""
    found = None
    f = families or start_families(n)
    while True:
        finer = [x for x in FAMILIES if x > f]
        rows = cells(points, f)
        hot = None
        if finer:
            hot = stored(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_size).select("cell"), "hot-cells")
            if hot.limit(1).count():
                members = join_small(rows.select("cell", "fp"), hot, "cell", "left_semi").select("fp").distinct()
                rows = rows.join(hot, "cell", "left_anti")
            else:
                hot = None
        slices = slices_for(n * len(routes(f)) * 48)
        part = (rows.withColumn("slot", F.pmod(F.col("cell"), F.lit(slices))).groupBy("slot")
                .applyInArrow(lambda g: _links(bits)(g), "a long, b long"))
        part = stored(part, "simhash-links")
        found = part if found is None else found.union(part)
        if hot is None:
            return found
        points, f = stored(members, "hot-points"), finer[0]


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2, seed: int = 42, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Fingerprint and component of every document.

    Returns doc_id, fingerprint (16 hex digits) and component_id, the smallest
    doc_id reachable by links between fingerprints that differ in at most ``bits``
    bits (up to two).  Shingles are runs of ``shingle`` words, repeats counted; a
    shorter text is one shingle; a null, empty or blank text has fingerprint zero
    and links like any other.  Bits that exactly half the hashes have are 0.
    Rows without an id are left out; repeated rows have equal results.  Texts of
    any length are read whole.  Empty table: empty result.  Extra columns are not
    read.
    """
    if not 0 <= bits <= 2:
        raise ValueError("the routing of points to cells holds for at most 2 differing bits")
    prints = stored(fingerprints(id_text(docs, id_col, text_col), shingle, seed), "fingerprints")
    points = stored(prints.groupBy("fp").agg(F.min("id").alias("low")), "points")
    n = points.count()
    comp = connected(links(points.select("fp"), n, bits))
    linked = points.join(comp, F.col("fp") == F.col("node"))
    lows = linked.groupBy("component").agg(F.min("low").alias("least"))
    linked = linked.select("fp", "component").join(lows, "component").select(F.col("fp").alias("_fp"), "least")
    owner = points.join(linked, F.col("fp") == F.col("_fp"), "left").select("fp", F.coalesce("least", "low").alias("component_id"))
    out = join_small(prints, owner, "fp")
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
