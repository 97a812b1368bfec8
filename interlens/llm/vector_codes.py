"""Compression of vectors to one code byte a part, by bounded codebook search.

Vectors become integers and are cut into equal parts, each with a codebook that
is refined in rounds: every part goes to its nearest entry, then entries become
the (floored) means of their parts.  Distances are exact integers.

*Norm-of-sum bounds*: a row keeps, for each part and each group of entries, a lower
bound of the distance to every entry of the group but its own, and the round in
which that bound was measured (its stamp).  All codebooks so far are kept, so at
round t a bound of round s loses the true displacement |entry(t) - entry(s)| of the
group's farthest mover, the norm of the sum of its moves.  That is never more, and
with entries that swing back much less, than the sum of the moves' norms.  A group
whose bound stays above the distance to the row's own entry is passed over; any
other is rescanned exactly and its bound stamped anew.  Bounds are rounded down,
and an equal distance is never passed over, so ties go to the lower index.

The codebooks have a fixed size (parts x entries x length, one set a round): they
are what is broadcast.  Tasks send one sum per entry and coordinate; the vectors
stay where they are, and a round's rows are written once.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_small
from .common import _short_batches, release, stored

GROUPS = 8
_FAR = np.iinfo(np.int64).max


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows x entries) of int64 vectors."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)), 1)
    if 4 * x.shape[1] * top * top < 1 << 53:        # every step is a whole number that a double holds
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.zeros((len(x), len(c)), np.int64)
    for i in range(x.shape[1]):
        step = x[:, i][:, None] - c[:, i][None, :]
        out += step * step
    return out


def entry_groups(codebook: np.ndarray, n: int) -> list[np.ndarray]:
    """Entries of one part in ``n`` groups of neighbours: cut in half, again and
    again, along the widest coordinate; ascending inside a group."""
    parts = [np.arange(len(codebook))]
    while len(parts) < n and max(map(len, parts)) > 1:
        big = max(range(len(parts)), key=lambda i: len(parts[i]))
        own = parts.pop(big)
        c = codebook[own]
        axis = int(np.argmax(c.max(0) - c.min(0)))
        order = own[np.argsort(c[:, axis], kind="stable")]
        parts += [np.sort(order[:len(order) // 2]), np.sort(order[len(order) // 2:])]
    return parts


class History:
    """Codebooks of all rounds so far (parts x entries x length each), the groups
    of entries, and how far each group has moved from any round to the last."""

    def __init__(self, first: np.ndarray, groups: int = GROUPS):
        self.books = [first]
        self.groups = [entry_groups(c, groups) for c in first]
        self.moved: list[np.ndarray] = []
        self._measure()

    def add(self, book: np.ndarray) -> None:
        self.books.append(book)
        self._measure()

    def _measure(self) -> None:
        last = self.books[-1]
        self.moved = [np.array([[math.sqrt(max(((last[p][g] - book[p][g]) ** 2).sum(1).max(), 0)) * (1 + 1e-9) for g in groups]
                                for p, groups in enumerate(self.groups)]) for book in self.books]

    @property
    def round(self) -> int:
        return len(self.books) - 1


def _down(d2: np.ndarray) -> np.ndarray:
    """Distances from squares, rounded down to float32; none: infinite."""
    return np.where(d2 == _FAR, np.inf, np.sqrt(d2.astype(np.float64)) * (1 - 1e-6)).astype(np.float32)


def assign(x: np.ndarray, part: int, h: History, near=None, bound=None, stamp=None):
    """Nearest entry of every row of one part: (entry, squared distance, bounds,
    stamps, groups scanned).  Without a state every group is scanned."""
    book, groups, t = h.books[-1][part], h.groups[part], h.round
    n, g_n = len(x), len(groups)
    if near is None:
        own, own_d = np.full(n, len(book)), np.full(n, _FAR)
        now = np.zeros((n, g_n))
        bound, stamp = np.zeros((n, g_n), np.float32), np.zeros((n, g_n), np.uint8)
        scan = np.ones((n, g_n), bool)
    else:
        own = near.astype(np.int64)
        own_d = ((x - book[own]) ** 2).sum(1)
        drift = np.stack([m[part] for m in h.moved])                    # rounds x groups
        now = bound - drift[stamp, np.arange(g_n)[None, :]] * (1 + 1e-6)
        scan = now <= np.sqrt(own_d.astype(np.float64))[:, None] * (1 + 1e-6)
    best, best_d = own.copy(), own_d.copy()
    first, first_d, second_d = (np.full((n, g_n), v) for v in (-1, _FAR, _FAR))
    for g, entries in enumerate(groups):
        rows = np.flatnonzero(scan[:, g])
        if not len(rows):
            continue
        d = squared(x[rows], book[entries])
        at = d.argmin(1)
        k = np.arange(len(rows))
        first[rows, g], first_d[rows, g] = entries[at], d[k, at]
        d[k, at] = _FAR
        second_d[rows, g] = d.min(1)
        better = (first_d[rows, g] < best_d[rows]) | ((first_d[rows, g] == best_d[rows]) & (first[rows, g] < best[rows]))
        best[rows[better]], best_d[rows[better]] = first[rows[better], g], first_d[rows[better], g]
    bound, stamp = bound.copy(), stamp.copy()
    fresh = _down(np.where(first == best[:, None], second_d, first_d))
    bound[scan], stamp[scan] = fresh[scan], t
    if near is not None:        # a group passed over gets its row's former entry back
        of = np.empty(len(book), np.int64)
        for g, entries in enumerate(groups):
            of[entries] = g
        lost = np.flatnonzero((best != own) & ~scan[np.arange(n), of[own]])
        g = of[own[lost]]
        bound[lost, g] = np.minimum(now[lost, g] * (1 - 1e-6), _down(own_d[lost]))
        stamp[lost, g] = t
    return best, best_d, bound, stamp, int(scan.sum())


_STATE = "vec_id long, label string, ints binary, near binary, bound binary, stamp binary, error long"


def _ints(column, d: int, scale: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = np.floor(flat * scale).reshape(-1, d)
    if v.size and np.abs(v).max() >= math.isqrt((1 << 61) // d):
        raise ValueError("vector components are too large for exact 64-bit distances")
    return v.astype(np.int64)


def _pack(a: np.ndarray, dtype) -> pa.Array:
    """One blob a row."""
    a = np.ascontiguousarray(a.reshape(len(a), -1).astype(dtype))
    width = a.shape[1] * a.itemsize
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer((np.arange(len(a) + 1) * width).astype(np.int32).tobytes()),
                                                       pa.py_buffer(a.tobytes())])


def _unpack(blobs, dtype, shape) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), dtype).reshape(len(blobs), *shape)


def _narrow(v: np.ndarray):
    """Smallest integer type that holds all values."""
    top = np.abs(v).max(initial=0)
    return np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64


def _integers(blobs, d: int) -> np.ndarray:
    """Rows of ``_pack``ed integers, whose type may differ from batch to batch."""
    size = np.array([len(b) for b in blobs.to_pylist()]) // d
    out = np.zeros((len(blobs), d), np.int64)
    for s in np.unique(size):
        at = np.flatnonzero(size == s)
        out[at] = _unpack(blobs.take(pa.array(at)), f"<i{s}", (d,))
    return out


def _assigned(rows: DataFrame, d: int, parts: int, scale: int, history, first: bool) -> DataFrame:
    """One assignment round: raw rows (vec_id, label, vector) in the
    first, else rows of the round before."""
    w = d // parts

    def run(batches):
        h = history.value
        shape = (parts, len(h.groups[0]))
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _ints(batch.column("vector"), d, scale) if first else _integers(batch.column("ints"), d)
            x = v.reshape(-1, parts, w)
            if not first:
                near = _unpack(batch.column("near"), np.uint8, (parts,))
                bound = _unpack(batch.column("bound"), np.float32, shape)
                stamp = _unpack(batch.column("stamp"), np.uint8, shape)
            got = [assign(x[:, p], p, h, *(() if first else (near[:, p], bound[:, p], stamp[:, p]))) for p in range(parts)]
            error = sum(e[1] for e in got)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "label")), _pack(v, _narrow(v)),
                 _pack(np.stack([e[0] for e in got], 1), np.uint8), _pack(np.stack([e[2] for e in got], 1), np.float32),
                 _pack(np.stack([e[3] for e in got], 1), np.uint8), pa.array(error, pa.int64())],
                ["vec_id", "label", "ints", "near", "bound", "stamp", "error"])

    return rows.mapInArrow(run, _STATE)


def _sums(rows: DataFrame, d: int, parts: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums (parts x entries x length, Python integers) and counts of the parts of
    every entry: one row a task and non-empty cell, added up by a shuffle."""
    w = d // parts

    def run(batches):
        total = np.zeros((parts * k, w + 1), np.int64)
        for batch in batches:
            x = _integers(batch.column(0), d).reshape(-1, parts, w)
            near = _unpack(batch.column(1), np.uint8, (parts,))
            for p in range(parts):
                order = np.argsort(near[:, p], kind="stable")
                own = near[order, p].astype(np.int64)
                cut = np.flatnonzero(np.diff(own, prepend=-1))
                if len(cut):
                    one = np.ones((len(x), 1), np.int64)
                    total[p * k + own[cut]] += np.add.reduceat(np.concatenate([x[order, p], one], 1), cut, axis=0)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.ravel()[cell])], ["cell", "total"])

    out = np.zeros(parts * k * (w + 1), object)
    for r in (rows.select("ints", "near").mapInArrow(run, "cell long, total long").groupBy("cell")
              .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()):
        out[r["cell"]] = int(r["total"])
    out = out.reshape(parts, k, w + 1)
    return out[:, :, :w], out[:, :, w]


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, groups: int = GROUPS,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Code of every vector, and the final codebooks' digest.

    Returns vec_id, code (two hex digits a part), error (squared distance to the
    coded vector), label_error (errors summed over equal labels, nulls together)
    and codebooks_sha256.  Component x counts as floor(scale * x).  A null or
    empty vector and one with a null, NaN or infinite component are left out; so is
    one whose length is not that of the vector with the smallest id (a length that ``parts``
    does not divide raises, as do components over about 2**28 / scale).  Rows
    without an id are coded, but never seed a codebook.  Of rows with one id, those
    with the smaller vectors seed first; equal vectors get equal codes, and an
    entry with an equal twin of lower index stays unused.  With fewer than
    ``entries`` vectors the codebook is as small.  Empty table: empty result.
    Extra columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("codes are one byte a part")
    spark = vectors.sparkSession
    _short_batches(spark)
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[label_col].cast("string").alias("label"),
                          vectors[vector_col].cast("array<double>").alias("vector")).where((F.size("vector") > 0) & finite)
    seeded = kept.where("vec_id is not null").orderBy("vec_id", "vector")
    lead = seeded.select(F.size("vector")).first()
    if lead is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    d = lead[0]
    if d % parts:
        raise ValueError(f"vectors of {d} components have no {parts} equal parts")
    kept = kept.where(F.size("vector") == d)
    seeds = _ints(pa.array([r["vector"] for r in seeded.where(F.size("vector") == d).limit(entries).collect()],
                           pa.list_(pa.float64())), d, scale)
    k = len(seeds)
    h = History(np.ascontiguousarray(seeds.reshape(k, parts, d // parts).transpose(1, 0, 2)), groups)

    rows = kept
    for t in range(rounds + 1):
        known = spark.sparkContext.broadcast(h)
        last, rows = rows, stored(_assigned(rows, d, parts, scale, known, t == 0), "codes")
        if t:
            release(last)
        known.unpersist()
        if t < rounds:
            total, count = _sums(rows, d, parts, k)
            book = h.books[-1].copy()
            for p, j in zip(*np.nonzero(count)):
                book[p, j] = [int(s) // int(count[p, j]) for s in total[p, j]]
            h.add(book)

    final = hashlib.sha256(",".join(str(v) for v in h.books[-1].ravel().tolist()).encode()).hexdigest()
    coded = rows.select("vec_id", "label", F.lower(F.hex("near")).alias("code"), "error")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return join_small(coded, by_label, "label", null_safe=True).select(
        "vec_id", "code", "error", "label_error", F.lit(final).alias("codebooks_sha256"))
