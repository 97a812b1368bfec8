"""Merkle manifest of a dataset, with an incremental witness for every row.

A row's leaf is a digest of its columns.  The leaves of a group (a language)
stand in order of their id and form a binary tree: two neighbours become the
digest of both, a last one without a neighbour the digest of itself.  The roots
of the groups, in order of the groups, form a tree in the same way.

*Streaming aligned append*: a task takes an aligned block of nodes one by one and
keeps a stack of open subtrees (``Frontier``).  A node's witness is partial at
first, empty; whenever two subtrees of one height are complete, each gives its
digest to the witnesses of the other's nodes.  Block roots are appends of the
next level, over blocks of blocks, until a group has one root.  A block's own
witness then extends those of its nodes by one join: a block holds at most
``1 << BLOCK`` nodes, so no key of that join is hot, however large a group is.

Texts are read once and never shuffled: what moves is 80 bytes a row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.positions import global_positions, group_positions
from .common import _short_batches, stored

BLOCK = 12      # levels of a block: 4096 nodes


def digest(data: bytes) -> bytes:
    """SHA-256 as lowercase hex text, which is what parents hash."""
    return hashlib.sha256(data).hexdigest().encode()


class Frontier:
    """Open aligned subtrees over nodes 0, 1, .. and the witnesses so far."""

    def __init__(self, n: int, levels: int):
        self.n = 0
        self.open: list[tuple[int, bytes, int]] = []        # level, digest, first node
        self.has = np.zeros((n, levels), bool)              # is there a sibling at that level
        self.siblings = np.zeros((n, levels), "V32")

    def append(self, node: bytes) -> None:
        """The next node; every pair of subtrees that it completes is merged."""
        top = (0, node, self.n)
        self.n += 1
        while self.open and self.open[-1][0] == top[0]:
            top = self._merge(self.open.pop(), top)
        self.open.append(top)

    def _merge(self, left, right):
        level, a, first = left
        _, b, middle = right
        for lo, hi, sibling in ((first, middle, b), (middle, self.n, a)):
            self.has[lo:hi, level] = True
            self.siblings[lo:hi, level] = np.void(bytes.fromhex(sibling.decode()))
        return level + 1, digest(a + b), first

    def close(self, height: int) -> tuple[bytes, int]:
        """No more nodes: short last runs rise alone, at least to ``height``.
        Returns the root and its height."""
        top = self.open.pop()
        while self.open or top[0] < height:
            if self.open and self.open[-1][0] == top[0]:
                top = self._merge(self.open.pop(), top)
            else:
                top = (top[0] + 1, digest(top[1]), top[2])
        return top[1], top[0]


_GROWN = "height int, has long, siblings binary, top binary"


def _block(group: pa.Table, bits: int) -> pa.Table:
    """Witnesses inside one aligned block, and its root at its first node."""
    group = group.sort_by("pos")
    nodes = [x.as_py().hex().encode() for x in group["node"]]
    tree = Frontier(len(nodes), bits)
    for node in nodes:
        tree.append(node)
    root, height = tree.close(bits if group["pos"][0].as_py() >> bits else 0)
    sizes = 32 * tree.has.sum(1)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    siblings = pa.Array.from_buffers(pa.binary(), len(nodes), [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(tree.siblings[tree.has].tobytes())])
    has = (tree.has.astype(np.int64) << np.arange(bits)).sum(1)
    return (group.append_column("height", pa.array(np.full(len(nodes), height, np.int32)))
            .append_column("has", pa.array(has, pa.int64())).append_column("siblings", siblings)
            .append_column("top", pa.array([bytes.fromhex(root.decode())] + [None] * (len(nodes) - 1), pa.binary())))


def _grow(nodes: DataFrame, bits: int) -> DataFrame:
    """One level of blocks over (tree, pos, node, ..): witnesses inside the block."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return stored(nodes.groupBy("tree", F.shiftright("pos", bits).alias("block"))
                  .applyInArrow(lambda g: _block(g, bits), f"{schema}, {_GROWN}"), "merkle")


def _tops(grown: DataFrame, bits: int) -> DataFrame:
    return grown.where("top is not null").select("tree", F.shiftright("pos", bits).alias("pos"), F.col("top").alias("node"))


def _extend(rows: DataFrame, outer: DataFrame, bits: int) -> DataFrame:
    """Witnesses of ``rows`` extended by those of their blocks (tree, pos, ..)."""
    o = outer.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("height").alias("_height"),
                     F.col("has").alias("_has"), F.col("siblings").alias("_siblings"),
                     *[c for c in outer.columns if c not in rows.columns])
    joined = rows.join(o, F.col("tree").eqNullSafe(F.col("_tree")) & (F.shiftright("pos", bits) == F.col("_pos")))
    return (joined.withColumn("has", F.col("has").bitwiseOR(F.expr("shiftleft(_has, height)")))
            .withColumn("height", F.col("height") + F.col("_height"))
            .withColumn("siblings", F.concat("siblings", "_siblings"))
            .drop("_tree", "_pos", "_height", "_has", "_siblings"))


def _forest(nodes: DataFrame, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """Block levels over (tree, pos, node, ..), the leaves' first, and the root of
    each tree (tree, pos = 0, node)."""
    levels = [_grow(nodes, bits)]
    while True:
        tops = _tops(levels[-1], bits)
        if tops.where("pos > 0").limit(1).count() == 0:
            return levels, tops
        levels.append(_grow(tops, bits))


def leaf(docs: DataFrame, changed: dict[str, Column] | None = None,
         columns=("doc_id", "source", "lang", "n_chars", "text")) -> Column:
    """SHA-256 of the columns: ``-`` for a null, else byte count, colon, value.
    ``changed`` gives other values for some of them."""
    def field(c):
        v = (changed or {}).get(c, docs[c]).cast("string")
        return F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))

    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def manifest(docs: DataFrame, others: dict[str, Column] | None = None, id_col: str = "doc_id", group_col: str = "lang",
             columns=("doc_id", "source", "lang", "n_chars", "text"), bits: int = BLOCK) -> DataFrame:
    """Leaf, tree position and witness of every row of ``docs``.

    Returns doc_id, the columns ``others`` (computed in the same scan), leaf,
    subroot, root (binary digests), pos (the row's place in its group), height,
    has (bit l: there is a sibling at level l), siblings (32 bytes each, leaf to
    subroot), and group_pos, group_height, group_has, group_siblings (subroot to
    root).  A null text or any other null column counts as null, not as empty;
    rows without an id or group are rows like any other and stand first; repeated
    rows stand side by side, rows that share an id by their leaf.  Texts of any
    length are hashed whole.  Empty table: empty result.  Extra columns are not
    read.
    """
    _short_batches(docs.sparkSession)
    extra = others or {}
    leaves = stored(docs.select(docs[group_col].alias("tree"), docs[id_col].cast("long").alias("doc_id"),
                                leaf(docs, columns=columns).alias("node"), *[c.alias(n) for n, c in extra.items()]), "leaves")
    placed, _ = group_positions(leaves, ["tree"], ["doc_id", "node"])
    levels, subroots = _forest(placed, bits)

    # the groups' own tree: one more forest, of one tree
    groups = subroots.select(F.col("tree").alias("name"), F.col("node").alias("subroot"))
    ordered, _ = global_positions(groups, ["name"])
    upper, top = _forest(ordered.select(F.lit(0).alias("tree"), "pos", F.col("subroot").alias("node"), "name"), bits)
    path = _chain(upper, bits)
    root = top.first()      # one row, none for an empty table
    group_paths = stored(path.select(
        F.col("name").alias("tree"), F.col("node").alias("subroot"), F.lit(root and root["node"]).cast("binary").alias("root"),
        F.col("pos").alias("group_pos"), F.col("height").alias("group_height"), F.col("has").alias("group_has"),
        F.col("siblings").alias("group_siblings")), "group-paths")

    outer = _chain(levels[1:], bits) if len(levels) > 1 else _alone(subroots)
    g = group_paths.withColumnRenamed("tree", "_name")
    outer = outer.drop("node", "top").join(g, F.col("tree").eqNullSafe(F.col("_name"))).drop("_name")
    out = _extend(levels[0], outer, bits).withColumnRenamed("node", "leaf")
    return out.select("doc_id", *extra, "leaf", "subroot", "root", "pos", "height", "has", "siblings",
                      "group_pos", "group_height", "group_has", "group_siblings")


def _alone(tops: DataFrame) -> DataFrame:
    """The empty witness of trees that are one block."""
    return tops.select("tree", "pos", "node", F.lit(0).alias("height"), F.lit(0).cast("long").alias("has"),
                       F.lit(b"").alias("siblings"))


def _chain(levels: list[DataFrame], bits: int) -> DataFrame:
    """Whole witnesses of the first level's nodes, from the top level down."""
    path = levels[-1]
    for lower in reversed(levels[:-1]):
        path = _extend(lower, path.drop("node", "top", "name"), bits)
    return path


def fold(node: bytes, pos: int, height: int, has: int, siblings: bytes) -> bytes:
    """Root (hex) that a node (hex) and its witness lead to."""
    at = 0
    for level in range(height):
        if has >> level & 1:
            s = siblings[at:at + 32].hex().encode()
            at += 32
            node = digest(s + node if pos >> level & 1 else node + s)
        else:
            node = digest(node)
    return node


def verified(rows: DataFrame, leaf_col: str = "leaf") -> DataFrame:
    """Rows of ``manifest`` folded from ``leaf_col`` along their own witnesses:
    doc_id, leaf, subroot, root, proof_sha256 (digest of all siblings), folded_root
    and whether it equals the root; digests as hex text."""
    cols = ["doc_id", "leaf", "subroot", "root", "_from", "pos", "height", "has", "siblings",
            "group_pos", "group_height", "group_has", "group_siblings"]

    def run(batches):
        for batch in batches:
            out = []
            for i, lf, sub, root, start, *w in zip(*[batch.column(c).to_pylist() for c in cols]):
                near, far = w[:4], w[4:]
                got = fold(fold(start.hex().encode(), *near), *far).decode()
                proof = digest((near[3] + far[3]).hex().encode()).decode()
                out.append((i, lf.hex(), sub.hex(), root.hex(), proof, got, got == root.hex()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), _VERIFIED)], schema=_VERIFIED)

    return rows.withColumn("_from", rows[leaf_col]).select(*cols).mapInArrow(
        run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


_VERIFIED = pa.schema([("doc_id", pa.int64()), *((c, pa.string()) for c in (
    "leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())])


def tampered(docs: DataFrame, share: int = 7, id_col: str = "doc_id") -> Column:
    """Leaves as if, where ``share`` divides the crc32 of the id as text, one had
    been added to n_chars (nulls stay)."""
    hit = F.crc32(docs[id_col].cast("string").cast("binary")) % share == 0
    more = (docs["n_chars"].cast("decimal(20,0)") + 1).cast("string")
    return F.when(hit & docs["n_chars"].isNotNull(), leaf(docs, {"n_chars": more})).otherwise(leaf(docs))


def audit(docs: DataFrame, bits: int = BLOCK) -> DataFrame:
    """Manifest of ``docs`` and the check of each row against it after tampering
    with a fixed seventh of the ids: the witnesses must expose just those."""
    return verified(manifest(docs, {"found": tampered(docs)}, bits=bits), "found")
