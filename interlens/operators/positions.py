"""Positions inside ordered groups without a one-task window, and count expansion.

``cell_positions`` selects by order statistics: rows are counted by group, and a
group of over ``CELL`` rows is refined like a histogram: its rows are cut into
cells by equal ranges of the first order column in which they differ, and every
cell that is still too large again, until no (group, cell) is.  A row's position
is the weight of the cells before its own, from the counts, and its place inside
the cell, from a window over rows that one task can hold.  The input is not
sorted as a whole, only groups that are too large cost more than one count, and
all of it is JVM expressions.

``group_positions`` gives each row the number of (weighted) rows before it in
its group, in a total order.  A window ``partitionBy(group).orderBy(...)``
would put a whole group in one task; here the rows are range partitioned on
(group, order), sorted and checkpointed once, so a large group is spread over
many tasks, and positions are made in two passes over those partitions:

1. an aggregate reports each partition's first and last group with their
   weight sums (one row per partition reaches the driver);
2. the driver turns those into a carried offset for each partition whose
   first group continues from earlier partitions (a sparse map, shipped as a
   broadcast variable), and a narrow Arrow pass appends the position as one
   column.  The other columns pass through untouched, so every type and every
   null, NaN and large integer stays as it is.

``global_positions`` (one order, no groups, distinct rows) needs no Python:
per-partition counts give offsets, joined as a one-row-per-partition broadcast,
and ``monotonically_increasing_id`` on the sorted partition gives the rest.

The sort key must be a total order on the rows (collapse exact copies into a
weight first), so a recomputed partition yields the same positions.

``expand_counts`` turns (row, n) back into n rows.  A row with a huge count is
cut into chunks that are spread over tasks before they are exploded, so a
group of copies never lands in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .joins import join_small

_PID = "_pid"
_GKEY = "_gkey"
_W = "_w"


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")),
               spark.sparkContext.defaultParallelism)


def global_positions(df: DataFrame, order_cols, out: str = "pos",
                     num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """Add ``out`` (bigint, 0-based): the row's place in the total order.

    Range partitioning sorts the rows over many tasks; each partition's row
    count (one row per partition) gives its offset, and the row's index inside
    its partition comes from ``monotonically_increasing_id`` taken on the
    sorted partition.  The order must be total (e.g. distinct keys).
    """
    order_cols = list(order_cols)
    n = _num_partitions(df, num_partitions)
    ranged = cut_lineage(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                         .withColumn(_PID, F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()))
    counts = {r[0]: r[1] for r in ranged.groupBy(_PID).count().collect()}
    offsets, acc = {}, 0
    for pid in sorted(counts):
        offsets[pid], acc = acc, acc + counts[pid]
    if not offsets:
        return ranged.drop(_PID, "_mid").withColumn(out, F.lit(None).cast("long")), 0
    # one row per partition: a bounded broadcast
    off = df.sparkSession.createDataFrame(sorted(offsets.items()), f"{_PID} int, _off long")
    local = F.col("_mid") - F.shiftleft(F.col(_PID).cast("long"), 33)
    res = ranged.join(F.broadcast(off), _PID).withColumn(out, (F.col("_off") + local).cast("long"))
    return res.drop(_PID, "_mid", "_off"), acc


def group_positions(df: DataFrame, group_cols, order_cols, weight: str | None = None,
                    out: str = "pos", num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """Add ``out`` (bigint, 0-based): total weight of earlier rows in the group.

    Returns the DataFrame and the total weight.  One path at every size: range
    partitions (``spark.sql.shuffle.partitions`` of them, which a cluster sizes
    for its data), of which a large group spans as many as its rows fill.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    if not group_cols:
        raise ValueError("group_positions needs group columns; use global_positions for one order")
    keys = group_cols + order_cols
    # groups are compared by 64 hash bits and, where those agree, by their columns
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    ranged = cut_lineage(df.withColumn(_GKEY, F.xxhash64(*group_cols)).withColumn(_W, w)
                         .repartitionByRange(_num_partitions(df, num_partitions), *keys).sortWithinPartitions(*keys)
                         .withColumn(_PID, F.spark_partition_id()))

    # pass 1 (JVM): per partition its first and last group with their weights.
    # Each partition's rows are sorted by group, so the partial aggregate by
    # (partition, group) is one row per group and the partition edges follow.
    per_group = ranged.groupBy(_PID, _GKEY, *group_cols).agg(F.sum(_W).alias("_s"))
    edge = F.struct(*group_cols, _GKEY, "_s")
    edge_rows = per_group.groupBy(_PID).agg(F.min(edge).alias("first"), F.max(edge).alias("last"),
                                            F.sum("_s").alias("total")).collect()
    offsets: dict[int, int] = {}
    carry_key, carry_w, total = None, 0, 0
    for r in sorted(edge_rows, key=lambda r: r[_PID]):
        total += r.total
        first, last = (repr(tuple(e)[:-1]) for e in (r.first, r.last))      # text, so that NaN equals itself
        offsets[r[_PID]] = carry_w if first == carry_key else 0
        carry_key, carry_w = last, r.last["_s"] + (offsets[r[_PID]] if first == last else 0)

    # only partitions that continue a group carry an offset; shipped once per
    # executor as a broadcast variable, not inside every task's closure
    carried = df.sparkSession.sparkContext.broadcast({p: o for p, o in offsets.items() if o})
    payload = [c for c in ranged.columns if c not in (_GKEY, _PID, _W)]
    raw = [c for c in group_cols if not isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]

    def changes(a, b):
        """Rows of ``b`` whose group is not that of the row of ``a`` before them."""
        out = pc.not_equal(a.column(_GKEY), b.column(_GKEY)).to_numpy(zero_copy_only=False)
        for c in raw:
            x, y = a.column(c), b.column(c)
            out = out | pc.fill_null(pc.not_equal(x, y), False).to_numpy(zero_copy_only=False)
            out |= pc.not_equal(pc.is_null(x), pc.is_null(y)).to_numpy(zero_copy_only=False)
        return out

    # pass 2 (narrow): running weight inside each partition plus the carried offset
    def positions(batches):
        last, running = None, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            wv = b.column(_W).to_numpy()
            if last is None:
                running = carried.value.get(b.column(_PID)[0].as_py(), 0)
            new = np.empty(n, bool)
            new[0] = last is not None and changes(last, b.slice(0, 1))[0]
            new[1:] = changes(b.slice(0, n - 1), b.slice(1))
            before = np.cumsum(wv) - wv
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            pos = before - before[start] + np.where(np.cumsum(new) == 0, running, 0)
            running, last = int(pos[-1] + wv[-1]), b.slice(n - 1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in payload), pa.array(pos, pa.int64())], [*payload, out])

    schema = T.StructType([ranged.schema[c] for c in payload] + [T.StructField(out, T.LongType())])
    return ranged.mapInArrow(positions, schema), int(total)


CELL = 1 << 20
_LONGS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def order_codes(df: DataFrame, col: str):
    """Two longs that order as the column does, nulls first; None for types whose
    order no long carries."""
    t, c = df.schema[col].dataType, F.col(col)
    if isinstance(t, T.DateType):
        c = F.unix_date(c)
    elif isinstance(t, T.TimestampType):
        c = F.unix_micros(c)
    elif not isinstance(t, _LONGS):
        return None
    return [c.isNotNull().cast("long"), F.coalesce(c.cast("long"), F.lit(0).cast("long"))]


def largest_group(df: DataFrame, group_cols) -> int:
    """Rows of the largest group, counted with a partial step before the shuffle."""
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(F.max("_n")).first()[0] or 0


def refined_cells(df: DataFrame, group_cols, codes, limit: int = CELL) -> DataFrame:
    """``df`` with ``_cell``, an array that orders as the rows do: empty for groups
    of at most ``limit`` rows, else the path of ranges that holds the row."""
    keys = [*group_cols, "_cell"]
    out = df.withColumn("_cell", F.array().cast("array<bigint>"))
    while True:
        size = F.col("_n")
        fan = F.least(F.greatest(4 * size / limit, F.lit(2)), F.lit(4096)).cast("long")
        spans = F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"_lo{i}").alias("lo"), F.col(f"_hi{i}").alias("hi"))
                          for i in range(len(codes))])
        stats = out.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[
            f(c).alias(f"{n}{i}") for i, c in enumerate(codes) for n, f in (("_lo", F.min), ("_hi", F.max))])
        split = (stats.where(size > limit)
                 .withColumn("_s", F.filter(spans, lambda x: x["lo"] < x["hi"])).where(F.size("_s") > 0)    # rows that differ
                 .withColumn("_s", F.col("_s")[0]).withColumn("_f", fan)
                 .selectExpr(*keys, "_s.at AS _at", "greatest(1L, _s.hi div _f - _s.lo div _f) AS _step", "_s.lo AS _lo"))
        split = cut_lineage(split)
        if split.isEmpty():
            return out
        x = F.element_at(F.array(*codes), F.col("_at") + 1)
        out = (join_small(out.withColumn("_codes", F.array(*codes)), split, keys, "left", null_safe=True)
               .withColumn("_x", x).withColumn("_cell", F.expr(
                   "CASE WHEN _at IS NULL THEN _cell ELSE array_append(_cell, _x div _step - _lo div _step) END"))
               .drop("_at", "_step", "_lo", "_x", "_codes"))


def cell_sums(df: DataFrame, group_cols, order_cols, sums: dict[str, str | None], limit: int = CELL,
              largest: int | None = None) -> DataFrame:
    """Add running sums over the group's earlier rows: for each ``out: weight`` of
    ``sums`` a bigint, the weight of the rows before (their number for None).

    ``limit``: rows of a group that one window may hold.  Rows that tie in all
    order columns cannot be told apart, so the order should be total.  Columns
    whose order is no number (text, floats) go to ``group_positions`` where a group
    is too large.  ``largest``: the largest group's rows, where known.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    zero = F.lit(0).cast("long")

    def weight(w):
        return F.col(w).cast("long") if w else F.lit(1).cast("long")

    def inside(frame, keys):
        win = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])
        before = win.rowsBetween(Window.unboundedPreceding, -1)
        return frame.withColumns({o: F.coalesce(F.sum(weight(w)).over(before), zero) if w else F.row_number().over(win).cast("long") - 1
                                  for o, w in sums.items()})

    if (largest_group(df, group_cols) if largest is None else largest) <= limit:
        return inside(df, group_cols)
    codes = [order_codes(df, c) for c in order_cols]
    if any(c is None for c in codes):
        for o, w in sums.items():
            df = group_positions(df, group_cols, order_cols, w, o)[0]
        return df
    cells = refined_cells(df, group_cols, [x for c in codes for x in c], limit)
    keys = [*group_cols, "_cell"]
    before = Window.partitionBy(*group_cols).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    held = {o: f"_b{i}" for i, o in enumerate(sums)}
    offsets = (cells.where(F.size("_cell") > 0).groupBy(*keys).agg(*[F.sum(weight(w)).alias(held[o]) for o, w in sums.items()])
               .withColumns({b: F.coalesce(F.sum(b).over(before), zero) for b in held.values()}))
    placed = join_small(inside(cells, keys), offsets, keys, "left", null_safe=True)
    return placed.withColumns({o: F.col(o) + F.coalesce(F.col(b), zero) for o, b in held.items()}).drop("_cell", *held.values())


def cell_positions(df: DataFrame, group_cols, order_cols, weight: str | None = None, out: str = "pos",
                   limit: int = CELL, largest: int | None = None) -> DataFrame:
    """Add ``out`` (bigint, 0-based): total weight of earlier rows in the group."""
    return cell_sums(df, group_cols, order_cols, {out: weight}, limit, largest)


def expand_counts(df: DataFrame, count_col: str, chunk: int = 100_000,
                  num_partitions: int | None = None) -> DataFrame:
    """Replace each row by ``count_col`` copies of itself (count column dropped).

    Rows with a count up to ``chunk`` are exploded in place; larger counts are
    first cut into chunk rows, hash partitioned on (row, chunk), then exploded.
    """
    cols = [c for c in df.columns if c != count_col]
    n = F.col(count_col).cast("long")
    small = (df.where(n.between(1, chunk))
             .select(*cols, F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("_i"))
             .drop("_i"))
    parts = _num_partitions(df, num_partitions)
    big = (df.where(n > chunk)
           .select(*cols, n.alias("_n"),
                   F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk).cast("long"))).alias("_c"))
           .repartition(parts, *cols, "_c")
           .select(*cols, F.least(F.lit(chunk).cast("long"), F.col("_n") - F.col("_c") * chunk).alias("_m"))
           .select(*cols, F.explode(F.sequence(F.lit(1), F.col("_m").cast("int"))).alias("_i"))
           .drop("_i"))
    return small.unionByName(big)
