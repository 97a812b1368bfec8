"""Dense integer ids for keys, and row ids.

``dense_index`` numbers the distinct keys in sorted order, 0.. or 1.., with no
gaps and no one-task window: distinct keys are range partitioned and numbered
by ``group_positions`` (per-partition counts plus offsets).  The index has one
row per key; ``attach_index`` joins it to the data and broadcasts it only when
its measured bytes are within Spark's threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import join_small
from .positions import global_positions

INT_MAX = (1 << 31) - 1


def dense_index(df: DataFrame, col_name: str, start: int = 0, out: str | None = None,
                as_int: bool = True, order: str = "key") -> tuple[DataFrame, int]:
    """(key, key_index) for the distinct non-null keys, and their number.

    ``order="key"``: keys in sorted order.  ``order="frequency"``: most frequent
    key first, ties by key (the order of Spark ML's StringIndexer, which however
    collects every label to the driver; here the counts are a partial aggregate
    and the numbering is distributed).
    """
    out = out or f"{col_name}_index"
    present = df.select(col_name).where(F.col(col_name).isNotNull())
    if order == "key":
        pos, n = global_positions(present.distinct(), [col_name], out="_pos")
    elif order == "frequency":
        counted = present.groupBy(col_name).agg(F.count(F.lit(1)).alias("_freq"))
        pos, n = global_positions(counted, [F.col("_freq").desc(), F.col(col_name).asc()], out="_pos")
    else:
        raise ValueError(f"order must be 'key' or 'frequency', got {order!r}")
    if as_int and n + start - 1 > INT_MAX:
        raise OverflowError(f"{n} keys do not fit an int index; use as_int=False")
    idx = (F.col("_pos") + F.lit(start))
    return pos.select(col_name, (idx.cast("int") if as_int else idx).alias(out)), n


def attach_index(df: DataFrame, col_name: str, start: int = 0, out: str | None = None,
                 index: DataFrame | None = None, as_int: bool = True, how: str = "inner",
                 source: DataFrame | None = None) -> DataFrame:
    """``df`` with ``<col>_index`` joined on (J3); builds the index when not given.
    ``source``: as in ``join_small``."""
    if index is None:
        index, _ = dense_index(df, col_name, start, out, as_int)
    return join_small(df, index, col_name, how, source=source)


def attach_indexes(df: DataFrame, cols, start: int = 0, as_int: bool = True) -> DataFrame:
    """``df`` with a dense index for each of ``cols``.

    The indexes are independent, so their (small) jobs are submitted from a
    thread pool and overlap; each is then measured and joined.  Heavy hitters are
    sought in ``df`` itself: in the rows joined so far, every index before would be
    joined once more, with all it shuffles.
    """
    from concurrent.futures import ThreadPoolExecutor
    cols = list(cols)
    with ThreadPoolExecutor(max_workers=max(1, min(4, len(cols)))) as pool:
        built = list(pool.map(lambda c: dense_index(df, c, start, as_int=as_int), cols))
    out = df
    for c, (idx, _) in zip(cols, built):
        out = attach_index(out, c, index=idx, source=df)
    return out


def lookup_index(df: DataFrame, index: DataFrame, col_name: str) -> DataFrame:
    """Look keys up in an index table; unknown keys get null (P7 as a join)."""
    return join_small(df, index, col_name, "left")


def row_index(df: DataFrame, out: str = "row_index") -> DataFrame:
    """Unique 64-bit row id.

    ``monotonically_increasing_id``: unique, but neither dense nor stable
    across runs or partitionings.  Never cast it to int.
    """
    return df.withColumn(out, F.monotonically_increasing_id())
