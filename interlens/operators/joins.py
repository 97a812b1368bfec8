"""Joins against a derived key table, broadcast only below a measured size.

The key tables here (frequent users, sampled users, index maps, per-user
thresholds) are results of an aggregation, so the planner's estimate of their
size is the size of the input they came from.  They are checkpointed into the
shared folder and measured there, in bytes: rows, fixed columns and the lengths
of every string.  Up to Spark's own broadcast threshold they are broadcast.

Beyond it the join is a shuffle join that salts the heavy hitters alone.  One
pass over the large side's keys builds a frequent-items sketch (mergeable, of
fixed size, with a proven error), which finds every key that would fill more
than a fair shuffle partition.  Such a key gets as many salts as it fills
partitions: its rows are dealt over them and its row of the key table is copied
to each.  All other keys have one salt, so the key table grows by at most two
rows a shuffle partition, skewed or not, and a join without heavy hitters is
plain.  What the sketch reports shapes the plan only, never the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

ROW_OVERHEAD = 32   # hash relation and row header, per row
MOST_PARTS = 125_000    # the sketch tracks a million keys at most


def broadcast_limit(spark) -> int:
    """Spark's broadcast threshold in bytes (0: never)."""
    s = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    limit = int(float(s[:-1]) * units[s[-1]]) if s and s[-1] in units else int(s)
    return max(limit, 0)


def row_bytes(schema: T.StructType):
    """Bytes of a row as a column expression."""
    total = F.lit(ROW_OVERHEAD).cast("long")
    for f in schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + 16 + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + 16 + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0))
        else:
            total = total + 16
    return total


def measured(small: DataFrame) -> tuple[DataFrame, int]:
    """``small``, checkpointed, and its size in bytes."""
    small = cut_lineage(small)
    size = small.agg(F.sum(row_bytes(small.schema))).first()[0]
    return small, int(size or 0)


def frequent_hashes(df: DataFrame, keys, parts: int) -> tuple[list[tuple[int, int]], int]:
    """(hash of the key columns, estimated rows) of every key that holds at least
    one in ``parts`` rows, and the number of rows, in one pass.

    The sketch tracks at least ``8 * parts`` keys, which bounds its error by a third
    of such a key's share; so none is missed, and at most about three times
    ``parts`` keys are reported.  ``parts`` may be up to ``MOST_PARTS``.
    """
    if not 0 < parts <= MOST_PARTS:
        raise ValueError(f"parts must be between 1 and {MOST_PARTS}")
    row = df.select(F.xxhash64(*keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, {4 * parts}, {8 * parts})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [(t["item"], t["count"]) for t in row["top"] or [] if t["count"] * parts >= row["n"]], row["n"]


def hot_keys(df: DataFrame, keys, parts: int) -> DataFrame:
    """Keys that hold at least one in ``parts`` rows: (keys, n_rows, n_total), with
    exact counts.  The sketch names the candidates; only their rows are counted."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    found, total = frequent_hashes(df, keys, parts)
    table = df.sparkSession.createDataFrame([(h,) for h, _ in found], "_hot long")     # at most a few times parts
    rows = df.select(*keys).join(F.broadcast(table), F.xxhash64(*keys) == F.col("_hot"), "left_semi")
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(*keys, "n_rows", F.lit(total).cast("long").alias("n_total")).where(
        F.col("n_rows") * parts >= F.col("n_total"))


def salts(df: DataFrame, keys, parts: int | None = None) -> DataFrame | None:
    """(_hot, _salts): hash and number of salts of the keys that fill more than a
    fair one of ``parts`` shuffle partitions; None when there are none."""
    spark = df.sparkSession
    parts = min(MOST_PARTS, max(2, parts or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))
    found, n = frequent_hashes(df, keys, parts)
    # a key of x partitions' rows gets 2x salts, so that each piece is half a partition
    table = [(h, min(parts, -(-2 * c * parts // n))) for h, c in found]
    return spark.createDataFrame(table, "_hot long, _salts int") if table else None


def dealt(big: DataFrame, keys, table: DataFrame) -> DataFrame:
    """``big`` with ``_salt``: 0, but for rows of a hot key one of its salts.  The
    salt follows from the row and its partition, so copies of a row are dealt out
    too, and a task that runs again deals alike."""
    spread = F.pmod(F.xxhash64(*big.columns) + F.spark_partition_id(), F.col("_salts"))
    return (big.join(F.broadcast(table), F.xxhash64(*keys) == F.col("_hot"), "left")
            .withColumn("_salt", F.when(F.col("_salts").isNull(), 0).otherwise(spread).cast("int")).drop("_hot", "_salts"))


def copied(small: DataFrame, keys, table: DataFrame) -> DataFrame:
    """The key table with ``_k_salt``: a row for every salt of its key."""
    return (small.join(F.broadcast(table), F.xxhash64(*keys) == F.col("_hot"), "left")
            .withColumn("_k_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_hot", "_salts"))


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", limit: int | None = None,
               null_safe: bool = False, size: int | None = None, source: DataFrame | None = None) -> DataFrame:
    """``big.join(small, on, how)`` on equally named columns, which come once.

    ``small`` is broadcast if its measured bytes are within ``limit`` (Spark's
    threshold); else heavy hitters of ``big`` are salted.  ``how``: inner, left or
    left_semi.  ``null_safe``: null keys match null keys.  ``size``: the bytes of a
    ``small`` that was already ``measured``.  ``source``: the table whose keys tell
    the heavy hitters, where ``big`` is made from it by joins that keep its rows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if size is None:
        small, size = measured(small)
    renamed = {c: f"_k_{c}" for c in keys}
    right = small.withColumnsRenamed(renamed)
    left, salt = big, []
    if size <= (broadcast_limit(big.sparkSession) if limit is None else limit):
        right = F.broadcast(right)
    else:
        # equal keys of two types have two hashes: such a join stays plain (AQE splits its skew)
        alike = all(big.schema[c].dataType == small.schema[c].dataType for c in keys)
        table = salts(big if source is None else source, keys) if alike else None
        if table is not None:
            left, right = dealt(big, keys, table), copied(right, list(renamed.values()), table)
            salt = [F.col("_salt") == F.col("_k_salt")]
    equal = [F.col(c).eqNullSafe(F.col(renamed[c])) if null_safe else F.col(c) == F.col(renamed[c]) for c in keys]
    extra = [c for c in small.columns if c not in keys] if how != "left_semi" else []
    return left.join(right, equal + salt, how).select(*big.columns, *extra)


def restrict_to_keys(df: DataFrame, keys: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``keys`` (left semi join; left columns only)."""
    return join_small(df, keys.select(key).where(F.col(key).isNotNull()), key, "left_semi", limit)
