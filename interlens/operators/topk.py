"""Per-user top k.

``ties="drop"``: exactly k rows per user by ``row_number`` with a total order;
Catalyst turns ``row_number <= k`` into a WindowGroupLimit that keeps k rows per
user in every map task, so at most k rows per user and task are shuffled.

``ties="keep"`` (the reference's ``rank() <= k``) has two strategies with the
same rows:

``"spread"`` (default): a row can only qualify if fewer than k rows of its user
are better *in its own input partition*.  That is a limit per (user, partition),
which Catalyst applies in the map tasks, so the rows that are left, about k per
user and partition and their ties, are all that is shuffled and written.  They
are spread by (user, partition), so a user whose rows all tie fills many tasks.
Among them the ranks follow from counts per (user, value), of which only the k
best can qualify, and are joined back: broadcast when their measured size allows,
else a shuffle join that salts hot users.  Rows and ranks read one checkpoint, so
a value computed upstream (a mean of floats) is the same number on both sides.

``"window"``: one window per user, limited in the map tasks as well.  One shuffle
and no written copy, but a user's ties meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Roles
from ..session import cut_lineage
from .joins import join_small


def _order(col: str, ascending: bool):
    return F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()


def survivors(df: DataFrame, k: int, by: str, user: str, ascending: bool = False) -> DataFrame:
    """Rows with fewer than k better ones of their user in their own partition,
    checkpointed: every row of rank() <= k, and few others."""
    w = Window.partitionBy(user, "_part").orderBy(_order(by, ascending))
    left = (df.withColumn("_part", F.spark_partition_id()).withColumn("_local", F.rank().over(w))
            .where(F.col("_local") <= k).drop("_part", "_local"))
    return cut_lineage(left)


def top_k(df: DataFrame, k: int, by: str, roles: Roles, ties: str = "keep", ascending: bool = False,
          rank_col: str = "rank", strategy: str = "spread") -> DataFrame:
    """Rows whose per-user rank on ``by`` is at most k, with the rank."""
    if k < 1:
        raise ValueError("k must be >= 1")
    u = roles.user
    base = df.where(F.col(u).isNotNull())
    if ties == "drop":
        w = Window.partitionBy(u).orderBy(_order(by, ascending), F.col(roles.item).asc_nulls_last(),
                                          *[F.col(c).asc_nulls_last() for c in roles.tiebreak])
        return base.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
    if ties != "keep":
        raise ValueError(f"ties must be 'keep' or 'drop', got {ties!r}")
    if strategy == "window":
        w = Window.partitionBy(u).orderBy(_order(by, ascending))
        return base.withColumn(rank_col, F.rank().over(w)).where(F.col(rank_col) <= k)
    if strategy != "spread":
        raise ValueError(f"strategy must be 'spread' or 'window', got {strategy!r}")
    left = survivors(base, k, by, u, ascending)
    ranks = value_ranks(left, k, by, u, ascending).select(u, by, F.col("_rank").alias(rank_col))
    return join_small(left, ranks, [u, by], "inner", null_safe=True)


def value_ranks(df: DataFrame, k: int, by: str, user: str, ascending: bool = False) -> DataFrame:
    """(user, value, _rank, _n) for the values whose rank() is at most k."""
    groups = df.groupBy(user, by).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(user).orderBy(_order(by, ascending))
    best = groups.withColumn("_g", F.row_number().over(w)).where(F.col("_g") <= k)
    before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (best.withColumn("_rank", (before + 1).cast("int"))
            .where(F.col("_rank") <= k).select(user, by, "_rank", "_n"))


def topk_lists(df: DataFrame, k: int, by: str, roles: Roles, ascending: bool = False,
               out: str = "items") -> DataFrame:
    """(user, items): the k best items per user as an ordered array (A5).

    Built on the exact-k variant, so a list never holds more than k items.
    """
    top = top_k(df, k, by, roles, ties="drop", ascending=ascending, rank_col="_r")
    return (top.groupBy(roles.user)
            .agg(F.sort_array(F.collect_list(F.struct("_r", roles.item))).alias("_l"))
            .select(roles.user, F.transform("_l", lambda x: x[roles.item]).alias(out)))
