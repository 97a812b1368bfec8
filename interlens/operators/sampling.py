"""User sampling, per-user hold-out and exact halves.

Sampling and hold-out are seeded hash buckets of the key: a projection and a
filter, no shuffle, the same rows for any partitioning, and equal (user, item)
pairs always on one side.  Exact halves need positions inside each user's rows;
they come from ``cell_positions``, which refines users that are too large by
counts of order ranges, so no user and no group of copies is handled by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_HOLDOUT, DEFAULT_PERCENTAGE, DEFAULT_SEED, Roles
from ..functions.hashing import SALT_HALF, SALT_ROW, SALT_SAMPLE, bucket, cut
from .filters import frequent_users
from .joins import restrict_to_keys
from .positions import CELL, cell_positions, expand_counts, largest_group


def in_sample(user: str, p: float, seed: int = DEFAULT_SEED, salt: str = SALT_SAMPLE, method: str = "md5"):
    """Predicate: the user's bucket falls in the first share ``p``."""
    return F.col(user).isNotNull() & (bucket(seed, salt, user, method=method) < F.lit(cut(p)))


def sample_users(df: DataFrame, user: str = "user_id", percentage: float = DEFAULT_PERCENTAGE,
                 seed: int = DEFAULT_SEED, users: DataFrame | None = None, method: str = "md5") -> DataFrame:
    """Rows of a seeded ``percentage`` of users (C4 with ``users``, C5 without).

    With ``users`` the sample is drawn from those users only: the bucket filter
    runs on both sides first, so only sampled keys reach the semi join.
    """
    pred = in_sample(user, percentage, seed, method=method)
    out = df.where(pred)
    if users is not None:
        out = restrict_to_keys(out, users.where(pred), user)
    return out


def sample_report(sampled: DataFrame, user: str = "user_id", percentage: float | None = None,
                  approx_rsd: float | None = None) -> DataFrame:
    """Rows and distinct users kept by a sample, in one aggregate.

    ``approx_rsd``: count users with ``approx_count_distinct`` at that relative
    standard deviation (a fixed-size sketch per task instead of a distinct set).
    """
    users = F.countDistinct(user) if approx_rsd is None else F.approx_count_distinct(user, rsd=approx_rsd)
    rep = sampled.agg(F.count(F.lit(1)).alias("rows_kept"), users.alias("users_kept"))
    cols = [F.col("rows_kept").cast("bigint"), F.col("users_kept").cast("bigint")]
    if percentage is not None:
        cols.insert(0, F.lit(float(percentage)).alias("percentage"))
    return rep.select(*cols)


def create_subset(df: DataFrame, threshold: int = 500, percentage: float = DEFAULT_PERCENTAGE,
                  user: str = "user_id", seed: int = DEFAULT_SEED, inclusive: bool = True) -> DataFrame:
    """Frequent users (C1), then a seeded share of them (C4): their rows."""
    return sample_users(df, user, percentage, seed, users=frequent_users(df, user, threshold, inclusive))


def holdout_flag(roles: Roles, fraction: float = DEFAULT_HOLDOUT, seed: int = DEFAULT_SEED, method: str = "md5"):
    """Per-row hold-out predicate on (user, item): equal pairs share a side."""
    return bucket(seed, SALT_ROW, roles.user, roles.item, method=method) < F.lit(cut(fraction))


def stratified_halves(df: DataFrame, roles: Roles, seed: int = DEFAULT_SEED, order: str = "item",
                      out: str = "half", limit: int = CELL, counted: bool = False) -> DataFrame:
    """Each user's rows cut into two exact halves (R5); adds ``out``: 0 even, 1 odd.

    Rows are numbered 1.. per user in the order (item, tie-break columns, the
    rest of the row), or with ``order="hash"`` by a seeded hash of (user, item)
    first; even numbers form half 0.  Rows with a null user are dropped.  A user of
    over ``limit`` rows is cut into cells of its order, so that no task numbers more.
    ``counted``: rows of a half that are equal come once, with ``n_copies``; in
    pieces where that saves a shuffle.
    """
    cols = df.columns
    rest = [c for c in cols if c not in (roles.user, roles.item) and c not in roles.tiebreak]
    order_cols = [roles.item, *roles.tiebreak, *rest]
    base = df.where(F.col(roles.user).isNotNull())
    if order == "hash":
        base = base.withColumn("_h", bucket(seed, SALT_HALF, roles.user, roles.item))
        order_cols = ["_h", *order_cols]
    elif order != "item":
        raise ValueError(f"order must be 'item' or 'hash', got {order!r}")
    largest = largest_group(base, [roles.user])
    if largest <= limit:
        # every user fits a window; copies are rows like any other
        halves = (cell_positions(base, [roles.user], order_cols, out="_p", limit=limit, largest=largest)
                  .select(*cols, ((F.col("_p") + 1) % 2).cast("int").alias(out)))
        return halves.withColumn("n_copies", F.lit(1).cast("long")) if counted else halves
    # Copies are collapsed to one row with a count, numbered cell by cell, then
    # expanded again: no user and no group of copies is one task.
    collapsed = base.groupBy(*base.columns).agg(F.count(F.lit(1)).alias("_cnt"))
    pos = cell_positions(collapsed, [roles.user], order_cols, weight="_cnt", out="_p", limit=limit)
    # rows of this value hold numbers p+1 .. p+cnt; how many of them are even
    p, c = F.col("_p"), F.col("_cnt")
    n_even = F.floor((p + c) / 2) - F.floor(p / 2)
    halves = pos.select(*cols, F.explode(F.array(
        F.struct(F.lit(0).alias(out), n_even.cast("long").alias("_n")),
        F.struct(F.lit(1).alias(out), (c - n_even).cast("long").alias("_n")))).alias("_s"))
    halves = halves.select(*cols, F.col("_s")[out].alias(out), F.col("_s._n").alias("_n"))
    halves = halves.where(F.col("_n") > 0)
    return halves.withColumnRenamed("_n", "n_copies") if counted else expand_counts(halves, "_n")
