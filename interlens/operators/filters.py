"""Activity filters and the removal report.

Counting per user is a hash aggregate with a partial step before the shuffle,
so a user holding a large share of the rows costs one row per map task.  Rows
of the kept users are selected with a semi join whose key side is broadcast
only below a measured size.  (A count window over the user would put every row
of a user in one task; the result is the same.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_THRESHOLD
from .joins import restrict_to_keys

COUNT = "n_interactions"


def _keep(count_col, threshold: int, inclusive: bool):
    c = F.col(count_col) if isinstance(count_col, str) else count_col
    return c >= F.lit(threshold) if inclusive else c > F.lit(threshold)


def user_activity(df: DataFrame, user: str = "user_id") -> DataFrame:
    """Interactions per user: (user, n_interactions bigint); null users excluded."""
    return df.where(F.col(user).isNotNull()).groupBy(user).agg(F.count(F.lit(1)).alias(COUNT))


def frequent_users(df: DataFrame, user: str = "user_id", threshold: int = DEFAULT_THRESHOLD,
                   inclusive: bool = True, with_count: bool = False) -> DataFrame:
    """Users with at least (inclusive) or more than (strict) ``threshold`` rows."""
    act = user_activity(df, user).where(_keep(COUNT, threshold, inclusive))
    return act if with_count else act.select(user)


def frequent_interactions(df: DataFrame, user: str = "user_id", threshold: int = DEFAULT_THRESHOLD,
                          inclusive: bool = True) -> DataFrame:
    """Rows whose user passes the activity threshold, in the input's columns."""
    return restrict_to_keys(df, frequent_users(df, user, threshold, inclusive), user)


def removal_report(df: DataFrame, user: str = "user_id", threshold: int = DEFAULT_THRESHOLD,
                   inclusive: bool = True) -> DataFrame:
    """One row: users and rows before and after the filter, and the shares removed.

    Rows with a null user are counted in ``n_rows`` and ``null_user_rows``; they
    are never kept.  Shares are percent, rounded to 2 places.
    """
    act = df.groupBy(user).agg(F.count(F.lit(1)).alias(COUNT))
    is_user = F.col(user).isNotNull()
    kept = is_user & _keep(COUNT, threshold, inclusive)
    rep = act.agg(
        F.sum(is_user.cast("long")).alias("n_users"),
        F.sum(F.col(COUNT)).alias("n_rows"),
        F.sum(F.when(~is_user, F.col(COUNT)).otherwise(0)).alias("null_user_rows"),
        F.sum(kept.cast("long")).alias("users_kept"),
        F.sum(F.when(kept, F.col(COUNT)).otherwise(0)).alias("rows_kept"),
    )
    return rep.select(
        F.lit(threshold).cast("int").alias("threshold"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
          for c in ("n_users", "n_rows", "null_user_rows", "users_kept", "rows_kept")],
        _pct_removed("users_kept", "n_users").alias("pct_users_removed"),
        _pct_removed("rows_kept", "n_rows").alias("pct_rows_removed"),
    )


def _pct_removed(kept: str, total: str):
    share = F.try_divide(F.col(kept).cast("double"), F.col(total).cast("double"))
    return F.round((F.lit(1.0) - share) * 100, 2)


# ------------------------------------------------- mergeable distinct counts (A2)

SKETCH_LG = 12      # 4096 registers


def sketch_error(lg_k: int = SKETCH_LG) -> float:
    """Relative standard deviation of a merged distinct sketch."""
    return 1.04 / (1 << lg_k) ** 0.5


def distinct_sketches(df: DataFrame, group_cols, col: str, lg_k: int = SKETCH_LG) -> DataFrame:
    """(group columns, sketch): a HyperLogLog sketch of the distinct non-null values
    of ``col`` in each group, of fixed size however many there are.  Stored, it
    answers later unions without the rows: days to months, parts to wholes."""
    return df.groupBy(*group_cols).agg(F.hll_sketch_agg(F.col(col), F.lit(lg_k)).alias("sketch"))


def merged_distinct(sketches: DataFrame, by=()) -> DataFrame:
    """(by, n_distinct): stored sketches merged over all groups of equal ``by`` and
    estimated.  Exact counts do not add up over groups that share values; sketches do."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
