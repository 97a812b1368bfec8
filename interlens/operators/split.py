"""User-level splits, k folds, hold-out roles and unions.

A row's side is a function of its keys, written into columns:

* ``split``: train / val / test for the user (cumulative cuts of one bucket);
* ``role``:  train / val / test for the row: a held-out user's rows go to
  train unless the (user, item) bucket holds them out;
* ``user_fold``: 0..k-1 for cross-validation users, -1 for test users.

So one projection replaces the reference's joins, driver-side dictionaries and
set differences, with bag semantics and no shuffle; every split is a filter on
the same labelled table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_FOLDS, DEFAULT_HOLDOUT, DEFAULT_SEED, DEFAULT_SPLIT_WEIGHTS, Roles
from ..functions.hashing import SALT_FOLD, SALT_SPLIT, SALT_TEST, SPACE, bucket, cumulative_cuts, cut
from .sampling import holdout_flag

TRAIN, VAL, TEST = "train", "val", "test"


def split_label(user: str, weights=DEFAULT_SPLIT_WEIGHTS, seed: int = DEFAULT_SEED,
                names=(TRAIN, VAL, TEST), method: str = "md5") -> Column:
    """Which part of a weighted user split a user falls in."""
    if len(weights) != len(names):
        raise ValueError("one name per weight")
    cuts = cumulative_cuts(weights)
    h = bucket(seed, SALT_SPLIT, user, method=method)
    expr = None
    for c, name in zip(cuts[:-1], names[:-1]):
        expr = F.when(h < F.lit(c), F.lit(name)) if expr is None else expr.when(h < F.lit(c), F.lit(name))
    return expr.otherwise(F.lit(names[-1])) if expr is not None else F.lit(names[-1])


def label_roles(df: DataFrame, roles: Roles, weights=DEFAULT_SPLIT_WEIGHTS,
                holdout: float = DEFAULT_HOLDOUT, seed: int = DEFAULT_SEED,
                names=(TRAIN, VAL, TEST), method: str = "md5") -> DataFrame:
    """Add ``split`` and ``role`` (C7, C8).  Rows without a user or an item are
    dropped (``null_keys`` counts them).

    ``role`` is written on the two bucket values directly (not on ``split``),
    so a filter such as ``role = 'val'`` that Catalyst pushes below the
    projection evaluates each md5 as few times as the test needs.
    """
    if len(weights) != len(names):
        raise ValueError("one name per weight")
    cuts = cumulative_cuts(weights)
    h = bucket(seed, SALT_SPLIT, roles.user, method=method)
    kept = ~holdout_flag(roles, holdout, seed, method)
    role = F.when((h < F.lit(cuts[0])) | kept, F.lit(names[0]))
    for c, name in zip(cuts[1:-1], names[1:-1]):
        role = role.when(h < F.lit(c), F.lit(name))
    role = role.otherwise(F.lit(names[-1]))
    out = df.where(keyed(roles))
    return out.withColumn("split", split_label(roles.user, weights, seed, names, method)).withColumn("role", role)


def keyed(roles: Roles) -> Column:
    """Rows that have both keys."""
    return F.col(roles.user).isNotNull() & F.col(roles.item).isNotNull()


def null_keys(df: DataFrame, roles: Roles) -> DataFrame:
    """One row: n_rows, and the rows without a user, without an item, and dropped."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(roles.user).isNull()).alias("null_user_rows"),
                  F.count_if(F.col(roles.item).isNull()).alias("null_item_rows"),
                  F.count_if(~keyed(roles)).alias("dropped_rows"))


def train_val_test_split(df: DataFrame, roles: Roles, **kw):
    """(train + other halves, held-out val half, held-out test half)."""
    lab = label_roles(df, roles, **kw)
    return tuple(lab.where(F.col("role") == r).drop("split", "role") for r in (TRAIN, VAL, TEST))


def user_fold(user: str, k: int = DEFAULT_FOLDS, test_share: float = 0.2, seed: int = DEFAULT_SEED,
              method: str = "md5") -> Column:
    """Fold of a user: -1 for the ``test_share`` of test users, else 0..k-1."""
    if k < 2:
        raise ValueError(f"k-fold split needs k >= 2, got {k}")
    test = bucket(seed, SALT_TEST, user, method=method) >= F.lit(cut(1.0 - test_share))
    fold = F.floor(bucket(seed, SALT_FOLD, user, method=method) * k / float(SPACE)).cast("int")
    return F.when(test, F.lit(-1)).otherwise(fold)


def kfold_labels(df: DataFrame, roles: Roles, k: int = DEFAULT_FOLDS, test_share: float = 0.2,
                 holdout: float = DEFAULT_HOLDOUT, seed: int = DEFAULT_SEED, method: str = "md5") -> DataFrame:
    """Add ``user_fold`` (-1 = test user) and ``held`` (0/1) (R3, C9).  Rows
    without a user or an item are dropped."""
    return (df.where(keyed(roles))
            .withColumn("user_fold", user_fold(roles.user, k, test_share, seed, method))
            .withColumn("held", holdout_flag(roles, holdout, seed, method).cast("int")))


def fold_role(fold: int) -> Column:
    """Role of a row in fold ``fold`` of a ``kfold_labels`` table."""
    uf, held = F.col("user_fold"), F.col("held") == 1
    return (F.when((uf == -1) & held, F.lit(TEST))
            .when((uf == fold) & held, F.lit(VAL))
            .otherwise(F.lit(TRAIN)))


def kfold_split(df: DataFrame, roles: Roles, k: int = DEFAULT_FOLDS, **kw) -> dict:
    """{fold: (train, val, test)} as filters on one labelled table."""
    lab = kfold_labels(df, roles, k, **kw)
    out = {}
    for f in range(k):
        r = lab.withColumn("role", fold_role(f))
        out[f] = tuple(r.where(F.col("role") == x).drop("user_fold", "held", "role") for x in (TRAIN, VAL, TEST))
    return out


def refit_split(lab: DataFrame, fold: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train ∪ val of ``fold``, test) of a ``kfold_labels`` table."""
    r = lab.withColumn("role", fold_role(fold))
    return tuple(r.where(c).drop("user_fold", "held", "role") for c in (F.col("role") != TEST, F.col("role") == TEST))


def final_split(df: DataFrame, roles: Roles, k: int = DEFAULT_FOLDS, fold: int = 0, **kw):
    """(train ∪ val of ``fold``, test) for the refit after cross-validation."""
    return refit_split(kfold_labels(df, roles, k, **kw), fold)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name."""
    if not dfs:
        raise ValueError("union_all needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b), dfs)
