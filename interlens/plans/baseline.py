"""Predictors that SQL can express: item mean and damped item bias.

They stand in for ALS wherever a result must be checked against a second
engine, and they make a tuning table out of the data itself: a grid of
damping values over k folds, with the fold roles of ``kfold_labels``.

Per-fold item statistics are not recomputed per fold.  A row is training data
in every fold except where it is held out (its own fold, or always for test
users), so fold f's statistics are ``all training-eligible rows`` minus ``held
rows of fold f``: one aggregate by (item, fold it validates, rating) covers all
folds, and holds the validation rows too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_FOLDS, DEFAULT_SEED, Roles
from ..operators.joins import join_small
from ..operators.split import kfold_labels
from ..session import cut_lineage

DEFAULT_DAMPING_GRID = (0.0, 1.0, 5.0, 25.0)


def item_means(train: DataFrame, roles: Roles) -> DataFrame:
    """(item, prediction): mean training rating per item."""
    return (train.where(F.col(roles.rating).isNotNull()).groupBy(roles.item)
            .agg(F.avg(F.col(roles.rating).cast("double")).alias(roles.prediction)))


def score_item_mean(train: DataFrame, target: DataFrame, roles: Roles) -> DataFrame:
    """``target`` rows with the item-mean prediction; items unseen in train are dropped."""
    return join_small(target, item_means(train, roles), roles.item)


def baseline_cv_table(df: DataFrame, roles: Roles, k: int = DEFAULT_FOLDS,
                      grid=DEFAULT_DAMPING_GRID, seed: int = DEFAULT_SEED) -> DataFrame:
    """(grid_no, regParam, fold, rmse, n_rows) of the damped item-bias predictor.

    prediction = mu_f + sum_f(r - mu_f) / (n_f + regParam) over fold f's
    training rows; validation rows whose item is unseen in fold f are dropped.
    """
    i, r = roles.item, roles.rating
    lab = kfold_labels(df, roles, k, seed=seed).where(F.col(r).isNotNull())
    held, uf = F.col("held") == 1, F.col("user_fold")
    # One pass over the data: rows per (item, g, rating), g = the fold a held row
    # validates, or -2 for rows that train in every fold; test users' held rows
    # train nowhere.  Fold f trains on every g except f.
    keyed = lab.where(~((uf == -1) & held)).withColumn("_g", F.when(held, uf).otherwise(F.lit(-2)))
    cells = cut_lineage(keyed.groupBy(i, "_g", r).agg(F.count(F.lit(1)).alias("_c")))
    stats = cells.groupBy(i, "_g").agg(F.sum("_c").alias("_n"), F.sum(F.col(r) * F.col("_c")).alias("_s"))
    stats = cut_lineage(stats)   # one row per (item, g): read three times below
    per_g = {row["_g"]: (row["_n"], row["_s"]) for row in
             stats.groupBy("_g").agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s")).collect()}
    n_all = sum(v[0] for v in per_g.values())
    s_all = sum(v[1] for v in per_g.values())
    # mean of fold f's training rows: k literals
    mu = {f: (s_all - per_g.get(f, (0, 0))[1]) / (n_all - per_g.get(f, (0, 0))[0])
          for f in range(k) if n_all - per_g.get(f, (0, 0))[0] > 0}
    mu_map = F.create_map(*[x for f, m in sorted(mu.items()) for x in (F.lit(f), F.lit(float(m)))])

    all_items = stats.groupBy(i).agg(F.sum("_n").alias("_na"), F.sum("_s").alias("_sa"))
    fold_items = stats.where(F.col("_g") >= 0).select(
        i, F.col("_g").alias("user_fold"), F.col("_n").alias("_nf"), F.col("_s").alias("_sf"))

    # the prediction depends on (fold, item) only: held rows collapse to distinct
    # (fold, item, rating) cells before the grid multiplies them
    v = cells.where(F.col("_g") >= 0).select(i, F.col("_g").alias("user_fold"), F.col(r).cast("double").alias("_l"), "_c")
    v = join_small(v, all_items, i)
    v = join_small(v, fold_items, [i, "user_fold"], "left")
    v = v.withColumn("_mu", F.element_at(mu_map, F.col("user_fold")))
    n_f = F.col("_na") - F.coalesce(F.col("_nf"), F.lit(0))
    s_f = (F.col("_sa") - F.coalesce(F.col("_sf"), F.lit(0))).cast("double")
    v = v.select("user_fold", "_l", "_c", "_mu", n_f.alias("_n"), s_f.alias("_s")).where(F.col("_n") > 0)

    g = F.array(*[F.struct(F.lit(j).alias("grid_no"), F.lit(float(x)).alias("regParam"))
                  for j, x in enumerate(grid)])
    v = v.select("*", F.explode(g).alias("_g"))
    pred = F.col("_mu") + (F.col("_s") - F.col("_mu") * F.col("_n")) / (F.col("_n") + F.col("_g.regParam"))
    err = pred - F.col("_l")
    return (v.groupBy(F.col("_g.grid_no").alias("grid_no"), F.col("_g.regParam").alias("regParam"),
                      F.col("user_fold").alias("fold"))
            .agg(F.sqrt(F.sum(F.col("_c") * err * err) / F.sum("_c")).alias("rmse"), F.sum("_c").alias("n_rows")))
