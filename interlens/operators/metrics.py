"""Top-k ranking and regression metrics in one job each.

Ranking (per user u; P = items by prediction desc, item asc; L = items whose
rating rank() is at most k, ties kept; a user's rows are first collapsed to
distinct items with their best rating):

    precision@k = |{i < k : P_i in L}| / k
    AP@k        = sum_{i<k} [P_i in L] * hits(i) / (i + 1) / min(|L|, k)
    AP          = sum_{i} [P_i in L] * hits(i) / (i + 1) / |L|, over the items whose
                  prediction rank() is at most k: ties at the k-th prediction stay
    NDCG@k      = sum_{i<k} [P_i in L] / ln(i + 2)  /  sum_{i < min(|L|, k)} 1 / ln(i + 2)

averaged over users.  These equal Spark's ``RankingMetrics`` fed the lists the
reference builds.  Where no user holds more than a fair share of the rows, one
shuffle by user brings each list together, and everything else follows inside it.
Else nothing needs a user's whole list in one place: P comes
from ``top_k``, whose survivors are spread over tasks, and L from per-(user,
rating) counts where only the k best ratings can qualify.  Where a user ties over
more rows than one window may hold, the places and the hits before each item are
running sums over cells of (rank, item): each cell is one task's, and the sums of
the cells before it are carried in.

Regression (rmse, mae, r2) runs over the rows whose prediction rank() is at
most k (all rows when k is None), from per-(user, prediction) counts, errors and
central moments, so large ratings lose no digits.  Without variance r2 is null.

Parity note: predicted and relevant lists come from the same held-out rows, so
a user with n <= k distinct items scores precision n/k and NDCG 1 whatever the
model; ``n_users_le_k`` reports how many users that is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import RANKING_METRICS, REGRESSION_METRICS, Roles
from ..session import cut_lineage
from .joins import join_small, measured
from .positions import CELL, cell_sums
from .topk import survivors, value_ranks


def _clean(df: DataFrame, roles: Roles) -> DataFrame:
    cols = [roles.user, roles.item, roles.rating, roles.prediction]
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.select(*cols).where(cond & ~F.isnan(F.col(roles.prediction).cast("double")))


FAIR = 4096     # rows of one user that are never too many for one task


def fair_users(df: DataFrame, user: str, limit: int = CELL) -> bool:
    """Whether each user's rows may meet in one task: none has over ``limit`` of them,
    or more than a fair shuffle partition.  One count with a partial step."""
    row = df.groupBy(user).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("top"), F.sum("_n").alias("n")).first()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return (row["top"] or 0) <= min(limit, max(FAIR, (row["n"] or 0) // max(1, parts)))


def _ranking_by_lists(pairs: DataFrame, k: int, u: str, i: str) -> DataFrame:
    """``ranking_per_user`` from each user's sorted list, of which only the items up to
    the k-th prediction and its ties are walked."""
    size, zero, none = F.size("_by"), F.lit(0).cast("long"), F.lit(0.0)
    lists = pairs.groupBy(u).agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("_p").cast("double")).alias("p"), F.col(i).alias("i"), F.col("_r").alias("r")))).alias("_by"))
    kth = F.least(size, F.lit(k))
    lists = lists.withColumns({
        "_thr": F.element_at(F.sort_array(F.transform("_by", lambda x: x["r"]), asc=False), kth),
        "_cut": F.element_at(F.col("_by"), kth)["p"]})
    lists = lists.select(
        u, "_thr", size.cast("bigint").alias("n_items"),
        F.size(F.filter("_by", lambda x: x["r"] >= F.col("_thr"))).cast("bigint").alias("n_relevant"),
        F.filter("_by", lambda x: x["p"] <= F.col("_cut")).alias("_top"))

    def step(a, x):
        pos = a["pos"] + 1
        rel = (x["r"] >= F.col("_thr")).cast("long")
        gain, disc, in_k = rel * (a["hits"] + rel) / pos, F.lit(1.0) / F.log(pos + F.lit(1.0)), pos <= k
        return F.struct(
            pos.alias("pos"), (a["hits"] + rel).alias("hits"),
            (a["hk"] + F.when(in_k, rel).otherwise(zero)).alias("hk"),
            (a["ap"] + F.when(in_k, gain).otherwise(none)).alias("ap"), (a["all"] + gain).alias("all"),
            (a["dcg"] + F.when(in_k, rel * disc).otherwise(none)).alias("dcg"),
            (a["idcg"] + F.when(pos <= F.least(F.col("n_relevant"), F.lit(k)), disc).otherwise(none)).alias("idcg"))

    start = F.struct(*[zero.alias(c) for c in ("pos", "hits", "hk")], *[none.alias(c) for c in ("ap", "all", "dcg", "idcg")])
    per = lists.withColumn("_s", F.aggregate("_top", start, step))
    return per.select(
        u, (F.col("_s.hk") / F.lit(float(k))).alias("precision"),
        (F.col("_s.ap") / F.least(F.col("n_relevant"), F.lit(k))).alias("ap"),
        (F.col("_s.all") / F.col("n_relevant")).alias("ap_all"),
        F.coalesce(F.try_divide(F.col("_s.dcg"), F.col("_s.idcg")), none).alias("ndcg"), "n_items", "n_relevant")


def ranking_per_user(scored: DataFrame, k: int, roles: Roles, limit: int = CELL) -> DataFrame:
    """(user, precision, ap, ap_all, ndcg, n_items, n_relevant) for every scored user.
    ``limit``: rows of one user that a window may hold."""
    if k < 1:
        raise ValueError("k must be >= 1")
    u, i, r, p = roles.user, roles.item, roles.rating, roles.prediction
    rows = _clean(scored, roles)
    fair = fair_users(rows, u, limit)
    pairs = (rows.repartition(u) if fair else rows).groupBy(u, i).agg(F.max(r).alias("_r"), F.max(p).alias("_p"))
    if fair:
        return cut_lineage(_ranking_by_lists(pairs, k, u, i))     # a row a user: used again, it scans no input
    left = survivors(pairs, k, "_p", u)
    ranks, size = measured(value_ranks(left, k, "_p", u).select(u, "_p", F.col("_rank").alias("_prank"), "_n"))
    tied = ranks.groupBy(u).agg(F.sum("_n").alias("_n")).agg(F.max("_n")).first()[0] or 0
    top = join_small(left, ranks.drop("_n"), [u, "_p"], size=size)

    hist = pairs.groupBy(u, "_r").agg(F.count(F.lit(1)).alias("_n"))
    w_rat = Window.partitionBy(u).orderBy(F.col("_r").desc())
    best = hist.withColumn("_g", F.row_number().over(w_rat)).where(F.col("_g") <= k)
    before = F.coalesce(F.sum("_n").over(w_rat.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rel_stats = (best.withColumn("_rank", before + 1).where(F.col("_rank") <= k)
                 .groupBy(u).agg(F.min("_r").alias("_thr"), F.sum("_n").alias("_L")))
    sizes = hist.groupBy(u).agg(F.sum("_n").alias("_items"))
    stats = rel_stats.join(sizes, u)

    # one row per user: broadcast if small, and a tied user's rows stay spread
    t = join_small(top, stats, u).withColumn("_rel", (F.col("_r") >= F.col("_thr")).cast("int"))
    t = cell_sums(t, [u], ["_prank", i], {"_pos": None, "_hits": "_rel"}, limit, tied)
    t = t.withColumn("_pos", F.col("_pos") + 1).withColumn("_hits", F.col("_hits") + F.col("_rel"))
    disc = F.lit(1.0) / F.log(F.col("_pos") + 1.0)
    gain = F.col("_rel") * F.col("_hits") / F.col("_pos")
    in_k = F.col("_pos") <= k
    per = t.groupBy(u).agg(
        F.sum(F.when(in_k, F.col("_rel")).otherwise(0)).alias("_hk"),
        F.sum(F.when(in_k, gain).otherwise(0.0)).alias("_ap"),
        F.sum(gain).alias("_ap_all"),
        F.sum(F.when(in_k, F.col("_rel") * disc).otherwise(0.0)).alias("_dcg"),
        F.sum(F.when(F.col("_pos") <= F.least(F.col("_L"), F.lit(k)), disc).otherwise(0.0)).alias("_idcg"),
        F.first("_L").alias("n_relevant"),
        F.first("_items").alias("n_items"),
    )
    return per.select(
        u,
        (F.col("_hk") / F.lit(float(k))).alias("precision"),
        (F.col("_ap") / F.least(F.col("n_relevant"), F.lit(k))).alias("ap"),
        (F.col("_ap_all") / F.col("n_relevant")).alias("ap_all"),
        F.coalesce(F.try_divide(F.col("_dcg"), F.col("_idcg")), F.lit(0.0)).alias("ndcg"),
        F.col("n_items").cast("bigint").alias("n_items"),
        F.col("n_relevant").cast("bigint").alias("n_relevant"),
    )


def ranking_metrics(scored: DataFrame, k: int, roles: Roles, limit: int = CELL) -> DataFrame:
    """One row: precision_at_k, map_at_k, mean_average_precision, ndcg_at_k, n_users, n_users_le_k.

    ``mean_average_precision`` is MAP without a cut-off over the items whose
    prediction rank() is at most k (divisor |L|), as Spark's
    ``RankingMetrics.meanAveragePrecision`` over those lists.
    """
    per = ranking_per_user(scored, k, roles, limit)
    return per.agg(
        F.avg("precision").alias("precision_at_k"),
        F.avg("ap").alias("map_at_k"),
        F.avg("ap_all").alias("mean_average_precision"),
        F.avg("ndcg").alias("ndcg_at_k"),
        F.count(F.lit(1)).alias("n_users"),
        F.sum((F.col("n_items") <= k).cast("long")).alias("n_users_le_k"),
    )


def regression_metrics(scored: DataFrame, k: int | None, roles: Roles) -> DataFrame:
    """One row: rmse, mae, r2, n_rows over rows with prediction rank() <= k."""
    u, r, p = roles.user, roles.rating, roles.prediction
    d = _clean(scored, roles).select(u, F.col(p).cast("double").alias("_p"), F.col(r).cast("double").alias("_l"))
    err = F.col("_p") - F.col("_l")
    g = d.groupBy(u, "_p").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(err * err).alias("_se"), F.sum(F.abs(err)).alias("_ae"),
        F.avg("_l").alias("_ml"), F.var_pop("_l").alias("_vl"))
    if k is not None:
        if k < 1:
            raise ValueError("k must be >= 1")
        w = Window.partitionBy(u).orderBy(F.col("_p").desc())
        before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        g = (g.withColumn("_g", F.row_number().over(w)).where(F.col("_g") <= k)
             .withColumn("_rank", before + 1).where(F.col("_rank") <= k))
    # the mean first (a scalar subquery), then moments about it
    mean = g.agg((F.try_divide(F.sum(F.col("_n") * F.col("_ml")), F.sum("_n"))).alias("_m")).scalar()
    off = F.col("_ml") - mean
    tot = g.select("_n", "_se", "_ae", (F.col("_n") * (F.col("_vl") + off * off)).alias("_sst")).agg(
        *[F.sum(c).alias(c) for c in ("_n", "_se", "_ae", "_sst")])
    n = F.col("_n").cast("double")
    return tot.select(
        F.sqrt(F.try_divide(F.col("_se"), n)).alias("rmse"),
        F.try_divide(F.col("_ae"), n).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.col("_se"), F.col("_sst"))).alias("r2"),
        F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
    )


# metric name -> (column, kind, higher is better)
METRICS = {
    "rmse": ("rmse", "regression", False),
    "mae": ("mae", "regression", False),
    "r2": ("r2", "regression", True),
    "precisionAt": ("precision_at_k", "ranking", True),
    "meanAveragePrecision": ("map_at_k", "ranking", True),
    "ndcgAt": ("ndcg_at_k", "ranking", True),
}
assert set(METRICS) == set(REGRESSION_METRICS) | set(RANKING_METRICS)


def metric_info(name: str):
    if name not in METRICS:
        raise ValueError(f"unknown metric {name!r}; choose one of {sorted(METRICS)}")
    return METRICS[name]


def evaluate(scored: DataFrame, metric: str, k: int | None, roles: Roles) -> float:
    """A single metric as a Python float (one job)."""
    col, kind, _ = metric_info(metric)
    df = regression_metrics(scored, k, roles) if kind == "regression" else ranking_metrics(scored, k, roles)
    v = df.select(col).first()[0]
    return float("nan") if v is None else float(v)

