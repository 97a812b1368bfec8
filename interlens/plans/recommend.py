"""ALS training, grid search, cross-validation, refit and saving.

Spark ML's ALS does the solving; this module decides what it is fed.  Splits
are role columns on one labelled table that is persisted once for the whole
grid, and only one metric row per fit reaches the driver.

Configurations run in a small thread pool.  Each fit is its own set of Spark jobs
in a scheduler pool of its own, with the caller's job properties, so that under
``spark.scheduler.mode=FAIR`` a long fit does not starve the others.  With a
history, every fit is recorded as soon as it is done and fits that the run has
already recorded are not made again: a killed run goes on where it stopped.  The fits that
run side by side share the cores, so each takes its share of them as blocks (what an
iteration sends grows with the blocks), and a fit's shuffle files go when it is done.
A block is made and solved whole in one task's memory, so there are as many more as
keep one at ``BLOCK_RATINGS`` ratings on average.

Two audits check what comes out.  ``optimality`` tests the factors: those of the
last half step must solve each user's non-negative least squares.
``audit_metrics`` tests the numbers: it computes every metric again from the
stored scores, by plain windows over sorted rows instead of aggregates.
"""

from __future__ import annotations

import gc
import json
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_FOLDS, DEFAULT_K, DEFAULT_MAX_ITER, DEFAULT_SEED, Roles
from ..operators.joins import join_small
from ..operators.metrics import fair_users, metric_info, ranking_metrics, regression_metrics
from ..operators.split import fold_role, kfold_labels, refit_split
from ..sources.io import read_history, write_history
from .tuning import best_config, fold_mean, grid

# ALS makes a block from about 60 bytes a rating, in the heap of one task
BLOCK_RATINGS = 1 << 22

_INTEGRAL = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)


def check_ids(df: DataFrame, roles: Roles) -> None:
    """ALS needs integer user and item ids; string keys must be indexed first."""
    for c in (roles.user, roles.item):
        t = df.schema[c].dataType
        if not isinstance(t, _INTEGRAL):
            raise TypeError(f"ALS needs integer ids but column {c!r} is {t.simpleString()}: "
                            f"index it first with interlens.operators.index.attach_index")


def als_estimator(roles: Roles, rank: int, reg_param: float, max_iter: int = DEFAULT_MAX_ITER,
                  seed: int = DEFAULT_SEED, nonnegative: bool = True, cold_start: str = "drop",
                  num_blocks: int | None = None, checkpoint_interval: int = 10) -> ALS:
    """Explicit-feedback ALS as the reference configures it (M1).

    Blocks default to the cluster's parallelism (at least Spark's 10), so the
    user and item blocks spread over all cores at scale.
    """
    if not num_blocks:
        from pyspark import SparkContext
        sc = SparkContext.getOrCreate()
        num_blocks = max(10, sc.defaultParallelism)
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg_param, seed=seed, coldStartStrategy=cold_start,
              userCol=roles.user, itemCol=roles.item, ratingCol=roles.rating, implicitPrefs=False,
              nonnegative=nonnegative, checkpointInterval=checkpoint_interval)
    return als.setNumUserBlocks(num_blocks).setNumItemBlocks(num_blocks)


def fit(train: DataFrame, roles: Roles, rank: int, reg_param: float, num_blocks: int | None = None,
        n_ratings: int | None = None, **kw) -> ALSModel:
    """``num_blocks`` is the least number of blocks (default: ``als_estimator``'s); there are
    more where a block would have over ``BLOCK_RATINGS`` ratings.  ``n_ratings``: how many
    rows ``train`` has at most, counted if not given."""
    check_ids(train, roles)
    ok = F.col(roles.user).isNotNull() & F.col(roles.item).isNotNull() & F.col(roles.rating).isNotNull()
    rows = train.where(ok)
    als = als_estimator(roles, rank, reg_param, num_blocks=num_blocks, **kw)
    blocks = max(als.getNumUserBlocks(), -(-(rows.count() if n_ratings is None else n_ratings) // BLOCK_RATINGS))
    return als.setNumUserBlocks(blocks).setNumItemBlocks(blocks).fit(rows)


def score(model: ALSModel, df: DataFrame) -> DataFrame:
    """Predictions; rows with a user or item unseen in training are dropped (M2)."""
    return model.transform(df)


def score_report(model: ALSModel, df: DataFrame, roles: Roles) -> dict:
    """How many rows scoring kept and dropped (D17), in one job."""
    scored = model.transform(df).select(F.lit(1).alias("_k"))
    row = df.agg(F.count(F.lit(1)).alias("n")).first()
    kept = scored.count()
    return {"n_rows": row["n"], "n_scored": kept, "n_dropped": row["n"] - kept}


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)


def release_factors(model: ALSModel) -> None:
    """Unpersist the factor sets that ALS keeps cached behind its model, those of
    its last iterations included; the training data's own cache is left alone."""
    todo = [f._jdf.queryExecution().toRdd() for f in (model.userFactors, model.itemFactors)]
    seen = set()
    while todo:
        rdd = todo.pop()
        if rdd.id() in seen:
            continue
        seen.add(rdd.id())
        if str(rdd.name()).startswith(("userFactors", "itemFactors")):
            rdd.unpersist(False)
        deps = rdd.dependencies()
        todo += [deps.apply(n).rdd() for n in range(deps.size())]


def optimality(model: ALSModel, train: DataFrame, roles: Roles, reg_param: float, tolerance: float = 1e-4) -> DataFrame:
    """Whether each user's factors solve the least squares of the last half step:
    (user, n_ratings, residual, optimal).

    ALS ends by solving, for every user, min over x >= 0 of sum (x.y - r)^2 +
    regParam n |x|^2 with the items' factors y fixed.  There the gradient must
    vanish where x > 0 and must not be negative where x = 0; ``residual`` is the
    largest violation relative to the size of sum r y.  Rows are joined with both
    factor tables and summed per user with a partial step, so a hot user is not
    one task's.
    """
    u, i, r = roles.user, roles.item, roles.rating
    rows = train.where(F.col(u).isNotNull() & F.col(i).isNotNull() & F.col(r).isNotNull()).select(
        u, i, F.col(r).cast("double").alias("_r"))

    def factors(df, key):
        t = train.schema[key].dataType
        return df.select(F.col("id").cast(t).alias(key), F.col("features").cast("array<double>").alias(f"_{key}"))

    x, y = F.col(f"_{u}"), F.col(f"_{i}")
    rows = join_small(join_small(rows, factors(model.itemFactors, i), i), factors(model.userFactors, u), u)
    error = F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b) - F.col("_r")
    rows = rows.withColumn("_e", error)
    ranks = range(model.rank)
    sums = rows.groupBy(u).agg(F.count(F.lit(1)).alias("n_ratings"), F.first(x).alias("_x"),
                               F.array(*[F.sum(F.col("_e") * y[j]) for j in ranks]).alias("_g"),
                               F.array(*[F.sum(F.abs(F.col("_r") * y[j])) for j in ranks]).alias("_b"))
    slope = F.zip_with("_g", "_x", lambda g, a: F.struct((g + reg_param * F.col("n_ratings") * a).alias("g"), a.alias("x")))
    off = F.transform(slope, lambda s: F.when(s["x"] > 0, F.abs(s["g"])).otherwise(F.greatest(-s["g"], F.lit(0.0))))
    size = F.greatest(F.array_max("_b"), F.lit(1e-12))
    out = sums.withColumn("residual", F.array_max(off) / size)
    return out.select(u, "n_ratings", "residual",
                      ((F.col("residual") <= tolerance) & (F.array_min("_x") >= 0)).alias("optimal"))


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark's cleaner delete the shuffle files that nothing refers to any more.
    It does so when the driver collects its garbage, which an idle driver may not do
    for half an hour, while the files of fit after fit pile up on the executors."""
    gc.collect()        # the proxies first: they keep their JVM objects
    spark.sparkContext._jvm.System.gc()


def _shared_blocks(spark: SparkSession, parallelism: int) -> int:
    """ALS blocks of one of ``parallelism`` fits that run side by side: its share of the cores."""
    return max(2, -(-spark.sparkContext.defaultParallelism // max(1, parallelism)))


def _ratings(df: DataFrame, roles: Roles, *more: str) -> DataFrame:
    """The columns that fits and metrics read, for a copy that is kept."""
    return df.select(roles.user, roles.item, roles.rating, *more)


METRIC_COLUMNS = ("precision_at_k", "map_at_k", "mean_average_precision", "ndcg_at_k", "rmse", "mae", "r2")


def _metric_row(scored: DataFrame, k: int | None, roles: Roles, scores_path: str | None = None,
                by_user: bool = False, **labels) -> dict:
    """All metrics of one scored table, scored once and released.  With a path the
    scores are kept there, under ``labels`` (grid_no, fold), for ``audit_metrics``.
    ``by_user``: keep the scores dealt by user, so that the metrics, which all group
    by user, send no row again (for tables of ``fair_users``)."""
    scored = scored.select(roles.user, roles.item, roles.rating, roles.prediction)
    scored = (scored.repartition(roles.user) if by_user else scored).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if scores_path:
            part = "/".join(f"{c}={-1 if v is None else v}" for c, v in labels.items())
            scored.write.mode("overwrite").parquet(f"{scores_path}/{part}")
        rk = ranking_metrics(scored, k, roles).first().asDict() if k else {}
        rg = regression_metrics(scored, k, roles).first().asDict()
        return {**rk, **rg, "n_scored": scored.count()}
    finally:
        scored.unpersist()


def audit_metrics(table: DataFrame, scores_path: str, k: int, roles: Roles, tolerance: float = 1e-9) -> DataFrame:
    """Whether each row of a tuning table is what its stored scores say: (grid_no,
    fold, off, agrees), ``off`` being the largest difference over all metrics.

    The second route numbers every user's sorted rows in windows and averages over
    them, for all configurations in one plan.  (It holds a user's rows in one task,
    so it is a check for test sets, not the way the metrics are made.)
    """
    u, i, r, p = roles.user, roles.item, roles.rating, roles.prediction
    spark = table.sparkSession
    key = ["grid_no", "fold"]
    # dealt by user once: every group and window below holds whole users
    s = (spark.read.parquet(scores_path).where(F.col(p).isNotNull() & ~F.isnan(p) & F.col(r).isNotNull())
         .select(*key, u, i, r, p).repartition(*key, u))
    by = Window.partitionBy(*key, u)
    pr, rt = F.col(p).cast("double"), F.col(r).cast("double")
    near = s.withColumn("_k", F.rank().over(by.orderBy(F.desc(p)))).where(F.col("_k") <= k)
    regression = near.groupBy(*key).agg(
        F.sqrt(F.avg((pr - rt) * (pr - rt))).alias("rmse"), F.avg(F.abs(pr - rt)).alias("mae"),
        (1 - F.try_divide(F.sum((pr - rt) * (pr - rt)), F.var_pop(rt) * F.count(F.lit(1)))).alias("r2"))
    pairs = s.groupBy(*key, u, i).agg(F.max(r).alias("_r"), F.max(p).alias("_p"))
    best, good = by.orderBy(F.desc("_p"), F.asc(i)), by.orderBy(F.desc("_r"))
    # by rating first, then by prediction: two sorts
    pos = pairs.withColumn("_rel", (F.rank().over(good) <= k).cast("int")).withColumn("_all", F.sum("_rel").over(by))
    pos = (pos.withColumn("_pos", F.row_number().over(best))
           .withColumn("_hits", F.sum("_rel").over(best.rowsBetween(Window.unboundedPreceding, 0)))
           .withColumn("_tie", F.rank().over(by.orderBy(F.desc("_p")))))
    gain, disc = F.col("_rel") * F.col("_hits") / F.col("_pos"), 1 / F.log(F.col("_pos") + 1.0)
    top = F.col("_pos") <= k
    user = pos.groupBy(*key, u).agg(
        (F.sum(F.when(top, F.col("_rel")).otherwise(0)) / k).alias("precision_at_k"),
        (F.sum(F.when(top, gain).otherwise(0)) / F.least(F.first("_all"), F.lit(k))).alias("map_at_k"),
        (F.sum(F.when(F.col("_tie") <= k, gain).otherwise(0)) / F.first("_all")).alias("mean_average_precision"),
        (F.sum(F.when(top, F.col("_rel") * disc).otherwise(0))
         / F.sum(F.when(F.col("_pos") <= F.least(F.col("_all"), F.lit(k)), disc).otherwise(0))).alias("ndcg_at_k"))
    ranking = user.groupBy(*key).agg(*[F.avg(c).alias(c) for c in METRIC_COLUMNS[:4]])
    again = ranking.join(regression, key).select(*key, *[F.col(c).alias(f"_{c}") for c in METRIC_COLUMNS])
    mine = table.withColumn("fold", F.coalesce("fold", F.lit(-1)))
    # null in both is agreement, null in one is not
    diff = [F.when(F.col(c).isNull() & F.col(f"_{c}").isNull(), 0.0).otherwise(
        F.coalesce(F.abs(F.col(c) - F.col(f"_{c}")), F.lit(float("inf")))) for c in METRIC_COLUMNS]
    out = mine.join(F.broadcast(again), key, "left").withColumn("off", F.greatest(*diff))       # one row a fit
    return out.select(*table.columns, "off", (F.col("off") <= tolerance).alias("agrees"))


_TABLE_SCHEMA = ("grid_no int, rank int, regParam double, fold int, precision_at_k double, "
                 "map_at_k double, mean_average_precision double, ndcg_at_k double, rmse double, mae double, "
                 "r2 double, n_users bigint, n_rows bigint, seconds double")


class History:
    """The history of one run: what it has finished, and where its fits go."""

    def __init__(self, spark: SparkSession, path: str, run_id: str, metric: str = "rmse", data: str | None = None):
        self.spark, self.path, self.run_id, self.metric, self.data = spark, path, run_id, metric, data
        self.done = {}
        for r in read_history(spark, path, run_id).where("kind = 'config' AND metrics IS NOT NULL").collect():     # grid-sized
            self.done[r["rank"], r["regParam"], r["fold"]] = json.loads(r["metrics"])

    def record(self, row: dict) -> None:
        write_history(self.spark, self.path, [{
            "run_id": self.run_id, "data": self.data, "kind": "config", "rank": row["rank"], "regParam": row["regParam"],
            "fold": row["fold"], "metric": self.metric, "value": row.get(metric_info(self.metric)[0]),
            "seconds": row["seconds"], "metrics": json.dumps(row)}])


def _run_grid(spark: SparkSession, tasks, parallelism: int, history: History | None = None) -> DataFrame:
    """Run ``tasks`` ((grid_no, rank, regParam, fold), fit) side by side, each in
    its own scheduler pool; those that the history has are read from it."""
    def one(labels, fit_one):
        j, rank, reg, fold = labels
        known = history and history.done.get((rank, reg, fold))
        if known:
            return {**known, "grid_no": j}
        sc = spark.sparkContext
        sc.setLocalProperty("spark.scheduler.pool", f"interlens-{j}-{fold}")
        try:
            t0 = time.time()
            row = {"grid_no": j, "rank": rank, "regParam": reg, "fold": fold, **fit_one(), "seconds": time.time() - t0}
            if history:
                history.record(row)
            return row
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)
            release_shuffles(spark)

    # workers take over the caller's job group, description and other properties
    run = inheritable_thread_target(spark)(one)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(lambda t: run(*t), tasks))
    cols = [c.split()[0] for c in _TABLE_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], _TABLE_SCHEMA)


def tuning_table(train: DataFrame, val: DataFrame, roles: Roles, rank_list, reg_list,
                 k: int = DEFAULT_K, parallelism: int = 2, history: History | None = None,
                 scores_path: str | None = None, **als_kw) -> DataFrame:
    """One row per configuration with all metrics on the validation rows (M4).
    ``history``: record each fit, skip those recorded.  ``scores_path``: keep the
    scores of each configuration."""
    check_ids(train, roles)
    train = _ratings(train, roles).persist(StorageLevel.MEMORY_AND_DISK)
    val = _ratings(val, roles).persist(StorageLevel.MEMORY_AND_DISK)
    als_kw = {"num_blocks": _shared_blocks(train.sparkSession, parallelism), **als_kw}

    def task(j, rank, reg):
        def run():
            model = fit(train, roles, rank, reg, n_ratings=n_ratings, **als_kw)
            row = _metric_row(score(model, val), k, roles, scores_path, fair, grid_no=j, fold=None)
            release_factors(model)
            return row
        return (j, rank, reg, None), run

    try:
        fair, n_ratings = fair_users(val, roles.user), train.count()
        return _run_grid(train.sparkSession, [task(*g) for g in grid(rank_list, reg_list)], parallelism, history)
    finally:
        train.unpersist()
        val.unpersist()


def cv_table(df: DataFrame, roles: Roles, rank_list, reg_list, k: int = DEFAULT_K,
             folds: int = DEFAULT_FOLDS, seed: int = DEFAULT_SEED, parallelism: int = 2,
             **als_kw) -> DataFrame:
    """One row per (configuration, fold) (M5); ``fold_mean`` averages them.
    ``seed`` fixes the folds and, unless ``als_seed`` says otherwise, the fits;
    ``history`` and ``scores_path`` as in ``tuning_table``."""
    check_ids(df, roles)
    lab = _ratings(kfold_labels(df, roles, folds, seed=seed), roles, "user_fold", "held").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _cv_on(lab, roles, rank_list, reg_list, k, folds, seed, parallelism, **als_kw)
    finally:
        lab.unpersist()


def _cv_on(lab: DataFrame, roles: Roles, rank_list, reg_list, k, folds, seed, parallelism,
           als_seed: int | None = None, history: History | None = None, scores_path: str | None = None, **als_kw) -> DataFrame:
    als_seed = seed if als_seed is None else als_seed
    blocks = {"num_blocks": _shared_blocks(lab.sparkSession, parallelism), **als_kw}

    def task(j, rank, reg, f):
        def run():
            r = lab.withColumn("_role", fold_role(f))
            model = fit(r.where(F.col("_role") == "train"), roles, rank, reg, seed=als_seed, n_ratings=n_ratings, **blocks)
            row = _metric_row(score(model, r.where(F.col("_role") == "val")), k, roles, scores_path, fair,
                              grid_no=j, fold=f)
            release_factors(model)
            return row
        return (j, rank, reg, f), run

    fair, n_ratings = fair_users(lab.where("held = 1"), roles.user), lab.count()
    tasks = [task(j, a, b, f) for (j, a, b) in grid(rank_list, reg_list) for f in range(folds)]
    return _run_grid(lab.sparkSession, tasks, parallelism, history)


def choose(table: DataFrame, metric: str) -> dict:
    """Best configuration by ``metric`` (first in grid order on ties)."""
    col, _, higher = metric_info(metric)
    return best_config(fold_mean(table, col, out=col), col, higher).first().asDict()


def final_test_metrics(df: DataFrame, roles: Roles, rank_list, reg_list, metric: str = "rmse",
                       k: int = DEFAULT_K, folds: int = DEFAULT_FOLDS, seed: int = DEFAULT_SEED,
                       model_path: str | None = None, parallelism: int = 2, als_seed: int | None = None,
                       history: History | None = None, scores_path: str | None = None, **als_kw) -> DataFrame:
    """Cross-validate, refit the best configuration on train + val of fold 0,
    score the test rows; one row with the choice, all test metrics, dropped rows
    and seconds (M5-M7, M9).  Saves the model when ``model_path`` is given (S8).
    The labels are made once, for the folds, the refit and the test.  ``history``
    as in ``tuning_table``; ``scores_path`` keeps the test scores (grid_no -1).
    """
    t0 = time.time()
    check_ids(df, roles)
    lab = _ratings(kfold_labels(df, roles, folds, seed=seed), roles, "user_fold", "held").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        table = _cv_on(lab, roles, rank_list, reg_list, k, folds, seed, parallelism, als_seed, history, **als_kw)
        best = choose(table, metric)
        train, test = refit_split(lab)
        model = fit(train, roles, best["rank"], best["regParam"], seed=seed if als_seed is None else als_seed,
                    n_ratings=lab.count(), **als_kw)
        row = _metric_row(score(model, test), k, roles, scores_path, fair_users(test, roles.user), grid_no=-1, fold=None)
        n_test = test.count()
        if model_path:
            save_model(model, model_path)
        release_factors(model)
        del model
    finally:
        lab.unpersist()
        release_shuffles(df.sparkSession)
    out = {"rank": best["rank"], "regParam": best["regParam"], "metric": metric,
           "value": row[metric_info(metric)[0]], **row, "n_test_rows": n_test,
           "n_dropped": n_test - row["n_scored"],
           "seconds": time.time() - t0}
    schema = ("rank int, regParam double, metric string, value double, precision_at_k double, "
              "map_at_k double, mean_average_precision double, ndcg_at_k double, n_users bigint, n_users_le_k bigint, rmse double, "
              "mae double, r2 double, n_rows bigint, n_test_rows bigint, n_dropped bigint, seconds double")
    cols = [c.split()[0] for c in schema.split(", ")]
    return df.sparkSession.createDataFrame([tuple(out.get(c) for c in cols)], schema)


def record_history(spark: SparkSession, path: str, table: DataFrame, metric: str, run_id: str,
                   model_path: str | None = None, data: str | None = None, final: dict | None = None,
                   note: str | None = None) -> DataFrame:
    """Write one history row per configuration (and fold) of ``table`` and one for
    the final test result to the Parquet history at ``path`` (S9, M9).  Recorded
    again, a run's rows replace themselves.  Returns the run's history."""
    col = metric_info(metric)[0]
    cols = [c for c in ("rank", "regParam", "fold", col, "seconds") if c in table.columns]
    rows = [{"run_id": run_id, "model_path": model_path, "data": data, "kind": "config", "metric": metric, "value": r[col],
             "note": note, **{c: r[c] for c in cols if c != col}}
            for r in table.select(*cols).collect()]   # grid-sized
    if final is not None:
        rows.append({"run_id": run_id, "model_path": model_path, "data": data, "kind": "final",
                     "rank": final["rank"], "regParam": final["regParam"], "metric": metric,
                     "value": final["value"], "seconds": final.get("seconds"), "note": note})
    write_history(spark, path, rows)
    return read_history(spark, path, run_id)
