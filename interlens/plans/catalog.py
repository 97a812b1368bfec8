"""Registered queries: each operator run over the driver's whole tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is the
same result in plain SQL for DuckDB (tables pre-registered as views).  Both use
the interaction views of ``sources.views`` and the fixed parameters below;
column names, types and rounding are kept identical so rows can be hashed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Roles
from ..functions.hashing import (SALT_FOLD, SALT_HALF, SALT_ROW, SALT_SAMPLE, SALT_SPLIT, SALT_TEST,
                                 bucket_sql, cumulative_cuts, cut)
from ..operators import filters, index, joins, metrics, sampling, setops, split, topk
from ..plans import baseline, recommend, tuning
from ..session import cut_lineage, scratch_path
from ..sources import io, schema, views
from ..sources.views import COLUMNS, ROLES

# Fixed parameters of the registered queries.
SEED = 123
THRESHOLD = 20          # activity threshold of the filters
SUBSET_THRESHOLD = 50   # stands in for the reference's 500 on these tables
SAMPLE_P = 0.25         # share of users kept by the samplers
K = 5                   # top k of the ranking and top-k queries
FOLDS = 4
DAMPING = baseline.DEFAULT_DAMPING_GRID

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _a(spark, d):
    return views.stored_interactions(spark, d)


def _cols(df: DataFrame, *extra) -> DataFrame:
    return df.select(*COLUMNS, *extra)


# ------------------------------------------------------------------ SQL pieces

C1, C2, _ = cumulative_cuts((0.6, 0.2, 0.2))
HALF = cut(0.5)
ACOLS = ", ".join(COLUMNS)


def _b(salt, *keys):
    return bucket_sql(SEED, salt, *keys)


LABELED_SQL = f"""
SELECT *, CASE WHEN split <> 'train' AND {_b(SALT_ROW, 'user_id', 'item_id')} < {HALF}
               THEN split ELSE 'train' END AS role
FROM (SELECT *, CASE WHEN {_b(SALT_SPLIT, 'user_id')} < {C1} THEN 'train'
                     WHEN {_b(SALT_SPLIT, 'user_id')} < {C2} THEN 'val' ELSE 'test' END AS split
      FROM interactions WHERE user_id IS NOT NULL) s
"""

SCORED_SQL = """
SELECT l.*, m.prediction
FROM labeled l JOIN (SELECT item_id, AVG(CAST(rating AS DOUBLE)) AS prediction
                     FROM labeled WHERE role = 'train' AND rating IS NOT NULL GROUP BY item_id) m
  ON l.item_id = m.item_id
WHERE l.role = 'val'
"""


def _sql(final: str, *ctes, views_=("interactions",)) -> str:
    """WITH <views>, <ctes> <final>."""
    defs = {"interactions": views.INTERACTIONS_SQL, "event_interactions": views.EVENT_INTERACTIONS_SQL,
            "string_interactions": views.STRING_INTERACTIONS_SQL}
    parts = [f"{v} AS ({defs[v]})" for v in views_] + [f"{n} AS ({q})" for n, q in ctes]
    return ("WITH " + ",\n".join(parts) + "\n" + final) if parts else final


def _labeled(spark, d) -> DataFrame:
    return split.label_roles(_a(spark, d), ROLES, seed=SEED)


def _scored(spark, d) -> DataFrame:
    lab = _labeled(spark, d)
    train = lab.where(F.col("role") == "train")
    val = lab.where(F.col("role") == "val")
    return baseline.score_item_mean(train, val, ROLES)


# ------------------------------------------------------------ sources

@register("interactions_scan", _sql(f"SELECT {ACOLS} FROM interactions"))
def interactions_scan(spark: SparkSession, d: str) -> DataFrame:
    """The join itself, straight from the driver tables."""
    return _cols(views.interactions(spark, d))


_A_SCHEMA = "user_id int, item_id int, l_orderkey bigint, l_linenumber int, l_suppkey bigint, " \
            "is_read int, rating int, is_reviewed int"


@register("csv_roundtrip", _sql(f"SELECT {ACOLS} FROM interactions"))
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """View A written as CSV with a header, read back strictly with its schema."""
    path = scratch_path(spark, "csv")
    io.write_csv(_cols(_a(spark, d)), path)
    from pyspark.sql.types import _parse_datatype_string
    return io.read_csv(spark, path, _parse_datatype_string(_A_SCHEMA), strict=True)


@register("json_interactions", _sql("""
SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS book_id,
       CASE WHEN event_type IN ('view', 'purchase') THEN 1 ELSE 0 END AS is_read,
       CAST(LEAST(5, FLOOR(value / 10)) AS INT) AS rating,
       CASE WHEN event_type = 'purchase' AND length(props) > 0 THEN 1 ELSE 0 END AS is_reviewed
FROM events""", views_=()))
def json_interactions(spark: SparkSession, d: str) -> DataFrame:
    """Events written as genre JSON lines, read with the genre schema, mapped."""
    path = scratch_path(spark, "json")
    views.event_genre_records(spark, d).write.mode("overwrite").json(path)
    raw = io.read_json(spark, path, schema.GENRE_JSON, strict=True)
    return io.genre_to_interactions(raw, item="book_id")


@register("review_flag", _sql("""
SELECT 'd' || CAST(doc_id AS VARCHAR) AS user_id,
       CASE WHEN coalesce(length(text), 0) > 0 THEN 1 ELSE 0 END AS is_reviewed,
       CAST(coalesce(length(text), 0) AS BIGINT) AS review_chars
FROM documents""", views_=()))
def review_flag(spark: SparkSession, d: str) -> DataFrame:
    """Documents as genre JSON (whole texts as review), read back, review flag."""
    path = scratch_path(spark, "reviews")
    views.genre_records(spark, d).write.mode("overwrite").json(path)
    raw = io.read_json(spark, path, schema.GENRE_JSON, strict=True)
    return raw.select("user_id", io.review_flag("review_text_incomplete").alias("is_reviewed"),
                      F.coalesce(F.length("review_text_incomplete"), F.lit(0)).cast("bigint").alias("review_chars"))


_CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
_CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@register("parquet_typed", """
SELECT CAST(o_orderkey AS INT) AS o_orderkey, CAST(o_custkey AS INT) AS o_custkey, o_orderstatus FROM orders""")
def parquet_typed(spark, d):
    """Orders read with the caller's narrower schema."""
    from pyspark.sql.types import _parse_datatype_string
    return io.read_parquet(spark, f"{d}/orders.parquet",
                           _parse_datatype_string("o_orderkey int, o_custkey int, o_orderstatus string"))


@register("parquet_overwrite", _CUSTOMER_SQL)
def parquet_overwrite(spark, d):
    """Suppliers written, then customers over them: the customers stand."""
    path = scratch_path(spark, "overwrite")
    io.write_parquet(views.table(spark, d, "supplier"), path)
    io.write_parquet(views.table(spark, d, "customer"), path, mode="overwrite")
    return io.read_parquet(spark, path).select(*[c.split()[0] for c in _CUSTOMER.split(", ")])


@register("parquet_ignore", _CUSTOMER_SQL)
def parquet_ignore(spark, d):
    """Customers written, then suppliers with mode ignore: the customers stand (S3)."""
    path = scratch_path(spark, "ignore")
    io.write_parquet(views.table(spark, d, "customer"), path)
    io.write_parquet(views.table(spark, d, "supplier"), path, mode="ignore")
    return io.read_parquet(spark, path).select(*[c.split()[0] for c in _CUSTOMER.split(", ")])


JSON_HEAD = 500


@register("json_head", f"SELECT CAST(LEAST(COUNT(*), {JSON_HEAD}) AS BIGINT) AS n_rows FROM events")
def json_head(spark, d):
    """Exactly the first rows asked for of the events as JSON lines."""
    path = scratch_path(spark, "json-head")
    views.event_genre_records(spark, d).write.json(path)
    return io.read_json(spark, path, schema.GENRE_JSON, head=JSON_HEAD).agg(F.count(F.lit(1)).alias("n_rows"))


BAD_EVERY = 17          # every so many events have a cell that does not parse


@register("csv_quarantine", _sql(f"""
SELECT 'row' AS kind, event_id, CAST(user_id AS INT) AS user_id, CAST(floor(value) AS INT) AS rating, NULL AS line, NULL AS n
FROM events WHERE event_id % {BAD_EVERY} <> 0 AND event_id % {BAD_EVERY} <> 5
UNION ALL SELECT 'line', NULL, NULL, NULL, event_id || ',' || user_id || ',' ||
  CASE WHEN event_id % {BAD_EVERY} = 0 THEN 'n/a' ELSE floor(value)::INT || ',' || event_type END, NULL
FROM events WHERE event_id % {BAD_EVERY} IN (0, 5)
UNION ALL SELECT 'good', NULL, NULL, NULL, NULL, COUNT(*) FILTER (event_id % {BAD_EVERY} NOT IN (0, 5)) FROM events
UNION ALL SELECT 'bad', NULL, NULL, NULL, NULL, COUNT(*) FILTER (event_id % {BAD_EVERY} IN (0, 5)) FROM events""", views_=()))
def csv_quarantine(spark, d):
    """Events as CSV lines, of which every ``BAD_EVERY``-th has a cell that is no number and
    as many have a cell too many: good rows, bad lines and both counts (S1, D13)."""
    from pyspark.sql.types import _parse_datatype_string
    ev, path = views.table(spark, d, "events"), scratch_path(spark, "bad-csv")
    rule = F.col("event_id") % BAD_EVERY
    cell = F.floor("value").cast("int").cast("string")
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"),
                       F.when(rule == 0, "n/a").otherwise(cell), F.when(rule == 5, F.col("event_type")))
    ev.select(line.alias("value")).write.text(path)
    good, bad, counts = io.quarantine_csv(spark, path, _parse_datatype_string("event_id bigint, user_id int, rating int"),
                                          scratch_path(spark, "quarantine"), header=False)
    text, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    rows = good.select(F.lit("row").alias("kind"), "event_id", "user_id", "rating", text.alias("line"), number.alias("n"))
    lines = bad.select(F.lit("line"), number, number.cast("int"), number.cast("int"), "line", number)
    totals = spark.createDataFrame([("good", counts["n_good"]), ("bad", counts["n_bad"])], "kind string, n bigint")
    return rows.union(lines).union(totals.select("kind", number, number.cast("int"), number.cast("int"), text, "n"))


# ------------------------------------------------------------ filters (A1-A4)

@register("user_activity", _sql("""
SELECT user_id, COUNT(*) AS n_interactions FROM interactions WHERE user_id IS NOT NULL GROUP BY user_id"""))
def user_activity(spark, d):
    return filters.user_activity(_a(spark, d))


@register("frequent_users", _sql(f"""
SELECT user_id FROM interactions WHERE user_id IS NOT NULL GROUP BY user_id HAVING COUNT(*) >= {THRESHOLD}"""))
def frequent_users(spark, d):
    return filters.frequent_users(_a(spark, d), threshold=THRESHOLD)


@register("frequent_users_strict", _sql(f"""
SELECT user_id FROM interactions WHERE user_id IS NOT NULL GROUP BY user_id HAVING COUNT(*) > {THRESHOLD}"""))
def frequent_users_strict(spark, d):
    return filters.frequent_users(_a(spark, d), threshold=THRESHOLD, inclusive=False)


_FREQ_ROWS = """
SELECT {cols} FROM interactions
WHERE user_id IN (SELECT user_id FROM interactions GROUP BY user_id HAVING COUNT(*) {op} {t})"""


@register("frequent_interactions_strict", _sql(_FREQ_ROWS.format(cols=ACOLS, op=">", t=THRESHOLD)))
def frequent_interactions_strict(spark, d):
    """Rows of users with more than the threshold: the result of a count window
    over the user, by aggregate and semi join."""
    return _cols(filters.frequent_interactions(_a(spark, d), threshold=THRESHOLD, inclusive=False))


@register("frequent_interactions", _sql(_FREQ_ROWS.format(cols=ACOLS, op=">=", t=THRESHOLD)))
def frequent_interactions(spark, d):
    return _cols(filters.frequent_interactions(_a(spark, d), threshold=THRESHOLD))


@register("distinct_users", _sql("SELECT DISTINCT user_id FROM interactions"))
def distinct_users(spark, d):
    return setops.distinct_values(_a(spark, d), "user_id")


@register("removal_report", _sql(f"""
SELECT CAST({THRESHOLD} AS INT) AS threshold,
       CAST(SUM(CASE WHEN user_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_users,
       CAST(SUM(n) AS BIGINT) AS n_rows,
       CAST(SUM(CASE WHEN user_id IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_user_rows,
       CAST(SUM(CASE WHEN user_id IS NOT NULL AND n >= {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS users_kept,
       CAST(SUM(CASE WHEN user_id IS NOT NULL AND n >= {THRESHOLD} THEN n ELSE 0 END) AS BIGINT) AS rows_kept,
       ROUND((1.0 - CAST(SUM(CASE WHEN user_id IS NOT NULL AND n >= {THRESHOLD} THEN 1 ELSE 0 END) AS DOUBLE)
             / SUM(CASE WHEN user_id IS NOT NULL THEN 1 ELSE 0 END)) * 100, 2) AS pct_users_removed,
       ROUND((1.0 - CAST(SUM(CASE WHEN user_id IS NOT NULL AND n >= {THRESHOLD} THEN n ELSE 0 END) AS DOUBLE)
             / SUM(n)) * 100, 2) AS pct_rows_removed
FROM (SELECT user_id, COUNT(*) AS n FROM interactions GROUP BY user_id) a"""))
def removal_report(spark, d):
    return filters.removal_report(_a(spark, d), threshold=THRESHOLD)


@register("distinct_sketch", _sql("""
SELECT rating, CAST(COUNT(DISTINCT user_id) AS BIGINT) AS n_users, true AS within
FROM interactions GROUP BY rating"""))
def distinct_sketch(spark, d):
    """Distinct users per rating, from sketches stored per (line number, rating) and
    merged: within three standard deviations of the exact count (A2)."""
    a, path = _a(spark, d), scratch_path(spark, "sketches")
    filters.distinct_sketches(a, ["l_linenumber", "rating"], "user_id").write.parquet(path)
    about = filters.merged_distinct(spark.read.parquet(path), ["rating"]).withColumnRenamed("rating", "_rating")
    exact = a.groupBy("rating").agg(F.countDistinct("user_id").alias("n_users"))
    near = F.abs(F.col("n_distinct") - F.col("n_users")) <= 3 * filters.sketch_error() * F.col("n_users")
    return (exact.join(about, F.col("rating").eqNullSafe(F.col("_rating")), "left")
            .select("rating", "n_users", F.coalesce(near, F.lit(False)).alias("within")))


# ------------------------------------------------------------ sampling

_SAMPLED = f"{_b(SALT_SAMPLE, 'user_id')} < {cut(SAMPLE_P)}"


@register("downsample_users", _sql(f"SELECT {ACOLS} FROM interactions WHERE user_id IS NOT NULL AND {_SAMPLED}"))
def downsample_users(spark, d):
    return _cols(sampling.sample_users(_a(spark, d), percentage=SAMPLE_P, seed=SEED))


@register("sample_report", _sql(f"""
SELECT CAST({SAMPLE_P} AS DOUBLE) AS percentage, CAST(COUNT(*) AS BIGINT) AS rows_kept,
       CAST(COUNT(DISTINCT user_id) AS BIGINT) AS users_kept
FROM interactions WHERE user_id IS NOT NULL AND {_SAMPLED}"""))
def sample_report(spark, d):
    s = sampling.sample_users(_a(spark, d), percentage=SAMPLE_P, seed=SEED)
    return sampling.sample_report(s, percentage=SAMPLE_P)


@register("create_subset", _sql(f"""
SELECT {ACOLS} FROM interactions
WHERE {_SAMPLED}
  AND user_id IN (SELECT user_id FROM interactions WHERE user_id IS NOT NULL
                  GROUP BY user_id HAVING COUNT(*) >= {SUBSET_THRESHOLD})"""))
def create_subset(spark, d):
    return _cols(sampling.create_subset(_a(spark, d), threshold=SUBSET_THRESHOLD, percentage=SAMPLE_P, seed=SEED))


# ------------------------------------------------------------ splits

def _split_role(role):
    def q(spark, d):
        return _cols(_labeled(spark, d).where(F.col("role") == role), "split")
    return q


for _role in ("train", "val", "test"):
    register(f"split_{_role}", _sql(f"SELECT {ACOLS}, split FROM labeled WHERE role = '{_role}'",
                                     ("labeled", LABELED_SQL)))(_split_role(_role))


_FOLD_SQL = f"""
SELECT user_id,
       CASE WHEN {_b(SALT_TEST, 'user_id')} >= {cut(0.8)} THEN -1
            ELSE CAST(FLOOR({_b(SALT_FOLD, 'user_id')} * {FOLDS} / 4294967296.0) AS INT) END AS user_fold
FROM (SELECT DISTINCT user_id FROM interactions WHERE user_id IS NOT NULL) u"""


@register("fold_assign", _sql(_FOLD_SQL))
def fold_assign(spark, d):
    users = _a(spark, d).select("user_id").where(F.col("user_id").isNotNull()).distinct()
    return users.select("user_id", split.user_fold("user_id", FOLDS, seed=SEED).alias("user_fold"))


@register("holdout_half", _sql(f"""
SELECT {ACOLS}, split, CASE WHEN role = split THEN 1 ELSE 0 END AS held
FROM labeled WHERE split <> 'train'""", ("labeled", LABELED_SQL)))
def holdout_half(spark, d):
    lab = _labeled(spark, d).where(F.col("split") != "train")
    return _cols(lab, "split", (F.col("role") == F.col("split")).cast("int").alias("held"))


_HALF_ORDER = "item_id, l_orderkey, l_linenumber, l_suppkey, is_read, rating, is_reviewed"
_HALF_SQL = f"""
SELECT {ACOLS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {{order}}) AS rn
  FROM interactions WHERE user_id IS NOT NULL) t
WHERE rn % 2 = {{parity}}"""


@register("stratified_half_even", _sql(_HALF_SQL.format(order=_HALF_ORDER, parity=0)))
def stratified_half_even(spark, d):
    return _cols(sampling.stratified_halves(_a(spark, d), ROLES, SEED).where(F.col("half") == 0))


@register("stratified_half_odd", _sql(_HALF_SQL.format(order=_HALF_ORDER, parity=1)))
def stratified_half_odd(spark, d):
    return _cols(sampling.stratified_halves(_a(spark, d), ROLES, SEED).where(F.col("half") == 1))


@register("stratified_half_hash", _sql(f"""
SELECT {ACOLS}, CAST(rn % 2 AS INT) AS half FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
                               ORDER BY {_b(SALT_HALF, 'user_id', 'item_id')}, {_HALF_ORDER}) AS rn
  FROM interactions WHERE user_id IS NOT NULL) t"""))
def stratified_half_hash(spark, d):
    return _cols(sampling.stratified_halves(_a(spark, d), ROLES, SEED, order="hash"), "half")


@register("union_all_splits", _sql(f"""
SELECT {ACOLS}, split FROM labeled WHERE role = 'train'
UNION ALL
SELECT {ACOLS}, split FROM labeled WHERE role = 'val'""", ("labeled", LABELED_SQL)))
def union_all_splits(spark, d):
    lab = _labeled(spark, d)
    return split.union_all(*[_cols(lab.where(F.col("role") == r), "split") for r in ("train", "val")])


def _refit(part):
    def q(spark, d):
        return _cols(split.final_split(_a(spark, d), ROLES, FOLDS, seed=SEED)[part])
    return q


_REFIT_LAB = f"""
SELECT *, CASE WHEN {_b(SALT_TEST, 'user_id')} >= {cut(0.8)}
                AND {_b(SALT_ROW, 'user_id', 'item_id')} < {HALF} THEN 1 ELSE 0 END AS is_test
FROM interactions WHERE user_id IS NOT NULL AND item_id IS NOT NULL"""
for _part, _name in enumerate(("train", "test")):
    register(f"final_split_{_name}", _sql(f"SELECT {ACOLS} FROM rlab WHERE is_test = {_part}",
                                          ("rlab", _REFIT_LAB)))(_refit(_part))


# ------------------------------------------------------------ set operations

@register("subtract_distinct", _sql(f"""
SELECT {ACOLS} FROM labeled WHERE split = 'val'
EXCEPT
SELECT {ACOLS} FROM labeled WHERE role = 'val'""", ("labeled", LABELED_SQL)))
def subtract_distinct(spark, d):
    lab = _labeled(spark, d)
    return setops.subtract_distinct(_cols(lab.where(F.col("split") == "val")),
                                    _cols(lab.where(F.col("role") == "val")))


_B_COLS = "user_id, item_id, is_read, rating, is_reviewed"
_B_ROLES = Roles(user="user_id", item="item_id")


@register("except_all", _sql(f"""
SELECT {_B_COLS} FROM event_interactions
EXCEPT ALL
SELECT {_B_COLS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {_B_COLS.replace('user_id, ', '')}) AS rn
  FROM event_interactions WHERE user_id IS NOT NULL) t
WHERE rn % 2 = 0""", views_=("event_interactions",)))
def except_all(spark, d):
    """Event interactions (many copies) minus their even half: the odd half, as a bag."""
    b = views.event_interactions(spark, d)
    even = sampling.stratified_halves(b, _B_ROLES, SEED, counted=True).where(F.col("half") == 0).drop("half")
    return setops.expanded(setops.except_counted(b.withColumn(setops.COPIES, F.lit(1).cast("long")), even))


@register("counted_bag", _sql(f"""
SELECT {_B_COLS}, CAST(COUNT(*) AS BIGINT) AS n_copies FROM (
  (SELECT {_B_COLS} FROM event_interactions EXCEPT ALL SELECT DISTINCT {_B_COLS} FROM event_interactions)
  UNION ALL SELECT {_B_COLS} FROM event_interactions WHERE rating >= 4) t
GROUP BY {_B_COLS}""", views_=("event_interactions",)))
def counted_bag(spark, d):
    """Surplus copies of the events' interactions (all but one of each), and all
    highly rated ones, as a counted bag that is never expanded."""
    b = setops.counted(views.event_interactions(spark, d))
    surplus = setops.except_counted(b, b.withColumn(setops.COPIES, F.lit(1).cast("long")))
    return setops.union_counted(surplus, b.where("rating >= 4"))


# ------------------------------------------------------------ heavy hitters

HOT_PARTS = 100         # a key is hot when it holds at least one in so many rows


@register("hot_keys", _sql(f"""
SELECT 'order_line' AS key_of, CAST(l_linenumber AS BIGINT) AS key, COUNT(*) AS n_rows, ANY_VALUE(n) AS n_total
FROM (SELECT l_linenumber, COUNT(*) OVER () AS n FROM interactions) a
GROUP BY l_linenumber HAVING COUNT(*) * {HOT_PARTS} >= ANY_VALUE(n)
UNION ALL
SELECT 'event_item', CAST(item_id AS BIGINT), COUNT(*), ANY_VALUE(n)
FROM (SELECT item_id, COUNT(*) OVER () AS n FROM event_interactions) b
GROUP BY item_id HAVING COUNT(*) * {HOT_PARTS} >= ANY_VALUE(n)""", views_=("interactions", "event_interactions")))
def hot_keys(spark, d):
    """Keys that one join partition in a hundred could not hold: line numbers of
    orders and items of events, by a frequent-items sketch, with exact counts."""
    parts = [joins.hot_keys(df, key, HOT_PARTS).select(
        F.lit(name).alias("key_of"), F.col(key).cast("bigint").alias("key"), "n_rows", "n_total")
        for name, df, key in (("order_line", _a(spark, d), "l_linenumber"),
                              ("event_item", views.event_interactions(spark, d), "item_id"))]
    return parts[0].unionByName(parts[1])


@register("heavy_hitter_join", _sql(f"""
SELECT {ACOLS}, n_line, mean_rating FROM interactions JOIN (
  SELECT l_linenumber, COUNT(*) AS n_line, ROUND(AVG(CAST(rating AS DOUBLE)), 6) AS mean_rating
  FROM interactions GROUP BY l_linenumber) k USING (l_linenumber)"""))
def heavy_hitter_join(spark, d):
    """Every interaction with its line number's statistics.  The key has a handful
    of values, all hot; with the broadcast ruled out, they are salted."""
    a = _a(spark, d)
    k = a.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n_line"),
                                      F.round(F.avg(F.col("rating").cast("double")), 6).alias("mean_rating"))
    return _cols(joins.join_small(a, k, "l_linenumber", limit=0), "n_line", "mean_rating")


@register("heavy_hitter_lookup", _sql("""
SELECT e.user_id, e.item_id, e.rating, m.item_index
FROM event_interactions e LEFT JOIN (
  SELECT item_id, CAST(DENSE_RANK() OVER (ORDER BY item_id) AS INT) AS item_index
  FROM (SELECT DISTINCT item_id FROM event_interactions WHERE rating >= 5) k) m
ON e.item_id = m.item_id""", views_=("event_interactions",)))
def heavy_hitter_lookup(spark, d):
    """Index lookup of the events' items (unknown ones get null) through the
    shuffle join that salts heavy hitters alone."""
    b = views.event_interactions(spark, d)
    idx, _ = index.dense_index(b.where("rating >= 5"), "item_id", start=1, out="item_index")
    return joins.join_small(b, idx, "item_id", "left", limit=0).select("user_id", "item_id", "rating", "item_index")


# ------------------------------------------------------------ index builders

@register("dense_index", _sql("""
SELECT user_key, item_key, l_orderkey, l_linenumber, l_suppkey, rating,
       CAST(DENSE_RANK() OVER (ORDER BY user_key) - 1 AS INT) AS user_key_index,
       CAST(DENSE_RANK() OVER (ORDER BY item_key) - 1 AS INT) AS item_key_index
FROM string_interactions""", views_=("interactions", "string_interactions")))
def dense_index(spark, d):
    c = index.attach_indexes(views.string_interactions(spark, d), ["user_key", "item_key"], start=0)
    return c.select("user_key", "item_key", "l_orderkey", "l_linenumber", "l_suppkey", "rating",
                    "user_key_index", "item_key_index")


@register("frequency_index", _sql("""
SELECT item_key, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, item_key) - 1 AS INT) AS item_key_index,
       CAST(n AS BIGINT) AS n_rows
FROM (SELECT item_key, COUNT(*) AS n FROM string_interactions GROUP BY item_key) c""",
    views_=("interactions", "string_interactions")))
def frequency_index(spark, d):
    """Item keys numbered most frequent first (the StringIndexer order of X4)."""
    c = views.string_interactions(spark, d)
    idx, _ = index.dense_index(c, "item_key", order="frequency")
    counts = c.groupBy("item_key").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
    return index.lookup_index(counts, idx, "item_key").select("item_key", "item_key_index", "n_rows")


_C_TRAIN = f"{_b(SALT_SPLIT, 'user_key')} < {C1}"


@register("index_map_lookup", _sql(f"""
SELECT s.user_key, s.item_key, s.rating, m.item_key_index
FROM string_interactions s LEFT JOIN (
  SELECT item_key, CAST(DENSE_RANK() OVER (ORDER BY item_key) AS INT) AS item_key_index
  FROM (SELECT DISTINCT item_key FROM string_interactions WHERE {_C_TRAIN}) k) m
ON s.item_key = m.item_key""", views_=("interactions", "string_interactions")))
def index_map_lookup(spark, d):
    """1-based item index built from training users' rows, looked up for all rows."""
    c = views.string_interactions(spark, d)
    train = c.where(split.split_label("user_key", seed=SEED) == "train")
    idx, _ = index.dense_index(train, "item_key", start=1)
    return index.lookup_index(c, idx, "item_key").select("user_key", "item_key", "rating", "item_key_index")


@register("row_index", _sql("SELECT COUNT(*) AS n_rows, COUNT(*) AS n_ids FROM interactions"))
def row_index(spark, d):
    """Row ids (X5): no row lost, no id twice."""
    return index.row_index(_a(spark, d)).agg(F.count(F.lit(1)).alias("n_rows"),
                                             F.count_distinct("row_index").alias("n_ids"))


# ------------------------------------------------------------ top k

_SCORED_CTES = (("labeled", LABELED_SQL), ("scored", SCORED_SQL))
_TOPK_COLS = "user_id, item_id, l_orderkey, l_linenumber, l_suppkey, rating"


def _topk_out(df):
    return df.select(*_TOPK_COLS.split(", "), F.round("prediction", 6).alias("prediction"),
                     F.col("rank").cast("bigint").alias("rank"))


_TOPK_SQL = f"""
SELECT {_TOPK_COLS}, ROUND(prediction, 6) AS prediction, CAST(rk AS BIGINT) AS rank FROM (
  SELECT *, {{fn}}() OVER (PARTITION BY user_id ORDER BY {{order}}) AS rk FROM scored) t
WHERE rk <= {K}"""


@register("topk_pred_rank", _sql(_TOPK_SQL.format(fn="RANK", order="prediction DESC"), *_SCORED_CTES))
def topk_pred_rank(spark, d):
    return _topk_out(topk.top_k(_scored(spark, d), K, "prediction", ROLES, ties="keep"))


@register("topk_actual_rank", _sql(_TOPK_SQL.format(fn="RANK", order="rating DESC"), *_SCORED_CTES))
def topk_actual_rank(spark, d):
    return _topk_out(topk.top_k(_scored(spark, d), K, "rating", ROLES, ties="keep"))


@register("topk_strict", _sql(_TOPK_SQL.format(
    fn="ROW_NUMBER", order="prediction DESC, item_id, l_orderkey, l_linenumber, l_suppkey"), *_SCORED_CTES))
def topk_strict(spark, d):
    return _topk_out(topk.top_k(_scored(spark, d), K, "prediction", ROLES, ties="drop"))


@register("topk_lists", _sql(f"""
SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rk) AS items, CAST(COUNT(*) AS BIGINT) AS n_items
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
                                   ORDER BY prediction DESC, item_id, l_orderkey, l_linenumber, l_suppkey) AS rk
      FROM scored) t
WHERE rk <= {K} GROUP BY user_id""", *_SCORED_CTES))
def topk_lists(spark, d):
    lists = topk.topk_lists(_scored(spark, d), K, "prediction", ROLES)
    return lists.select("user_id", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"),
                        F.size("items").cast("bigint").alias("n_items"))


# ------------------------------------------------------------ metrics

_REG_SQL = f"""
SELECT {{expr}} AS {{name}}, CAST(COUNT(*) AS BIGINT) AS n_rows FROM (
  SELECT *, RANK() OVER (PARTITION BY user_id ORDER BY prediction DESC) AS rk FROM scored) t
WHERE rk <= {K}"""


def _reg_query(name):
    def q(spark, d):
        m = metrics.regression_metrics(_scored(spark, d), K, ROLES)
        return m.select(F.round(name, 6).alias(name), "n_rows")
    return q


for _name, _expr in (
        ("rmse", "ROUND(SQRT(AVG((prediction - rating) * (prediction - rating))), 6)"),
        ("mae", "ROUND(AVG(ABS(prediction - rating)), 6)"),
        ("r2", "ROUND(1 - SUM((prediction - rating) * (prediction - rating)) / "
               "(VAR_POP(CAST(rating AS DOUBLE)) * COUNT(*)), 6)")):
    register(f"topk_{_name}", _sql(_REG_SQL.format(expr=_expr, name=_name), *_SCORED_CTES))(_reg_query(_name))


# Per user: collapse to distinct items (best rating), predicted positions by
# (prediction desc, item), relevance = rating rank() <= k.
_RANK_CTES = _SCORED_CTES + (
    ("pairs", "SELECT user_id, item_id, MAX(rating) AS r, MAX(prediction) AS p FROM scored "
              "WHERE rating IS NOT NULL AND prediction IS NOT NULL GROUP BY user_id, item_id"),
    ("ranked", f"""SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY p DESC, item_id) AS pos,
                   RANK() OVER (PARTITION BY user_id ORDER BY p DESC) AS prank,
                   CASE WHEN RANK() OVER (PARTITION BY user_id ORDER BY r DESC) <= {K} THEN 1 ELSE 0 END AS rel
                   FROM pairs"""),
    ("sized", "SELECT *, SUM(rel) OVER (PARTITION BY user_id) AS nrel, "
              "SUM(rel) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
              "AS hits FROM ranked"),
    ("per_user", f"""SELECT user_id,
        SUM(CASE WHEN pos <= {K} THEN rel ELSE 0 END) / {float(K)} AS precision,
        SUM(CASE WHEN pos <= {K} THEN rel * hits / pos ELSE 0 END) / LEAST(MAX(nrel), {K}) AS ap,
        SUM(CASE WHEN prank <= {K} THEN rel * hits / pos ELSE 0 END) / MAX(nrel) AS ap_all,
        SUM(CASE WHEN pos <= {K} THEN rel / LN(pos + 1.0) ELSE 0 END)
          / SUM(CASE WHEN pos <= LEAST(nrel, {K}) THEN 1 / LN(pos + 1.0) ELSE 0 END) AS ndcg,
        COUNT(*) AS n_items
      FROM sized GROUP BY user_id"""),
)


def _rank_query(col):
    def q(spark, d):
        m = metrics.ranking_metrics(_scored(spark, d), K, ROLES)
        return m.select(F.round(col, 6).alias(col), F.col("n_users").cast("bigint").alias("n_users"),
                        F.col("n_users_le_k").cast("bigint").alias("n_users_le_k"))
    return q


for _col, _src in (("precision_at_k", "precision"), ("map_at_k", "ap"), ("ndcg_at_k", "ndcg"),
                   ("mean_average_precision", "ap_all")):
    register(_col, _sql(
        f"SELECT ROUND(AVG({_src}), 6) AS {_col}, CAST(COUNT(*) AS BIGINT) AS n_users, "
        f"CAST(SUM(CASE WHEN n_items <= {K} THEN 1 ELSE 0 END) AS BIGINT) AS n_users_le_k FROM per_user",
        *_RANK_CTES))(_rank_query(_col))


# ------------------------------------------------------------ the same on event interactions
# (view B: many repeated (user, item) pairs and tied ratings 0-5)

_EV_LABELED_SQL = LABELED_SQL.replace("FROM interactions ", "FROM event_interactions ")
_EV_SCORED_CTES = (("labeled", _EV_LABELED_SQL), ("scored", SCORED_SQL))
_EV_RANK_CTES = _EV_SCORED_CTES + _RANK_CTES[2:]


def _scored_events(spark, d) -> DataFrame:
    lab = split.label_roles(views.event_interactions(spark, d), _B_ROLES, seed=SEED)
    return baseline.score_item_mean(lab.where(F.col("role") == "train"), lab.where(F.col("role") == "val"),
                                    _B_ROLES)


@register("event_topk_actual_rank", _sql(f"""
SELECT {_B_COLS}, ROUND(prediction, 6) AS prediction, CAST(rk AS BIGINT) AS rank FROM (
  SELECT *, RANK() OVER (PARTITION BY user_id ORDER BY rating DESC) AS rk FROM scored) t
WHERE rk <= {K}""", *_EV_SCORED_CTES, views_=("event_interactions",)))
def event_topk_actual_rank(spark, d):
    t = topk.top_k(_scored_events(spark, d), K, "rating", _B_ROLES, ties="keep")
    return t.select(*_B_COLS.split(", "), F.round("prediction", 6).alias("prediction"),
                    F.col("rank").cast("bigint").alias("rank"))


@register("event_precision_at_k", _sql(
    f"SELECT ROUND(AVG(precision), 6) AS precision_at_k, ROUND(AVG(ndcg), 6) AS ndcg_at_k, "
    f"CAST(COUNT(*) AS BIGINT) AS n_users, "
    f"CAST(SUM(CASE WHEN n_items <= {K} THEN 1 ELSE 0 END) AS BIGINT) AS n_users_le_k FROM per_user",
    *_EV_RANK_CTES, views_=("event_interactions",)))
def event_precision_at_k(spark, d):
    m = metrics.ranking_metrics(_scored_events(spark, d), K, _B_ROLES)
    return m.select(F.round("precision_at_k", 6).alias("precision_at_k"), F.round("ndcg_at_k", 6).alias("ndcg_at_k"),
                    F.col("n_users").cast("bigint").alias("n_users"),
                    F.col("n_users_le_k").cast("bigint").alias("n_users_le_k"))


# ------------------------------------------------------------ tuning tables

_FOLD_LAB = f"""
SELECT *, CASE WHEN {_b(SALT_TEST, 'user_id')} >= {cut(0.8)} THEN -1
               ELSE CAST(FLOOR({_b(SALT_FOLD, 'user_id')} * {FOLDS} / 4294967296.0) AS INT) END AS user_fold,
          CASE WHEN {_b(SALT_ROW, 'user_id', 'item_id')} < {HALF} THEN 1 ELSE 0 END AS held
FROM interactions WHERE user_id IS NOT NULL AND rating IS NOT NULL"""

_GRID_LIST = ", ".join(f"{{'grid_no': {j}, 'regParam': CAST({x} AS DOUBLE)}}" for j, x in enumerate(DAMPING))
_FOLD_LIST = ", ".join(str(f) for f in range(FOLDS))
_CV_CTES = (
    ("flab", _FOLD_LAB),
    # each row once per fold it trains in (UNNEST, the SQL twin of explode)
    ("train_f", f"""SELECT fold, item_id, rating FROM (
                      SELECT item_id, rating, user_fold, held, UNNEST([{_FOLD_LIST}]) AS fold FROM flab) t
                    WHERE NOT (user_fold = -1 AND held = 1) AND NOT (user_fold = fold AND held = 1)"""),
    ("mu", "SELECT fold, SUM(rating) AS s, COUNT(*) AS n FROM train_f GROUP BY fold"),
    ("istat", "SELECT fold, item_id, SUM(rating) AS s, COUNT(*) AS n FROM train_f GROUP BY fold, item_id"),
    ("scored_cv", f"""SELECT v.user_fold AS fold, v.rating, m.s AS ms, m.n AS mn, i.s AS s_i, i.n AS n_i,
                             UNNEST([{_GRID_LIST}]) AS g
                      FROM flab v JOIN istat i ON i.fold = v.user_fold AND i.item_id = v.item_id
                           JOIN mu m ON m.fold = v.user_fold
                      WHERE v.user_fold >= 0 AND v.held = 1"""),
    ("cv", """SELECT g.grid_no AS grid_no, g.regParam AS regParam, fold,
                SQRT(AVG(POWER(((CAST(ms AS DOUBLE) / mn) + (s_i - (CAST(ms AS DOUBLE) / mn) * n_i)
                               / (n_i + g.regParam)) - rating, 2))) AS rmse,
                CAST(COUNT(*) AS BIGINT) AS n_rows
              FROM scored_cv GROUP BY g.grid_no, g.regParam, fold"""),
)


def _cv(spark, d):
    return baseline.baseline_cv_table(_a(spark, d), ROLES, FOLDS, DAMPING, SEED)


@register("baseline_cv_table", _sql(
    "SELECT CAST(grid_no AS INT) AS grid_no, regParam, CAST(fold AS INT) AS fold, ROUND(rmse, 6) AS rmse, n_rows "
    "FROM cv", *_CV_CTES))
def baseline_cv_table(spark, d):
    t = _cv(spark, d)
    return t.select(F.col("grid_no").cast("int").alias("grid_no"), "regParam", F.col("fold").cast("int").alias("fold"),
                    F.round("rmse", 6).alias("rmse"), F.col("n_rows").cast("bigint").alias("n_rows"))


@register("fold_mean", _sql(
    "SELECT CAST(grid_no AS INT) AS grid_no, regParam, ROUND(AVG(rmse), 6) AS mean_rmse FROM cv "
    "GROUP BY grid_no, regParam", *_CV_CTES))
def fold_mean(spark, d):
    m = tuning.fold_mean(_cv(spark, d), "rmse", ("grid_no", "regParam"))
    return m.select(F.col("grid_no").cast("int").alias("grid_no"), "regParam",
                    F.round("mean_rmse", 6).alias("mean_rmse"))


@register("best_config", _sql(
    "SELECT CAST(grid_no AS INT) AS grid_no, regParam, ROUND(mean_rmse, 6) AS mean_rmse FROM ("
    "SELECT grid_no, regParam, AVG(rmse) AS mean_rmse FROM cv GROUP BY grid_no, regParam) t "
    "ORDER BY mean_rmse, grid_no LIMIT 1", *_CV_CTES))
def best_config(spark, d):
    m = tuning.fold_mean(_cv(spark, d), "rmse", ("grid_no", "regParam"))
    b = tuning.best_config(m, "mean_rmse", higher_is_better=False)
    return b.select(F.col("grid_no").cast("int").alias("grid_no"), "regParam",
                    F.round("mean_rmse", 6).alias("mean_rmse"))


# ------------------------------------------------------------ ALS
#
# No SQL engine repeats a factorisation, so these queries return what SQL can
# check: which rows are scored, the grid and its folds, the users and rows that
# the metrics cover, what a reload changes.  tests/test_recommend.py compares
# each prediction with the dot product of the saved factors.

ALS_RANK, ALS_REG = 5, 0.1
GRID_RANKS, GRID_REGS = (5, 10), (0.01, 0.1)
CV_RANKS, CV_REGS = (5, 10), (0.1,)


def _n_rows(spark, d) -> int:
    """Ratings that a split of view A has at most (from the files' footers alone)."""
    return _a(spark, d).count()


def _als_split(spark, d):
    lab = _labeled(spark, d)
    return lab.where(F.col("role") == "train"), lab.where(F.col("role") == "val")


# rows of {target} whose user and item are both in {train}
_COVERED = """SELECT t.* FROM {target} t WHERE t.user_id IN (SELECT user_id FROM {train} WHERE rating IS NOT NULL)
              AND t.item_id IN (SELECT item_id FROM {train} WHERE rating IS NOT NULL)"""
_ALS_CTES = (("labeled", LABELED_SQL), ("als_train", "SELECT * FROM labeled WHERE role = 'train'"),
             ("als_val", "SELECT * FROM labeled WHERE role = 'val'"),
             ("covered", _COVERED.format(target="als_val", train="als_train")))


def _grid_rows(ranks, regs):
    return "(VALUES " + ", ".join(f"({j}, {a}, CAST({b} AS DOUBLE))" for j, a, b in tuning.grid(ranks, regs)) \
        + ") g(grid_no, rank, regParam)"


@register("als_predict", _sql("SELECT user_id, item_id, rating, true AS predicted FROM covered", *_ALS_CTES))
def als_predict(spark, d):
    """ALS fit on the training role, scored on the held-out validation rows: the
    rows whose user and item were both trained get a number."""
    train, val = _als_split(spark, d)
    model = recommend.fit(train, ROLES, ALS_RANK, ALS_REG, seed=SEED, n_ratings=_n_rows(spark, d))
    return recommend.score(model, val).select(
        "user_id", "item_id", "rating",
        (F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("predicted"))


@register("als_optimality", _sql("""
SELECT user_id, CAST(COUNT(*) AS BIGINT) AS n_ratings, true AS optimal
FROM als_train WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL GROUP BY user_id""", *_ALS_CTES))
def als_optimality(spark, d):
    """Each trained user's factors solve the non-negative least squares of the
    fit's last half step, over exactly that user's ratings (M1)."""
    train, _ = _als_split(spark, d)
    model = recommend.fit(train, ROLES, ALS_RANK, ALS_REG, seed=SEED, n_ratings=_n_rows(spark, d))
    return recommend.optimality(model, train, ROLES, ALS_REG).drop("residual")


@register("als_reload_scores", _sql("SELECT user_id, item_id, rating, CAST(0 AS DOUBLE) AS abs_diff FROM covered",
                                    *_ALS_CTES))
def als_reload_scores(spark, d):
    """Saved and reloaded model scores the same rows with the same numbers."""
    train, val = _als_split(spark, d)
    model = recommend.fit(train, ROLES, ALS_RANK, ALS_REG, seed=SEED, n_ratings=_n_rows(spark, d))
    path = scratch_path(spark, "als-model")
    recommend.save_model(model, path)
    first = recommend.score(model, val.select("user_id", "item_id", "rating")) \
        .withColumnRenamed("prediction", "prediction_saved")
    again = recommend.score(recommend.load_model(path), first)
    return again.select("user_id", "item_id", "rating",
                        F.abs(F.col("prediction") - F.col("prediction_saved")).cast("double").alias("abs_diff"))


@register("tuning_table", _sql(
    f"SELECT CAST(grid_no AS INT) AS grid_no, CAST(rank AS INT) AS rank, regParam, "
    f"(SELECT COUNT(DISTINCT user_id) FROM covered) AS n_users, true AS measured, true AS agrees, true AS timed "
    f"FROM {_grid_rows(GRID_RANKS, GRID_REGS)}", *_ALS_CTES))
def tuning_table(spark, d):
    """ALS grid on train / validation: every metric per configuration (M4), each
    equal to the same metric of the stored scores by a second route."""
    (train, val), path = _als_split(spark, d), scratch_path(spark, "grid-scores")
    t = recommend.tuning_table(train, val, ROLES, GRID_RANKS, GRID_REGS, k=K, seed=SEED, scores_path=path)
    return recommend.audit_metrics(t, path, K, ROLES).select("grid_no", "rank", "regParam", "n_users", _measured(), "agrees", _timed())


def _timed():
    """The fit took time, and no longer than a day (M9)."""
    return (F.col("seconds").isNotNull() & (F.col("seconds") > 0) & (F.col("seconds") < 86400)).alias("timed")


def _measured():
    """All metrics are numbers, and shares lie in [0, 1]."""
    ok = F.col("rmse").isNotNull() & F.col("mae").isNotNull() & F.col("r2").isNotNull()
    for c in ("precision_at_k", "map_at_k", "mean_average_precision", "ndcg_at_k"):
        ok = ok & F.col(c).between(0, 1)
    return ok.alias("measured")


# the k-fold roles: each fold's training rows, and its validation rows that they cover
_ALS_CV_CTES = (
    ("flab", _FOLD_LAB),
    ("fold_train", f"""SELECT fold, user_id, item_id FROM (SELECT *, UNNEST([{_FOLD_LIST}]) AS fold FROM flab) t
                       WHERE NOT (user_fold = -1 AND held = 1) AND NOT (user_fold = fold AND held = 1)"""),
    ("fold_val", """SELECT user_fold AS fold, user_id, item_id FROM flab WHERE user_fold >= 0 AND held = 1"""),
    ("fold_users", """SELECT fold, COUNT(DISTINCT user_id) AS n_users FROM fold_val v
                      WHERE EXISTS (SELECT 1 FROM fold_train t WHERE t.fold = v.fold AND t.user_id = v.user_id)
                        AND EXISTS (SELECT 1 FROM fold_train t WHERE t.fold = v.fold AND t.item_id = v.item_id)
                      GROUP BY fold"""),
    ("refit", "SELECT * FROM flab WHERE NOT (user_fold = -1 AND held = 1)"),
    ("tested", "SELECT * FROM flab WHERE user_fold = -1 AND held = 1"),
    ("covered_test", _COVERED.format(target="tested", train="refit")),
)


@register("cv_table", _sql(
    f"SELECT CAST(grid_no AS INT) AS grid_no, CAST(rank AS INT) AS rank, regParam, CAST(fold AS INT) AS fold, n_users, "
    f"true AS measured, true AS agrees, true AS timed FROM fold_users JOIN {_grid_rows(CV_RANKS, CV_REGS)} ON true", *_ALS_CV_CTES))
def cv_table(spark, d):
    """ALS grid over k folds: one row per (configuration, fold) (M5), its metrics
    those of the stored scores by a second route."""
    path = scratch_path(spark, "fold-scores")
    t = recommend.cv_table(_a(spark, d), ROLES, CV_RANKS, CV_REGS, k=K, folds=FOLDS, seed=SEED, scores_path=path)
    return recommend.audit_metrics(t, path, K, ROLES).select(
        "grid_no", "rank", "regParam", "fold", "n_users", _measured(), "agrees", _timed())


@register("final_test_metrics", _sql(f"""
SELECT 'precisionAt' AS metric, (SELECT COUNT(*) FROM tested) AS n_test_rows,
       (SELECT COUNT(*) FROM tested) - (SELECT COUNT(*) FROM covered_test) AS n_dropped,
       COUNT(*) AS n_users, COUNT(*) FILTER (n_items <= {K}) AS n_users_le_k, true AS measured,
       true AS agrees, true AS timed
FROM (SELECT user_id, COUNT(DISTINCT item_id) AS n_items FROM covered_test GROUP BY user_id)""", *_ALS_CV_CTES))
def final_test_metrics(spark, d):
    """Cross-validate, refit the best on train + val, test metrics; model saved (M6-M9).
    All test metrics, the chosen one among them, equal those of the stored scores."""
    path = scratch_path(spark, "test-scores")
    t = recommend.final_test_metrics(_a(spark, d), ROLES, CV_RANKS, CV_REGS, metric="precisionAt", k=K, folds=FOLDS, seed=SEED,
                                     model_path=scratch_path(spark, "final-model"), scores_path=path)
    t = recommend.audit_metrics(t.withColumns({"grid_no": F.lit(-1), "fold": F.lit(None).cast("int")}), path, K, ROLES)
    chosen = F.col("value") == F.col("precision_at_k")
    return t.select("metric", "n_test_rows", "n_dropped", "n_users", "n_users_le_k", _measured(),
                    (F.col("agrees") & chosen).alias("agrees"), _timed())


# a resumed run: its first fits are there already
_RESUME_RANKS, _RESUME_REGS = (3, 5), (0.05, 0.1)


@register("tuning_resume", f"""
SELECT CAST(rank AS INT) AS rank, regParam, CAST(1 AS BIGINT) AS n_records, grid_no < 2 AS kept, true AS timed
FROM {_grid_rows(_RESUME_RANKS, _RESUME_REGS)}, (SELECT COUNT(*) AS n FROM lineitem) t WHERE n > 0""")
def tuning_resume(spark, d):
    """An ALS grid that stopped after its first two fits, run again to its end:
    each configuration is recorded once, those two as they were (M4, M5, M9, S9)."""
    (train, val), path = _als_split(spark, d), scratch_path(spark, "resumed")

    def run(ranks):
        h = recommend.History(spark, path, "nightly")
        recommend.tuning_table(train, val, ROLES, ranks, _RESUME_REGS, k=K, history=h, seed=SEED, max_iter=2)

    run(_RESUME_RANKS[:1])
    first = io.read_history(spark, path, "nightly").select("rank", "regParam", F.col("seconds").alias("_s"), F.col("value").alias("_v")).collect()
    run(_RESUME_RANKS)
    before = spark.createDataFrame(first, "rank int, regParam double, _s double, _v double")         # two records
    h = io.read_history(spark, path, "nightly").join(F.broadcast(before), ["rank", "regParam"], "left")
    kept = (F.col("_s") == F.col("seconds")) & (F.col("_v") == F.col("value"))
    return h.groupBy("rank", "regParam").agg(F.count(F.lit(1)).alias("n_records"), F.bool_and(F.coalesce(kept, F.lit(False))).alias("kept"),
                                             F.bool_and(F.col("seconds") > 0).alias("timed"))


@register("history_retry", _sql(
    "SELECT run_id, regParam, CAST(fold AS INT) AS fold, 'rmse' AS metric, ROUND(rmse, 6) AS value "
    "FROM cv, (VALUES ('a'), ('b')) r(run_id)", *_CV_CTES))
def history_retry(spark, d):
    """The baseline's tuning table recorded by two runs, the first of which is
    retried: read back, every run has each record once, with its value (S9)."""
    path, t = scratch_path(spark, "retried"), _cv(spark, d).select(F.lit(0).alias("rank"), "regParam", "fold", "rmse")
    t = cut_lineage(t)      # made once: grid-sized, recorded three times
    for run in ("a", "b", "a"):
        recommend.record_history(spark, path, t, "rmse", run_id=run, data=d)
    return io.read_history(spark, path).select("run_id", "regParam", "fold", "metric", F.round("value", 6).alias("value"))


@register("tuning_history", f"""
SELECT 'config' AS kind, CAST(rank AS INT) AS rank, regParam, 'rmse' AS metric, true AS has_value
FROM {_grid_rows(GRID_RANKS, GRID_REGS)}
UNION ALL SELECT 'final', NULL, NULL, 'rmse', true""")
def tuning_history(spark, d):
    """ALS grid on train / validation, best configuration refit on train and
    scored on the test rows; every configuration and the final result appended
    to a Parquet history table, which is read back (S9, M9).  The final row's
    configuration is the fit's choice, so it is not returned."""
    import uuid
    lab = _labeled(spark, d)
    train, val = lab.where(F.col("role") == "train"), lab.where(F.col("role") == "val")
    table = recommend.tuning_table(train, val, ROLES, GRID_RANKS, GRID_REGS, k=K, seed=SEED)
    best = recommend.choose(table, "rmse")
    model = recommend.fit(lab.where(F.col("role") != "test"), ROLES, best["rank"], best["regParam"], seed=SEED,
                          n_ratings=_n_rows(spark, d))
    test_rmse = metrics.evaluate(recommend.score(model, lab.where(F.col("role") == "test")), "rmse", K, ROLES)
    recommend.release_factors(model)
    path = scratch_path(spark, "history")
    recommend.record_history(spark, path, table, "rmse", run_id=uuid.uuid4().hex[:8], data=d,
                             final={"rank": best["rank"], "regParam": best["regParam"], "value": test_rmse},
                             note=f"top {K} rmse on test rows")
    config = F.col("kind") == "config"
    return io.read_history(spark, path).select("kind", F.when(config, F.col("rank")).alias("rank"),
                                           F.when(config, F.col("regParam")).alias("regParam"), "metric",
                                           F.col("value").isNotNull().alias("has_value"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Frequent users -> hash split -> hold-out -> item-mean predictor -> all top-k metrics."""
    a = filters.frequent_interactions(_a(spark, d), threshold=THRESHOLD)
    lab = split.label_roles(a, ROLES, seed=SEED)
    scored = baseline.score_item_mean(lab.where(F.col("role") == "train"), lab.where(F.col("role") == "val"), ROLES)
    rk = metrics.ranking_metrics(scored, K, ROLES)
    rg = metrics.regression_metrics(scored, K, ROLES)
    return rk.join(F.broadcast(rg))  # two one-row aggregates
