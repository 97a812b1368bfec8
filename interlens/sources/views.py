"""Interaction views over the driver's tables.

A  ``interactions``       lineitem joined with orders: one row per line item
B  ``event_interactions`` events with a JSON item key
C  ``string_interactions`` A with string keys (input of the index builders)
D  ``genre_records``      documents as genre JSON records (review text)

Each view exists twice: as a DataFrame plan and as SQL text for the DuckDB
oracle.  Both must stay the same definition.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Roles

# (l_orderkey, l_linenumber) is not unique in the test tables: these columns,
# then the whole row, make the order of a user's rows total.
TIEBREAK = ("l_orderkey", "l_linenumber", "l_suppkey")
ROLES = Roles(user="user_id", item="item_id", rating="rating", tiebreak=TIEBREAK)
COLUMNS = ("user_id", "item_id", "l_orderkey", "l_linenumber", "l_suppkey",
           "is_read", "rating", "is_reviewed")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View A.  Both tables are large at scale, so the join is a shuffle (merge)
    join: the hint keeps that plan at small scale too, where a broadcast of
    ``orders`` would leave every later narrow step in the one task per file."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("item_id"),
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.when(F.col("l_returnflag") == "N", 0).otherwise(1).alias("is_read"),
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("rating"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("is_reviewed"),
    )


_STORED: dict = {}
_LOCK = threading.Lock()


def stored_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View A written once per session as Parquet in the shared folder, then read.

    The join runs once instead of once per job that reads the view, the later
    scans get one split per written file and can prune columns and push down
    filters, and lineage is cut: a lost executor does not re-run the join.  The
    copy is made again when the tables' files have changed or it was released.
    """
    from ..session import fingerprint, is_scratch, scratch_path
    root = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, root,
           *(fingerprint(spark, f"{root}/{t}.parquet") for t in ("lineitem", "orders")))
    with _LOCK:
        path = _STORED.get(key)
        if path is None or not is_scratch(path):
            path = scratch_path(spark, "interactions")
            interactions(spark, sf_dir).write.mode("errorifexists").parquet(path)
            _STORED[key] = path
    return spark.read.parquet(path)


def event_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.get_json_object("props", "$.k").cast("int").alias("item_id"),
        F.col("event_type").isin("view", "purchase").cast("int").alias("is_read"),
        F.least(F.lit(5.0), F.floor(F.col("value") / 10)).cast("int").alias("rating"),
        (F.col("event_type") == "purchase").cast("int").alias("is_reviewed"),
    )


def string_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = stored_interactions(spark, sf_dir)
    return a.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_key"),
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("item_key"),
        *[c for c in COLUMNS if c not in ("user_id", "item_id")],
    )


def genre_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the genre JSON layout: the text is the review."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("user_id"),
        F.col("source").alias("book_id"),
        (F.col("lang") == "en").alias("is_read"),
        (F.col("n_chars") % 6).cast("int").alias("rating"),
        F.col("text").alias("review_text_incomplete"),
    )


def event_genre_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the genre JSON layout; purchases carry their props as review."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("book_id"),
        F.col("event_type").isin("view", "purchase").alias("is_read"),
        F.least(F.lit(5.0), F.floor(F.col("value") / 10)).cast("int").alias("rating"),
        F.when(F.col("event_type") == "purchase", F.col("props")).otherwise(F.lit("")).alias(
            "review_text_incomplete"),
    )


# ------------------------------------------------------------------ SQL text

INTERACTIONS_SQL = """
SELECT CAST(o_custkey AS INT) AS user_id, CAST(l_partkey AS INT) AS item_id,
       l_orderkey, l_linenumber, l_suppkey,
       CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS is_read,
       CAST(CEIL(l_quantity / 10) AS INT) AS rating,
       CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS is_reviewed
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

EVENT_INTERACTIONS_SQL = """
SELECT CAST(user_id AS INT) AS user_id,
       CAST(json_extract_string(props, '$.k') AS INT) AS item_id,
       CASE WHEN event_type IN ('view', 'purchase') THEN 1 ELSE 0 END AS is_read,
       CAST(LEAST(5, FLOOR(value / 10)) AS INT) AS rating,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_reviewed
FROM events
"""

STRING_INTERACTIONS_SQL = """
SELECT 'u' || CAST(user_id AS VARCHAR) AS user_key, 'b' || CAST(item_id AS VARCHAR) AS item_key,
       l_orderkey, l_linenumber, l_suppkey, is_read, rating, is_reviewed
FROM interactions
"""
