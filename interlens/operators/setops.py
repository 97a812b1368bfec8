"""Set difference with set and bag semantics.

Both sides are reduced by a hash aggregate before anything is compared, so a
group of identical rows costs one row per map task, not one task of copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .positions import expand_counts


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct values of ``cols`` (all columns when none are given)."""
    return (df.select(*cols) if cols else df).distinct()


def subtract_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right`` (SQL EXCEPT, Spark subtract).

    One aggregate over both sides tagged by origin: a single shuffle, copies
    combined before it, and nulls compare equal as EXCEPT requires.
    """
    cols = left.columns
    tagged = (left.select(*cols, F.lit(True).alias("_l"), F.lit(False).alias("_r"))
              .unionByName(right.select(*cols, F.lit(False).alias("_l"), F.lit(True).alias("_r"))))
    seen = tagged.groupBy(*cols).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return seen.where(F.col("_l") & ~F.col("_r")).select(*cols)


COPIES = "n_copies"


def counted(df: DataFrame, copies: str | None = None) -> DataFrame:
    """A bag as its distinct rows with ``n_copies``; ``copies`` names a column that
    already counts them.  The form that bag operations pass on."""
    n = F.count(F.lit(1)) if copies is None else F.sum(F.col(copies).cast("long"))
    return df.groupBy(*[c for c in df.columns if c != copies]).agg(n.alias(COPIES))


def _signed(left: DataFrame, right: DataFrame, sign: int) -> DataFrame:
    """Copies of both sides, the right one's times ``sign``, summed by row: one
    aggregate whose partial step combines equal rows before the shuffle."""
    cols = [c for c in left.columns if c != COPIES]
    both = left.unionByName(right.withColumn(COPIES, F.col(COPIES) * sign))
    return both.groupBy(*cols).agg(F.sum(COPIES).alias(COPIES))


def except_counted(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag difference of counted bags: max(0, m - n) copies of each row.  Either side
    may hold a row several times, with its copies in pieces."""
    return _signed(left, right, -1).where(F.col(COPIES) > 0)


def union_counted(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag union of counted bags."""
    return _signed(left, right, 1)


def expanded(bag: DataFrame) -> DataFrame:
    """The rows of a counted bag, each as often as it counts: once, at the sink."""
    return expand_counts(bag, COPIES)


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag difference (SQL EXCEPT ALL): each row kept max(0, m - n) times."""
    one = F.lit(1).cast("long")
    return expanded(except_counted(left.withColumn(COPIES, one), right.withColumn(COPIES, one)))
