"""Readers and writers.

All readers take the caller's schema and never infer one, so no extra job runs
at read time.  Strict modes raise on a header that does not match or a cell that
does not parse; permissive modes turn bad cells into nulls and keep the raw line
in ``_corrupt_record`` so it can be counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import exists

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


# ---------------------------------------------------------------- CSV

def read_csv(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True,
             header: bool = True) -> DataFrame:
    """CSV with a header and an explicit schema.

    strict: header names must equal the schema's (``enforceSchema=False``) and any
    bad or short row fails the read.  Otherwise columns bind by position, bad
    cells become null and the raw line is kept in ``_corrupt_record``.
    """
    reader = spark.read.option("header", header)
    if strict:
        return reader.option("enforceSchema", False).option("mode", "FAILFAST").schema(schema).csv(path)
    return (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .schema(_with_corrupt(schema)).csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line per part file, no index column."""
    df.write.mode(mode).option("header", True).csv(path)


# ------------------------------------------------------------ Parquet

def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet; with ``schema`` the columns are matched by name and cast.

    The file's own schema is read first and then cast, because asking the
    reader for ``int`` where the file holds INT64 raises.  Under ANSI mode a
    value out of the target range raises too, rather than wrapping.
    """
    df = spark.read.parquet(path)
    if schema is None:
        return df
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are not in {path}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet sink; ``mode`` is overwrite (S2), ignore (S3), append or error."""
    df.write.mode(mode).parquet(path)


# ---------------------------------------------------------- JSON lines

def read_json(spark: SparkSession, path: str, schema: T.StructType, head: int | None = None,
              strict: bool = False) -> DataFrame:
    """JSON lines with an explicit schema; ``head`` keeps exactly that many rows."""
    reader = spark.read.schema(schema if strict else _with_corrupt(schema))
    if strict:
        df = reader.option("mode", "FAILFAST").json(path)
    else:
        df = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    if head is not None:
        if head < 0:
            raise ValueError("head must be >= 0")
        df = df.limit(head)
    return df


def review_flag(text: str | Column) -> Column:
    """1 when the review text is non-empty, 0 when empty or absent."""
    c = F.col(text) if isinstance(text, str) else text
    return (F.coalesce(F.length(c), F.lit(0)) > 0).cast("int")


def genre_to_interactions(df: DataFrame, user: str = "user_id", item: str = "book_id",
                          review_col: str = "is_reviewed") -> DataFrame:
    """Map genre JSON records to interaction rows (flags as int)."""
    return df.select(
        F.col("user_id").alias(user),
        F.col("book_id").alias(item),
        F.col("is_read").cast("int").alias("is_read"),
        F.col("rating").cast("int").alias("rating"),
        review_flag("review_text_incomplete").alias(review_col),
    )


def count_corrupt(df: DataFrame) -> int:
    """Rows a permissive read could not parse (one small aggregate job).  Data
    columns are counted along: Spark refuses a query of the corrupt column only."""
    if CORRUPT not in df.columns:
        return 0
    data = [F.count(F.col(c)).alias(c) for c in df.columns if c != CORRUPT]
    return df.agg(F.count_if(F.col(CORRUPT).isNotNull()).alias(CORRUPT), *data).first()[CORRUPT]


# ------------------------------------------------------------- history

HISTORY_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("kind", T.StringType()),        # "config" or "final"
    T.StructField("rank", T.IntegerType()),
    T.StructField("regParam", T.DoubleType()),
    T.StructField("fold", T.IntegerType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("note", T.StringType()),
    T.StructField("metrics", T.StringType()),     # every metric of the record, as JSON
])
_RECORD = ("kind", "rank", "regParam", "fold", "metric")     # what makes two records of a run the same


def record_id(row: dict) -> str:
    """Name of a record inside its run, the same whenever it is written again.  A
    run has one final record a metric, whatever configuration it names."""
    if row.get("kind") == "final":
        return f"final-{row.get('metric')}"
    return "-".join("none" if row.get(c) is None else repr(row[c]) if isinstance(row[c], float) else str(row[c]) for c in _RECORD)


def write_history(spark: SparkSession, path: str, rows: list[dict]) -> None:
    """Write tuning records to the Parquet history at ``path``.

    A record's place is its run and its own name (kind, configuration, fold,
    metric), and a write replaces just the places it holds: a retried run leaves
    one copy of every record, and runs that write at the same time do not touch
    each other's.
    """
    names = HISTORY_SCHEMA.fieldNames()
    if any(not r.get("run_id") for r in rows):
        raise ValueError("every record needs a run_id")
    df = spark.createDataFrame([(*(r.get(n) for n in names), record_id(r)) for r in rows],
                               T.StructType([*HISTORY_SCHEMA.fields, T.StructField("record", T.StringType())]))
    # the run stands in the data too, so that a partition value read as a number loses nothing
    (df.withColumn("run", F.col("run_id")).repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run", "record").parquet(path))


def read_history(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """The records at ``path`` (of one run); none where nothing was written."""
    if not exists(spark, path):
        return spark.createDataFrame([], HISTORY_SCHEMA)
    df = spark.read.schema(HISTORY_SCHEMA).parquet(path)
    return df.where(F.col("run_id") == run_id) if run_id is not None else df


# ------------------------------------------------------- quarantine

def quarantine_csv(spark: SparkSession, path: str, schema: T.StructType, out_path: str,
                   header: bool = True) -> tuple[DataFrame, DataFrame, dict]:
    """Split a CSV into typed rows and raw bad lines: (rows, lines, counts).

    One pass over the text writes Parquet partitioned by whether the row parsed, so
    no line is lost, kept twice or parsed again; the counts (``n_good``, ``n_bad``)
    are observed by that same write.  ``rows`` has the schema's columns, ``lines``
    the lines of all other rows as they stand (one column ``line``).
    """
    raw = read_csv(spark, path, schema, strict=False, header=header)
    counts = Observation()
    parsed = F.col(CORRUPT).isNull()
    (raw.observe(counts, F.count_if(parsed).alias("n_good"), F.count_if(~parsed).alias("n_bad"))
     .withColumn("parsed", parsed.cast("int")).write.mode("overwrite").partitionBy("parsed").parquet(out_path))
    stored = spark.read.schema(T.StructType([*_with_corrupt(schema).fields, T.StructField("parsed", T.IntegerType())])).parquet(out_path)
    return (stored.where("parsed = 1").select(*schema.fieldNames()),
            stored.where("parsed = 0").select(F.col(CORRUPT).alias("line")), counts.get)
