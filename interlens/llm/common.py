"""Helpers shared by the operators: inputs, sizes, written intermediate tables
and connected components over DataFrames."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import importable, release_scratch, scratch_path, shared_dir
from .textvec import mix


BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
           "spark.sql.parquet.columnarReaderBatchSize": ("4096", "512")}


def _short_batches(spark: SparkSession) -> None:
    """Texts are long: unless the session says otherwise, Arrow and Parquet
    batches have fewer rows than Spark's defaults, which bounds the memory of
    executors and of Python workers."""
    importable(spark)
    for key, (default, rows) in BATCHES.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, rows)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _short_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) of every document that has an id; a null text is empty.  Other
    columns, whatever their names, are left behind."""
    _short_batches(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")).where("id is not null")


def text_bytes(docs: DataFrame) -> tuple[int, int]:
    """Number and bytes of all texts (one narrow scan; sizes slices and sketches)."""
    n, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text").cast("long"))).first()
    return n, int(size or 0)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage is
    cut there, so losing an executor repeats no earlier stage."""
    spark = df.sparkSession
    shared_dir(spark)
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """``df`` written like ``stored``, in buckets of ``key`` (as many as the session
    has shuffle partitions): later joins and groups on the key read it in place."""
    spark = df.sparkSession
    shared_dir(spark)
    path, table = scratch_path(spark, name), f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(table)
    out = spark.table(table)
    out.schema  # noqa: B018  resolved while the table is there
    spark.sql(f"DROP TABLE {table}")    # the files stay
    out._scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that no later result reads."""
    for t in tables:
        release_scratch(t.sparkSession, t._scratch)


def _give_back() -> None:
    """Freed memory goes back to the system: Arrow's pool and, where it is there,
    glibc's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run):
    """A ``mapInArrow`` function whose worker gives back what it has freed when its
    task ends: workers that wait for the next task count as their executor's memory."""
    def one(batches):
        yield from run(batches)
        _give_back()
    return one


def slices_for(n_bytes: int, per_slice: int = 8 << 20, least: int = 64) -> int:
    """Hash slices of the input: about ``per_slice`` bytes each, and up to eight
    times as much once there are over 4096 of them (fewer, larger messages)."""
    n = -(-n_bytes // per_slice)
    return int(max(least, min(n, max(4096, n // 8))))


def crc_fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5: remainder 0 is held out."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5


def connected(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Components of the links (a, b): (node, component) with the smallest
    reachable node, for every node of a link.

    Alternating large-star and small-star steps; each aggregates minima with
    map-side combine and joins them back, so a node with very many links never
    sits in one task (AQE splits that join).  Steps are written to the shared
    folder; the number of links never grows.  It ends when a round changes no link.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "cc-links")
    for _ in range(rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large-star: neighbours above go to a's minimum
        large = (edges.select(F.col("b").alias("a"), F.col("a").alias("v")).join(low, "a")
                 .select(F.col("v").alias("a"), F.col("m").alias("b"), (F.col("m") != F.col("a")).alias("moved"))
                 .where("a <> b").groupBy("a", "b").agg(F.max("moved").alias("moved")))
        large = stored(large, "cc-large")
        # small-star: a and its neighbours below go to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"),
                                               (F.col("moved") | (F.col("m") != F.col("b"))).alias("moved"))
                 .where("a <> b").groupBy("a", "b").agg(F.max("moved").alias("moved")))
        last, edges = edges, stored(small, "cc-round")
        release(last, large)
        # without a move in either step the links are the same as before
        if not edges.where("moved").take(1):
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = nodes.union(nodes.select(F.col("component").alias("node"), "component").distinct())
    out._scratch = edges._scratch
    return out


MERGE_BYTES = 64 << 20


def fan_in(size: int) -> int:
    """Vectors of ``size`` bytes that one merge holds: a power of two up to 64."""
    return 1 << min(6, max(1, (MERGE_BYTES // max(size, 1)).bit_length() - 1))


def n_tasks(df: DataFrame) -> int:
    """Tasks that make ``df``: the parts of its scan, or the session's shuffle
    partitions where it is shuffled (nothing is run to find out)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return df.rdd.getNumPartitions()


def merged(vectors: DataFrame, column: str, size: int, add, keys: tuple[str, ...] = (), tasks: int | None = None) -> DataFrame:
    """Binary vectors of ``size`` bytes merged level by level: (keys, column).

    ``vectors`` has a row for each task (and key) and the task's number in ``task``
    (``numbered`` adds it).  ``add`` merges a list of vectors.  No group holds more
    than ``fan_in(size)`` of them, however many tasks there are; with ``tasks`` tasks
    there are as many levels as leave one row a key.
    """
    f = fan_in(size)
    tasks = n_tasks(vectors) if tasks is None else tasks

    def step(group: pa.Table) -> pa.Table:
        one = {c: group[c][:1] for c in ("task", *keys)}
        return pa.table({**one, column: pa.array([add([x.as_py() for x in group[column]])], pa.binary())})

    rows = vectors.select("task", *keys, column)
    while tasks > 1:
        tasks = -(-tasks // f)
        rows = rows.withColumn("task", F.floor(F.col("task") / f).cast("long"))
        rows = rows.groupBy("task", *keys).applyInArrow(lambda g: step(g), rows.schema)
    return rows.drop("task")


def numbered(vectors: DataFrame) -> DataFrame:
    return vectors.withColumn("task", F.spark_partition_id().cast("long"))


def _sum_vectors(blobs: list[bytes]) -> bytes:
    total = np.frombuffer(blobs[0], np.int64).copy()
    for b in blobs[1:]:
        total += np.frombuffer(b, np.int64)
    return total.tobytes()


def _or_vectors(blobs: list[bytes]) -> bytes:
    total = np.frombuffer(blobs[0], np.uint8).copy()
    for b in blobs[1:]:
        total |= np.frombuffer(b, np.uint8)
    return total.tobytes()


def summed(vectors: DataFrame, size: int) -> np.ndarray:
    """Sum of the int64 vectors of length ``size`` in the binary column ``count``,
    one a task."""
    rows = merged(numbered(vectors.select("count")), "count", 8 * size, _sum_vectors).toLocalIterator()
    return sum((np.frombuffer(r["count"], np.int64) for r in rows), np.zeros(size, np.int64))


BLOOM_BITS = 1 << 26


class IdFilter:
    """Bloom filter of a set of ids, sent to the scans: rows that surely are not
    of the set need no shuffle.  At most ``BLOOM_BITS``; beyond about ten million
    ids more rows pass, and the join that follows stays exact."""

    def __init__(self, bits: np.ndarray, spark: SparkSession):
        self.bits = spark.sparkContext.broadcast(bits)

    @staticmethod
    def slots(ids: np.ndarray, bits: int) -> list[np.ndarray]:
        h = mix(ids.astype(np.int64).view(np.uint64))
        return [((h >> np.uint64(32 * k)) & np.uint64(bits - 1)).astype(np.int64) for k in range(2)]

    def mask(self, ids: pa.Array | np.ndarray) -> np.ndarray:
        """Which ids may be of the set (in a task)."""
        bits = self.bits.value
        if not isinstance(ids, np.ndarray):
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        ok = np.ones(len(ids), bool)
        for slot in IdFilter.slots(ids, len(bits) * 8):
            ok &= (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
        return ok

    def rows(self, df: DataFrame, id_col: str, wanted: bool = True) -> DataFrame:
        """Rows that may be of the set, all of it among them; or, not
        ``wanted``, rows that surely are not of it."""
        column = df.columns.index(id_col)

        def run(batches):
            for batch in batches:
                ok = self.mask(batch.column(column))
                yield batch.filter(pa.array(ok if wanted else ~ok))

        return df.mapInArrow(run, df.schema)


def id_filter(ids: DataFrame, id_col: str, n: int) -> IdFilter:
    """Filter of the ids (no nulls) in a table of about ``n`` rows."""
    bits = min(BLOOM_BITS, 1 << max(10, (16 * max(n, 1) - 1).bit_length()))

    def run(batches):
        mine = np.zeros(bits, bool)
        for batch in batches:
            for slot in IdFilter.slots(batch.column(0).to_numpy(zero_copy_only=False), bits):
                mine[slot] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(mine, bitorder="little").tobytes()], pa.binary())], ["bits"])

    part = numbered(ids.select(ids[id_col].cast("long")).mapInArrow(run, "bits binary"))
    found = np.zeros(bits // 8, np.uint8)
    for r in merged(part, "bits", bits // 8, _or_vectors).toLocalIterator():
        found |= np.frombuffer(r["bits"], np.uint8)
    return IdFilter(found, ids.sparkSession)
