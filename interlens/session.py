"""Session helpers: the shared scratch folder and a local session for tests.

Everything that must outlive a task (checkpoints, round-trip files, saved
models) goes under the folder the cluster names in ``spark.checkpoint.dir``.
It is read from the session; only a local master without one gets a private
folder, as in tests.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, also
    when the driver runs in another folder.  (A cluster installs the package.)"""
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared scratch area (``spark.checkpoint.dir``)."""
    importable(spark)
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        current = sc.getCheckpointDir()
        if current:
            d = os.path.dirname(current.rstrip("/"))
    if not d:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder every executor can reach "
                "(HDFS, S3, ...) before running operators that cut lineage or write scratch files")
        d = tempfile.mkdtemp(prefix="interlens-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    root = shared_dir(spark).rstrip("/")
    path = f"{root}/interlens-scratch/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(release_scratch, spark)
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def is_scratch(path: str) -> bool:
    """Whether a scratch copy still stands."""
    return path in _SCRATCH


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, by Spark's own file system."""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def release_scratch(spark: SparkSession, *paths: str) -> int:
    """Delete the given scratch copies, or every one made so far; call it once
    results are written (``bench.py`` and the tests do; at exit it runs by itself)."""
    n = 0
    for path in list(paths or _SCRATCH):
        _SCRATCH.remove(path)
        try:
            fs, p = _file_system(spark, path)
            n += bool(fs.delete(p, True))
        except Exception:  # the session has ended: nothing can be reached any more
            break
    return n


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """(name, length, modification time) of the files of a table, by Spark's own
    file system: tells whether a table has changed since it was read."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return ()
    files = fs.listStatus(p)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder: survives executor loss, keeps
    partitions and order, and is removed with its last reference where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "interlens",
                  extra: dict | None = None) -> SparkSession:
    """Session used by tests and the benchmark: local master, UI off, AQE on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.scheduler.mode", "FAIR")     # fits of a grid share the cores
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark
