"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


# Paths of materialized tables by application, and the names of those in the catalog, for ``release``.
_WRITTEN: dict[str, list[str]] = {}
_NAMED: dict[str, list[str]] = {}
# Frames over materialized tables that queries of one application share; forgotten by ``release``.
SHARED: dict[tuple, object] = {}
# Rows of a partition that a task sorts: some hundred bytes each, within a task's share of an executor's memory.
ROWS_PER_PARTITION = 500_000


def build_session(master: str | None = None, partitions: int | None = None,
                  app: str = "dosecast", driver_memory: str | None = None) -> SparkSession:
    """Local or cluster session with AQE on and the UI off.

    On a cluster ``master`` is left to spark-submit; shuffle partitions then
    come from the cluster config and AQE coalesces them at run time.  In
    local mode the driver JVM is the only executor, so it gets a real heap
    (``$DOSECAST_DRIVER_MEMORY``, default 8g) instead of the 1g default.
    """
    b = (SparkSession.builder.appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.driver.memory",
                         driver_memory or os.environ.get("DOSECAST_DRIVER_MEMORY", "8g"))
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give every executor this package (once a session): Python workers import its modules by name,
    wherever the driver was started.  The archive is handed out by the driver, not read from a shared path."""
    sc = spark.sparkContext
    if getattr(sc, "_dosecast_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="dosecast-zip-"), "dosecast.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.join("dosecast", os.path.relpath(path, here)))
    sc.addPyFile(archive)
    sc._dosecast_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (tests, a laptop) a fresh local folder is registered through the
    SparkContext (the conf itself cannot be changed at run time).
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                               "(a machine-local folder does not survive executor loss)")
        d = tempfile.mkdtemp(prefix="dosecast-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name) if "://" not in base else f"{base.rstrip('/')}/tables/{name}"


def materialize(df, name: str = "table", observe=None):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Used for tables that several branches consume (the extracts, the panel):
    they are computed once instead of once per branch; the lineage is cut so a
    lost executor recomputes nothing upstream; and, unlike a checkpointed RDD,
    the read-back gets column pruning and filter pushdown.  Never a local
    checkpoint or a machine-local folder on a cluster.
    """
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    if observe is not None:          # (Observation, metric columns...) computed during the write
        df = df.observe(*observe)
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.parquet(path)


def partitions_for(spark, rows: int) -> int:
    """Partitions for ``rows`` rows: the session's number for shuffles, or more, so that what a task sorts does not grow
    with the input.  A set number of partitions is not split by AQE, and a task's sort beyond its memory is spilled."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_PARTITION))


def materialize_by(df, keys: list[str], name: str = "table", partitions: int | None = None):
    """``materialize`` as a table bucketed by ``keys`` and sorted within its buckets: joins, aggregations and windows by
    these keys (or more) read it without a shuffle.  For tables in which no key holds many rows; those that are joined
    have the same number of ``partitions`` (the session's if not given)."""
    import uuid
    spark = df.sparkSession
    # A join on more keys than the buckets' is co-partitioned too.
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    table = f"dosecast_{name}_{uuid.uuid4().hex}"
    path, n = scratch_path(spark, table), partitions or partitions_for(spark, 0)
    # Each task holds one bucket, sorted here: the writer's own sort would first compare the bucket's hash, row by row.
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "4")
    (df.repartition(n, *keys).sortWithinPartitions(*keys).write.format("parquet").option("path", path).bucketBy(n, *keys).saveAsTable(table))
    app = spark.sparkContext.applicationId
    _WRITTEN.setdefault(app, []).append(path)
    _NAMED.setdefault(app, []).append(table)
    return spark.table(table)


def large(df):
    """``df`` as a side of a join that is not to be broadcast.  Spark plans with the size of compressed files, in which
    an explode or a repeated value does not show, so a table of many rows can pass for a small one and fill the driver."""
    return df.hint("merge")


def deal(df, *keys: str, partitions: int | None = None):
    """``df`` hash-partitioned by ``keys``; joins by these keys and more, which may be put in afterwards, then need no
    other shuffle."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return df.repartition(partitions or partitions_for(spark, 0), *keys)


def small_or_large(df, name: str = "table", most: int = 500_000):
    """``df`` (short rows) written and its rows counted: for a broadcast up to ``most`` rows, else ``large``."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    seen = Observation(name)
    df = materialize(df, name, (seen, F.count(F.lit(1)).alias("n")))
    return F.broadcast(df) if seen.get["n"] <= most else large(df)


def release(spark: SparkSession) -> int:
    """Delete the tables that ``materialize`` has written in this application; how many there were.

    For the job runner, once the results that read them are written: tables
    are kept until then, because a DataFrame may still read them.
    """
    jvm = spark.sparkContext._jvm
    SHARED.clear()
    for table in _NAMED.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"drop table if exists {table}")
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return len(paths)


def materialize_all(dfs: dict, by: dict[str, list[str]] | None = None, partitions: int | None = None) -> dict:
    """Materialize independent DataFrames as concurrent Spark jobs; those named in ``by`` bucketed by these keys.

    The jobs share nothing, so submitting them from driver threads lets the
    scheduler overlap their stages instead of running them back to back.
    Values may be zero-argument builders, so plan construction (analysis on
    the driver) overlaps as well.
    """
    from concurrent.futures import ThreadPoolExecutor
    if not dfs:
        return {}

    def run(k, v):
        df = v() if callable(v) else v
        return materialize_by(df, by[k], k, partitions) if by and k in by else materialize(df, k)

    with ThreadPoolExecutor(max_workers=len(dfs)) as pool:
        futs = {k: pool.submit(run, k, v) for k, v in dfs.items()}
        return {k: f.result() for k, f in futs.items()}
