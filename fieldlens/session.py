"""Session construction and the shared scratch location.

On a cluster the shared folder comes from ``spark.checkpoint.dir``; we only
pick our own folder when that setting is unset and Spark runs in local mode
(tests, laptops).  A machine-local folder is never used on a cluster.
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Observation, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "fieldlens", **conf) -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**_LOCAL_DEFAULTS, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables."""
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            d = None
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(
                "spark.checkpoint.dir is unset; set it to a shared (HDFS/S3/ABFS) folder"
            )
        d = tempfile.mkdtemp(prefix="fieldlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def unique_name(name: str) -> str:
    """A table name of its own run, so that two runs never collide."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one written table."""
    root = checkpoint_root(spark)
    path = f"{root}/fieldlens/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_WRITTEN: dict[str, list[str]] = {}
_TABLES: dict[str, list[str]] = {}


def owned_table(spark: SparkSession, name: str) -> str:
    """A catalog name of its own, dropped by :func:`release_written`."""
    table = unique_name("fieldlens_" + "".join(c if c.isalnum() else "_" for c in name))
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(table)
    return table


def side_by_side(spark: SparkSession, *jobs, at_once: int | None = None):
    """Results of the functions ``jobs``, run at the same time (``at_once`` of
    them at most): each submits its Spark jobs from a thread of its own, so that
    short stages of one fill the cores that the others leave idle."""
    with ThreadPoolExecutor(max(1, at_once or len(jobs))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(j)) for j in jobs]]


def release_written(spark: SparkSession) -> int:
    """Remove every table and file this application has written to the shared
    folder through :func:`shared_path`, and return how many there were.  Call
    it when the results that read them have been consumed; nothing else
    deletes what a returned frame may still need."""
    for table in _TABLES.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove_path(spark, path)
    return len(paths)


class Scratch:
    """Written intermediate tables of one operator, removed when it ends.

    ``table`` writes a frame as parquet in the shared folder and reads it back
    (cuts the lineage; a lost executor re-reads the table).  Leaving the
    ``with`` block removes every folder written except those passed through
    ``keep``, which the caller still reads from.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths, self.kept = spark, name, {}, set()

    def table(self, df, part: str, partition_by=(), arrow_rows: int | None = None):
        """``arrow_rows`` bounds the rows of one Arrow batch while this table
        is written, so that long texts do not meet by the ten thousand in one
        Python worker."""
        path = shared_path(self.spark, f"{self.name}-{part}")
        key = "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = self.spark.conf.get(key)
        if arrow_rows:
            self.spark.conf.set(key, str(arrow_rows))
        try:
            w = df.write.mode("overwrite")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(path)
        finally:
            self.spark.conf.set(key, before)
        self.paths[part] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, part: str) -> None:
        self.kept.add(part)

    def drop(self, part: str) -> None:
        remove_path(self.spark, self.paths.pop(part))

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        for part in [p for p in self.paths if p not in self.kept]:
            self.drop(part)
        return False


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system (any store Spark writes)."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)


def materialize(df, name: str = "stage", partition_by=(), path: str | None = None):
    """Write ``df`` once as a parquet table in the shared folder and read it
    back.

    Used where one intermediate table feeds several actions or branches
    (block bounds, model fit, quantile passes): each then scans the written
    table, with column pruning and pushed filters, instead of re-running the
    lineage; a lost executor cannot force a recompute of upstream stages.
    With ``partition_by`` (e.g. ``Year``) later filters prune partitions.
    """
    path = path or shared_path(df.sparkSession, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_observed(df, metrics, name: str = "stage", partition_by=(), path: str | None = None):
    """:func:`materialize`, and the values of the aggregate columns ``metrics``
    over the written rows as a dict: Spark collects them while it writes
    (``Observation``), so that they cost no job of their own."""
    seen = Observation(unique_name(name))
    table = materialize(df.observe(seen, *metrics), name, partition_by, path)
    return table, seen.get
