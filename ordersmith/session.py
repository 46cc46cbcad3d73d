"""Session set-up and the shared work folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. AQE re-plans joins from measured shuffle sizes
# (a small side becomes a broadcast only after its real size is known), splits
# skewed partitions of a join, and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "ordersmith",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass no ``master`` and let ``spark-submit`` decide; size
    ``shuffle_partitions`` to the data (AQE coalesces from there).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for lineage cuts and staged tables.

    Read from ``spark.checkpoint.dir`` (or an already set checkpoint folder).
    Where neither is set, a local master (tests) gets a private temporary folder,
    registered for the session; on a cluster that is an error, because executors
    do not see each other's disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ordersmith-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` (any Hadoop file system) exists."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty if it does not exist)."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(hpath) if st.isDirectory())


def file_sizes(spark: SparkSession, path: str) -> list[int]:
    """Bytes of the file ``path``, or of the files in the folder ``path``."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [st.getLen() for st in fs.listStatus(hpath) if st.isFile()]


def table_bytes(df: DataFrame) -> int:
    """Spark's estimate of the size of ``df``, from the files it is read from."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def max_split_bytes(spark: SparkSession) -> int:
    """Bytes of a file from which a scan cuts it into several splits."""
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote (no error if it is gone)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hpath, True)


def release(spark: SparkSession) -> None:
    """Let the cleaner drop the shuffle files of plans that nothing refers to any more."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


__all__ = ["get_session", "shared_dir", "scratch_path", "path_exists", "list_dirs", "file_sizes", "table_bytes",
           "max_split_bytes", "delete_path", "release", "DEFAULT_CONF"]
