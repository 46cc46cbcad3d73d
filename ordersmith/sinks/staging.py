"""Mart sinks, and records split into accepted and rejected.

A mart is a folder of versions ``version-000000001/`` ... each a complete Parquet copy
written by one run. Readers take the newest version whose write committed (Spark's
``_SUCCESS`` marker), so a mart is never overwritten while it is being read; a retried run
rewrites its own version. Staging tables, which loads change in parts, are in
:mod:`ordersmith.sinks.buckets`.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import delete_path, list_dirs, path_exists

_PREFIX = "version-"
PARQUET = {"compression": "zstd"}      # of staging tables, records and marts


def version_dir(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{_PREFIX}{version:09d}"


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    out = []
    for name in list_dirs(spark, root):
        if name.startswith(_PREFIX):
            v = int(name[len(_PREFIX):])
            if path_exists(spark, f"{version_dir(root, v)}/_SUCCESS"):
                out.append(v)
    return sorted(out)


def read_current(spark: SparkSession, root: str, schema: StructType,
                 before: int | None = None) -> DataFrame:
    """Newest committed version (below ``before`` if given), or an empty table."""
    vs = [v for v in committed_versions(spark, root) if before is None or v < before]
    if not vs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_dir(root, vs[-1]))


def prune_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` committed versions, and older failed ones; returns how
    many folders went."""
    committed = committed_versions(spark, root)
    if not committed:
        return 0
    oldest = committed[-max(keep, 1):][0]
    gone = [n for n in list_dirs(spark, root)
            if n.startswith(_PREFIX) and int(n[len(_PREFIX):]) < oldest]
    for n in gone:
        delete_path(spark, f"{root.rstrip('/')}/{n}")
    return len(gone)


def write_version(df: DataFrame, root: str, version: int) -> int:
    """Write ``df`` as version ``version`` (overwriting a failed attempt of the same version) and
    return its row count, observed during the write (A10) instead of a second job."""
    return write_observed(df, root, version)["rows"]


def write_observed(df: DataFrame, root: str, version: int, metrics: Sequence[Column] = (),
                   partition_by: Sequence[str] = ()) -> dict:
    """:func:`write_version`, with the aggregates ``metrics`` observed beside ``rows``, so that
    checks take no second read."""
    obs = Observation(f"version_{uuid.uuid4().hex[:8]}")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics)
    out.write.mode("overwrite").partitionBy(*partition_by).options(**PARQUET).parquet(
        version_dir(root, version))
    return obs.get


def _counted(records: DataFrame, reasons: Sequence[str]) -> tuple[Observation, DataFrame]:
    obs = Observation(f"records_{uuid.uuid4().hex[:8]}")
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in reasons]
    return obs, records.observe(obs, F.count(F.lit(1)).alias("read"),
                                F.count("reason").alias("rejected"), *counts)


def _totals(obs: Observation, reasons: Sequence[str]) -> dict[str, int]:
    got = obs.get
    if got["rejected"] != sum(got[r] for r in reasons):
        raise ValueError(f"a reason outside {', '.join(reasons)}")
    return {**got, "accepted": got["read"] - got["rejected"]}


def write_split(records: DataFrame, path: str, reasons: Sequence[str]) -> dict[str, int]:
    """Write records once, those with a ``reason`` beside those without, and count on the way.

    ``path`` gets two folders, ``accepted=true`` and ``accepted=false``, in one job. Returns
    the rows read, accepted and rejected, the rejected ones also for each of ``reasons``.
    """
    obs, counted = _counted(records, reasons)
    (counted.withColumn("accepted", F.col("reason").isNull())
     .write.partitionBy("accepted").mode("overwrite").options(**PARQUET).parquet(path))
    return _totals(obs, reasons)


def read_split(spark: SparkSession, path: str, schema: StructType, taken: bool) -> DataFrame:
    """One side of :func:`write_split` (empty where no record went there)."""
    part = f"{path}/accepted={str(taken).lower()}"
    if not path_exists(spark, part):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(part)


def write_accepted(records: DataFrame, reasons: Sequence[str], write) -> dict[str, int]:
    """Run ``write`` on the writer of the ``value`` of records without a ``reason``, and count the
    records read, accepted, rejected, and rejected for each reason, on the way (A10)."""
    obs, counted = _counted(records, reasons)
    write(counted.filter("reason is null").select("value").write)
    return _totals(obs, reasons)


# Records of a compressed file of lines: it cannot be split, so it is kept small.
MESSAGES_PER_FILE = 100_000


def in_small_files(writer: DataFrameWriter) -> DataFrameWriter:
    """A writer of lines (messages, CSV) with its files compressed. Files of a task are numbered in
    the order of its rows, and none is larger than one task should read."""
    return writer.option("compression", "gzip").option("maxRecordsPerFile", MESSAGES_PER_FILE)


def write_messages(values: DataFrame, path: str) -> None:
    """Message texts (one string column) as compressed lines."""
    in_small_files(values.write).text(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                options: dict | None = None) -> int:
    """Write a mart or staging output once and log its row count from
    an ``Observation``. ``fmt="jdbc"`` writes through JDBC (``options`` carry url,
    dbtable, user, password, driver; batch size 1000 by default)."""
    obs = Observation("rows_written")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if fmt == "jdbc":
        opts = {"batchsize": "1000"}
        opts.update(options or {})
        out.write.format("jdbc").options(**opts).mode(mode).save()
    else:
        w = out.write.mode(mode)
        if options:
            w = w.options(**options)
        w.format(fmt).save(path)
    return obs.get["rows"]
