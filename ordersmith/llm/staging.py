"""Cutting lineage, and sizing shuffles from the input."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import delete_path, release, scratch_path, shared_dir, table_bytes

PARTITION_BYTES = 16 << 20
UNKNOWN = 1 << 60         # Spark's estimate where it knows nothing


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the cluster's shared folder and read it back.

    The written table is the lineage cut: a lost executor rereads it instead of
    recomputing what led to it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing will read any more: all outputs built
    from it are written. Files outside the shared folder are left alone."""
    spark = df.sparkSession
    base = shared_dir(spark).rstrip("/").split("://")[-1].split(":", 1)[-1]
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if base.rstrip("/") + "/" in folder:
            delete_path(spark, folder)


def partitions_for(df: DataFrame, bytes_each: int = PARTITION_BYTES) -> int:
    """Shuffle partitions for work in proportion to ``df``: grows with its size, at
    least the session's setting. Frames that Spark has no size for take the setting. Only the
    number of partitions depends on it, not what is done."""
    size = table_bytes(df)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size >= UNKNOWN:
        return least
    return int(max(least, min(size // bytes_each, 200_000)))


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


__all__ = ["stage", "unstage", "release", "partitions_for", "require", "PARTITION_BYTES"]
