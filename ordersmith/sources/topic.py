"""Topic reads (K1): an envelope DataFrame ``(key, value, topic, partition,
offset, timestamp)``, bounded from the first to the last message.

``format="kafka"`` reads a Kafka topic (the connector jar must be on the
classpath); ``format="json-lines"`` reads files of one JSON message per line
and synthesises the envelope, which is what tests and the testbed use. Messages
are ordered by (batch, source, offset): the micro-batch of a stream, then for file
messages the path (run folders and part numbers sort by time of writing) with the start of
the split, then the place within it; for Kafka the partition's offset alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ENVELOPE


def read_topic(spark: SparkSession, topic: str, source: str | list[str], *,
               format: str = "json-lines", options: dict | None = None) -> DataFrame:
    """Bounded read of every message of ``topic``.

    ``source`` is the bootstrap server list for Kafka, or a path (list of
    paths) for JSON-lines files.
    """
    if format == "kafka":
        opts = {
            "kafka.bootstrap.servers": source,
            "subscribe": topic,
            "startingOffsets": "earliest",
            "endingOffsets": "latest",
        }
        opts.update(options or {})
        return _kafka_places(spark.read.format("kafka").options(**opts).load())
    if format == "json-lines":
        paths = [source] if isinstance(source, str) else list(source)
        raw = spark.read.options(**(options or {})).text(paths)
        return as_envelope(_placed(raw), topic, source_col="__source")
    raise ValueError(f"unknown topic format {format!r}")


def file_split() -> Column:
    """The split that a row of a file scan comes from; splits of a file sort by their start."""
    return F.concat(F.col("_metadata.file_path"), F.lit("#"),
                    F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0"))


def _placed(raw: DataFrame) -> DataFrame:
    """Lines with the split they come from and their order within it (a task reads each
    of its splits from start to end, so its running number rises there)."""
    return raw.select("value", file_split().alias("__source"),
                      F.monotonically_increasing_id().alias("__pos"))


def as_envelope(df: DataFrame, topic: str, value_col: str = "value",
                offset_col: str | None = "__pos", partition_col: str | None = None,
                key_col: str | None = None, source_col: str | None = None) -> DataFrame:
    """Shape any frame holding message text into the envelope schema, with its place
    (batch, source) among the topic's messages."""
    cols = {
        "batch": F.lit(0).cast("long"),
        "source": F.col(source_col) if source_col else F.lit(None).cast("string"),
        "key": (F.col(key_col).cast("binary") if key_col else F.lit(None).cast("binary")),
        "value": F.col(value_col).cast("binary"),
        "topic": F.lit(topic),
        "partition": (F.col(partition_col).cast("int") if partition_col else F.lit(0)),
        "offset": (F.col(offset_col).cast("long") if offset_col else F.lit(None).cast("long")),
        "timestamp": F.lit(None).cast("timestamp"),
    }
    return df.select(*[cols[c].alias(c) for c in [*ENVELOPE.fieldNames(), "batch", "source"]])


def in_batch(batch: DataFrame, batch_id: int) -> DataFrame:
    """A micro-batch with its number, and its file messages numbered within their splits.

    Later batches rank after earlier ones. A streaming plan cannot number rows, but the frame
    that ``foreachBatch`` hands over is static and has one partition for each reading task, so
    the running number rises within a split here as it does in a batch read. Kafka messages keep
    their offsets.
    """
    place = F.coalesce("offset", F.monotonically_increasing_id())
    return batch.withColumn("batch", F.lit(batch_id).cast("long")).withColumn("offset", place)


def _kafka_places(messages: DataFrame) -> DataFrame:
    return messages.withColumn("batch", F.lit(0).cast("long")) \
        .withColumn("source", F.lit(None).cast("string"))


def read_topic_stream(spark: SparkSession, topic: str, source: str, *,
                      format: str = "json-lines", options: dict | None = None) -> DataFrame:
    """Streaming form of :func:`read_topic` (for :mod:`ordersmith.streaming`)."""
    if format == "kafka":
        opts = {"kafka.bootstrap.servers": source, "subscribe": topic,
                "startingOffsets": "earliest"}
        opts.update(options or {})
        return _kafka_places(spark.readStream.format("kafka").options(**opts).load())
    if format == "json-lines":
        # a streaming plan cannot number rows: in_batch does, in each micro-batch
        raw = spark.readStream.options(**(options or {})).text(source)
        return as_envelope(raw.select("value", file_split().alias("__source")), topic,
                           offset_col=None, source_col="__source")
    raise ValueError(f"unknown topic format {format!r}")
