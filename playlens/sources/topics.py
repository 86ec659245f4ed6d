"""Topic sources and sinks, and the file streams that take their place offline."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from playlens import constants, schemas
from playlens.session import ROCKSDB, session_conf

# State in RocksDB, saved as changes instead of whole snapshots after each micro-batch.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

Sink = Callable[[DataFrame, int], None]


def read_topics(spark: SparkSession, servers: str, topics: Iterable[str],
                starting: str = "latest", since_millis: int | None = None,
                max_offsets: int | None = None) -> DataFrame:
    """Stream of (key, value) bytes from one or more topics.

    A new stream begins at ``since_millis`` if given, else at ``starting``. To count afresh,
    begin a new checkpoint at a new ``since_millis``.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
    )
    if since_millis is not None:
        reader = reader.option("startingTimestamp", since_millis)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select("key", "value")


def read_wire_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of (key, value) bytes from parquet files in order of arrival."""
    reader = spark.readStream.schema(schemas.WIRE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def topic_writer(messages: DataFrame, servers: str, topic: str, mode: str = "append") -> DataStreamWriter:
    """Writer of (key, value) to a topic. Delivery is at least once: consumers drop repeats by key."""
    return (
        messages.writeStream.outputMode(mode)
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
    )


def batch_writer(rows: DataFrame, sink: Sink, mode: str = "append") -> DataStreamWriter:
    """Writer that hands each micro-batch to ``sink`` with its number."""
    return rows.writeStream.outputMode(mode).foreachBatch(sink)


def files_by_batch(path: str) -> Sink:
    """Parquet below ``batch_id=``; a repeated micro-batch replaces its own files."""
    return lambda rows, batch_id: rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def file_writer(rows: DataFrame, path: str, fmt: str = "parquet") -> DataStreamWriter:
    """Writer to files; each row lands exactly once."""
    return rows.writeStream.format(fmt).option("path", path)


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish a batch of (key, value)."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def start(spark: SparkSession, writer: DataStreamWriter, checkpoint: str, *, name: str | None = None,
          available_now: bool = False, interval: str = constants.BATCH_INTERVAL) -> StreamingQuery:
    """Start a stream every ``interval``, or until the present input is used up."""
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    with session_conf(spark, STATE_SETTINGS):
        return writer.trigger(**trigger).start()
