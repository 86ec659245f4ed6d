"""Publish events of files: check, re-encode, send."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from playlens import constants
from playlens.functions.messages import wire_key, wire_value
from playlens.sources.lines import parse_events
from playlens.sources.topics import topic_writer


def to_wire(events: DataFrame) -> DataFrame:
    """Typed events as (key, value) bytes."""
    return events.select(wire_key(F.col("user_id")).alias("key"), wire_value().alias("value"))


def encode_lines(lines: DataFrame) -> DataFrame:
    """Event lines, batch or stream, as (key, value) bytes; lines without six fields are left out."""
    return to_wire(parse_events(lines).rows)


def replay_files(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Stream of (key, value) from text files of event lines, a few files per micro-batch."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    return encode_lines(lines)


def replay_writer(wire: DataFrame, servers: str, topic: str = constants.EVENT_TOPIC) -> DataStreamWriter:
    """Publish a replay stream to a topic; events of a user share its key and stay in order."""
    return topic_writer(wire, servers, topic)


def publish_files(lines: DataFrame, order: list[str], path: str, files: int) -> None:
    """Write event lines in wire form as files, each of which covers a range of ``order``."""
    ranged = lines.repartitionByRange(files, *order).sortWithinPartitions(*order)
    encode_lines(ranged).write.parquet(path)


def without_repeats(wire: DataFrame, within: str) -> DataFrame:
    """A stream without events whose bytes came before, at most ``within`` ago by the clock of the micro-batches.

    A topic delivers at least once, and a file may be published twice. The keys seen are state, which
    ``within`` bounds: it is dropped when as old. No event is late, as the times are those of arrival.
    """
    arrived = wire.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return arrived.dropDuplicatesWithinWatermark(["key", "value"]).drop("_arrived")
