"""Running play counter per user; a banner is due on every n-th play.

The counter is a streaming aggregation, so the state is Spark's own and no Python runs per user.
It must know what the current micro-batch adds to a user, beside the total. To that end each
micro-batch is first reduced to one row per user; then the row with the highest batch time is the
current one.

Users may be those of a table as it is at the start, or those of the user table as it is in each
micro-batch. For the latter a first stream *lands* the plays of known users, looked up in the newest
load, as one folder a micro-batch; the counter is a second stream over these folders. So loads take
effect while both run, and no micro-batch reads a load that was replaced long ago.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens import constants
from playlens.functions.messages import banner_message, first_line_filled, payload
from playlens.operators.counting import crossings, event_counts
from playlens.sources import storage, user_table
from playlens.sources.topics import Sink

EVENTS_METRIC = "batch_events"
LANDED = "user_id string, banner string, n bigint, batch_id bigint"


def event_users(wire: DataFrame) -> DataFrame:
    """(user_id) of each payload whose first line is not empty; counts them per micro-batch."""
    text = payload(F.col("value"))
    return (
        wire.filter(first_line_filled(text))
        .select(F.substring_index(text, "\t", 1).alias("user_id"))
        .observe(EVENTS_METRIC, F.count(F.lit(1)).alias("events"))
    )


def partial_counts(users: DataFrame) -> DataFrame:
    """(user_id, n), summed within each Arrow batch before any shuffle.

    A user behind a third of the events then sends one row per Arrow batch to its task
    rather than one per event.
    """

    # Defined here so that it is shipped by value: workers need not have this package.
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = pa.Table.from_batches([batch]).group_by("user_id").aggregate([([], "count_all")])
            yield from counts.rename_columns(["user_id", "n"]).to_batches()

    return users.mapInArrow(count, "user_id string, n bigint")


def batch_counts(users: DataFrame) -> DataFrame:
    """(user_id, n) with exactly one row per user and micro-batch."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def add(tables: list[pa.Table]) -> pa.Table:
            sums = pa.concat_tables(tables).group_by("user_id").aggregate([("n", "sum")])
            return sums.rename_columns(["user_id", "n"])

        # The sums are one row per user of the micro-batch in this partition (streams can't sort, so
        # they can't be merged in passing); what waits is at most as large again. More buckets of
        # the user table mean more partitions, and fewer users in each.
        tables, waiting, limit = [], 0, 100_000
        for batch in batches:
            tables.append(pa.Table.from_batches([batch]))
            waiting += batch.num_rows
            if waiting > limit:
                tables, waiting = [add(tables)], 0
                limit = max(limit, tables[0].num_rows)
        if tables:
            yield from add(tables).combine_chunks().to_batches(max_chunksize=10_000)

    return partial_counts(users).repartition("user_id").mapInArrow(add_up, "user_id string, n bigint")


def running_counts(known: DataFrame, generation: int = 0) -> DataFrame:
    """(user_id, banner, before, after) per user of the micro-batch, from (user_id, banner, n).

    Batches are told apart by (generation, batch time). Should the clock ever step back
    behind a batch already counted, the stream stops rather than miscount; start it again on the
    same checkpoint with a higher ``generation``.
    """
    stamp = F.struct(F.lit(generation).alias("generation"), F.current_timestamp().alias("at"))
    totals = known.withColumn("stamp", stamp).groupBy("user_id").agg(
        F.sum("n").alias("after"),
        F.max_by(F.struct("n", "banner"), "stamp").alias("latest"),
        F.max("stamp").alias("seen"),
    )
    added = F.when(F.col("seen") == stamp, F.col("latest.n")).otherwise(
        F.raise_error("the batch time went back: restart with a higher generation").cast("bigint")
    )
    return totals.select(
        "user_id", F.col("latest.banner").alias("banner"), (F.col("after") - added).alias("before"), "after"
    )


def banner_stream(wire: DataFrame, users: DataFrame, every: int = constants.PLAYS_PER_BANNER,
                  generation: int = 0) -> DataFrame:
    """(user_id, play_no, banner, message, key, value) for every n-th play of a known user.

    ``users`` (user_id, banner) has one row per user; a table bucketed by user_id spares the
    shuffle of it in each micro-batch. ``key`` is unique per message, so that a consumer can
    drop what a topic sink delivers twice. The messages do not depend on the order of events.
    Write it in update mode.
    """
    known = batch_counts(event_users(wire)).join(users.select("user_id", "banner"), "user_id")
    return due_messages(running_counts(known, generation), every)


def due_messages(running: DataFrame, every: int = constants.PLAYS_PER_BANNER) -> DataFrame:
    """A message for each multiple of ``every`` that a user's count passes."""
    due = crossings(running, F.col("before"), F.col("after"), every, spread=False)
    message = banner_message(F.col("user_id"), F.col("banner"))
    return due.select(
        "user_id",
        "play_no",
        "banner",
        message.alias("message"),
        F.concat_ws(":", "user_id", "play_no").alias("key"),
        message.alias("value"),
    )


def plays_stream(wire: DataFrame, users: DataFrame, generation: int = 0) -> DataFrame:
    """(user_id, plays): the running total of each known user a micro-batch brings events of. Write it in update mode."""
    known = batch_counts(event_users(wire)).join(users.select("user_id", "banner"), "user_id")
    return running_counts(known, generation).select("user_id", F.col("after").alias("plays"))


def latest_plays(totals: DataFrame) -> DataFrame:
    """The readable counter: totals only rise, so the highest of a user is the present one."""
    return totals.groupBy("user_id").agg(F.max("plays").alias("plays"))


def reject_stream(wire: DataFrame, users: DataFrame) -> DataFrame:
    """(user_id, n) of events whose user is unknown or empty, for a sink of its own."""
    return partial_counts(event_users(wire)).join(
        users.select("user_id"), "user_id", "left_anti"
    )


def landing_sink(location: str, out: str, rejects: str | None = None) -> Sink:
    """Sink of (user_id) rows: the plays of users that the table at ``location`` holds now, as (user_id, banner, n) below
    ``out/batch_id=``; the others, if asked for, as (user_id, n) below ``rejects/batch_id=``.

    A folder appears at once and is written once: a micro-batch that is repeated leaves what it finds.
    """

    def land(users: DataFrame, batch_id: int) -> None:
        found = user_table.find_users(users.sparkSession, location, event_counts(users))
        if rejects is not None:
            found = found.persist()
        storage.write_once(found.where("known").select("user_id", "banner", "n"), f"{out}/batch_id={batch_id}")
        if rejects is not None:
            storage.write_once(found.where("NOT known").select("user_id", "n"), f"{rejects}/batch_id={batch_id}")
            found.unpersist()

    return land


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Stream of what a ``landing_sink`` writes."""
    storage.make_folder(spark, path)
    return spark.readStream.schema(LANDED).parquet(path)


def landed_counts(landed: DataFrame) -> DataFrame:
    """(user_id, banner, n) with one row per user and micro-batch, which may hold several landed ones: the last banner counts."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def add(tables: list[pa.Table]) -> pa.Table:
            ordered = pa.concat_tables(tables).sort_by("batch_id")
            sums = ordered.group_by("user_id", use_threads=False).aggregate([("n", "sum"), ("banner", "last"), ("batch_id", "last")])
            return sums.rename_columns(["user_id", "n", "banner", "batch_id"]).select(["user_id", "banner", "n", "batch_id"])

        # As in batch_counts: what waits is at most as large as the sums.
        tables, waiting, limit = [], 0, 100_000
        for batch in batches:
            tables.append(pa.Table.from_batches([batch]))
            waiting += batch.num_rows
            if waiting > limit:
                tables, waiting = [add(tables)], 0
                limit = max(limit, tables[0].num_rows)
        if tables:
            yield from add(tables).select(["user_id", "banner", "n"]).combine_chunks().to_batches(max_chunksize=10_000)

    return landed.repartition("user_id").mapInArrow(add_up, "user_id string, banner string, n bigint")


def landed_banner_stream(landed: DataFrame, every: int = constants.PLAYS_PER_BANNER, generation: int = 0) -> DataFrame:
    """As ``banner_stream``, from landed plays."""
    return due_messages(running_counts(landed_counts(landed), generation), every)


def landed_plays_stream(landed: DataFrame, generation: int = 0) -> DataFrame:
    """As ``plays_stream``, from landed plays."""
    return running_counts(landed_counts(landed), generation).select("user_id", F.col("after").alias("plays"))


def plays_in_state(spark: SparkSession, checkpoint: str, user: Column | None = None) -> DataFrame:
    """(user_id, plays): the present counters, out of the state of a counter stream as of its last complete micro-batch.

    ``user``, a constant, reads the partition of that user's counter only, where it has a snapshot yet.
    """
    reader = spark.read.format("statestore")
    if user is not None:
        operators = spark.read.format("state-metadata").load(checkpoint)
        partitions, last = operators.select("numPartitions", "maxBatchId").first()
        number = spark.range(1).select(F.pmod(F.hash(user.cast("string")), F.lit(partitions))).first()[0]
        files = storage.names(spark, f"{checkpoint.rstrip('/')}/state/0/{number}")
        # A file <v>.zip holds the state before micro-batch v; later changes lie beside it.
        versions = [int(name.removesuffix(".zip")) for name in files if name.endswith(".zip") and name[:-4].isdigit()]
        versions = [version for version in versions if 0 < version <= last + 1]
        if versions:
            reader = reader.option("snapshotPartitionId", number).option("snapshotStartBatchId", max(versions) - 1)
    plays = reader.load(checkpoint).select(F.col("key.user_id").alias("user_id"), F.col("value.sum").alias("plays"))
    return plays if user is None else plays.where(F.col("user_id") == user)
