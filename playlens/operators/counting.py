"""Play counts per user and the banners they lead to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playlens import constants
from playlens.functions.messages import banner_message
from playlens.operators.ids import numbered_in_order
from playlens.session import pin, shuffle_partitions

# Users with more events than this are numbered over several tasks.
HOT_EVENTS = 1_000_000
# Multiples made from one row before they are spread over tasks.
CHUNK = 100_000


def event_counts(events: DataFrame) -> DataFrame:
    """(user_id, n): events per user, combined before the shuffle."""
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def since(events: DataFrame, start: Column, at: str = "ts") -> DataFrame:
    """Events from ``start`` on: counting afresh means counting from a new start."""
    return events.filter(F.col(at) >= start)


def unknown_users(counts: DataFrame, users: DataFrame) -> DataFrame:
    """(user_id, n) of users the user table does not hold; they are not counted."""
    return counts.join(users.select("user_id"), "user_id", "left_anti")


def crossings(counts: DataFrame, before: Column, after: Column, every: int, spread: bool) -> DataFrame:
    """``counts`` with a row per multiple of ``every`` in (before, after], as ``play_no``.

    Long runs of multiples are made in chunks; with ``spread`` the chunks of one row go to
    different tasks, so a user with a large share of all plays does not fill one of them.
    """
    first, last = F.floor(before / every) + 1, F.floor(after / every)
    chunked = counts.withColumn("_first", first).withColumn("_last", last).filter(
        F.col("_first") <= F.col("_last")
    ).withColumn("_from", F.explode(F.sequence("_first", "_last", F.lit(CHUNK).cast("bigint"))))
    if spread:
        # A fixed number of partitions: adaptive execution would merge these small rows again.
        partitions = shuffle_partitions(counts.sparkSession)
        chunked = chunked.repartition(partitions, "user_id", "_from")
    until = F.least("_last", F.col("_from") + (CHUNK - 1))
    return chunked.withColumn("_multiple", F.explode(F.sequence("_from", until))).select(
        *counts.columns, (F.col("_multiple") * every).alias("play_no")
    )


def banners_due(counts: DataFrame, users: DataFrame,
                every: int = constants.PLAYS_PER_BANNER) -> DataFrame:
    """(user_id, play_no, banner, message) for each ``every``-th play of a known user.

    A message names the user and the banner only, so the count per user says which are due:
    no event is sorted or numbered.
    """
    known = counts.join(users.select("user_id", "banner"), "user_id").select(
        "user_id", "banner", "n"
    )
    due = crossings(known, F.lit(0), F.col("n"), every, spread=True)
    return due.select(
        "user_id", "play_no", "banner", banner_message(F.col("user_id"), F.col("banner")).alias("message")
    )


def number_plays(events: DataFrame, order: list[str], hot_events: int = HOT_EVENTS) -> DataFrame:
    """``events`` with ``play_no``: 1, 2, ... within ``user_id`` in the given order.

    Most users fit a task and take one shuffle. Users above ``hot_events`` are cut into ranges
    of (user, order), numbered within each, and shifted by what the earlier ranges hold. A range holds
    about ``hot_events`` rows; where that is little, there are as many ranges as a shuffle has
    partitions, or more, of ``HOT_EVENTS`` rows, so that tasks and files don't grow with the users. Ties of
    the order are broken by the other columns, so both ways give the same numbers; rows equal in
    all columns are interchangeable. Events without user are numbered as those of one user.
    """
    order = [*order, *(name for name in events.columns if name not in (*order, "user_id"))]
    ranked = F.row_number().over(W.partitionBy("user_id").orderBy(*order))
    hot = pin(event_counts(events).filter(F.col("n") > hot_events), "hot-users")
    total = hot.agg(F.sum("n")).first()[0]
    if total is None:
        return events.withColumn("play_no", ranked.cast("bigint"))
    is_hot = events["user_id"].eqNullSafe(hot["user_id"])
    cold = events.join(hot, is_hot, "left_anti").withColumn("play_no", ranked.cast("bigint"))

    partitions = min(-(-total // hot_events), max(shuffle_partitions(events.sparkSession), -(-total // HOT_EVENTS)))
    placed = numbered_in_order(
        events.join(hot, is_hot, "left_semi"), ["user_id", *order], partitions, "hot-events"
    )
    runs = placed.groupBy("_part", "user_id").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_size")
    )
    # Runs number at most the partitions plus the hot users.
    earlier = F.sum("_size").over(
        W.partitionBy("user_id").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    )
    shifts = pin(
        runs.select("_part", "user_id", "_first", F.coalesce(earlier, F.lit(0)).alias("_shift")),
        "hot-shifts",
    )
    same_run = (placed["_part"] == shifts["_part"]) & placed["user_id"].eqNullSafe(shifts["user_id"])
    numbered = placed.join(shifts, same_run).select(
        *(placed[name] for name in events.columns), (F.col("_pos") - F.col("_first") + F.col("_shift") + 1).alias("play_no")
    )
    return cold.select(*events.columns, "play_no").unionByName(numbered)


def every_nth(numbered: DataFrame, every: int = constants.PLAYS_PER_BANNER) -> DataFrame:
    return numbered.filter(F.col("play_no") % every == 0)


def events_per_interval(events: DataFrame, interval: str = constants.BATCH_INTERVAL,
                        at: str = "ts") -> DataFrame:
    """Events per fixed interval of event time, as (start, n)."""
    return events.groupBy(F.window(at, interval).alias("w")).agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.col("w.start").alias("start"), "n")
