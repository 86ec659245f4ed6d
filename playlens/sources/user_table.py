"""The user table: one row per user with banner and play counter, as a folder of loads.

The folder is the table, whatever program made it. ``load_ts=<stamp>/buckets=<n>`` is a *base* with
all users, bucketed and sorted by user, so a join on the user neither shuffles nor sorts it.
``delta_ts=<stamp>/buckets=<n>`` is a *delta* with the users of one load, put over what came before:
the last writer of a user counts. A load writes as much as it brings; once the deltas are large
beside the base, or many, they are merged into a new base. A load is complete once its success
marker is there. One program loads at a time; any number may read.
"""

from __future__ import annotations

import hashlib
import time
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.sources import storage

# Buckets of a base, and partitions of the streams that join it.
BUCKETS = 64
# Bases that stay, and for how long a replaced one stays at least: someone may be reading it.
KEPT = 3
KEPT_MILLIS = 24 * 60 * 60 * 1000
# Deltas are merged when there are as many, or when they hold this share of the bytes of the base.
MOST_DELTAS = 16
DELTA_SHARE = 0.5
COLUMNS = "user_id STRING, banner STRING, plays BIGINT"


class Snapshot(NamedTuple):
    """A load; ``full`` is a base, else a delta."""

    load_ts: int
    buckets: int
    path: str
    full: bool = True


def _complete(spark: SparkSession, location: str, prefix: str, full: bool) -> list[Snapshot]:
    location, found = location.rstrip("/"), []
    for name in storage.names(spark, location):
        kind, _, stamp = name.partition("=")
        if kind != prefix or not stamp.isdigit():
            continue
        for inner in storage.names(spark, f"{location}/{name}"):
            buckets = inner.removeprefix("buckets=")
            path = f"{location}/{name}/{inner}"
            if inner != buckets and buckets.isdigit() and storage.exists(spark, f"{path}/_SUCCESS"):
                found.append(Snapshot(int(stamp), int(buckets), path, full))
    return sorted(found)


def snapshots(spark: SparkSession, location: str) -> list[Snapshot]:
    """Complete bases, oldest first."""
    return _complete(spark, location, "load_ts", True)


def deltas(spark: SparkSession, location: str) -> list[Snapshot]:
    """Complete deltas, oldest first."""
    return _complete(spark, location, "delta_ts", False)


def newest(spark: SparkSession, location: str) -> tuple[Snapshot | None, list[Snapshot]]:
    """The base, and the deltas put over it."""
    # Deltas first: should they be merged meanwhile, the base found after holds them already.
    over, bases = deltas(spark, location), snapshots(spark, location)
    base = bases[-1] if bases else None
    return base, [delta for delta in over if base is not None and delta.load_ts > base.load_ts]


def latest(spark: SparkSession, location: str) -> Snapshot | None:
    """The last load."""
    base, over = newest(spark, location)
    return over[-1] if over else base


def _catalog_name(snapshot: Snapshot) -> str:
    """A name of this session's catalog; it only tells the planner of the buckets."""
    return f"playlens_users_{hashlib.md5(snapshot.path.encode()).hexdigest()}"


def _base_users(spark: SparkSession, base: Snapshot) -> DataFrame:
    name = _catalog_name(base)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}) USING parquet "
        f"CLUSTERED BY (user_id) SORTED BY (user_id) INTO {base.buckets} BUCKETS LOCATION '{base.path}'"
    )
    return spark.table(name)


def _changed_users(spark: SparkSession, over: list[Snapshot]) -> DataFrame:
    """(user_id, banner, plays) of the users in deltas, the last load of each."""
    loads = reduce(DataFrame.unionByName, (
        spark.read.schema(COLUMNS).parquet(delta.path).withColumn("_ts", F.lit(delta.load_ts)) for delta in over))
    return loads.groupBy("user_id").agg(F.max_by(F.struct("banner", "plays"), "_ts").alias("last")).select(
        "user_id", "last.banner", "last.plays")


def current_users(spark: SparkSession, location: str) -> DataFrame:
    """All users as of the last load; an empty table when there is none."""
    base, over = newest(spark, location)
    if base is None:
        return spark.createDataFrame([], COLUMNS)
    users = _base_users(spark, base)
    if not over:
        return users
    changed = _changed_users(spark, over)
    return users.join(changed, "user_id", "left_anti").unionByName(changed)


def find_users(spark: SparkSession, location: str, ids: DataFrame) -> DataFrame:
    """``ids`` (user_id, ...) with ``banner`` and ``known`` as of the last load.

    Only the ids are shuffled and looked up: the base is read by its buckets, the deltas are small.
    """
    base, over = newest(spark, location)
    if base is None:
        return ids.select("*", F.lit(None).cast("string").alias("banner"), F.lit(False).alias("known"))
    held = _base_users(spark, base).select("user_id", F.col("banner").alias("_banner"), F.lit(True).alias("_held"))
    found = ids.join(held, "user_id", "left")
    if not over:
        return found.select(*ids.columns, F.col("_banner").alias("banner"), F.col("_held").isNotNull().alias("known"))
    changed = _changed_users(spark, over).select(
        "user_id", F.col("banner").alias("_new"), F.lit(True).alias("_changed"))
    is_changed = F.col("_changed").isNotNull()
    return found.join(changed, "user_id", "left").select(
        *ids.columns, F.when(is_changed, F.col("_new")).otherwise(F.col("_banner")).alias("banner"),
        (is_changed | F.col("_held").isNotNull()).alias("known"))


def _last_rows(load: DataFrame, order_by: Column | None) -> DataFrame:
    """(user_id, new_banner) of a load: the last row by ``order_by``; without an order a user may come once only."""
    if order_by is not None:
        return load.groupBy("user_id").agg(F.max_by("banner", order_by).alias("new_banner"))
    once = F.when(F.count(F.lit(1)) == 1, F.max("banner")).otherwise(F.raise_error(
        F.concat(F.lit("the load has a user twice and no order: "), F.max(F.coalesce("user_id", F.lit("null"))))))
    return load.groupBy("user_id").agg(once.cast("string").alias("new_banner"))


def merge_users(current: DataFrame, load: DataFrame, order_by: Column | None = None) -> DataFrame:
    """``current`` with the users of ``load`` put in, counters back to zero.

    The last row by ``order_by`` counts; without an order a user may come once only.
    """
    last = _last_rows(load, order_by).withColumn("loaded", F.lit(True))
    loaded = F.col("loaded").isNotNull()
    return current.join(last, "user_id", "full_outer").select(
        "user_id",
        F.when(loaded, F.col("new_banner")).otherwise(F.col("banner")).alias("banner"),
        F.when(loaded, F.lit(0)).otherwise(F.col("plays")).cast("bigint").alias("plays"),
    )


def _write_base(spark: SparkSession, location: str, users: DataFrame, load_ts: int, buckets: int) -> None:
    new = Snapshot(load_ts, buckets, f"{location.rstrip('/')}/load_ts={load_ts}/buckets={buckets}")
    name = f"{_catalog_name(new)}_new"
    (
        users.repartition(buckets, "user_id").write.mode("overwrite").format("parquet")
        .bucketBy(buckets, "user_id").sortBy("user_id").option("path", new.path).saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # the files stay


def upsert_users(spark: SparkSession, location: str, load: DataFrame, load_ts: int, *,
                 order_by: Column | None = None, buckets: int = BUCKETS, keep: int = KEPT,
                 keep_millis: int = KEPT_MILLIS, most_deltas: int = MOST_DELTAS,
                 delta_share: float = DELTA_SHARE) -> None:
    """Put the users of a load in, stamped ``load_ts``, their counters back to zero.

    Writes the load's users only; every so often, by ``most_deltas`` and ``delta_share``, all users.
    """
    before = latest(spark, location)
    if before is not None and load_ts <= before.load_ts:
        raise ValueError(f"load_ts {load_ts} is not newer than the last load {before.load_ts}")
    last = _last_rows(load, order_by).select(
        "user_id", F.col("new_banner").alias("banner"), F.lit(0).cast("bigint").alias("plays"))
    if before is None:
        _write_base(spark, location, last, load_ts, buckets)
        return
    path = f"{location.rstrip('/')}/delta_ts={load_ts}/buckets={buckets}"
    last.write.mode("overwrite").parquet(path)
    base, over = newest(spark, location)
    waiting = sum(storage.size(spark, delta.path) for delta in over)
    if len(over) >= most_deltas or waiting >= delta_share * storage.size(spark, base.path):
        compact(spark, location, buckets=buckets, keep=keep, keep_millis=keep_millis)


def compact(spark: SparkSession, location: str, *, buckets: int | None = None, keep: int = KEPT,
            keep_millis: int = KEPT_MILLIS) -> None:
    """Merge the deltas into a new base with the stamp of the last one; old loads expire."""
    base, over = newest(spark, location)
    if over:
        _write_base(spark, location, current_users(spark, location), over[-1].load_ts, buckets or base.buckets)
    expire(spark, location, keep, keep_millis)


def expire(spark: SparkSession, location: str, keep: int = KEPT, keep_millis: int = KEPT_MILLIS) -> None:
    """Delete all but the ``keep`` newest bases and what lies over them, if replaced for ``keep_millis`` at least."""
    bases = snapshots(spark, location)
    now = time.time() * 1000

    def long_replaced(load_ts: int) -> bool:
        by = next((base for base in bases if base.load_ts > load_ts), None)
        return by is not None and storage.modified(spark, f"{by.path}/_SUCCESS") <= now - keep_millis

    gone = [base for base in bases[:-keep] if long_replaced(base.load_ts)]
    oldest = next((base.load_ts for base in bases if base not in gone), 0)
    # A delta is replaced by the base that holds it, the one of its own stamp perhaps.
    gone += [delta for delta in deltas(spark, location) if delta.load_ts <= oldest and long_replaced(delta.load_ts - 1)]
    for old in gone:
        spark.sql(f"DROP TABLE IF EXISTS {_catalog_name(old)}")
        storage.delete(spark, old.path.rpartition("/")[0])


def lookup_users(users: DataFrame, ids: DataFrame) -> DataFrame:
    """Banner and counter of the given ids; nulls for ids the table does not hold."""
    return ids.join(users, "user_id", "left").select("user_id", "banner", "plays")
