"""Archive of the raw topic, rolled into files by bytes.

The stream writes a file per partition and micro-batch. ``roll`` packs those of a day into files of a
given size: a manifest names the rolled folders and the stream's files they hold, and appears by
one rename, so readers see either the old files or the new one, never both or neither. Orphans of a
roll that failed are named by no manifest and go with the next. One program rolls an archive at a time.
"""

from __future__ import annotations

import json
import time
from collections import defaultdict
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import NamedTuple
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from playlens import constants
from playlens.sources import storage
from playlens.sources.topics import file_writer

DAY = "arrival_date"


def raw_rows(wire: DataFrame, fmt: str) -> DataFrame:
    """The bytes as they came, and the day they came: key and value, or for text a line per value."""
    day = F.current_date().cast("string").alias(DAY)
    if fmt == "text":
        # A cast keeps every byte, also those that are no UTF-8.
        return wire.select(F.col("value").cast("string").alias("value"), day)
    return wire.select("key", "value", day)


def archive_writer(wire: DataFrame, path: str, fmt: str = "text",
                   max_records_per_file: int = 50_000_000) -> DataStreamWriter:
    """Text (values only) or parquet (keys and values) files below ``arrival_date=``, cut at a number of records only."""
    return (
        file_writer(raw_rows(wire, fmt), path, fmt)
        .partitionBy(DAY)
        .option("maxRecordsPerFile", max_records_per_file)
    )


class Manifest(NamedTuple):
    """``rolled``: folders below the rolled archive; ``covered``: files below the stream's, both by their relative names."""

    version: int
    rolled: list[str]
    covered: list[str]


def manifest(spark: SparkSession, rolled: str) -> Manifest:
    versions = [int(name) for name in storage.names(spark, f"{rolled}/_manifest") if name.isdigit()]
    if not versions:
        return Manifest(0, [], [])
    held = json.loads(storage.read_text(spark, f"{rolled}/_manifest/{max(versions)}"))
    return Manifest(max(versions), held["rolled"], held["covered"])


def _schema(fmt: str) -> str:
    return f"value string, {DAY} string" if fmt == "text" else f"key binary, value binary, {DAY} string"


def _relative(path: str) -> str:
    """Day and name of a file."""
    return "/".join(path.split("/")[-2:])


def _stream_files(spark: SparkSession, raw: str, fmt: str) -> list[tuple[str, int]]:
    """(relative name, bytes) of the files the stream has completed and that are still there."""
    there = {_relative(path): n for path, n in storage.files(spark, raw)}
    if not there:
        return []
    # The reader knows from the stream's own log which files are complete.
    complete = [_relative(unquote(path)) for path in spark.read.schema(_schema(fmt)).format(fmt).load(raw).inputFiles()]
    return [(name, there[name]) for name in sorted(complete) if name in there]


def _read(spark: SparkSession, base: str, names: list[str], fmt: str) -> DataFrame:
    paths = [f"{base}/{name}" for name in names]
    return spark.read.schema(_schema(fmt)).option("basePath", base).format(fmt).load(paths)


def read_archive(spark: SparkSession, raw: str, rolled: str, fmt: str = "text") -> DataFrame:
    """Every archived row once: the rolled files, and those of the stream that aren't rolled yet."""
    raw, rolled = raw.rstrip("/"), rolled.rstrip("/")
    done = manifest(spark, rolled)
    covered = set(done.covered)
    rest = [name for name, _ in _stream_files(spark, raw, fmt) if name not in covered]
    parts = [_read(spark, base, names, fmt) for base, names in ((rolled, done.rolled), (raw, rest)) if names]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _schema(fmt))


def packed(files: list[tuple[str, int]], target: int, final: bool) -> list[list[str]]:
    """Files of each day, in order, in groups of ``target`` bytes at least, and less than that and one file more; what is
    left of a day stays, unless this is ``final``."""
    by_day = defaultdict(list)
    for name, n in files:
        by_day[name.split("/")[0]].append((name, n))
    groups = []
    for day in sorted(by_day):
        group, held = [], 0
        for name, n in by_day[day]:
            group.append(name)
            held += n
            if held >= target:
                groups.append(group)
                group, held = [], 0
        if final and group:
            groups.append(group)
    return groups


def roll(spark: SparkSession, raw: str, rolled: str, fmt: str = "text", target: int = constants.ROLL_BYTES,
         final: bool = False, parallelism: int = 4) -> int:
    """Pack the stream's files below ``raw`` into files of ``target`` bytes below ``rolled``; returns how many were made."""
    raw, rolled = raw.rstrip("/"), rolled.rstrip("/")
    done = manifest(spark, rolled)
    there = _stream_files(spark, raw, fmt)
    covered = set(done.covered)
    groups = packed([(name, n) for name, n in there if name not in covered], target, final)
    named = {name for name in done.rolled}
    for day in storage.names(spark, rolled):
        if day.startswith(f"{DAY}="):
            for name in storage.names(spark, f"{rolled}/{day}"):
                if f"{day}/{name}" not in named:
                    storage.delete(spark, f"{rolled}/{day}/{name}")
    if not groups:
        return 0

    def write(numbered: tuple[int, list[str]]) -> str:
        number, names = numbered
        name = f"{names[0].split('/')[0]}/roll-{done.version + 1}-{number}"
        # One task reads the files of a group and writes one file: nothing is shuffled.
        _read(spark, raw, names, fmt).drop(DAY).coalesce(1).write.format(fmt).save(f"{rolled}/{name}")
        return name

    with ThreadPool(parallelism) as pool:
        made = pool.map(inheritable_thread_target(spark)(write), list(enumerate(groups)))
    # Names of files that have been deleted meanwhile are not needed any more.
    still = {name for name, _ in there}
    now_covered = sorted((covered & still) | {name for group in groups for name in group})
    storage.make_folder(spark, f"{rolled}/_manifest")
    storage.write_text(
        spark, f"{rolled}/_manifest/{done.version + 1}", json.dumps({"rolled": [*done.rolled, *made], "covered": now_covered}))
    return len(made)


def drop_rolled(spark: SparkSession, raw: str, rolled: str, keep_millis: int = 24 * 60 * 60 * 1000) -> int:
    """Delete the stream's files that were rolled ``keep_millis`` ago at least: no reader began before that."""
    raw, rolled = raw.rstrip("/"), rolled.rstrip("/")
    done = manifest(spark, rolled)
    if not done.version or storage.modified(spark, f"{rolled}/_manifest/{done.version}") > time.time() * 1000 - keep_millis:
        return 0
    for name in done.covered:
        storage.delete(spark, f"{raw}/{name}")
    return len(done.covered)
