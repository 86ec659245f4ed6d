"""Batch outputs: run-stamped parquet and the text files other programs read."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.functions.text import TAB
from playlens.sources import storage


def now_millis() -> int:
    return int(time.time() * 1000)


def write_stamped(df: DataFrame, base: str, load_ts: int) -> str:
    """Write one run below ``base``; readers of ``base`` prune on ``load_ts``."""
    path = f"{base.rstrip('/')}/load_ts={load_ts}"
    df.write.parquet(path)
    return path


def read_stamped(spark: SparkSession, base: str, load_ts: int) -> DataFrame:
    return spark.read.parquet(base).filter(F.col("load_ts") == load_ts).drop("load_ts")


def put(df: DataFrame, path: str, mode: str, write: Callable[[DataFrame, str, str], object]) -> None:
    """Write ``df``; with mode ``overwrite`` the old rows stay until the new ones are complete."""
    if mode == "overwrite":
        storage.replace(df.sparkSession, path, lambda staged: write(df, staged, "error"))
    else:
        write(df, path, mode)


def write_id_map(ids: DataFrame, path: str, mode: str = "error") -> None:
    """(id, rank) as tab-separated text without header."""
    put(ids, path, mode, lambda df, to, how: df.write.csv(to, sep=TAB, header=False, mode=how))


def _text(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode(mode).text(path)


def write_alias(ids: DataFrame, path: str, mode: str = "error") -> None:
    """(id, index) as ``id,index`` lines."""
    put(ids.select(F.concat_ws(",", *ids.columns)), path, mode, _text)


def write_catalogue(catalogue: DataFrame, path: str, mode: str = "error") -> None:
    """(artist, index, name) as tab-separated lines; an artist without name has an empty one."""
    name = F.coalesce("artist_name", F.lit(""))
    put(catalogue.select(F.concat_ws(TAB, "artist_id", "item", name)), path, mode, _text)


def write_rejects(rejects: DataFrame, path: str, mode: str = "error") -> None:
    """(value, reason) of the lines a job left out."""
    put(rejects, path, mode, lambda df, to, how: df.write.mode(how).parquet(to))
