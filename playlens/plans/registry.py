"""Queries by name, each with the SQL that must give the same rows, where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from playlens.plans.standins import Tables

Build = Callable[[Tables], DataFrame]


class Query(NamedTuple):
    build: Build
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Build], Build]:
    """Register a builder under its function name."""

    def register(build: Build) -> Build:
        QUERIES[build.__name__] = Query(build, sql)
        return build

    return register
