"""Parallel import of a relational table through JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playlens.sources.files import write_stamped


def jdbc_options(url: str, table: str, properties: dict[str, str] | None = None) -> dict[str, str]:
    return {"url": url, "dbtable": table, "fetchsize": "10000", **(properties or {})}


def key_bounds(spark: SparkSession, url: str, table: str, column: str,
               properties: dict[str, str] | None = None) -> tuple[int, int] | None:
    """Smallest and largest key, asked of the database in one row; None for an empty table."""
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"
    row = spark.read.format("jdbc").options(**jdbc_options(url, query, properties)).load().first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]))


def read_table(spark: SparkSession, url: str, table: str, *, column: str | None = None,
               num_partitions: int = 1, bounds: tuple[int, int] | None = None,
               properties: dict[str, str] | None = None) -> DataFrame:
    """A table as a typed DataFrame, split over ``num_partitions`` ranges of ``column``.

    Without a column it is read by one task, which suits small tables only.
    """
    reader = spark.read.format("jdbc").options(**jdbc_options(url, table, properties))
    if column and num_partitions > 1:
        bounds = bounds or key_bounds(spark, url, table, column, properties)
        if bounds:
            reader = reader.options(
                partitionColumn=column,
                lowerBound=str(bounds[0]),
                upperBound=str(bounds[1] + 1),
                numPartitions=str(num_partitions),
            )
    return reader.load()


def import_table(spark: SparkSession, url: str, table: str, out: str, load_ts: int,
                 **reading) -> str:
    """Copy a table into run-stamped parquet; returns the path."""
    return write_stamped(read_table(spark, url, table, **reading), out, load_ts)
