"""Given tables and Arrow helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_batch(
    df: DataFrame, schema: str, make: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """Apply ``make`` to each Arrow batch; it yields any number of batches of ``schema``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from make(batch)

    return df.mapInArrow(work, schema)


def typed(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id and the text, under these names and types."""
    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


#: Splitting on this gives the words of a text and, at its ends, perhaps empty strings.
WORD = r"[^\x20\x09-\x0D]+"


#: DuckDB has no crc32: a table of remainders as the CTE ``crc (t)``, and the checksum of an ASCII text by it.
CRC_SQL = """crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
)"""


def crc_sql(text: str) -> str:
    codes = f"list_transform(range(1, length({text}) + 1), lambda p: ascii(substr({text}, p, 1))::BIGINT)"
    return (f"xor(list_reduce([4294967295::BIGINT] || {codes}, "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")
