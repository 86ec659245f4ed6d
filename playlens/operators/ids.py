"""Numeric ids for text keys, and the artist catalogue."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.session import pin, shuffle_partitions

# monotonically_increasing_id() holds the position within the partition in its low 33 bits.
POSITION_BITS = 33


def numbered_in_order(df: DataFrame, order: list[str], partitions: int, label: str) -> DataFrame:
    """``df`` in range partitions by ``order``, with columns ``_part`` and ``_pos``, written once.

    Rows of an earlier partition sort before those of a later one, and ``_pos`` counts from 0
    within a partition, so no task sees more than one range, whatever the keys.
    """
    ranged = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()
    return pin(
        ranged.select(
            "*",
            F.shiftright(number, POSITION_BITS).cast("int").alias("_part"),
            number.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).alias("_pos"),
        ),
        label,
    )


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def dense_ids(df: DataFrame, key: str, id_name: str, start: int = 0,
              partitions: int | None = None) -> DataFrame:
    """Consecutive ids from ``start`` for the distinct values of ``key``, in key order.

    Same numbers as ``row_number() over (order by key)`` without sorting in one task. The
    result reads a written table, so that every reader sees the same ids.
    """
    partitions = partitions or shuffle_partitions(df.sparkSession)
    placed = numbered_in_order(distinct_keys(df, key), [key], partitions, f"keys-{id_name}")
    # One number per partition comes to the driver, and goes back as a constant: no join.
    sizes = dict(placed.groupBy("_part").count().collect())
    offsets = accumulate((sizes.get(part, 0) for part in range(partitions - 1)), initial=start)
    constant = F.expr(f"array({', '.join(f'{offset}L' for offset in offsets)})")
    return placed.select(key, (F.get(constant, "_part") + F.col("_pos")).alias(id_name))


def gapped_ids(df: DataFrame, key: str, id_name: str) -> DataFrame:
    """Unique ids with gaps for the distinct values of ``key``, without an ordering pass.

    They can exceed the int range, so train on ``dense_ids``.
    """
    keys = distinct_keys(df, key)
    return pin(keys.withColumn(id_name, F.monotonically_increasing_id()), f"gapped-{id_name}")


def artist_catalogue(plays: DataFrame, artist_ids: DataFrame) -> DataFrame:
    """(artist_id, item, artist_name): a row per name, so an artist of two names has two."""
    names = plays.select("artist_id", "artist_name").distinct()
    return names.join(artist_ids, "artist_id").select("artist_id", "item", "artist_name")
