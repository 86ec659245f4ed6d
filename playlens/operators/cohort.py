"""Users of two sets that share a profile."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.constants import PROFILE_KEYS
from playlens.session import pin, shuffle_partitions

# Pairs of one key that a task makes before the key is dealt over a grid of tasks, and pairs for which there is a task.
PAIRS_PER_CELL = 1_000_000


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(name).alias(prefix + name) for name in df.columns])


def _on(keys: Sequence[str]) -> list:
    return [F.col(f"a_{key}") == F.col(f"b_{key}") for key in keys]


def match_profiles(left: DataFrame, right: DataFrame, keys: Sequence[str] = PROFILE_KEYS,
                   pairs_per_cell: int = PAIRS_PER_CELL) -> DataFrame:
    """All pairs equal in every key, columns prefixed ``a_`` and ``b_``; empty texts match.

    A key of m x n pairs, more than ``pairs_per_cell``, is dealt over a grid: left rows by their hash
    over r rows of cells, right rows over c columns, with r x c cells of about that many pairs.
    Each left row goes to the c cells of its grid row and each right row to the r cells of its column. r and c
    are chosen so that these copies, m x c + n x r, are fewest: about 2 m n / sqrt(pairs_per_cell). Other
    keys have one cell, and their rows are not copied.

    The rows of a key are few beside its pairs: by the bytes that are read, all would go to a few tasks. So where
    there are more pairs than ``pairs_per_cell``, both sides go by cell to as many partitions as the pairs need.
    """
    sizes = pin(_sizes(left, right, keys), "sizes")
    grid, one = _grid(sizes, keys, pairs_per_cell), F.lit(1)
    partitions = _partitions(sizes, pairs_per_cell)

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Each row with its place on its own side, and a copy for each place on the other."""
        placed = rows.join(grid, list(keys), "left")
        at = F.pmod(F.xxhash64(*rows.columns), F.coalesce(own, one)).cast("int").alias(own)
        copies = F.explode(F.sequence(F.lit(0), (F.coalesce(other, one) - 1).cast("int"))).alias(other)
        return placed.select(*rows.columns, at, copies)

    on = [*_on(keys), F.col("a__row") == F.col("b__row"), F.col("a__col") == F.col("b__col")]
    columns = [f"a_{name}" for name in left.columns] + [f"b_{name}" for name in right.columns]
    sides = _renamed(dealt(left, "_row", "_col"), "a_"), _renamed(dealt(right, "_col", "_row"), "b_")
    if partitions > 1:
        cell = [*keys, "_row", "_col"]
        sides = tuple(side.repartition(partitions, *(letter + "_" + name for name in cell)) for side, letter in zip(sides, "ab"))
    return sides[0].join(sides[1], on).select(columns)


def _partitions(sizes: DataFrame, pairs_per_cell: int) -> int:
    """Partitions of about ``pairs_per_cell`` pairs, at least those of a shuffle; 1 where so few pairs are all."""
    pairs = sizes.agg(F.sum(F.col("n_left").cast("double") * F.col("n_right").cast("double"))).first()[0] or 0
    if pairs <= pairs_per_cell:
        return 1
    return max(shuffle_partitions(sizes.sparkSession), math.ceil(pairs / pairs_per_cell))


def _grid(sizes: DataFrame, keys: Sequence[str], pairs_per_cell: int) -> DataFrame:
    """Grid rows and columns (_row, _col) of the keys of more than ``pairs_per_cell`` pairs."""
    left, right = F.col("n_left").cast("double"), F.col("n_right").cast("double")
    cells = F.ceil(left * right / pairs_per_cell)
    rows = F.greatest(F.lit(1), F.least(left, F.round(F.sqrt(cells * left / right)))).cast("bigint")
    columns = F.least(right, F.ceil(F.col("cells") / F.col("_row"))).cast("bigint")
    return sizes.withColumn("cells", cells).where("cells > 1").withColumn("_row", rows).withColumn("_col", columns).select(
        *keys, "_row", "_col")


def _sizes(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both sides per key that both have; decimals, as their product can exceed a bigint."""
    left_sizes = left.groupBy(*keys).agg(F.count(F.lit(1)).cast("decimal(19,0)").alias("n_left"))
    right_sizes = right.groupBy(*keys).agg(F.count(F.lit(1)).cast("decimal(19,0)").alias("n_right"))
    return left_sizes.join(right_sizes, list(keys))


def count_matches(left: DataFrame, right: DataFrame,
                  keys: Sequence[str] = PROFILE_KEYS) -> DataFrame:
    """Number of pairs ``match_profiles`` has, from the sizes of the groups, without any pair."""
    pairs = F.sum(F.col("n_left") * F.col("n_right"))
    return _sizes(left, right, keys).agg(F.coalesce(pairs, F.lit(0)).cast("bigint").alias("n_pairs"))


def first_matches(left: DataFrame, right: DataFrame, n: int = 50,
                  keys: Sequence[str] = PROFILE_KEYS, id_column: str = "id") -> DataFrame:
    """The first ``n`` pairs by (left id, right id).

    Every left row with a partner starts at least one pair, so the first n pairs start from
    the n smallest of those rows: only n rows are joined, however large the groups are.
    """
    partners = right.select(*keys).distinct()
    starts = left.join(partners, list(keys), "left_semi").orderBy(id_column).limit(n)
    pairs = _renamed(right, "b_").join(F.broadcast(_renamed(starts, "a_")), _on(keys))
    columns = [f"a_{name}" for name in left.columns] + [f"b_{name}" for name in right.columns]
    return pairs.select(columns).orderBy(f"a_{id_column}", f"b_{id_column}").limit(n)
