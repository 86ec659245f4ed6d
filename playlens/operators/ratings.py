"""Play totals, rating triples and the split for tuning."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens import constants
from playlens.operators.ids import dense_ids
from playlens.session import pin

# Fixed values of the split hash. Products stay below 2^63 for ids in the int range.
USER_FACTOR = 2654435761
ITEM_FACTOR = 40503
SEED_FACTOR = 97
PRIME = 1000003
BUCKETS = 1000


def plays_by(plays: DataFrame, key: str) -> DataFrame:
    """Total plays per user or artist."""
    return plays.groupBy(key).agg(F.sum(F.col("plays").cast("bigint")).alias("plays"))


def count_by_pair(plays: DataFrame) -> DataFrame:
    """Number of rows per (user, artist)."""
    return plays.groupBy("user_id", "artist_id").agg(F.count(F.lit(1)).alias("n"))


def plays_by_pair(plays: DataFrame) -> DataFrame:
    """Total plays per (user, artist), so that a pair is rated once."""
    return plays.groupBy("user_id", "artist_id").agg(
        F.sum(F.col("plays").cast("bigint")).alias("plays")
    )


def rating_triples(pairs: DataFrame, user_ids: DataFrame, artist_ids: DataFrame) -> DataFrame:
    """(user, item, plays) with the int ids the recommender needs; pairs without an id drop out.

    ``pairs`` has one row per (user, artist), see ``plays_by_pair``. The id tables are unique
    by key, so a frequent user or artist never multiplies rows.
    """
    return (
        pairs.join(user_ids, "user_id")
        .join(artist_ids, "artist_id")
        .select(F.col("user").cast("int"), F.col("item").cast("int"), "plays")
    )


def unrated_pairs(pairs: DataFrame, user_ids: DataFrame, artist_ids: DataFrame) -> DataFrame:
    """Pairs ``rating_triples`` leaves out: the user or the artist has no id."""
    return (
        pairs.join(user_ids, "user_id", "left")
        .join(artist_ids, "artist_id", "left")
        .filter(F.col("user").isNull() | F.col("item").isNull())
        .select("user_id", "artist_id", "plays")
    )


class Rated(NamedTuple):
    """Rating triples and the id tables behind them."""

    triples: DataFrame
    user_ids: DataFrame
    artist_ids: DataFrame


def rate(plays: DataFrame) -> Rated:
    """Number users and artists and rate their pairs, reading the play counts once.

    The totals per pair are written first; ids and ratings come from that smaller table.
    """
    pairs = pin(plays_by_pair(plays), "pairs")
    user_ids = dense_ids(pairs, "user_id", "user")
    artist_ids = dense_ids(pairs, "artist_id", "item")
    return Rated(rating_triples(pairs, user_ids, artist_ids), user_ids, artist_ids)


def split_bucket(user: Column, item: Column, seed: int = constants.SPLIT_SEED) -> Column:
    """A bucket below 1000 that depends on the pair only, not on how rows are laid out."""
    mixed = (
        user.cast("bigint") * USER_FACTOR + item.cast("bigint") * ITEM_FACTOR + seed * SEED_FACTOR
    )
    return F.pmod(mixed, F.lit(PRIME)) % BUCKETS


def assign_split(ratings: DataFrame, weights: Sequence[float] = constants.SPLIT_WEIGHTS,
                 seed: int = constants.SPLIT_SEED) -> DataFrame:
    """``ratings`` with ``split`` 0, 1, ... in shares of ``weights``; reproducible."""
    total = sum(weights)
    bounds = [round(BUCKETS * sum(weights[: i + 1]) / total) for i in range(len(weights) - 1)]
    bucket = split_bucket(F.col("user"), F.col("item"), seed)
    split = sum(((bucket >= bound).cast("int") for bound in bounds), F.lit(0))
    return ratings.withColumn("split", split)


def random_split(ratings: DataFrame, weights: Sequence[float] = constants.SPLIT_WEIGHTS,
                 seed: int = constants.SPLIT_SEED) -> list[DataFrame]:
    """Spark's own weighted random split; repeatable only for one layout of partitions."""
    return ratings.randomSplit(list(weights), seed)


def split_sizes(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
