"""Splitting documents by a set of ids without shuffling their texts.

A set of ids of any size becomes a bit set of a fixed one. Documents whose bit isn't set surely
aren't in it and can stay where they are; the others take part in the join, which is exact. With
more ids than bits most documents take part, which costs a shuffle and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import by_batch

BITS = 1 << 23


def bit_set(ids: DataFrame, bits: int = BITS):
    """Broadcast bits of the hashes of ``doc_id``; at most bits / 64 numbers pass through the driver."""
    places = ids.select(F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("place"))
    longs = places.groupBy(F.shiftrightunsigned("place", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("long")).collect()
    found = np.zeros(bits // 64, np.int64)
    for at, long in longs:
        found[at] = long
    return ids.sparkSession.sparkContext.broadcast(found)


def with_place(docs: DataFrame, shared) -> DataFrame:
    """doc_id, text, and the place of the id's bit."""
    return docs.select(
        "doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(len(shared.value) * 64)).alias("place"))


def has_bit(batch: pa.RecordBatch, shared) -> np.ndarray:
    """Which rows have their bit set; null ids aren't in any set."""
    place = np.asarray(batch.column("place"))
    there = (shared.value[place >> 6] >> (place & 63)) & 1 == 1
    return there & np.asarray(batch.column("doc_id").is_valid())


def among(docs: DataFrame, shared, inside: bool) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) whose bit is set, or those whose isn't."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.select(["doc_id", "text"]).filter(pa.array(has_bit(batch, shared) == inside))

    return by_batch(with_place(docs, shared), "doc_id long, text string", make)
