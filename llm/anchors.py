"""Content-selected places in texts: of the k-grams in each window of words the one with the least hash.

Equal windows select equal k-grams wherever they stand, so texts that share a window share an
anchor, and anchors are a small part of all places.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import by_batch
from llm.words import Spans, Texts, chunks, runs, signed, span_hashes, whole, words


class Anchored(NamedTuple):
    """Words of a chunk, and per window of ``size`` words inside a row its first word and its anchor's place."""

    words: Spans
    hashes: np.ndarray
    window: np.ndarray
    anchor: np.ndarray
    keys: np.ndarray


def anchored(texts: Texts, size: int, gram: int) -> Anchored:
    found = words(texts)
    hashes = span_hashes(texts.data, found.start, found.end)
    grams = runs(hashes, gram)
    window = np.flatnonzero(whole(found.counts, found.row, size)) if len(hashes) else np.zeros(0, np.int64)
    anchor = np.arange(len(grams))
    least = grams.copy()
    # After each round the least over twice as many grams; the leftmost of equals.
    reach, need = 1, size - gram + 1
    while reach < need and len(least):
        step = min(reach, need - reach)
        after, at = least[step:], anchor[step:]
        lower = after < least[:len(after)]
        least, anchor = np.where(lower, after, least[:len(after)]), np.where(lower, at, anchor[:len(after)])
        reach += step
    return Anchored(found, hashes, window, anchor[window], grams[anchor[window]])


def shared_keys(docs: DataFrame, size: int, gram: int, heavy: int, places: bool = False) -> DataFrame:
    """doc_id, keys, heavy: the anchors of each document that another has too, and which of them more than ``heavy`` have,
    or with ``places`` stand in more than ``heavy`` places; then ``times`` tells in how many.

    One shuffle, of (key, doc_id); a document sends a key once.
    """

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = np.asarray(batch.column(0))
        for texts in chunks(batch.column(1)):
            found = anchored(texts, size, gram)
            row = found.words.row[found.window]
            new = np.ones(len(row), bool)
            new[1:] = (found.anchor[1:] != found.anchor[:-1]) | (row[1:] != row[:-1])
            pairs, times = np.unique(np.rec.fromarrays((row[new], found.keys[new])), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(pairs["f1"].copy())), pa.array(ids[texts.first + pairs["f0"]]),
                 pa.array(times.astype(np.int32))], names=["key", "doc_id", "times"])

    rows = by_batch(docs, "key long, doc_id long, times int", make)
    same = Window.partitionBy("key")
    return (
        rows.select("key", "doc_id", F.min("doc_id").over(same).alias("first"), F.max("doc_id").over(same).alias("last"),
                    (F.sum("times") if places else F.count("*")).over(same).alias("n"))
        .where("first < last")
        .groupBy("doc_id").agg(
            F.collect_list("key").alias("keys"), F.collect_list(F.col("n") > heavy).alias("heavy"),
            *([F.collect_list(F.col("n").cast("int")).alias("times")] if places else []))
    )


def _by_row(found: Anchored, texts: Texts, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows' ``keys``, and the anchors of the windows, told apart by row."""
    keys = keys.slice(texts.first, len(texts))
    sizes = np.asarray(keys.value_lengths().fill_null(0))
    row = np.repeat(np.arange(len(sizes)), sizes).astype(np.uint64)
    salt = np.uint64(0x9E3779B97F4A7C15)
    known = np.asarray(keys.flatten()).view(np.uint64) ^ (row * salt)
    return known, found.keys ^ (found.words.row[found.window].astype(np.uint64) * salt)


def marked(found: Anchored, texts: Texts, keys: pa.Array, flags: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per window: is its anchor's key among its row's ``keys``, and is it flagged there?"""
    known, own = _by_row(found, texts, keys)
    flagged = known[np.asarray(flags.slice(texts.first, len(texts)).flatten(), bool)]
    return np.isin(own, known), np.isin(own, flagged)


def numbers(found: Anchored, texts: Texts, keys: pa.Array, values: pa.Array) -> np.ndarray:
    """Per window the value beside its anchor's key among its row's ``keys``, else 0."""
    known, own = _by_row(found, texts, keys)
    values = np.asarray(values.slice(texts.first, len(texts)).flatten(), np.int64)
    if not len(known):
        return np.zeros(len(own), np.int64)
    order = np.argsort(known)
    at = np.minimum(np.searchsorted(known, own, sorter=order), len(known) - 1)
    return np.where(known[order[at]] == own, values[order[at]], 0)
