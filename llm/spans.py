"""Removing spans of words from texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.idset import among, bit_set
from llm.tables import by_batch
from playlens.session import pin


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words left, joined by one space), kept_sha256 of each row of ``docs``.

    ``spans``: doc_id, at (first word, from 0), n (words). Rows of one id lose the same words; those with a null id none.
    Texts without a span aren't shuffled.
    """

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n_words, n_removed, kept, digests = [], [], [], []
        at_, n_ = batch.column("at"), batch.column("n")
        for i, text in enumerate(batch.column("text")):
            words = (text.as_py() or "").encode().split()
            gone = 0
            if at_[i].is_valid:
                at = np.minimum(np.asarray(at_[i].values), len(words))
                to = np.minimum(at + np.asarray(n_[i].values), len(words))
                inside = np.cumsum(np.bincount(at, minlength=len(words) + 1) - np.bincount(to, minlength=len(words) + 1))
                inside = inside[:len(words)] > 0
                gone = int(inside.sum())
                left = [words[k] for k in np.flatnonzero(~inside)]
            else:
                left = words
            joined = b" ".join(left)
            n_words.append(len(words))
            n_removed.append(gone)
            kept.append(joined)
            digests.append(hashlib.sha256(joined).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string()), pa.array(digests, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    per_doc = pin(spans.groupBy("doc_id").agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n")), "spans")
    touched = bit_set(per_doc)
    none = F.lit(None).cast("array<int>")
    marked = (
        among(docs, touched, True).join(per_doc, "doc_id", "left").select("doc_id", "text", "at", "n")
        .union(among(docs, touched, False).select("doc_id", "text", none, none))
    )
    return by_batch(marked, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string", make)


def runs_of_words(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """For each start, ``size`` values from there, as one binary."""
    ends = np.cumsum(size)
    place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)
    offsets = np.concatenate(([0], ends * values.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values[place].tobytes())])
