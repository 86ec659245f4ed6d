"""Suffix-array dedup with sparse suffixes: repeated passages of ``size`` words or more leave later documents.

1. Of every window of ``size`` words the suffix at its minimiser is retained, the place of the k-gram
   with the least hash: about one in (size - gram + 2) / 2 places, and the same ones wherever a passage
   stands. Suffixes whose k-gram no other document has are dropped after one shuffle of
   (k-gram, document).
2. The others are sorted by k-gram and by the ``size`` words from there on, copies in order of their
   document: a sorted suffix array in pieces, one for each k-gram. The same rows are sorted by the
   words before, backwards, as well: an array of reversed prefixes.
3. Neighbours in either order are compared: the common words to the right, and, extending the match to the left,
   those before. A match of ``size`` words or more in all is a repeated passage; its words are removed
   from the document with the larger id. Each suffix is compared with the one before it and, where
   that is another, with the earliest document of the matches in progress, so that copies whose
   neighbours are all later still find the first.

4. Where a k-gram stands in more than two places, others may be sorted between the two ends of a match in
   both orders. Windows of ``size`` words at such k-grams are grouped by the window itself as well, and each
   is removed from all documents but the first that has it. So the array of a k-gram of very many places
   may be cut: its suffixes are dealt by document into lanes of some LANE places, each sorted by itself.

A longer passage is covered by the matches at all its minimisers, each of which reaches at most
``size`` words to either side, so nothing is missed. What is removed always stands, in full, in a document
with a smaller id.

Words are compared by 32-bit hashes, over ``size`` words and more; windows of step 4 by 64-bit hashes. Null and empty texts have no words.
Rows of one id are one document. Rows with a null id keep all words and remove none. Further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.anchors import anchored, marked, numbers, shared_keys
from llm.spans import remove_spans, runs_of_words
from llm.tables import by_batch, table, typed
from llm.words import chunks, mix, runs, signed
from playlens.session import pin

SIZE = 50
GRAM = 8
#: Places of one k-gram that are sorted together; this changes the cost, not the result.
LANE = 4096


def _suffixes(docs: DataFrame, size: int, gram: int, lane: int) -> DataFrame:
    """key, lane, doc_id, at (minimiser's word), right and left (32-bit words; left ones nearest first)."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, keys, times = (batch.column(name) for name in ("doc_id", "keys", "times"))
        ids = np.asarray(ids)
        for texts in chunks(batch.column(1)):
            found = anchored(texts, size, gram)
            if not len(found.window):
                continue
            row = found.words.row[found.window]
            places = numbers(found, texts, keys, times)
            new = np.ones(len(row), bool)
            new[1:] = (found.anchor[1:] != found.anchor[:-1]) | (row[1:] != row[:-1])
            head = np.flatnonzero(new & (places > 0))
            at = found.anchor[head]
            row = row[head]
            lanes = -(-places[head] // lane)
            dealt = (mix(ids[texts.first + row].astype(np.uint64)) % lanes.astype(np.uint64)).astype(np.int32)
            bounds = found.words.offsets()
            # Big-endian, so that binaries sort as their words do.
            words = found.hashes.astype(np.uint32).astype(">u4")
            right = np.minimum(size, bounds[row + 1] - at)
            left = np.minimum(size - gram, at - bounds[row])
            back = words[::-1]
            for low in range(0, len(head), 1 << 13):
                part = slice(low, low + (1 << 13))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(found.keys[head[part]])), pa.array(dealt[part]), pa.array(ids[texts.first + row[part]]),
                     pa.array((at[part] - bounds[row[part]]).astype(np.int32)),
                     runs_of_words(words, at[part], right[part]),
                     runs_of_words(back, len(words) - at[part], left[part])],
                    names=["key", "lane", "doc_id", "at", "right", "left"])

    return by_batch(docs, "key long, lane int, doc_id long, at int, right binary, left binary", make)


def _padded(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``size`` words, and how many are real."""
    lengths = np.asarray(pc.binary_length(column)) // 4
    data = np.frombuffer(b"".join(column.to_pylist()), ">u4").astype(np.uint32)
    out = np.zeros((len(column), size), np.uint32)
    out[np.arange(size) < lengths[:, None]] = data
    return out, lengths


def _common(words: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of leading words that rows i and j have in common."""
    same = np.logical_and.accumulate(words[i] == words[j], axis=1).sum(1)
    return np.minimum(same, np.minimum(lengths[i], lengths[j]))


def _neighbours(suffixes: DataFrame, size: int, gram: int) -> DataFrame:
    """doc_id, at, n: the matches of neighbours, which come sorted by key, lane, then right or left, then (doc_id, at)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, and the survivor of the run it is in
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            k = 0 if held is None else held.num_rows
            key, doc, at = (np.asarray(rows[c]) for c in ("key", "doc_id", "at"))
            right, r_len = _padded(rows["right"].combine_chunks(), size)
            left, l_len = _padded(rows["left"].combine_chunks(), size - gram)
            out: list[tuple] = []

            def match(i, j, key=key, doc=doc, at=at, right=right, left=left, r_len=r_len, l_len=l_len, out=out):
                """Spans in the later document of each pair; which pairs match."""
                before, after = _common(left, l_len, i, j), _common(right, r_len, i, j)
                fine = (before + after >= size) & (key[i] == key[j])
                later = np.where(doc[i] > doc[j], i, j)
                cut = fine & (doc[i] != doc[j])
                out.append((doc[later][cut], (at[later] - before)[cut], (before + after)[cut]))
                return fine

            n = len(key)
            now = np.arange(max(1, k), n)
            fine = np.zeros(n, bool)
            fine[now] = match(now - 1, now)
            # The survivor: the least document among the matches in progress.
            survivor = np.arange(n)
            if k == 2:
                survivor[1] = 0
            asked = []
            for i in now.tolist():
                if key[i] != key[i - 1]:
                    continue
                s = survivor[i - 1]
                if s == i - 1:
                    if fine[i] and doc[s] <= doc[i]:
                        survivor[i] = s
                elif fine[i] or _one(right, left, r_len, l_len, s, i) >= size:
                    asked.append((s, i))
                    survivor[i] = s if doc[s] <= doc[i] else i
            if asked:
                s, i = np.array(asked).T
                match(s, i)
            doc_, at_, n_ = (np.concatenate(c) for c in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_), pa.array(at_.astype(np.int32)), pa.array(n_.astype(np.int32))], names=["doc_id", "at", "n"])
            last = survivor[n - 1]
            held = rows.take([last, n - 1] if last != n - 1 else [n - 1])

    return suffixes.mapInArrow(work, "doc_id long, at int, n int")


def _one(right, left, r_len, l_len, i: int, j: int) -> int:
    total = 0
    for words, lengths in ((right, r_len), (left, l_len)):
        n = min(lengths[i], lengths[j])
        differ = words[i, :n] != words[j, :n]
        total += int(differ.argmax()) if differ.any() else n
    return total


def _windows(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """window (hash), doc_id, at (its first word): the windows whose anchor is flagged."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, keys, flags = np.asarray(batch.column(0)), batch.column(2), batch.column(3)
        for texts in chunks(batch.column(1)):
            found = anchored(texts, size, gram)
            if not len(found.window):
                continue
            at = found.window[marked(found, texts, keys, flags)[1]]
            row = found.words.row[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(runs(found.hashes, size)[at])), pa.array(ids[texts.first + row]),
                 pa.array((at - found.words.offsets()[row]).astype(np.int32))], names=["window", "doc_id", "at"])

    return by_batch(docs, "window long, doc_id long, at int", make)


def _later(windows: DataFrame, size: int) -> DataFrame:
    """doc_id, at, n: the windows that an earlier document has."""
    held = windows.groupBy("window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    return windows.join(held, "window").where("doc_id > first").select("doc_id", "at", F.lit(size).alias("n"))


def repeated_passages(docs: DataFrame, size: int = SIZE, gram: int = GRAM, lane: int = LANE) -> DataFrame:
    """doc_id, at, n: words of ``docs`` (doc_id, text) in passages that an earlier document has."""
    known = docs.where("doc_id IS NOT NULL")
    keys = pin(shared_keys(known, size, gram, heavy=2, places=True), "keys")
    shared = known.join(keys, "doc_id").select("doc_id", "text", "keys", "heavy", "times")
    dealt = _suffixes(shared, size, gram, lane).repartition("key", "lane")
    forward, backward = (dealt.sortWithinPartitions("key", "lane", side, "doc_id", "at") for side in ("right", "left"))
    between = _later(_windows(shared.where("exists(heavy, x -> x)"), size, gram), size)
    return _neighbours(forward, size, gram).union(_neighbours(backward, size, gram)).union(between)


def dedup_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM, lane: int = LANE,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept, kept_sha256."""
    docs = typed(docs, doc_id, text)
    return remove_spans(docs, repeated_passages(docs, size, gram, lane))


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_passages(table(spark, sf_dir, "documents")).drop("kept")
