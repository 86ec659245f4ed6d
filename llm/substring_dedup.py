"""Substring dedup: suffix automata of reference passages give the matching statistics of later documents.

Every word of a document that lies in a window of ``size`` words which also starts in a document with a
smaller id is removed; windows are judged on the texts as given.

Automata of the whole corpus grow with it: neither can they be broadcast, nor can every document be
streamed through all of them. So references are cut into shards that meet just what can match:

1. Each window selects an anchor, the k-gram with the least hash in it. Equal windows have equal
   anchors; one shuffle of (anchor, document) finds the anchors that several documents have.
2. Around each such anchor the document's piece, of the windows that selected it, is dealt by the
   anchor, in order of ids. Anchors of more than ``heavy`` documents deal each of their windows by
   the window itself instead, so that no shard holds a large group of different pieces.
3. Each shard is a suffix automaton of the pieces seen so far. A document's pieces are streamed through
   it: where the matching statistic reaches ``size``, the maximal span is removed. Then pieces with a
   window that is new are added. Pieces equal to an earlier document's need no stream.

Words are 16-bit hashes in an automaton; a window is compared by 64 bits of its anchor and the ids of
its words, over 160 bits in all.

Null and empty texts have no words. Rows of one id are one document and remove nothing from each
other. Rows with a null id have no place in the order: they keep all words and remove none. Further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm.anchors import anchored, marked, shared_keys
from llm.spans import remove_spans, runs_of_words
from llm.tables import by_batch, table, typed
from llm.words import chunks, range_hashes, runs, signed, span_hashes

SIZE = 13
GRAM = 6
HEAVY = 4096
#: Rows of one shard that are held at once, before equal pieces are folded.
HELD = 1 << 15


class Automaton:
    """Suffix automaton of several words sequences."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """A copy of q for what is reached from p and its suffixes."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
                continue
            new = self._state(self.length[last] + 1, 0, {})
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            last = new

    def statistics(self, words: list[int]) -> Iterator[int]:
        """Length of the longest match that ends at each word."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            yield length


def _pieces(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """route, doc_id, at (first words), words (16-bit ids): the pieces of (doc_id, text, keys, heavy).

    A piece that a document has in several places is one row with all of them.
    """

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, keys, flags = np.asarray(batch.column(0)), batch.column(2), batch.column(3)
        for texts in chunks(batch.column(1)):
            found = anchored(texts, size, gram)
            if not len(found.window):
                continue
            shared, heavy = marked(found, texts, keys, flags)
            row = found.words.row[found.window]
            new = np.ones(len(row), bool)
            new[1:] = (found.anchor[1:] != found.anchor[:-1]) | (row[1:] != row[:-1])
            head = np.flatnonzero(shared & (new | heavy))
            # A piece ends with the last window of its anchor; a heavy one with its own.
            stop = np.append(np.flatnonzero(new)[1:], len(row))
            last = stop[np.cumsum(new)[head] - 1]
            count = np.where(heavy[head], 1, last - head)
            at = found.window[head]
            own = runs(found.hashes, size)
            route = np.where(heavy[head], own[at], found.keys[head])
            first = found.words.offsets()[row[head]]
            word_ids = found.hashes.astype(np.uint16)
            digest = range_hashes(found.hashes, at, at + count + (size - 1))
            order = np.lexsort((at, digest, route, row[head]))
            new = np.ones(len(order), bool)
            for column in (digest, route, row[head]):
                new[1:] &= column[order][1:] == column[order][:-1]
            new[1:] = ~new[1:]
            groups = np.flatnonzero(new)
            sizes = np.diff(np.append(groups, len(order)))
            places = (at - first)[order].astype(np.int32)
            one = order[groups]
            for low in range(0, len(one), 1 << 15):
                part = slice(low, low + (1 << 15))
                own = one[part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(route[own])), pa.array(ids[texts.first + row[head[own]]]),
                     runs_of_words(places, groups[part], sizes[part]),
                     runs_of_words(word_ids, at[own], count[own] + size - 1)],
                    names=["route", "doc_id", "at", "words"])

    return by_batch(docs, "route long, doc_id long, at binary, words binary", make)


def _group_spans(doc: np.ndarray, at: list[bytes], words: list[bytes], size: int) -> Iterator[tuple[int, int, int]]:
    """Spans (doc, at, n) of one shard's pieces, in order of documents, that stand in those of earlier ones."""
    machine = Automaton()
    first: dict[bytes, int] = {}
    waiting: list[list[int]] = []
    known: dict[bytes, list[tuple[int, int]]] = {}
    now = None
    for d, places, piece in zip(doc.tolist(), at, words, strict=True):
        if d != now:
            for one in waiting:
                machine.add(one)
            waiting, known, now = [], {}, d
        n = len(piece) // 2
        places = np.frombuffer(places, np.int32).tolist()
        before = first.setdefault(piece, d)
        if before < d:
            for place in places:
                yield d, place, n
            continue
        if piece not in known:
            one = np.frombuffer(piece, np.uint16).tolist()
            spans: list[list[int]] = []
            covered = 0
            for end, length in enumerate(machine.statistics(one), 1):
                if length >= size:
                    covered += 1
                    if spans and spans[-1][1] >= end - size:
                        spans[-1][1] = end
                    else:
                        spans.append([end - size, end])
            known[piece] = [(a, b) for a, b in spans]
            if covered < n - size + 1:
                waiting.append(one)
        for a, b in known[piece]:
            for place in places:
                yield d, place + a, b - a


def _matched(pieces: DataFrame, size: int) -> DataFrame:
    """doc_id, at, n: spans of the pieces, which come sorted by (route, doc_id)."""

    def covered(doc, at, words, which) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces ``which``, whole, at all their places."""
        times, lengths = (at.binary_length() // 4)[which], (words.binary_length() // 2)[which]
        places = np.frombuffer(b"".join(at.array.filter(pa.array(which)).to_pylist()), np.int32)
        return np.repeat(doc[which], times), places, np.repeat(lengths, times)

    def batch_of(doc, at, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(doc.astype(np.int64)), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))],
            names=["doc_id", "at", "n"])

    def spans(route, doc, at, words) -> Iterator[pa.RecordBatch]:
        """Of complete shards."""
        head = np.flatnonzero(np.concatenate(([True], route[1:] != route[:-1])))
        digest = _digests(words)
        low, high = np.minimum.reduceat(digest, head), np.maximum.reduceat(digest, head)
        sizes = np.diff(np.append(head, len(route)))
        alike = np.repeat(low == high, sizes)
        later = alike & (doc > np.repeat(doc[head], sizes))
        out = [covered(doc, at, words, later)]
        found = [
            span
            for a, n in zip(head[low != high], sizes[low != high], strict=True) if doc[a] != doc[a + n - 1]
            for span in _group_spans(doc[a:a + n], at.slice(a, n).to_pylist(), words.slice(a, n).to_pylist(), size)
        ]
        if found:
            out.append(tuple(np.array(c) for c in zip(*found, strict=True)))
        yield batch_of(*(np.concatenate(c) for c in zip(*out, strict=True)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows < 8192:
                continue
            route = np.asarray(held["route"])
            whole = int(np.searchsorted(route != route[-1], False)) if route[0] == route[-1] else int(
                len(route) - np.argmax(route[::-1] != route[-1]))
            if whole:
                yield from spans(*_columns(held.slice(0, whole)))
                held = held.slice(whole).combine_chunks()
            if held.num_rows > HELD:
                # One long shard: rows of pieces that an earlier document has are settled; the first of each stays.
                route, doc, at, words = _columns(held)
                digest = _digests(words)
                order = np.lexsort((np.arange(len(digest)), digest))
                start = np.concatenate(([True], digest[order][1:] != digest[order][:-1]))
                first = np.empty(len(digest), np.int64)
                first[order] = order[np.maximum.accumulate(np.where(start, np.arange(len(order)), 0))]
                later = doc > doc[first]
                yield batch_of(*covered(doc, at, words, later))
                held = held.filter(pa.array(~later)).combine_chunks()
        if held is not None and held.num_rows:
            yield from spans(*_columns(held))

    return pieces.mapInArrow(work, "doc_id long, at int, n int")


def _columns(rows: pa.Table):
    at, words = (_Binary(pa.concat_arrays(rows[c].chunks)) for c in ("at", "words"))
    return np.asarray(rows["route"]), np.asarray(rows["doc_id"]), at, words


class _Binary:
    """A binary array with the few operations used here."""

    def __init__(self, array: pa.Array) -> None:
        self.array = array

    def offsets(self) -> np.ndarray:
        return np.frombuffer(self.array.buffers()[1], np.int32, len(self.array) + 1, self.array.offset * 4).astype(np.int64)

    def binary_length(self) -> np.ndarray:
        return np.diff(self.offsets())

    def slice(self, at: int, n: int) -> pa.Array:
        return self.array.slice(at, n)


def _digests(words: _Binary) -> np.ndarray:
    offsets = words.offsets()
    data = np.frombuffer(words.array.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    return span_hashes(data, offsets[:-1], offsets[1:])


def repeated_spans(docs: DataFrame, size: int = SIZE, gram: int = GRAM, heavy: int = HEAVY) -> DataFrame:
    """doc_id, at, n: the spans of ``docs`` (doc_id, text) that stand in earlier documents."""
    known = docs.where("doc_id IS NOT NULL")
    keys = shared_keys(known, size, gram, heavy)
    pieces = _pieces(known.join(keys, "doc_id").select("doc_id", "text", "keys", "heavy"), size, gram)
    return _matched(pieces.repartition("route").sortWithinPartitions("route", "doc_id"), size)


def dedup_substrings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM, heavy: int = HEAVY,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept, kept_sha256."""
    docs = typed(docs, doc_id, text)
    return remove_spans(docs, repeated_spans(docs, size, gram, heavy))


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents")).drop("kept")
