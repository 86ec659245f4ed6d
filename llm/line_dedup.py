"""Line dedup by pairwise alignment: shared rare lines find overlapping documents, patience diff aligns them.

1. Lines (parts between line feeds, with a word) are hashed, blanks at their ends aside. Keys are the lines of
   ``least_words`` words or more, and the shortest runs of lines that together have as many: every block that can go
   begins with one. For each key its first holder, the document with the least id, is found; every later holder makes
   a pair with it, and with the first that has it just once, where that is another. So each holder of a key
   makes two pairs at most however many there are, and a line that a third of all documents share
   makes no more pairs than others.
2. A pair's line hashes are aligned by patience diff: lines unique in both, put in order by a
   longest increasing run, are extended over equal neighbours, and the gaps between are aligned
   again. Where none is unique in both, those of equal number (first, second, ...) in both take their place.
3. An aligned common block of ``least_words`` words or more is deleted from the later document. What
   is left is aligned again while more is found, so a block that the later document has twice goes twice.
   Pairs are judged on the texts as given, not on what is left. Since the first holder of a line
   keeps it, one copy of every line stays.

A document that loses nothing keeps its text unchanged; otherwise the lines kept are joined by line
feeds. Null and empty texts have no lines and lose nothing. Rows of one id are one document: a line
in any of them is held by it, they delete nothing from each other, and each loses its own lines; rows with a null id are left
alone. Whole copies lose all their lines and end empty. Further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.tables import by_batch, table, typed
from llm.words import chunks, range_hashes, signed, span_hashes, words
from playlens.session import pin

LEAST_WORDS = 10


def _hashed(docs: DataFrame, least_words: int) -> DataFrame:
    """doc_id, version (hash of the text), lines (hash, and words in each; in order, blank lines left out), keys (hashes of the shortest runs of
    lines that have ``least_words`` words, one for each line that begins one; a line of as many words is a run)."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0)
        for texts in chunks(batch.column(1)):
            found = words(texts)
            # Words of one line stand together: a line feed between two words parts them.
            feeds = np.concatenate(([0], np.cumsum(texts.data == 0x0A)))
            line = feeds[found.start]
            new = np.ones(len(line), bool)
            new[1:] = (line[1:] != line[:-1]) | (found.row[1:] != found.row[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(line)) - 1 if len(first) else first
            hashes = signed(span_hashes(texts.data, found.start[first], found.end[last]))
            counts = np.bincount(found.row[first], minlength=len(texts))
            offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
            sizes = last - first + 1
            before = np.concatenate(([0], np.cumsum(sizes)))
            stop = np.searchsorted(before, before[:-1] + least_words)  # the run of line i is i to stop, without it
            begins = np.flatnonzero(stop <= np.cumsum(counts)[found.row[first]])
            n_runs = np.bincount(found.row[first][begins], minlength=len(texts))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(texts.first, len(texts)), batch.column(2).slice(texts.first, len(texts)),
                 pa.ListArray.from_arrays(offsets, pa.array(hashes)),
                 pa.ListArray.from_arrays(offsets, pa.array(sizes.astype(np.int32))),
                 pa.ListArray.from_arrays(
                     pa.array(np.concatenate(([0], np.cumsum(n_runs))).astype(np.int32)),
                     pa.array(signed(range_hashes(hashes.view(np.uint64), begins, stop[begins]))))],
                names=["doc_id", "version", "lines", "sizes", "keys"])

    versions = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    return by_batch(versions, "doc_id long, version long, lines array<long>, sizes array<int>, keys array<long>", make)


def patience(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Aligned equal blocks (place in a, place in b, length), in order."""
    out: list[tuple[int, int, int]] = []
    open_ = [(0, len(a), 0, len(b))]
    while open_:
        a0, a1, b0, b1 = open_.pop()
        head = 0
        while a0 + head < a1 and b0 + head < b1 and a[a0 + head] == b[b0 + head]:
            head += 1
        tail = 0
        while a1 - tail > a0 + head and b1 - tail > b0 + head and a[a1 - tail - 1] == b[b1 - tail - 1]:
            tail += 1
        if head:
            out.append((a0, b0, head))
        if tail:
            out.append((a1 - tail, b1 - tail, tail))
        a0, b0, a1, b1 = a0 + head, b0 + head, a1 - tail, b1 - tail
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {x: i for i, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        anchors = _rising([(i, where[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in where])
        if not anchors:
            numbered = {x: i for i, x in _numbered(b, b0, b1)}
            anchors = _rising([(i, numbered[x]) for i, x in _numbered(a, a0, a1) if x in numbered])
        if not anchors:
            continue
        for (i, j), (k, m) in zip([(a0, b0), *anchors], [*anchors, (a1, b1)], strict=True):
            if (i, j) == (k, m):
                continue
            open_.append((i, k, j, m))
    return _joined(sorted(out))


def _numbered(lines: list[int], low: int, high: int) -> Iterator[tuple[int, tuple[int, int]]]:
    """Place, and line with how often it came before, of the lines from ``low`` to ``high``."""
    seen: Counter = Counter()
    for i in range(low, high):
        yield i, (lines[i], seen[lines[i]])
        seen[lines[i]] += 1


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, sorted by their first number, in which the second rises."""
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for n, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        before.append(ends[at - 1] if at else -1)
        if at == len(tops):
            tops.append(j)
            ends.append(n)
        else:
            tops[at], ends[at] = j, n
    out, n = [], ends[-1] if ends else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def _joined(blocks: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out: list[tuple[int, int, int]] = []
    for i, j, n in blocks:
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            out[-1] = (out[-1][0], out[-1][1], out[-1][2] + n)
        else:
            out.append((i, j, n))
    return out


def common_places(own: list, sizes: list[int], other: list, least_words: int) -> list[int]:
    """Places in ``own`` of the aligned blocks; found ones are taken out, and what they parted stays apart."""
    found: list[int] = []
    own = list(own)
    while True:
        new = [
            place
            for at, _, n in patience(own, other) if sum(sizes[at:at + n]) >= least_words
            for place in range(at, at + n)
        ]
        if not new:
            return found
        found += new
        for place in new:
            own[place] = ~place, None  # equal to no line


def _deletions(pairs: DataFrame, least_words: int) -> DataFrame:
    """doc_id, version, gone: places of lines to delete, for each pair that has any."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, versions, gone = [], [], []
        lists = [batch.column(c) for c in ("later_lines", "later_sizes", "earlier_lines")]
        # Lines of one pair at a time become Python numbers.
        for k, (later, version) in enumerate(zip(batch.column("later").to_pylist(), batch.column("version").to_pylist(), strict=True)):
            own, sizes, other = (np.asarray(column[k].values).tolist() for column in lists)
            found = common_places(own, sizes, other, least_words)
            if found:
                ids.append(later)
                versions.append(version)
                gone.append(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(versions, pa.int64()), pa.array(gone, pa.list_(pa.int32()))],
            names=["doc_id", "version", "gone"])

    return by_batch(pairs, "doc_id long, version long, gone array<int>", make)


def _delete(marked: DataFrame, text: str, counts: tuple[str, str]) -> DataFrame:
    """All columns but the last, the places that go, with the text without those lines; then the ``counts``: lines with a word, and
    those of them that went."""
    at = marked.columns.index(text)
    fields = marked.schema.fields[:-1]
    schema = T.StructType([*fields, *(T.StructField(name, T.LongType()) for name in counts)])

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept, n_lines, n_gone = [], [], []
        texts = batch.column(at)
        for own, gone in zip(texts.to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
            gone, place = set(gone or ()), 0
            out = []
            for line in (own or "").split("\n"):
                if line.encode().split():
                    place += 1
                    if place - 1 in gone:
                        continue
                out.append(line)
            n_lines.append(place)
            n_gone.append(len(gone))
            kept.append(own if not gone else "\n".join(out).strip("\n"))
        columns = [*batch.columns[:-1], pa.array(n_lines, pa.int64()), pa.array(n_gone, pa.int64())]
        columns[at] = pa.array(kept, texts.type)
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return marked.mapInArrow(lambda batches: (out for batch in batches for out in make(batch)), schema)


def common_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, version, gone: places of the lines of ``docs`` (doc_id, text) that are to go, blank lines not counted."""
    hashed = pin(_hashed(docs.where("doc_id IS NOT NULL"), least_words), "lines")
    exploded = hashed.select("doc_id", F.explode("keys").alias("line"))
    held = exploded.groupBy("doc_id", "line").agg(F.count("*").alias("n"))
    first = held.groupBy("line").agg(
        F.min("doc_id").alias("earlier"), F.min(F.when(F.col("n") == 1, F.col("doc_id"))).alias("once"),
        F.max("doc_id").alias("last"),
    ).where("earlier < last")
    pairs = (
        held.select("doc_id", "line").join(first.select("line", "earlier", "once"), "line").where("doc_id > earlier")
        .select(F.col("doc_id").alias("later"), F.explode(F.array("earlier", "once")).alias("earlier"))
        .where("later > earlier").distinct()
    )
    pairs = pin(pairs, "pairs")
    earlier = hashed.select(F.col("doc_id").alias("earlier"), F.col("lines").alias("earlier_lines"))
    later = hashed.select(
        F.col("doc_id").alias("later"), "version", F.col("lines").alias("later_lines"), F.col("sizes").alias("later_sizes"))
    gone = _deletions(pairs.join(earlier, "earlier").join(later, "later"), least_words)
    return gone.groupBy("doc_id", "version").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, with underscores before those that a table has already, whatever the case."""
    lower, out = {name.lower() for name in taken}, []
    for name in names:
        while name.lower() in lower:
            name = f"_{name}"
        lower.add(name.lower())
        out.append(name)
    return out


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of ``docs`` with all their columns, in ``text`` what is left; then n_lines with a word, n_removed of them.

    Where ``docs`` has columns of those two names, the new ones have underscores before theirs, as ``free_names`` says.
    """
    id_, version, places, *counts = free_names(docs.columns, "id", "version", "gone", "n_lines", "n_removed")
    gone = common_lines(typed(docs, doc_id, text), least_words).select(
        F.col("doc_id").alias(id_), F.col("version").alias(version), F.col("gone").alias(places))
    same = (docs[doc_id].cast("long") == gone[id_]) & (F.xxhash64(docs[text].cast("string")) == gone[version])
    marked = docs.join(gone, same, "left").select(*[docs[c] for c in docs.columns], gone[places])
    return _delete(marked, text, (counts[0], counts[1]))


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    """The texts themselves are in ``dedup_lines``; here their digest."""
    return dedup_lines(typed(table(spark, sf_dir, "documents"))).select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars_kept"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


