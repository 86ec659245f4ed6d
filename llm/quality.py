"""Quality rules: repetition in a text, and bands of its compression ratio.

A text compresses the better the more it repeats, and hardly at all when it is noise. The ratio
of bytes to zstandard bytes also grows with length, so each length has its own limits. The whole
text must lie inside its band, and so must most of its fixed chunks: a page of repeats in the
middle of a long text doesn't hide behind the rest.

Null and empty texts have no words and are rejected by the base rules. Every row is judged by its
own text alone: repeated rows get equal results, columns other than the text only pass through.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from llm.tables import by_batch, table, typed
from llm.words import Texts, chunks, covered, lines, runs, span_hashes, whole, words

#: (bytes up to, least ratio, largest ratio). Largest: median plus 5 robust standard deviations (1.4826 MAD) of the
#: clean documents of one half of the labels, in each length with 30 of them; shorter and longer texts, with fewer, have
#: wide limits, and longer ones are judged by their chunks. Least: a third of the way from the most compressible
#: base64 words of that length to the median minus 5 deviations; under 256 bytes 5 % above those words. README has
#: what this rejects and loses.
BANDS = (
    (128, 1.02, 1.6),
    (192, 1.09, 1.85),
    (256, 1.14, 1.85),
    (384, 1.21, 1.758),
    (512, 1.23, 1.894),
    (768, 1.31, 1.986),
    (1024, 1.37, 2.092),
    (1536, 1.43, 2.182),
    (2048, 1.49, 2.184),
    (3072, 1.52, 2.239),
    (4096, 1.56, 2.251),
    (8192, 1.57, 2.396),
    (16384, 1.61, 2.42),
    (65536, 1.64, 2.75),
    (None, 1.64, 3.2),
)

SYMBOL = np.zeros(256, np.int64)
SYMBOL[list(b"#*$%&|<>")] = 1

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long"
)


class Limits(NamedTuple):
    least_words: int = 20
    repeat_percent: int = 30
    run: int = 8
    bands: tuple = BANDS
    chunk: int = 4096
    bad_percent: int = 50
    level: int = 3


def _totals(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[ends] - sums[starts]


def _again(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which (row, hash) were there before, and which occur twice or more; in order of place."""
    order = np.lexsort((hashes, row))
    same = (row[order][1:] == row[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    later, many = np.zeros(len(row), bool), np.zeros(len(row), bool)
    later[order[1:]] = same
    many[order[1:]] = same
    many[order[:-1]] |= same
    return later, many


def text_counts(texts: Texts, run: int) -> dict[str, np.ndarray]:
    """The counts of each row of the chunk."""
    found = words(texts)
    hashes = span_hashes(texts.data, found.start, found.end)
    places = np.flatnonzero(whole(found.counts, found.row, run))
    _, many = _again(found.row[places], runs(hashes, run)[places])
    begins = np.zeros(len(hashes), bool)
    begins[places[many]] = True
    bounds = found.offsets()
    letters = np.ones(len(texts.data), np.int64)
    letters[(texts.data & 0xC0) == 0x80] = 0
    chars = _totals(letters, found.start, found.end)
    # Lines with a word, of which an equal one came before.
    line = lines(texts)
    first = np.searchsorted(found.start, line.start)
    has = (first < len(found.start)) & (np.append(found.start, len(texts.data))[first] < line.end)
    row = line.row[has]
    later, _ = _again(row, span_hashes(texts.data, line.start[has], line.end[has]))
    return {
        "n_words": found.counts,
        "word_chars": _totals(chars, bounds[:-1], bounds[1:]),
        "n_symbols": _totals(SYMBOL[texts.data], texts.starts, texts.ends),
        "n_dup_lines": np.bincount(row[later], minlength=len(texts)),
        "n_repeat_words": _totals(covered(begins, run), bounds[:-1], bounds[1:]),
    }


def _outside(size: int, packed: int, bands: tuple) -> bool:
    least, most = next((b[1], b[2]) for b in bands if b[0] is None or size <= b[0])
    return not least * packed <= size <= most * packed


def compression(text: bytes, packer: zstandard.ZstdCompressor, limits: Limits) -> tuple[float, int, int, bool]:
    """Ratio of the whole, chunks, chunks outside their band, and the verdict."""
    if not text:
        return 1.0, 0, 0, False
    packed = len(packer.compress(text))
    if len(text) <= limits.chunk:
        bad = _outside(len(text), packed, limits.bands)
        return len(text) / packed, 1, int(bad), not bad
    parts = [text[at:at + limits.chunk] for at in range(0, len(text), limits.chunk)]
    bad = sum(_outside(len(part), len(packer.compress(part)), limits.bands) for part in parts)
    fine = not _outside(len(text), packed, limits.bands) and 100 * bad <= limits.bad_percent * len(parts)
    return len(text) / packed, len(parts), bad, fine


def _judge(column: pa.Array, limits: Limits) -> dict[str, np.ndarray]:
    packer = zstandard.ZstdCompressor(level=limits.level)
    parts = []
    for texts in chunks(column):
        out = text_counts(texts, limits.run)
        data = texts.data.tobytes()
        bands = [compression(data[a:b], packer, limits) for a, b in zip(texts.starts, texts.ends, strict=True)]
        ratio, n_chunks, bad, fine = map(np.array, zip(*bands, strict=True))
        failed = (out["n_words"] < limits.least_words) | (
            100 * out["n_repeat_words"] > limits.repeat_percent * out["n_words"]
        )
        parts.append(out | {
            "base_failed": failed, "kept": ~failed & fine.astype(bool),
            "ratio": ratio, "n_chunks": n_chunks, "n_bad_chunks": bad,
        })
    return {name: np.concatenate([part[name] for part in parts]) for name in parts[0]} if parts else {}


def quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its counts, its ratio, and whether it is kept."""

    def make(batch: pa.RecordBatch):
        found = _judge(batch.column(1), limits)
        if found:
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found.values())],
                                             names=["doc_id", *found])

    return by_batch(typed(docs), SCHEMA, make)


def keep_good(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    at = docs.columns.index(text)

    def make(batch: pa.RecordBatch):
        found = _judge(batch.column(at), limits)
        if found:
            yield batch.filter(pa.array(found["kept"]))

    return docs.mapInArrow(lambda batches: (out for batch in batches for out in make(batch)), docs.schema)


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


__all__ = ["BANDS", "Limits", "compression", "keep_good", "op5_quality_rules", "quality"]

