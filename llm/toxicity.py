"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length.

Folding lower-cases, takes off accents, and turns look-alike letters of other scripts, digits and
signs in the place of letters into plain letters. Entries are word beginnings, so that inflected
forms match; a match counts when no letter stands before it and it isn't inside an exception phrase.

The lexicon is learned from labels. The beginnings of the words of at most ``most_rows`` labelled
documents (those with the least hash of their id; this bounds what the driver gathers) are counted by label. Candidates
are those that occur ``least_odds`` times as often in toxic rows, and more often than chance explains: among the
beginnings found in k rows, as many as have so many toxic ones are at least ``surplus`` times those expected if labels
were dealt at random (for k up to FEW_ROWS; above, a likelihood ratio beyond that of the best of all beginnings by
chance). So a rare word enters where the rare words of toxic rows are too many to be chance, and there is no least share
of rows and no number of candidates. Of beginnings of one word that are in the same rows the longest is the candidate.
Of the candidates those are taken, one by one, that explain most toxic documents not
yet explained by one before, two at least. So a word that only keeps company
with others is left out. An entry weighs the log of how much more often toxic words begin with it
than others do.

What this misses: words of fewer than four letters a to z after folding, other scripts, words in one toxic row only, and
rare words where the language has so many that chance gives as many.

The score is logistic in the summed weights w and in w per thousand words, both as log(1 + x),
fitted to the same rows. A text without a match, and so a null or empty one, has the score of w = 0,
below the threshold. A null id has no remainder and is held out of training. Rows repeat as given.
Without labels of both kinds the lexicon is empty and every score 0. Further columns are ignored;
language and source are never read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.tables import by_batch, table, typed
from playlens.session import pin

MOST_ROWS = 20_000
FEW_ROWS = 30
BEGINNINGS = range(4, 10)
THRESHOLD = 0.3

#: Look-alikes of Latin letters.
_ALIKE = {
    "а": "a", "в": "b", "е": "e", "ѕ": "s", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ɡ": "g", "ո": "n", "ѵ": "v", "ԝ": "w", "ь": "b",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i",
}
#: A zero-width character hides a word without changing its looks.
_NOTHING = dict.fromkeys(map(ord, "­​‌‍⁠﻿"))

#: Harmless phrases with words that lexicons often have.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pond scum", "idiot proof")

_ASCII = {ord(a): b for a, b in _ALIKE.items() if ord(a) < 128}
_WORD = re.compile(r"[a-z]+")
#: A sign is a letter only where a letter or digit follows; at the end of a word it is punctuation.
_ENDS = re.compile(r"[!|$@]+(?![0-9A-Za-z])")


class _Fold(dict):
    """Translation of a code point, found once and then kept: lower case, without accents, look-alikes replaced."""

    def __missing__(self, code: int) -> str | int:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code).lower()) if not unicodedata.combining(c))
        self[code] = to = "".join(_ALIKE.get(c, c) for c in plain) or " "
        return to


_fold = _Fold(_NOTHING)


def fold(text: str) -> str:
    """The folded text. Numbers stay numbers, since digits turn into letters only next to letters."""
    text = _ENDS.sub(" ", text)
    if text.isascii():
        return text.lower().translate(_ASCII)
    return text.translate(_fold)


class Lexicon(NamedTuple):
    entries: tuple[str, ...] = ()
    weights: tuple[float, ...] = ()
    #: Logistic: constant, of log(1 + w), of log(1 + 1000 w / words).
    fit: tuple[float, float, float] = (-30.0, 0.0, 0.0)
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self):
        machine = ahocorasick.Automaton()
        for entry, weight in zip(self.entries, self.weights, strict=True):
            machine.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            machine.add_word(fold(phrase), (len(phrase), None))
        if len(machine):
            machine.make_automaton()
        return machine

    def score(self, weight: np.ndarray, words: np.ndarray) -> np.ndarray:
        z = np.stack((np.ones(len(weight)), np.log1p(weight), np.log1p(1000 * weight / np.maximum(words, 1))))
        return 1 / (1 + np.exp(-np.clip(np.array(self.fit) @ z, -30, 30)))


def matches(text: str, machine) -> float:
    """Summed weight of the matches in a folded text; of those that begin at one place the longest counts."""
    if not len(machine):
        return 0.0
    found, spared = {}, []
    for end, (length, weight) in machine.iter(text):
        begin = end + 1 - length
        if begin and text[begin - 1].isalpha():
            continue
        if weight is None:
            spared.append((begin, end))
        else:
            found[begin] = (end, weight)  # a longer one ends later, so it comes later
    return sum(w for a, (b, w) in found.items() if not any(c <= a and b <= d for c, d in spared))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def _features(text: str | None) -> tuple[int, dict[str, int]]:
    """Number of words, and how often one begins with each beginning."""
    words = _WORD.findall(fold(text or ""))
    found: dict[str, int] = {}
    for word in words:
        for k in BEGINNINGS:
            if k > len(word):
                break
            found[word[:k]] = found.get(word[:k], 0) + 1
    return len(words), found


def _count(docs: DataFrame) -> DataFrame:
    """entry, toxic, once, twice, hits: rows of each label where it occurs, where it does twice or more, and how often."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts: list[dict[str, list[int]]] = [{}, {}]
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            own = counts[toxic]
            for entry, n in _features(text)[1].items():
                row = own.setdefault(entry, [0, 0, 0])
                row[0] += 1
                row[1] += n > 1
                row[2] += n
        for toxic, own in enumerate(counts):
            numbers = np.array(list(own.values()), np.int64).reshape(len(own), 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.keys(), pa.string()), pa.array([toxic] * len(own), pa.int32()),
                 *(pa.array(numbers[:, k].copy()) for k in range(3))],
                names=["entry", "toxic", "once", "twice", "hits"])

    return by_batch(docs, "entry string, toxic int, once long, twice long, hits long", make)


def learn(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
    most_rows: int = MOST_ROWS, least_odds: float = 5, surplus: float = 4,
) -> Lexicon:
    """The lexicon of the labelled rows that aren't held out; of an id's texts the least counts."""
    known = (
        labels.where(F.col(toxic).isin(0, 1))
        .select(F.col(doc_id).cast("long").alias("doc_id"), F.col(toxic).cast("int").alias("toxic"))
        .where(~held_out(F.col("doc_id"))).distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(most_rows)
    )
    # At most most_rows rows are broadcast, and as many are kept: the corpus is read once.
    rows = pin(typed(docs, doc_id, text).join(F.broadcast(known), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min("text").alias("text")), "labelled")
    n = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    if not n.get(1) or not n.get(0):
        return Lexicon()
    sums = [
        F.sum(F.when(F.col("toxic") == kind, F.col(c)).otherwise(0)).alias(f"{c}_{kind}")
        for c in ("once", "twice", "hits") for kind in (0, 1)
    ]
    counted = pin(_count(rows).groupBy("entry").agg(*sums), "beginnings")

    def odds(c: str) -> Column:
        return (F.col(f"{c}_1") + 0.5) / (n[1] + 1) / ((F.col(f"{c}_0") + 0.5) / (n[0] + 1))

    found = {c: (odds(c) >= least_odds) & _beyond_chance(counted, c, n, surplus) for c in ("once", "twice")}
    log_odds = F.greatest(*(F.when(found[c], F.log(odds(c))) for c in found))
    worth = F.greatest(*(F.when(found[c], F.col(f"{c}_1") * F.log(odds(c))).otherwise(0.0) for c in found))
    best = counted.where((F.col("once_1") >= 2) & (found["once"] | found["twice"])).withColumn("log_odds", log_odds).withColumn(
        "worth", worth)
    # Another beginning of the same words, found in the same rows as often.
    names = [f"{c}_{kind}" for c in ("once", "twice", "hits") for kind in (0, 1)]
    longer = best.select(F.expr("left(entry, length(entry) - 1)").alias("entry"), *names).distinct()
    best = best.join(longer, ["entry", *names], "left_anti").orderBy(
        F.col("worth").desc(), F.length("entry").desc(), "entry").collect()
    return _choose(rows, best)


def _beyond_chance(counted: DataFrame, c: str, n: dict[int, int], surplus: float) -> Column:
    """Is an entry's number of toxic rows, of all rows it is in, more than chance gives among so many entries?"""
    toxic, all_ = F.col(f"{c}_1"), F.col(f"{c}_0") + F.col(f"{c}_1")
    share = n[1] / (n[0] + n[1])
    histogram = counted.select(all_.alias("k"), toxic.alias("toxic")).where(f"k BETWEEN 1 AND {FEW_ROWS}").groupBy(
        "k", "toxic").count().collect()
    least = []
    for k in range(FEW_ROWS + 1):
        held = np.zeros(k + 2)
        for row in histogram:
            if row["k"] == k:
                held[row["toxic"]] = row["count"]
        chance = np.array([math.comb(k, j) * share ** j * (1 - share) ** (k - j) for j in range(k + 1)])
        observed, expected = held[:k + 1][::-1].cumsum()[::-1], held.sum() * chance[::-1].cumsum()[::-1]
        enough = np.flatnonzero((observed > 0) & (observed >= surplus * expected))
        least.append(int(enough[0]) if len(enough) else FEW_ROWS + 1)
    # Of V entries the best by chance has a ratio of about 2 log V.
    entries = max(2, counted.count())
    clean, rest = F.col(f"{c}_0"), F.lit(float(n[0] + n[1])) - all_

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = 2 * (part(toxic, all_ * share) + part(clean, all_ * (1 - share))
                 + part(n[1] - toxic, rest * share) + part(n[0] - clean, rest * (1 - share)))
    few = toxic >= F.get(F.array(*map(F.lit, least)), all_.cast("int"))
    return F.when(all_ <= FEW_ROWS, few).otherwise(ratio > 2 * math.log(entries))


def _choose(rows: DataFrame, best: list) -> Lexicon:
    """Greedy choice of entries, and the fit; of each of the at most most_rows rows a few numbers are gathered."""
    place = {row["entry"]: i for i, row in enumerate(best)}

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n, at, times = [], [], []
        for text in batch.column("text").to_pylist():
            words, found = _features(text)
            own = [(place[e], k) for e, k in found.items() if e in place]
            n.append(words)
            at.append([i for i, _ in own])
            times.append([k for _, k in own])
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), pa.array(n, pa.int64()), pa.array(at, kind), pa.array(times, kind)],
            names=["doc_id", "toxic", "words", "at", "times"])

    got = by_batch(rows.select("doc_id", "toxic", "text"),
                   "doc_id long, toxic int, words long, at array<int>, times array<int>", make).toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("toxic", "ascending")]).combine_chunks()
    toxic, words = np.asarray(got["toxic"]), np.asarray(got["words"], float)
    at = got["at"].combine_chunks()
    row = np.repeat(np.arange(len(toxic)), np.asarray(at.value_lengths()))
    entry, times = np.asarray(at.flatten()), np.asarray(got["times"].combine_chunks().flatten())
    # Unexplained toxic rows gained, times the log odds: by occurring, or by occurring twice.
    log_odds = np.array([r["log_odds"] for r in best])
    of_toxic = toxic[row] == 1
    chosen: list[int] = []
    unexplained = toxic == 1
    while best:
        gain = np.bincount(entry[of_toxic & unexplained[row]], minlength=len(best))
        value = np.where(gain >= 2, gain * log_odds, 0)
        k = int(value.argmax())
        if value[k] <= 0 or k in chosen:
            break
        chosen.append(k)
        unexplained[row[entry == k]] = False
    # An entry that alone is in as many toxic rows as those chosen belongs to the lexicon too, unless it lengthens one.
    support = np.bincount(entry[of_toxic], minlength=len(best))
    if chosen:
        floor = support[chosen].max() / 3
        for k in np.argsort(-support, kind="stable"):
            e = best[k]["entry"]
            if support[k] >= floor and not any(e.startswith(best[c]["entry"]) or best[c]["entry"].startswith(e) for c in chosen):
                chosen.append(int(k))
    rate = [(best[k]["hits_1"] + 0.5) / (words[toxic == 1].sum() + 1) for k in chosen]
    base = [(best[k]["hits_0"] + 0.5) / (words[toxic == 0].sum() + 1) for k in chosen]
    weights = [float(np.clip(np.log(r / b), 0.5, 5)) for r, b in zip(rate, base, strict=True)]
    lexicon = Lexicon(tuple(best[k]["entry"] for k in chosen), tuple(weights))
    weight = np.zeros(len(best))
    weight[chosen] = weights
    return lexicon._replace(fit=_logistic(np.bincount(row, times * weight[entry], len(toxic)), words, toxic))


def _logistic(weight: np.ndarray, words: np.ndarray, toxic: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Newton's method; the ridge keeps separable rows finite."""
    x = np.stack((np.ones(len(weight)), np.log1p(weight), np.log1p(1000 * weight / np.maximum(words, 1))), 1)
    fit = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ fit, -30, 30)))
        step = np.linalg.solve(
            x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(3), x.T @ (toxic - p) - ridge * fit)
        fit += step * min(1.0, 3 / max(np.abs(step).max(), 1e-9))
    return tuple(map(float, fit))


def score(
    docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, weight of the matches."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        machine = lexicon.automaton()
        weight, words = [], []
        for text in batch.column(1):
            folded = fold(text.as_py() or "")
            weight.append(matches(folded, machine))
            words.append(len(folded.split()))
        weight, words = np.array(weight, float), np.array(words, float)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lexicon.score(weight, words)), pa.array(weight)], names=["doc_id", "score", "weight"])

    return by_batch(typed(docs, doc_id, text), "doc_id long, score double, weight double", make).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "weight")


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
