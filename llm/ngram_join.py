"""N-gram Jaccard join: documents whose sets of word shingles are at least ``percent`` alike.

1. A text becomes the set of hashes of its distinct ``size``-word shingles (the whole sequence when
   it has fewer words). Texts with equal sets are one class, with the least id as representative;
   from here on only representatives count.
2. Prefix filter: two sets that reach the similarity share one of the first n - ceil(p n) + 1
   elements of each, in any order common to all sets. The order puts the shingles last that at
   least one text in ``rare`` has; at most ``rare`` times the mean set size can be so frequent, which
   bounds what is broadcast. Postings of one shingle, sorted by set size, are cut into tiles.
3. First the diagonal tiles: sets near to each other in size. Their links are joined to components.
4. Then, for shingles whose postings still belong to several components, the tiles off the diagonal,
   by bands of set size. Only sets of different components are compared.
5. In each tile pairs pass the bounds on size and place, then the bitmap signatures: the bits in
   which two signatures differ bound the symmetric difference from below, so the overlap from above.
   What is left is intersected exactly, on sorted arrays: the likeliest partner of each document
   first, then the pairs that would still join two components.

So every link between different sets is found, or its ends are already in one component, and no
group of near copies is expanded into all its pairs. Null and empty texts have an empty set, are
linked with nothing and are components of their own. Rows with equal ids are one node. A null id
can't be linked to: such a row takes the component of its class, else null. Further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.components import components
from llm.idset import bit_set, has_bit, with_place
from llm.tables import by_batch, table, typed
from llm.words import LOWER, Texts, chunks, mix, runs, signed, span_hashes, whole, words
from playlens.session import pin, session_conf

SIZE = 5
PERCENT = 75
RARE = 10_000
BLOCK = 16
WIDTH = 128
FEW = 8
TILE = 1024
#: Rows in an Arrow batch of texts or whole sets, of which a worker holds one at a time.
HEAVY_ROWS = 2000


def shingle_sets(texts: Texts, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each row, sorted by both."""
    found = words(texts)
    data = LOWER[texts.data]
    hashes = span_hashes(data, found.start, found.end)
    places = np.flatnonzero(whole(found.counts, found.row, size))
    rows, values = [found.row[places]], [runs(hashes, size)[places]]
    first = found.offsets()[:-1]
    for few in range(1, size):
        short = np.flatnonzero(found.counts == few)
        if len(short):
            rows.append(short)
            values.append(mix(runs(hashes, few)[first[short]] + np.uint64(few)))
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[fresh], value[fresh]


def _sums(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    bounds = np.searchsorted(row, np.arange(n + 1))
    return sums[bounds[1:]] - sums[bounds[:-1]]


_SALT = np.uint64(0xD6E8FEB86659FD93)


def _classes(docs: DataFrame, size: int, rare: int) -> DataFrame:
    """Per row: kind 0, id, set size, digest (d1, d2), signature. Per batch: kind 1, count n of a locally frequent shingle d1."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        every = []
        n, d1, d2, bits = [], [], [], []
        for texts in chunks(batch.column(1)):
            row, value = shingle_sets(texts, size)
            every.append(value)
            n.append(np.bincount(row, minlength=len(texts)))
            d1.append(_sums(row, mix(value ^ _SALT), len(texts)))
            d2.append(_sums(row, mix(value + _SALT), len(texts)))
            bits.extend(signatures(row, value, n[-1]))
        if not every:
            return
        value = np.concatenate(every)
        every.clear()
        value.sort()
        least = max(3, 2 * batch.num_rows // rare)
        later = value[least - 1:]
        often = np.unique(later[later == value[:len(later)]])
        count = np.searchsorted(value, often, "right") - np.searchsorted(value, often)
        yield _table(kind=np.zeros(batch.num_rows, np.int32), doc_id=batch.column(0), n=np.concatenate(n),
                     d1=signed(np.concatenate(d1)), d2=signed(np.concatenate(d2)), signature=pa.array(bits, pa.binary()))
        if len(often):
            k = len(often)
            yield _table(kind=np.ones(k, np.int32), doc_id=pa.nulls(k, pa.int64()), n=count,
                         d1=signed(often), d2=np.zeros(k, np.int64), signature=pa.nulls(k, pa.binary()))

    return by_batch(docs, "kind int, doc_id long, n long, d1 long, d2 long, signature binary", make)


def signatures(row: np.ndarray, value: np.ndarray, n: np.ndarray) -> list[bytes]:
    """A bitmap per row, of the least power of two of bits that is four times the set size or more."""
    sizes = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(4 * n, 1))).astype(np.int64))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    marks = np.zeros(starts[-1], np.uint8)
    marks[starts[row] + (value & (sizes[row] - 1).astype(np.uint64)).astype(np.int64)] = 1
    packed, ends = np.packbits(marks).tobytes(), (starts // 8).tolist()
    return [packed[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def folded(signature: np.ndarray, to: int) -> np.ndarray:
    """Bitmaps, one per row of bytes, folded to ``to`` bytes: what they would be with as many bits."""
    return np.bitwise_or.reduce(signature.reshape(len(signature), signature.shape[-1] // to, to), axis=1)


def _table(**columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def _binaries(row: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """The values of each row as one binary."""
    ends = np.searchsorted(row, np.arange(n + 1))
    offsets = (ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def _prefixes(docs: DataFrame, size: int, percent: int, frequent) -> DataFrame:
    """Per row: id, digest, set size, and its prefix in the common order, as a binary of hashes."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for texts in chunks(batch.column(1)):
            row, value = shingle_sets(texts, size)
            k = len(texts)
            n = np.bincount(row, minlength=k)
            d1, d2 = _sums(row, mix(value ^ _SALT), k), _sums(row, mix(value + _SALT), k)
            at = np.minimum(np.searchsorted(often, value), max(0, len(often) - 1))
            late = often[at] == value if len(often) else np.zeros(len(value), bool)
            order = np.lexsort((value, late, row))
            row, value = row[order], value[order]
            place = np.arange(len(row)) - np.concatenate(([0], np.cumsum(n)))[row]
            inside = place < (n - (percent * n + 99) // 100 + 1)[row]
            yield _table(doc_id=batch.column(0).slice(texts.first, k), d1=signed(d1), d2=signed(d2), n=n,
                         prefix=_binaries(row[inside], value[inside], k))

    return by_batch(docs, "doc_id long, d1 long, d2 long, n long, prefix binary", make)


def _postings(prefixes: DataFrame) -> DataFrame:
    """token, n, doc, place: one row per element of a prefix."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data = batch.column("prefix")
        values = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in data] or [np.zeros(0, np.int64)])
        counts = np.array([len(x.as_buffer()) // 8 for x in data], np.int64)
        row = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(row)) - np.concatenate(([0], np.cumsum(counts)))[row]
        ids, n = np.asarray(batch.column("doc_id")), np.asarray(batch.column("n"))
        for at in range(0, len(row), 1 << 17):
            part = slice(at, at + (1 << 17))
            yield _table(token=values[part], n=n[row[part]].astype(np.int32), doc=ids[row[part]],
                         place=place[part].astype(np.int32))

    return by_batch(prefixes, "token long, n int, doc long, place int", make)


def _may_link(na, pa_, nb, pb, percent: int) -> np.ndarray:
    """Bounds on sizes, and on what can follow the first common element at these places."""
    na, nb = na.astype(np.int64), nb.astype(np.int64)
    least = -(-percent * (na + nb) // (100 + percent))
    return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (np.minimum(na - pa_, nb - pb) >= least)


def _diagonal(postings: DataFrame, percent: int, block: int) -> DataFrame:
    """From postings sorted by (token, n, doc): kind 0, pairs (a, b) inside a block or next to each other that pass
    the bounds; kind 1, the rows (token, doc a, n) of postings longer than a block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        held_at = np.zeros(0, np.int64)  # places in the postings of the rows held from the batch before
        for batch in batches:
            new = [np.asarray(batch.column(k)) for k in range(4)]
            k, m = len(held[0]), len(new[0])
            if not m:
                continue
            token, n, doc, place = (np.concatenate((h, x)) for h, x in zip(held, new, strict=True))
            head = np.ones(k + m, bool)
            head[1:] = token[1:] != token[:-1]
            start = np.maximum.accumulate(np.where(head, np.arange(k + m), 0))
            at = np.arange(k + m) - start
            if k:
                at[start == start[k - 1]] += held_at[0]
            a, b = [], []
            for lag in range(1, block):
                later = np.arange(max(k, lag), k + m)
                same = token[later] == token[later - lag]
                if lag > 1:
                    same &= at[later] % block >= lag
                later = later[same]
                if not len(later):
                    break
                fine = _may_link(n[later], place[later], n[later - lag], place[later - lag], percent)
                later = later[fine]
                later = later[doc[later] != doc[later - lag]]
                a.append(np.minimum(doc[later], doc[later - lag]))
                b.append(np.maximum(doc[later], doc[later - lag]))
            first, last = a and np.concatenate(a), b and np.concatenate(b)
            if len(first):
                pairs = np.unique(np.stack((first, last), 1), axis=0)
                yield _table(kind=np.zeros(len(pairs), np.int32), token=np.zeros(len(pairs), np.int64),
                             a=pairs[:, 0].copy(), b=pairs[:, 1].copy(), n=np.zeros(len(pairs), np.int32))
            sizes = np.diff(np.append(np.flatnonzero(head), k + m))
            long = np.repeat(sizes, sizes) > block
            long |= (token == token[-1]) | (token == token[k]) if k and token[k] == token[k - 1] else token == token[-1]
            long[:k] = False  # these were given with their own batch
            if long.any():
                yield _table(kind=np.ones(int(long.sum()), np.int32), token=token[long], a=doc[long],
                             b=np.zeros(int(long.sum()), np.int64), n=n[long])
            keep = max(k + m - block, int(start[-1]))
            held, held_at = [x[keep:] for x in (token, n, doc, place)], at[keep:]

    return postings.mapInArrow(work, "kind int, token long, a long, b long, n int")


def _sets(docs: DataFrame, size: int, shared) -> DataFrame:
    """doc_id, shingles: the sorted set of each document whose bit is set in ``shared``."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        batch = batch.filter(pa.array(has_bit(batch, shared)))
        for texts in chunks(batch.column(1)):
            row, value = shingle_sets(texts, size)
            yield _table(doc_id=batch.column(0).slice(texts.first, len(texts)), shingles=_binaries(row, value, len(texts)))

    return by_batch(with_place(docs, shared), "doc_id long, shingles binary", make)


def _overlap(a: np.ndarray, b: np.ndarray, na, nb) -> np.ndarray:
    """Bound on the overlap, from above: bits that differ come from elements that only one has."""
    width = min(a.shape[-1], b.shape[-1])
    differ = np.bitwise_count(folded(a, width) ^ folded(b, width)).sum(-1, dtype=np.int64)
    return (na + nb - differ) // 2


def _enough(overlap: np.ndarray, na, nb, percent: int) -> np.ndarray:
    return (100 + percent) * overlap >= percent * (na + nb)


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _near(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """a, b, likeness: the pairs whose signatures let them be linked."""
    left = marks.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
    right = marks.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))

    def bound(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        wide = [np.asarray(pc.binary_length(batch.column(c))) for c in ("sa", "sb")]

        for wa, wb in set(zip(*(w.tolist() for w in wide), strict=True)):
            part = batch.filter(pa.array((wide[0] == wa) & (wide[1] == wb)))
            na, nb = np.asarray(part.column("na")), np.asarray(part.column("nb"))
            most = _overlap(_bytes(part.column("sa")), _bytes(part.column("sb")), na, nb)
            fine = _enough(most, na, nb, percent)
            yield _table(a=part.column("a"), b=part.column("b"), likeness=most / (na + nb)).filter(pa.array(fine))

    met = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb")
    return by_batch(met, "a long, b long, likeness double", bound)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked, by exact intersection."""

    def intersect(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        linked = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(batch.column("xa"), batch.column("xb"), strict=True)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if len(x) > len(y):
                x, y = y, x
            if len(x):
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                linked[i] = 100 * both >= percent * (len(x) + len(y) - both)
        yield batch.select(["a", "b"]).filter(pa.array(linked))

    met = (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("xa")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("xb")), "b")
        .select("a", "b", "xa", "xb")
    )
    return pin(by_batch(met, "a long, b long", intersect), "linked")


def _merged(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of the links, and of those found before."""
    if parts is None:
        return components(links)
    return components(parts.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")).union(links))


def _verify(near: DataFrame, parts: DataFrame | None, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Components after the links among ``near`` pairs. The likeliest partner of each document is
    tried first; then only pairs that would still join two components."""
    ids = near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct()
    with session_conf(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(HEAVY_ROWS)}):
        sets = pin(_sets(docs, size, bit_set(ids)), "sets")
        best = near.groupBy("b").agg(F.max_by("a", F.struct("likeness", "a")).alias("a")).select("a", "b")
        parts = _merged(parts, _linked(best, sets, percent))
        of = [parts.select(F.col("doc_id").alias(c), F.col("component_id").alias(f"part_{c}")) for c in "ab"]
        rest = near.join(best, ["a", "b"], "left_anti").join(of[0], "a", "left").join(of[1], "b", "left").where(
            F.coalesce("part_a", "a") != F.coalesce("part_b", "b")).select("a", "b")
        return _merged(parts, _linked(rest, sets, percent))


def _narrow(marks: DataFrame) -> DataFrame:
    """doc_id, signature: bitmaps folded to WIDTH bytes at most."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        short = []
        for mark in batch.column("signature"):
            bits = np.frombuffer(mark.as_buffer(), np.uint8)[None]
            short.append(folded(bits, min(WIDTH, bits.shape[1])).tobytes())
        yield _table(doc_id=batch.column("doc_id"), signature=pa.array(short, pa.binary()))

    return by_batch(marks.select("doc_id", "signature"), "doc_id long, signature binary", make)


def _off_diagonal(rows: DataFrame, narrow: DataFrame, percent: int, tile: int) -> DataFrame:
    """From rows (token, doc, n, component) of long postings and bitmaps (doc, signature): pairs of different components
    that pass the bounds.

    A tile has the sets of a size band against those of that band and the next, both cut into blocks by a hash;
    a set that would be on both sides of its tile is sent once.
    Rows carry their bitmap folded to ``WIDTH`` bytes at most, and their ``FEW`` least tokens: a pair that meets
    in the tiles of several tokens is left to the least of them, as far as those tell.
    """
    ratio = float(np.log(100 / percent))
    counts = rows.groupBy("token").agg(F.count("*").alias("rows"))
    tokens = rows.groupBy("doc").agg(F.slice(F.sort_array(F.collect_list("token")), 1, FEW).alias("tokens"))
    # Bitmaps come last, so that rows are short while they are shuffled by token.
    banded = (
        rows.join(counts, "token").join(tokens.join(narrow, "doc"), "doc")
        .withColumn("blocks", F.ceil(F.col("rows") / tile).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
        # Rounded down a little, so that no two sizes in range are two bands apart.
        .withColumn("band", F.floor(F.log(F.col("n").cast("double")) / (ratio * 1.0001)).cast("int"))
    )
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    left = F.transform(others, lambda other: F.struct(
        F.col("band").alias("low"), F.col("block").alias("i"), other.alias("j"), F.lit(0).alias("side")))
    right = F.flatten(F.transform(F.array(F.col("band"), F.col("band") - 1), lambda low: F.transform(
        others, lambda other: F.struct(low.alias("low"), other.alias("i"), F.col("block").alias("j"), F.lit(1).alias("side")))))
    right = F.filter(right, lambda place: (place["low"] < F.col("band")) | (place["i"] != F.col("block")))
    # Both sides from one pass, so that the bitmaps are joined once.
    placed = banded.withColumn("place", F.explode(F.concat(left, right))).select(
        "token", "place.*", "doc", "n", "band", "component", "signature", "tokens")

    def compare(group: pa.Table) -> pa.Table:
        side, doc, n, band, part = (np.asarray(group.column(c)) for c in ("side", "doc", "n", "band", "component"))
        held = group.column("signature").combine_chunks()
        width = pc.min(pc.binary_length(held)).as_py()
        sig = np.concatenate([folded(np.frombuffer(x.as_buffer(), np.uint8)[None], width) for x in held])
        left = np.flatnonzero(side == 0)
        own_block = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        right = np.arange(len(side)) if own_block else np.flatnonzero(side == 1)
        token, tokens = group.column("token")[0].as_py(), group.column("tokens").to_pylist()
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in left:
            js = right[(part[right] != part[i]) & ((band[right] != band[i]) | (doc[right] > doc[i]))]
            js = js[100 * np.minimum(n[js], n[i]) >= percent * np.maximum(n[js], n[i])]
            size, own = n[js].astype(np.int64), np.int64(n[i])
            js = js[_enough(_overlap(sig[js], sig[i:i + 1], size, own), size, own, percent)]
            if len(js):
                less = {x for x in tokens[i] if x < token}
                js = js[[less.isdisjoint(tokens[j]) for j in js]]
            a.append(np.minimum(doc[js], doc[i]))
            b.append(np.maximum(doc[js], doc[i]))
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return placed.groupBy("token", "low", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT,
    rare: int = RARE, block: int = BLOCK, tile: int = TILE,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, class_id (representative of equal sets)."""
    spark = docs.sparkSession
    docs = typed(docs, doc_id, text)
    classes = pin(_classes(docs, size, rare), "classes")
    members = classes.where("kind = 0").select("doc_id", "n", "d1", "d2")
    reps = members.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("class_id"))
    n_sets = reps.count()
    often = (
        classes.where("kind = 1").groupBy("d1").agg(F.sum("n").alias("n")).where(F.col("n") * rare >= max(n_sets, 3 * rare))
        .select("d1")
    )
    values = np.sort(np.array([row[0] for row in often.collect()], np.int64).view(np.uint64))
    frequent = spark.sparkContext.broadcast(values)
    alone = reps.where("class_id IS NOT NULL").select(F.col("class_id").alias("doc_id"), "d1", "d2")
    prefixes = _prefixes(docs, size, percent, frequent).where("n > 0").join(alone, ["doc_id", "d1", "d2"], "left_semi")
    ordered = _postings(prefixes.select("doc_id", "n", "prefix")).repartition("token").sortWithinPartitions("token", "n", "doc")
    found = pin(_diagonal(ordered, percent, block), "tiles")
    pairs = found.where("kind = 0").select("a", "b").distinct()
    marks = classes.where("kind = 0").select("doc_id", "n", "d1", "d2", "signature").join(
        alone, ["doc_id", "d1", "d2"], "left_semi").select("doc_id", "n", "signature")
    parts = _verify(pin(_near(pairs, marks, percent), "near"), None, docs, size, percent)
    longer = found.where("kind = 1").select("token", F.col("a").alias("doc"), "n")
    placed = longer.join(parts.withColumnRenamed("doc_id", "doc"), "doc", "left").withColumn(
        "component", F.coalesce("component_id", "doc")).drop("component_id")
    mixed = placed.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    rows = pin(placed.join(mixed.select("token"), "token", "left_semi"), "rows")
    narrow = _narrow(marks).withColumnRenamed("doc_id", "doc")
    near = pin(_near(_off_diagonal(rows, narrow, percent, tile), marks, percent), "near")
    parts = _verify(near, parts, docs, size, percent)
    # Sets without shingles are linked with nothing and would all meet under one key.
    empty = members.where("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"))
    return (
        members.where("n > 0").join(reps, ["n", "d1", "d2"], "left")
        .join(parts.withColumnRenamed("doc_id", "class_id"), "class_id", "left")
        .select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "class_id", "doc_id").alias("component_id"),
            F.coalesce("class_id", "doc_id").alias("class_id"),
        ).unionByName(empty)
    )


def op1_ngram_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
