"""Approximate nearest neighbours by cosine: vantage-point trees per shard, with relaxed pruning.

Distances are angles, which obey the triangle inequality: a half of a tree whose points lie at
angles [low, high] from its vantage point is at least max(low - d, d - high) from a query at angle
d. It is left out where ``slack`` times that exceeds the angle of the k-th best so far: with a slack
of 1 never wrongly, so the search is exact; above 1 it visits less and may miss some.

*Shards.* A coarse tree is fitted on a bounded sample: 16 rows a cell, at most ``MOST_CELLS`` cells,
the rows of least hash. Its median splits follow the density of the rows, and every row goes to the
cell it falls into. A cell of more than ``SHARD`` rows is dealt by hash over several shards, so no
group of near copies fills a task. A task holds one shard with its own tree and lets queries stream past.

*Search.* A query first visits the shard of its own row, which bounds the angle of its k-th best;
then, with that bound, the shards of all cells the coarse tree can't leave out. Results of a query
are k per shard visited, cut to k before the last shuffle. On data with structure most cells are
left out; on data without (independent directions in many dimensions, where all angles are alike) no
tree can leave out much, and the work grows with queries x rows.

*Whole.* Every row is indexed. Of rows with equal vectors the k + 1 of least id suffice for any
result, so others are dropped early, within each batch and each shard.

Rows take no part whose id or vector is null, whose vector holds null or non-finite components or
has a norm that is zero or infinite in double precision, or whose length isn't that of most usable
rows (the longer at a tie). Rows equal in id and vector count once; an id with several vectors is
asked with the least of them, and its rows aren't candidates of their own id. Equal scores go by the
smaller id. Scores are of the original vectors in double precision, products added from the first
component on. Tables without rows or without queries give no result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from llm.tables import by_batch, table
from playlens.session import pin

#: Rows of a shard, of a tree's smallest parts, and of the sample for a cell.
SHARD, BUCKET, SAMPLED = 2048, 64, 16
MOST_CELLS = 1024
SLACK = 3.0
#: Candidate vantage points, and what rounding may make of an angle and of a cosine.
TRIED, ANGLE, COSINE = 8, 1e-6, 1e-12


class Split(NamedTuple):
    """``inside`` holds the points at angles ``near`` = (low, high) from the vantage point, ``outside`` those at ``far``."""

    vantage: np.ndarray
    near: tuple[float, float]
    far: tuple[float, float]
    inside: Tree
    outside: Tree


Tree = Split | np.ndarray


def angles(units: np.ndarray, vantage: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ vantage, -1, 1))


def grow(units: np.ndarray, least: int) -> Tree:
    """A tree over unit vectors; its leaves are places of at most ``least`` of them."""
    pick = np.random.default_rng(0)

    def half(places: np.ndarray) -> Tree:
        if len(places) <= least:
            return places
        tried = pick.choice(places, min(TRIED, len(places)), replace=False)
        # The candidate that tells the points best apart.
        spread = np.arccos(np.clip(units[places] @ units[tried].T, -1, 1)).std(axis=0)
        vantage = units[tried[spread.argmax()]]
        angle = angles(units[places], vantage)
        order = np.argsort(angle, kind="stable")
        middle = len(order) // 2
        angle, places = angle[order], places[order]
        return Split(vantage, (angle[0], angle[middle - 1]), (angle[middle], angle[-1]), half(places[:middle]), half(places[middle:]))

    return half(np.arange(len(units)))


def below(angle: np.ndarray, span: tuple[float, float]) -> np.ndarray:
    """The least angle that points at angles in ``span`` from a vantage point can have from points at ``angle`` from it."""
    return np.maximum(np.maximum(span[0] - angle, angle - span[1]), 0)


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.add.accumulate(vectors * vectors, axis=1)[:, -1])


def scores(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Cosines of paired rows."""
    return np.add.accumulate(one * other, axis=1)[:, -1] / (norms(one) * norms(other))


def thinned(ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` least ids of each distinct vector, each id once."""
    _, group = np.unique(vectors, axis=0, return_inverse=True)
    group = group.reshape(-1)
    order = np.lexsort((ids, group))
    group, ids = group[order], ids[order]
    new = np.ones(len(order), bool)
    new[1:] = (group[1:] != group[:-1]) | (ids[1:] != ids[:-1])
    order, group = order[new], group[new]
    first = np.searchsorted(group, group)
    return np.sort(order[np.arange(len(order)) - first < most])


class Shard:
    """The vectors of a shard and the tree over them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        kept = thinned(ids, vectors, k + 1)
        self.ids, self.vectors, self.k = ids[kept], vectors[kept], k
        self.units = self.vectors / norms(self.vectors)[:, None]
        self.tree = grow(self.units, BUCKET)

    def nearest(self, ids: np.ndarray, vectors: np.ndarray, floor: np.ndarray, slack: float) -> tuple[np.ndarray, ...]:
        """Of each query (id, vector, score below which nothing is of use) up to k rows: query's place, vec_id, score."""
        units = vectors / norms(vectors)[:, None]
        best = np.full((len(ids), self.k), -2.0)
        pool: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def bound(asked: np.ndarray) -> np.ndarray:
            return np.maximum(best[asked].min(axis=1), floor[asked])

        def visit(tree: Tree, asked: np.ndarray) -> None:
            if not len(asked):
                return
            if not isinstance(tree, Split):
                cosines = units[asked] @ self.units[tree].T
                cosines[ids[asked][:, None] == self.ids[tree][None, :]] = -2
                both = np.concatenate((best[asked], cosines), axis=1)
                best[asked] = np.partition(both, both.shape[1] - self.k, axis=1)[:, -self.k:]
                row, at = np.nonzero((cosines >= bound(asked)[:, None] - COSINE) & (cosines > -2))
                pool.append((asked[row], tree[at], cosines[row, at]))
                return
            angle = angles(units[asked], tree.vantage)
            inside, outside = below(angle, tree.near), below(angle, tree.far)
            first = inside <= outside
            for chosen, near, far, gap in ((first, tree.inside, tree.outside, outside), (~first, tree.outside, tree.inside, inside)):
                own = asked[chosen]
                visit(near, own)
                still = slack * gap[chosen] <= np.arccos(np.clip(bound(own), -1, 1)) + ANGLE
                visit(far, own[still])

        if len(self.ids):
            visit(self.tree, np.arange(len(ids)))
        if not pool:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        asked, at, cosine = map(np.concatenate, zip(*pool))
        good = cosine >= bound(asked) - COSINE
        asked, at = asked[good], at[good]
        exact = scores(vectors[asked], self.vectors[at])
        order = np.lexsort((self.ids[at], -exact, asked))
        asked, at, exact = asked[order], at[order], exact[order]
        kept = np.arange(len(asked)) - np.searchsorted(asked, asked) < self.k
        return asked[kept], self.ids[at[kept]], exact[kept]


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Arrays of one length as rows of doubles."""
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dim)


class Cells(NamedTuple):
    """The coarse tree, its leaves being one cell each, and the shards of each cell: ``parts`` from number ``first`` on."""

    tree: Tree
    parts: list[int]

    @property
    def first(self) -> list[int]:
        return [sum(self.parts[:cell]) for cell in range(len(self.parts))]


def numbered_leaves(tree: Tree) -> tuple[Tree, int]:
    """The tree with the number of each leaf in its place, and how many there are."""
    count = 0

    def again(tree: Tree) -> Tree:
        nonlocal count
        if isinstance(tree, Split):
            return tree._replace(inside=again(tree.inside), outside=again(tree.outside))
        count += 1
        return np.array([count - 1])

    return again(tree), count


def home(tree: Tree, units: np.ndarray) -> np.ndarray:
    """The cell of each unit vector."""
    cell = np.zeros(len(units), np.int32)

    def fall(tree: Tree, places: np.ndarray) -> None:
        if not isinstance(tree, Split):
            cell[places] = tree[0]
        elif len(places):
            inside = angles(units[places], tree.vantage) <= tree.near[1]
            fall(tree.inside, places[inside])
            fall(tree.outside, places[~inside])

    fall(tree, np.arange(len(units)))
    return cell


def reached(tree: Tree, units: np.ndarray, bound: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query's place and a cell that may hold something within the angle ``bound``."""
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def fall(tree: Tree, places: np.ndarray) -> None:
        if not len(places):
            return
        if not isinstance(tree, Split):
            found.append((places, np.full(len(places), tree[0])))
            return
        # Rows beyond the sample lie anywhere on their side of the border.
        gap = angles(units[places], tree.vantage) - tree.near[1]
        fall(tree.inside, places[slack * gap <= bound[places] + ANGLE])
        fall(tree.outside, places[slack * -gap <= bound[places] + ANGLE])

    fall(tree, np.arange(len(units)))
    return tuple(map(np.concatenate, zip(*found))) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def usable(rows: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, int, int]:
    """vec_id, vector of the rows that take part, the vectors' length and the number of rows."""
    single = isinstance(rows.schema[embedding].dataType, ArrayType) and isinstance(rows.schema[embedding].dataType.elementType, FloatType)
    vector = F.col(embedding).cast("array<float>" if single else "array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite).where((squares > 0) & (squares < float("inf")))
    most = rows.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return rows, 0, 0
    return rows.where(F.size("vector") == most["dim"]), most["dim"], most["n"]


FOUND = "query_id long, vec_id long, score double"


def _searched(index: DataFrame, asked: DataFrame, dim: int, k: int, slack: float) -> DataFrame:
    """FOUND in the shards each query (shard, vec_id, floor, vector) is sent to; ``index``: shard, vec_id, vector."""
    rows = index.select("shard", F.lit(0).alias("kind"), "vec_id", F.lit(0.0).alias("floor"), "vector").unionByName(
        asked.select("shard", F.lit(1).alias("kind"), "vec_id", "floor", "vector"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, waiting, shard = None, [], None
        for batch in batches:
            number, kind = np.asarray(batch.column("shard")), np.asarray(batch.column("kind"))
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (kind[1:] != kind[:-1])) + 1
            for low, high in zip([0, *cuts], [*cuts, len(number)]):
                if low == high:
                    continue
                if number[low] != current:
                    current, waiting, shard = number[low], [], None
                part = batch.slice(low, high - low)
                ids, vectors = np.asarray(part.column("vec_id")), matrix(part.column("vector"), dim)
                if kind[low] == 0:
                    waiting.append((ids, vectors))
                    continue
                if shard is None:
                    if not waiting:
                        continue
                    shard, waiting = Shard(*map(np.concatenate, zip(*waiting)), k), []
                place, vec_id, score = shard.nearest(ids, vectors, np.asarray(part.column("floor")), slack)
                if len(place):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[place]), pa.array(vec_id), pa.array(score)], names=["query_id", "vec_id", "score"])

    return rows.repartition("shard").sortWithinPartitions("shard", "kind", "vec_id").mapInArrow(work, FOUND)


def nearest(rows: DataFrame, is_query: Column, k: int, slack: float = SLACK, vec_id: str = "vec_id",
            embedding: str = "embedding", shard_rows: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row for whose ``vec_id`` the condition holds."""
    rows, dim, n = usable(rows, vec_id, embedding)
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vector_type = rows.schema["vector"].dataType.simpleString()
    cells = 1 << min(max(0, (n - 1) // shard_rows), MOST_CELLS - 1).bit_length()
    sample = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(SAMPLED * cells).select("vector").toArrow()
    sample = matrix(sample.column("vector").combine_chunks(), dim)
    tree, cells = numbered_leaves(grow(sample / norms(sample)[:, None], -(-len(sample) // cells)))

    def placed(thin: bool) -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            vectors = matrix(batch.column("vector"), dim)
            if thin and len(vectors):
                kept = thinned(np.asarray(batch.column("vec_id")), vectors, k + 1)
                batch, vectors = batch.take(pa.array(kept)), vectors[kept]
            cell = home(tree, vectors / norms(vectors)[:, None])
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), batch.column("vec_id"), batch.column("vector")], names=["cell", "vec_id", "vector"])

        return make

    schema = f"cell int, vec_id long, vector {vector_type}"
    index = pin(by_batch(rows, schema, placed(True)), "cells")
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    queries = pin(by_batch(queries, schema, placed(False)), "queries")
    sizes = dict(index.groupBy("cell").count().collect())
    shards = Cells(tree, [-(-sizes.get(cell, 0) // shard_rows) for cell in range(cells)])
    first, parts = shards.first, shards.parts
    constant = [F.array(*map(F.lit, numbers)) for numbers in (first, parts)]
    part = F.pmod(F.xxhash64("vec_id", "vector"), F.greatest(F.get(constant[1], "cell"), F.lit(1)))
    shard = (F.get(constant[0], "cell") + part).cast("int").alias("shard")
    index = index.select(shard, "vec_id", "vector")
    asked = queries.select(shard, "vec_id", F.lit(-2.0).alias("floor"), "vector")
    at_home = pin(_searched(index, asked, dim, k, slack), "found-at-home")

    # A query's k-th score so far is in this group of k rows at most.
    floors = at_home.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n"), F.min("score").alias("least"))
    asked = asked.drop("floor").join(floors, "vec_id", "left").select(
        "shard", "vec_id", F.when(F.col("n") >= k, F.col("least")).otherwise(-2.0).alias("floor"), "vector")

    def route(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vectors, floor = matrix(batch.column("vector"), dim), np.asarray(batch.column("floor"))
        place, cell = reached(tree, vectors / norms(vectors)[:, None], np.arccos(np.clip(floor, -1, 1)), slack)
        counts = np.asarray(parts)[cell]
        place, ends = np.repeat(place, counts), np.cumsum(counts)
        to = np.repeat(np.asarray(first)[cell], counts) + np.arange(len(place)) - np.repeat(ends - counts, counts)
        away = to != np.asarray(batch.column("shard"))[place]
        # Some thousand copies of queries at a time.
        for low in range(0, int(away.sum()), 4096):
            copies = pa.array(place[away][low:low + 4096])
            yield pa.RecordBatch.from_arrays(
                [pa.array(to[away][low:low + 4096], pa.int32()), *(batch.column(name).take(copies) for name in ("vec_id", "floor", "vector"))],
                names=["shard", "vec_id", "floor", "vector"])

    routed = by_batch(asked, f"shard int, vec_id long, floor double, vector {vector_type}", route)
    found = at_home.unionByName(_searched(index, routed, dim, k, slack))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op11_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)
