"""Neighbours against all cosines: exact with a slack of 1, nearly all with the slack in use."""

import numpy as np
import pyarrow.dataset
import pytest
from llm import neighbours
from llm.queries import QUERIES
from pyspark.sql import functions as F


def cosines(vectors, at):
    products = np.add.accumulate(vectors * vectors[at], axis=1)[:, -1]
    norms = np.sqrt(np.add.accumulate(vectors * vectors, axis=1)[:, -1])
    return products / (norms * norms[at])


def brute(ids, vectors, k, asked):
    out = []
    for at in np.flatnonzero(asked):
        score = cosines(vectors, at)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[at]][:k]
        out += [(int(ids[at]), rank + 1, int(ids[j]), float(score[j])) for rank, j in enumerate(order)]
    return sorted(out)


def of(sf):
    table = pyarrow.dataset.dataset(f"/root/testdata/{sf}/embeddings.parquet").to_table()
    return np.asarray(table["vec_id"]), np.array(table["embedding"].to_pylist(), np.float64)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("query_id", "rank", "vec_id", "score").collect())


def frame_of(spark, ids, vectors):
    rows = [(None if i is None else int(i), None if v is None else list(map(float, v)), "x", "y") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell string, shard string")


QUERY = "vec_id % 50 = 0"


@pytest.mark.parametrize("sf,shard_rows", [("sf0.01", 2048), ("sf0.1", 100), ("sf0.1", 700)])
def test_exact(spark, sf, shard_rows):
    ids, vectors = of(sf)
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    assert rows_of(neighbours.nearest(table, F.expr(QUERY), 5, slack=1, shard_rows=shard_rows)) == brute(ids, vectors, 5, ids % 50 == 0)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    ids, vectors = of(sf)
    expected = {row[::2] for row in brute(ids, vectors, 5, ids % 50 == 0)}
    got = rows_of(QUERIES["op11_nearest_neighbours"](spark, f"/root/testdata/{sf}"))
    assert len(got) == len(expected) and len({row[::2] for row in got} & expected) >= 0.95 * len(expected)
    for query_id, _, vec_id, score in got:
        assert score == cosines(vectors[[*np.flatnonzero(ids == query_id), *np.flatnonzero(ids == vec_id)]], 0)[1]


def test_prunes_what_is_far_away():
    """Clusters: the search with some slack visits few leaves and loses little."""
    pick = np.random.default_rng(5)
    centres = pick.normal(size=(64, 16))
    vectors = (centres[:, None, :] + 0.05 * pick.normal(size=(64, 40, 16))).reshape(-1, 16)
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    tree, cells = neighbours.numbered_leaves(neighbours.grow(units, 40))
    bound = np.full(len(units), 0.1)
    place, cell = neighbours.reached(tree, units, bound, 1.0)
    home = neighbours.home(tree, units)
    assert {*zip(range(len(units)), home)} <= {*zip(place, cell)}
    assert len(place) < 0.2 * len(units) * cells


def test_copies_ties_and_odd_rows(spark):
    """A third of all rows are one vector, ids repeat, vectors are null, zero, too short or not finite."""
    pick = np.random.default_rng(2)
    vectors = [*pick.integers(-2, 3, size=(300, 4)).astype(float), *np.ones((150, 4))]
    ids = list(range(len(vectors)))
    good = [(i, v) for i, v in zip(ids, vectors) if v.any()]
    odd = [(None, np.ones(4)), (50, np.array([1.0, 2.0])), (900, np.zeros(4)), (950, None), (1000, np.array([1, np.nan, 0, 0])),
           (1050, np.array([1, np.inf, 0, 0])), (1100, np.full(4, 1e-300)), (1150, np.full(4, 1e200)), (400, np.ones(4))]
    frame = frame_of(spark, *zip(*good, *odd))
    expected = brute(np.array([i for i, _ in good]), np.array([v for _, v in good]), 5, np.array([i % 50 == 0 for i, _ in good]))
    for shard_rows in (1000, 40):
        assert rows_of(neighbours.nearest(frame, F.expr(QUERY), 5, slack=1, shard_rows=shard_rows)) == expected


def test_few_and_no_rows(spark):
    few = frame_of(spark, [0, 1, 50], [[1, 0], [1, 1], [0, 2]])
    assert [row[:3] for row in rows_of(neighbours.nearest(few, F.expr(QUERY), 5))] == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert rows_of(neighbours.nearest(few.where("vec_id = 0"), F.expr(QUERY), 5)) == []
    assert rows_of(neighbours.nearest(few.where("vec_id = 1"), F.expr(QUERY), 5)) == []
    assert rows_of(neighbours.nearest(few.limit(0), F.expr(QUERY), 5)) == []
