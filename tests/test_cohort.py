import random

import pytest
from playlens.operators import cohort

DDL = "id string, gender string, age string, country string, registered string"


def profiles(spark, seed, n, hot):
    """A third of the rows share one profile when ``hot``."""
    rng = random.Random(seed)
    pick = lambda values: rng.choice(values)
    rows = [(f"{i:04d}", pick("mf"), pick(["", "20", "30"]), pick(["Peru", ""]), pick(["2006", "2007"]))
            if i % 3 or not hot else (f"{i:04d}", "m", "", "Peru", "2006") for i in range(n)]
    return spark.createDataFrame(rows, DDL), rows


@pytest.mark.parametrize("hot", [False, True])
def test_brute_force(spark, hot):
    left, left_rows = profiles(spark, 1, 90, hot)
    right, right_rows = profiles(spark, 2, 70, hot)
    expected = sorted((a, b) for a in left_rows for b in right_rows if a[1:] == b[1:])
    pairs = cohort.match_profiles(left, right)
    assert pairs.columns[:2] == ["a_id", "a_gender"]
    assert sorted((tuple(r)[:5], tuple(r)[5:]) for r in pairs.collect()) == expected
    assert cohort.count_matches(left, right).first()[0] == len(expected)
    for n in (1, 50, 10_000):
        first = [(r.a_id, r.b_id) for r in cohort.first_matches(left, right, n).collect()]
        assert first == [(a[0], b[0]) for a, b in expected][:n]


def test_empty_texts_match(spark):
    row = ("a", "m", "", "Peru", "2006")
    one = spark.createDataFrame([row], DDL)
    assert cohort.match_profiles(one, one).count() == 1


def test_no_match(spark):
    left = spark.createDataFrame([("a", "m", "1", "x", "y")], DDL)
    right = spark.createDataFrame([("b", "f", "1", "x", "y")], DDL)
    assert cohort.count_matches(left, right).first()[0] == 0
    assert cohort.first_matches(left, right).collect() == []


@pytest.mark.parametrize("sf,n", [("0.001", 5), ("0.01", 392), ("0.1", 41030)])
def test_known_answers(spark, sf, n):
    """Customers of even against those of odd key."""
    keys = ("nation", "segment", "balance")
    customers = spark.read.parquet(f"/root/testdata/sf{sf}/customer.parquet").selectExpr(
        "c_custkey id", "c_nationkey nation", "c_mktsegment segment", "floor(c_acctbal / 1000) balance")
    even, odd = customers.filter("id % 2 = 0"), customers.filter("id % 2 = 1")
    assert cohort.count_matches(even, odd, keys).first()[0] == n
    assert cohort.match_profiles(even, odd, keys).count() == n


def test_pairs_of_a_common_key_come_from_a_grid(spark):
    keys = ["gender", "age"]
    left = spark.range(90).selectExpr("id", "if(id < 30, 'm', cast(id as string)) gender", "'20' age")
    right = spark.range(60).selectExpr("id", "if(id < 20, 'm', cast(id as string)) gender", "'20' age")
    for limit in (1, 7, 50, 1000):
        pairs = cohort.match_profiles(left, right, keys, limit)
        assert pairs.columns == ["a_id", "a_gender", "a_age", "b_id", "b_gender", "b_age"]
        found = [(r.a_id, r.b_id) for r in pairs.collect()]
        assert len(found) == len(set(found)) == 30 * 20 + 30
    assert cohort.count_matches(left, right, keys).first()[0] == 630


@pytest.mark.parametrize("m,n", [(1_000_000, 1_000_000), (3_000, 3_000), (10, 5_000_000), (1, 10_000_000), (2_000_000, 7)])
def test_copies_of_a_hot_key_are_few(spark, m, n):
    """Rows sent for one key of m x n pairs, and the largest number of pairs a cell holds."""
    limit = 1_000_000
    sizes = spark.createDataFrame([("m", m, n), ("f", 10, 10)], "gender string, n_left bigint, n_right bigint")
    (row,) = cohort._grid(sizes, ["gender"], limit).collect()
    assert (row.gender, 1 <= row._row <= m, 1 <= row._col <= n) == ("m", True, True)
    copies = m * row._col + n * row._row
    assert copies <= 2.2 * m * n / limit ** 0.5 + m + n
    assert -(-m // row._row) * -(-n // row._col) <= 1.2 * limit + m / row._row + n / row._col


def test_only_hot_keys_are_copied(spark):
    """Rows that meet in the join: those of the hot key once for each cell of their side, others once."""
    left = spark.range(1000).selectExpr("cast(id as string) id", "if(id < 400, 'hot', cast(id as string)) gender")
    grid = cohort._grid(cohort._sizes(left, left, ["gender"]), ["gender"], 10_000).collect()
    assert [(r.gender, r._row, r._col) for r in grid] == [("hot", 4, 4)]
    assert cohort.match_profiles(left, left, ["gender"], 10_000).count() == 400 * 400 + 600


def test_tasks_grow_with_the_pairs(spark):
    """Few rows make many pairs: a task for each limit of pairs, whatever the bytes of the rows; one cell or several."""
    hot = spark.range(400).selectExpr("cast(id as string) id", "'hot' gender")
    even = spark.range(400).selectExpr("cast(id as string) id", "cast(id % 8 as string) gender")
    for rows, tasks in ((hot, 16), (even, 4)):
        pairs = cohort.match_profiles(rows, rows, ["gender"], 10_000)
        sizes = [len(part) for part in pairs.rdd.glom().collect()]
        assert len(sizes) == tasks and max(sizes) < sum(sizes) and sum(size > 0 for size in sizes) > tasks // 4
        assert sum(sizes) == cohort.count_matches(rows, rows, ["gender"]).first()[0]
