from playlens.operators import ids, ratings

BIG = 2147483647


def plays(spark, rows):
    return spark.createDataFrame(rows, "user_id string, artist_id string, artist_name string, plays int")


ROWS = [("ua", "a1", "One", 2137), ("ua", "a1", "One", 3), ("ub", "a1", "Uno", 5), ("uc", "a2", "Two", BIG),
        ("uc", "a3", "Three", BIG)]


def test_totals(spark):
    df = plays(spark, ROWS)
    assert {tuple(r) for r in ratings.plays_by(df, "user_id").collect()} == {
        ("ua", 2140), ("ub", 5), ("uc", 2 * BIG)}
    assert {tuple(r) for r in ratings.plays_by(df, "artist_id").collect()} == {
        ("a1", 2145), ("a2", BIG), ("a3", BIG)}
    assert ("ua", "a1", 2) in {tuple(r) for r in ratings.count_by_pair(df).collect()}


def test_rate(spark):
    rated = ratings.rate(plays(spark, ROWS))
    assert {tuple(r) for r in rated.triples.collect()} == {
        (0, 0, 2140), (1, 0, 5), (2, 1, BIG), (2, 2, BIG)}
    assert [f.dataType.simpleString() for f in rated.triples.schema] == ["int", "int", "bigint"]


def test_pairs_without_id(spark):
    df = plays(spark, ROWS)
    pairs = ratings.plays_by_pair(df)
    users = ids.dense_ids(df.filter("user_id != 'uc'"), "user_id", "user")
    artists = ids.dense_ids(df, "artist_id", "item")
    assert ratings.rating_triples(pairs, users, artists).count() == 2
    assert {r.artist_id for r in ratings.unrated_pairs(pairs, users, artists).collect()} == {"a2", "a3"}


def test_split_is_a_partition_and_repeatable(spark):
    triples = spark.range(20000).selectExpr("cast(id % 500 as int) user", "cast(id div 500 as int) item",
                                            "1 plays")
    split = ratings.assign_split(triples)
    other = ratings.assign_split(triples.repartition(7, "item"))
    assert split.exceptAll(other).count() == 0
    sizes = {r.split: r.n for r in ratings.split_sizes(split).collect()}
    assert sum(sizes.values()) == 20000
    for part, share in enumerate((0.6, 0.2, 0.2)):
        assert abs(sizes[part] / 20000 - share) < 0.02
    reseeded = {r.split: r.n for r in ratings.split_sizes(ratings.assign_split(triples, seed=9)).collect()}
    assert reseeded.keys() == sizes.keys()
    for row in split.limit(50).collect():
        bucket = (row.user * 2654435761 + row.item * 40503) % 1000003 % 1000
        assert row.split == (bucket >= 600) + (bucket >= 800)


def test_random_split(spark):
    parts = ratings.random_split(spark.range(3000))
    assert sum(p.count() for p in parts) == 3000 and len(parts) == 3
