import random

import pytest
from playlens.operators import counting
from playlens.operators.ids import numbered_in_order
from pyspark.sql import functions as F


def test_messages_at_every_tenth_play(spark):
    counts = spark.createDataFrame([("a", 9), ("b", 10), ("c", 20), ("d", 21), ("x", 50)],
                                   "user_id string, n bigint")
    users = spark.createDataFrame([(u, u.upper()) for u in "abcd"], "user_id string, banner string")
    due = counting.banners_due(counts, users)
    assert sorted((r.user_id, r.play_no) for r in due.collect()) == [
        ("b", 10), ("c", 10), ("c", 20), ("d", 10), ("d", 20)]
    assert due.filter("user_id = 'b'").first().message == "Usuario: b. Banner: B"
    assert [tuple(r) for r in counting.unknown_users(counts, users).collect()] == [("x", 50)]


@pytest.mark.parametrize("chunk", [1, 3, 100_000])
@pytest.mark.parametrize("spread", [False, True])
def test_crossings_in_chunks(spark, monkeypatch, chunk, spread):
    monkeypatch.setattr(counting, "CHUNK", chunk)
    rng = random.Random(chunk)
    rows = [(str(i), rng.randrange(200), rng.randrange(200)) for i in range(60)]
    counts = spark.createDataFrame(rows, "user_id string, lo bigint, hi bigint")
    found = counting.crossings(counts, F.col("lo"), F.col("hi"), 10, spread)
    assert sorted((r.user_id, r.play_no) for r in found.collect()) == sorted(
        (u, n) for u, lo, hi in rows for n in range(lo + 1, hi + 1) if n % 10 == 0)


def events(spark, n=3000):
    """A third of the events belong to one user, and a third of those share one time."""
    rng = random.Random(n)
    rows = []
    for i in range(n):
        user = "hot" if rng.random() < 0.33 else str(rng.randrange(40))
        ts = 7 if user == "hot" and rng.random() < 0.33 else rng.randrange(10_000)
        rows.append((i, ts, user))
    return spark.createDataFrame(rows, "event_id bigint, ts bigint, user_id string"), rows


@pytest.mark.parametrize("hot_events", [50, 80, 200, 10**6])
def test_numbering(spark, hot_events):
    df, rows = events(spark)
    expected, seen = set(), {}
    for event_id, ts, user in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        seen[user] = seen.get(user, 0) + 1
        expected.add((event_id, user, seen[user]))
    numbered = counting.number_plays(df, ["ts", "event_id"], hot_events)
    assert numbered.columns == ["event_id", "ts", "user_id", "play_no"]
    assert {(r.event_id, r.user_id, r.play_no) for r in numbered.collect()} == expected
    assert numbered.count() == len(rows)
    tenth = {(r.event_id, r.play_no) for r in counting.every_nth(numbered).collect()}
    assert tenth == {(e, p) for e, _, p in expected if p % 10 == 0}


def test_ranges_do_not_grow_with_the_users(spark, monkeypatch):
    made = []
    monkeypatch.setattr(counting, "numbered_in_order",
                        lambda df, order, n, label: made.append(n) or numbered_in_order(df, order, n, label))
    df, rows = events(spark)
    assert counting.number_plays(df, ["ts", "event_id"], 20).count() == len(rows)
    monkeypatch.setattr(counting, "HOT_EVENTS", 500)
    counting.number_plays(df, ["ts", "event_id"], 20)
    # As many as shuffle partitions; more where a range would hold more than HOT_EVENTS rows.
    assert made == [4, 6]


def test_counts_since(spark):
    df, rows = events(spark)
    later = counting.since(df, F.lit(5000))
    counts = {r.user_id: r.n for r in counting.event_counts(later).collect()}
    assert counts["hot"] == sum(u == "hot" and ts >= 5000 for _, ts, u in rows)
