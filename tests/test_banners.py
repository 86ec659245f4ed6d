import random

import pytest
from playlens.operators.banners import match_banners, match_many_banners
from playlens.session import session_conf

BANNERS = [(18, 25, "M", "A"), (25, 40, "M", "B"), (20, 30, "M", "C"), (None, None, "M", "N"),
           (18, None, "M", "X"), (18, 25, "m", "Y"), (18, 25, "M", "A"), (30, 50, "", "E")]
BANNER_DDL = "min_age int, max_age int, gender string, banner string"
USER_DDL = "user_id string, gender string, age int"


def matches(spark, users, banners=BANNERS, match=match_banners):
    df = match(spark.createDataFrame(users, USER_DDL), spark.createDataFrame(banners, BANNER_DDL))
    return {row.user_id: row.banner for row in df.collect()}


BOTH = pytest.mark.parametrize("match", [match_banners, match_many_banners])


@BOTH
def test_edges(spark, match):
    users = [("18", "m", 18), ("19", "m", 19), ("22", "M", 22), ("25", "m", 25), ("26", "m", 26),
             ("40", "m", 40), ("41", "m", 41), ("none", "m", None), ("f", "f", 22), ("", "", 40),
             ("null", None, 40), ("fnone", "f", None)]
    assert matches(spark, users, match=match) == {
        "18": "", "19": "A", "22": "AC", "25": "AC", "26": "BC", "40": "B", "41": "", "none": "N",
        "f": "", "": "E", "null": "E", "fnone": ""}


def brute_force(users, banners):
    answer = {}
    for user, gender, age in users:
        hits = {text for low, high, wanted, text in banners if wanted == gender.upper() and (
            (age is None and low is None and high is None)
            or (None not in (age, low, high) and low < age <= high))}
        answer[user] = "".join(sorted(hits))
    return answer


@BOTH
def test_brute_force(spark, match):
    rng = random.Random(1)
    bound = lambda: rng.choice([None, *range(0, 60, 5)])
    banners = [(bound(), bound(), rng.choice("MF"), rng.choice("ABCDEFG")) for _ in range(40)]
    users = [(str(i), rng.choice("mfMF"), rng.choice([None, *range(60)])) for i in range(400)]
    assert matches(spark, users, banners, match) == brute_force(users, banners)
    assert matches(spark, users, banners[:0], match) == {user: "" for user, _, _ in users}


def test_users_are_not_shuffled(spark, capsys):
    users = spark.range(1000).selectExpr("cast(id as string) user_id", "'m' gender", "cast(id % 90 as int) age")
    match_banners(users, spark.createDataFrame(BANNERS, BANNER_DDL)).explain()
    assert "Exchange hashpartitioning" not in capsys.readouterr().out


def test_texts_of_many_banners_are_made_once_and_the_longest_come_first(spark):
    """The text alone is read, as it was made for the kind, and no text follows a shorter one in a task of a sorting join."""
    users = spark.range(600).selectExpr("cast(id as string) user_id", "if(id % 2 = 0, 'm', 'f') gender", "cast(id % 50 as int) age")
    banners = spark.range(300).selectExpr(
        "cast(id % 40 as int) min_age", "cast(id % 40 + id % 7 as int) max_age", "if(id % 3 = 0, 'F', 'M') gender", "concat('P', id) banner")
    expected = {r.user_id: r.banner for r in match_banners(users, banners).collect()}
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        texts = match_many_banners(users, banners).select("user_id", "banner")
        plan = texts._jdf.queryExecution().executedPlan().toString()
        tasks = texts.rdd.glom().collect()
    assert "array_join" not in plan and "banners#" not in plan
    assert {r.user_id: r.banner for rows in tasks for r in rows} == expected
    assert "" in expected.values() and any(len(rows) > 1 for rows in tasks)
    for rows in tasks:
        lengths = [len(r.banner) for r in rows]
        assert lengths == sorted(lengths, reverse=True)
