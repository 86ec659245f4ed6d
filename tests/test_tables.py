import os
import subprocess
import sys

import pytest
from playlens.sources import storage, user_table
from pyspark.sql import functions as F

LOAD = "user_id string, banner string"


@pytest.fixture
def location(tmp_path):
    return str(tmp_path / "users")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_loads(spark, location):
    assert user_table.latest(spark, location) is None
    assert user_table.current_users(spark, location).count() == 0
    user_table.upsert_users(spark, location, spark.createDataFrame([("a", "A"), ("b", "B")], LOAD), 10, buckets=2)
    load = spark.createDataFrame([("b", "C"), ("c", None), ("d", "1"), ("d", "2")], LOAD)
    user_table.upsert_users(spark, location, load, 11, order_by=F.col("banner"), buckets=2)
    assert user_table.latest(spark, location).load_ts == 11
    assert rows(user_table.current_users(spark, location).fillna("")) == [
        ("a", "A", 0), ("b", "C", 0), ("c", "", 0), ("d", "2", 0)]
    with pytest.raises(ValueError, match="not newer"):
        user_table.upsert_users(spark, location, spark.createDataFrame([], LOAD), 11)


def test_a_user_twice_needs_an_order(spark, location):
    load = spark.createDataFrame([("d", "1"), ("d", "2")], LOAD)
    with pytest.raises(Exception, match="twice"):
        user_table.upsert_users(spark, location, load, 1, buckets=2)
    assert user_table.latest(spark, location) is None  # what was begun has no marker


def load_one_by_one(spark, location, stamps, **settings):
    for stamp in stamps:
        user_table.upsert_users(spark, location, spark.createDataFrame([(str(stamp), "A")], LOAD), stamp, buckets=2, **settings)


def test_old_snapshots_go(spark, location):
    load_one_by_one(spark, location, range(1, 6), keep=2, keep_millis=0, most_deltas=1)
    assert [s.load_ts for s in user_table.snapshots(spark, location)] == [4, 5]
    assert [s.load_ts for s in user_table.deltas(spark, location)] == [5]
    assert [r[0] for r in rows(user_table.current_users(spark, location))] == list("12345")


def test_what_may_still_be_read_stays(spark, location):
    """A table bound before many loads and merges is read after them."""
    load_one_by_one(spark, location, [1, 2], most_deltas=100, delta_share=100.0)
    bound = user_table.current_users(spark, location)
    load_one_by_one(spark, location, range(3, 9), keep=1, most_deltas=1)
    assert [r[0] for r in rows(bound)] == ["1", "2"]
    assert len(user_table.snapshots(spark, location)) == 7
    user_table.expire(spark, location, keep=1, keep_millis=0)
    assert [s.load_ts for s in user_table.snapshots(spark, location)] == [8]
    assert [r[0] for r in rows(user_table.current_users(spark, location))] == list("12345678")


def test_a_load_writes_its_own_rows(spark, location):
    """Bytes follow the load, not the table; merging gives the same rows."""
    many = spark.range(200_000).selectExpr("cast(id as string) user_id", "concat('B', id) banner")
    user_table.upsert_users(spark, location, many, 1, buckets=4)
    whole = storage.size(spark, location)
    load = spark.range(0, 200_000, 1000).selectExpr("cast(id as string) user_id", "'new' banner")
    user_table.upsert_users(spark, location, load, 2, buckets=4)
    assert storage.size(spark, location) - whole < whole / 20
    assert len(user_table.snapshots(spark, location)) == len(user_table.deltas(spark, location)) == 1
    before = user_table.current_users(spark, location)
    assert before.where("banner = 'new'").count() == 200 and before.count() == 200_000
    expected = before.exceptAll(spark.createDataFrame([], user_table.COLUMNS))
    user_table.compact(spark, location)
    base, over = user_table.newest(spark, location)
    assert (base.load_ts, over) == (2, [])
    merged = user_table.current_users(spark, location)
    assert merged.exceptAll(expected).count() == expected.exceptAll(merged).count() == 0


def test_deltas_are_merged_by_share_and_number(spark, location):
    load_one_by_one(spark, location, range(1, 5), most_deltas=3, delta_share=100.0)
    assert [s.load_ts for s in user_table.snapshots(spark, location)] == [1, 4]
    load_one_by_one(spark, location, [5], most_deltas=100, delta_share=0.1)
    assert [s.load_ts for s in user_table.snapshots(spark, location)] == [1, 4, 5]


@pytest.mark.parametrize("settings", [{"most_deltas": 100, "delta_share": 100.0}, {"most_deltas": 1}])
def test_find_users(spark, location, settings):
    ids = spark.createDataFrame([("1", 5), ("2", 6), ("x", 7)], "user_id string, n int")
    assert rows(user_table.find_users(spark, location, ids).fillna("-")) == [
        ("1", 5, "-", False), ("2", 6, "-", False), ("x", 7, "-", False)]
    load_one_by_one(spark, location, [1, 2], **settings)
    user_table.upsert_users(spark, location, spark.createDataFrame([("1", "N"), ("3", None)], LOAD), 3, buckets=2, **settings)
    assert rows(user_table.find_users(spark, location, ids).fillna("-")) == [
        ("1", 5, "N", True), ("2", 6, "A", True), ("x", 7, "-", False)]


def test_replacing_a_folder(spark, tmp_path):
    path = str(tmp_path / "out" / "rows")
    frame = spark.range(3)
    storage.replace(spark, path, frame.write.parquet)
    with pytest.raises(ValueError):
        storage.replace(spark, path, lambda staged: (_ for _ in ()).throw(ValueError("broken")))
    assert spark.read.parquet(path).count() == 3
    storage.replace(spark, path, spark.range(5).write.parquet)
    assert spark.read.parquet(path).count() == 5
    # A program that ended between the two renames.
    storage.rename(spark, path, str(tmp_path / "out" / "_replaced-rows"))
    storage.recover(spark, path)
    assert spark.read.parquet(path).count() == 5 and storage.names(spark, str(tmp_path / "out")) == ["rows"]


def test_write_once(spark, tmp_path):
    path = str(tmp_path / "batch_id=3")
    storage.write_once(spark.range(3), path)
    storage.write_once(spark.range(7), path)
    assert spark.read.parquet(path).count() == 3 and storage.names(spark, str(tmp_path)) == ["batch_id=3"]


PROGRAM = """
import sys
from playlens.session import build_session
from playlens.sources import storage, user_table
spark = build_session("loads", "local[2]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false")
user = sys.argv[2]
if user:
    load = spark.createDataFrame([(user, "A")], "user_id string, banner string")
    user_table.upsert_users(spark, sys.argv[1], load, int(sys.argv[3]), buckets=2)
print("FOUND", *sorted(r.user_id for r in user_table.current_users(spark, sys.argv[1]).collect()))
"""


def test_table_outlives_programs(location, tmp_path):
    def program(*args):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        done = subprocess.run([sys.executable, "-c", PROGRAM, location, *args], capture_output=True, text=True, timeout=300,
                              cwd=tmp_path, env=os.environ | {"PYTHONPATH": root})
        assert "FOUND" in done.stdout, done.stderr[-2000:]
        return done.stdout.split("FOUND")[1].split()

    assert program("u1", "1") == ["u1"]
    assert program("u2", "2") == ["u1", "u2"]
    assert program("") == ["u1", "u2"]


def test_merge_resets_loaded_counters_only(spark):
    current = spark.createDataFrame([("a", "A", 7), ("b", "B", 8)], "user_id string, banner string, plays bigint")
    merged = user_table.merge_users(current, spark.createDataFrame([("b", "N"), ("c", "N")], LOAD))
    assert rows(merged) == [("a", "A", 7), ("b", "N", 0), ("c", "N", 0)]


def test_lookup(spark):
    held = spark.createDataFrame([("a", "A", 7)], "user_id string, banner string, plays bigint")
    found = user_table.lookup_users(held, spark.createDataFrame([("a",), ("z",)], "user_id string"))
    assert sorted(found.collect(), key=str) == [("a", "A", 7), ("z", None, None)]


def test_bucketed_table_is_neither_shuffled_nor_sorted(spark, location, capsys):
    loaded = spark.range(100).selectExpr("cast(id as string) user_id", "'A' banner")
    user_table.upsert_users(spark, location, loaded, 1, buckets=4)
    events = spark.range(1000).selectExpr("cast(id % 150 as string) user_id")
    joined = events.join(user_table.current_users(spark, location).hint("merge"), "user_id")
    joined.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1
    assert joined.count() == 700
