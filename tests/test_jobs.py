"""Whole jobs over small files."""

import glob
import os
import random

import pytest
from playlens import __main__ as cli
from playlens.plans import jobs
from playlens.sources import lines as readers
from playlens.session import session_conf
from playlens.sources import relational, storage, topics, user_table
from playlens.streaming import counter
from playlens.streaming import replay as encode
from pyspark.sql import functions as F


@pytest.fixture
def save(lines, tmp_path):
    def write(name, *texts):
        path = str(tmp_path / name)
        lines(*texts).coalesce(1).write.text(path)
        return path

    return write


@pytest.fixture
def plays_path(save):
    rng = random.Random(2)
    return save("plays", *[f"u{rng.randrange(25)}→a{rng.randrange(15)}→Name→{rng.randrange(1, 50)}"
                           for _ in range(400)], "bad", "u1→a1→Name→x")


def test_users_to_messages(spark, lines, save, tmp_path):
    table = str(tmp_path / "table")
    users = save("users", "u1→m→22→Japan→x", "u2→f→→Peru→x", "u3→f→30→Chile→", "u6→m→abc→Spain→x")
    banners = save("banners", "18→25→M→A", "20→30→M→C", "→→F→N", "bad")
    out = str(tmp_path / "clean")
    stamp = jobs.prepare_users(spark, users, banners, out, table, buckets=4)
    jobs.prepare_users(spark, users, banners, out, table, load_ts=stamp + 1, buckets=4)
    assert sorted(tuple(r) for r in user_table.current_users(spark, table).collect()) == [
        ("u1", "AC", 0), ("u2", "N", 0)]
    assert spark.read.parquet(f"{out}/user_rejects").filter(f"load_ts = {stamp}").count() == 2
    assert spark.read.parquet(f"{out}/banner_rejects").count() == 2

    assert len(user_table.snapshots(spark, table)) == 2
    events = save("events", *["u1→ts→a→n→t→T"] * 4, *["zz→ts→a→n→t→T"] * 4, "short→line")
    wire, checkpoint = str(tmp_path / "wire"), str(tmp_path / "c")
    jobs.replay(spark, events, checkpoint + "1", out=wire, available_now=True).awaitTermination()
    sink = topics.files_by_batch(str(tmp_path / "messages"))
    stream = topics.read_wire_files(spark, wire)
    jobs.check_events(spark, stream, table, checkpoint + "2", sink=sink, available_now=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "messages")).count() == 0
    for _ in range(3):
        lines(*["u1→ts→a→n→t→T"] * 4, *["zz→ts→a→n→t→T"] * 4).write.mode("append").text(events)
    jobs.replay(spark, events, checkpoint + "1", out=wire, available_now=True).awaitTermination()
    jobs.check_events(spark, stream, table, checkpoint + "2", sink=sink, available_now=True).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "messages")).collect()
    assert [r.message for r in found] == ["Usuario: u1. Banner: AC"]

    found = counter.plays_in_state(spark, jobs.counter_checkpoint(checkpoint + "2"))
    assert [tuple(r) for r in found.collect()] == [("u1", 16)]
    jobs.present_plays(spark, checkpoint + "2", str(tmp_path / "present"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "present")).collect()] == [("u1", 16)]

    left_out = str(tmp_path / "left-out")
    jobs.reject_events(spark, stream, table, left_out, checkpoint + "4", available_now=True).awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(left_out).groupBy("user_id").sum("n").collect()} == {("zz", 16)}

    kept = str(tmp_path / "kept")
    jobs.archive_topic(spark, stream, kept, checkpoint + "3", available_now=True).awaitTermination()
    assert spark.read.text(kept).count() == 32

    totals = str(tmp_path / "totals")
    jobs.count_plays(spark, stream, table, totals, checkpoint + "5", available_now=True).awaitTermination()
    assert [tuple(r) for r in counter.latest_plays(spark.read.parquet(totals)).collect()] == [("u1", 16)]


def test_micro_batch_takes_the_user_table_as_it_lies(spark, save, tmp_path, capsys):
    """Only the users of the micro-batch are shuffled: the base is read by buckets, in their order."""
    table, out = str(tmp_path / "table"), str(tmp_path / "clean")
    jobs.prepare_users(spark, save("users", "u1→m→22→Japan→x"), save("banners", "18→25→M→A"), out, table, buckets=4)
    ids = spark.range(12).selectExpr("cast(id as string) user_id").groupBy("user_id").count()
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                              "spark.sql.shuffle.partitions": "4",
                              "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}):
        user_table.find_users(spark, table, ids).explain()
    plan = capsys.readouterr().out
    side = plan[plan.index("SortMergeJoin"):]
    table_side = side[side.rindex("FileScan parquet"):]
    assert "Bucketed: true" in table_side
    before = side[:side.rindex("FileScan parquet")].rstrip().splitlines()
    assert not any("Exchange" in line for line in before[-3:])
    assert plan.count("Exchange hashpartitioning") == 1


def test_loads_under_a_running_stream(spark, lines, tmp_path):
    """Five loads and merges between micro-batches: each takes effect, and none stops the streams or deletes what they read."""
    table, wire, messages, rejects = (str(tmp_path / name) for name in ("table", "wire", "messages", "rejects"))
    storage.make_folder(spark, wire)
    stream = topics.read_wire_files(spark, wire)
    running = jobs.check_events(spark, stream, table, str(tmp_path / "c"), sink=topics.files_by_batch(messages),
                                rejects=rejects, every=4, interval="0 seconds")
    try:
        for turn in range(5):
            load = spark.createDataFrame([(f"u{turn}", f"B{turn}"), ("u0", f"B{turn}")], "user_id string, banner string")
            user_table.upsert_users(spark, table, load.dropDuplicates(["user_id"]), turn + 1, buckets=4, keep=1, most_deltas=2)
            encode.encode_lines(lines(*[f"u{k}→ts→a→n→t→T" for k in range(5) for _ in range(2)])).write.mode("append").parquet(wire)
            running.processAllAvailable()
        assert running.landing.isActive and running.counting.isActive
        one = counter.plays_in_state(spark, jobs.counter_checkpoint(str(tmp_path / "c")), F.lit("u1"))
        assert [tuple(r) for r in one.collect()] == [("u1", 8)]
    finally:
        running.stop()
    counted = counter.plays_in_state(spark, jobs.counter_checkpoint(str(tmp_path / "c")))
    assert sorted(tuple(r) for r in counted.collect()) == [("u0", 10), ("u1", 8), ("u2", 6), ("u3", 4), ("u4", 2)]
    found = spark.read.parquet(messages).collect()
    assert sorted((r.user_id, r.play_no, r.banner) for r in found) == [
        ("u0", 4, "B1"), ("u0", 8, "B3"), ("u1", 4, "B1"), ("u1", 8, "B1"), ("u2", 4, "B2"), ("u3", 4, "B3")]
    left = spark.read.parquet(rejects).groupBy("user_id").sum("n").collect()
    assert sorted(tuple(r) for r in left) == [("u1", 2), ("u2", 4), ("u3", 6), ("u4", 8)]
    # The last micro-batch again, as after a crash before its end was noted: nothing is counted twice.
    last = max(glob.glob(str(tmp_path / "c" / "landing" / "commits" / "[0-9]*")), key=lambda p: int(p.rpartition("/")[2]))
    for path in (last, last.replace("commits/", "commits/.") + ".crc"):
        os.remove(path)
    jobs.check_events(spark, stream, table, str(tmp_path / "c"), sink=topics.files_by_batch(messages), rejects=rejects,
                      every=4, available_now=True).awaitTermination()
    counted = counter.plays_in_state(spark, jobs.counter_checkpoint(str(tmp_path / "c")))
    assert sorted(tuple(r) for r in counted.collect()) == [("u0", 10), ("u1", 8), ("u2", 6), ("u3", 4), ("u4", 2)]


def test_imported_users(spark, save, tmp_path):
    table, path = str(tmp_path / "t"), str(tmp_path / "imported")
    spark.sql("SELECT 1 id, 'm' gender, 22 age, 'Japan' since, 'x' note").write.parquet(path)
    banners = save("banners", "18→25→M→A")
    jobs.prepare_users(spark, path, banners, str(tmp_path / "clean"), table, imported=True, buckets=2)
    assert [tuple(r) for r in user_table.current_users(spark, table).collect()] == [("1", "A", 0)]


def test_map_ids(spark, plays_path, tmp_path, capsys):
    out = str(tmp_path / "maps")
    jobs.map_ids(spark, plays_path, out)
    users = readers.read_id_map(spark, f"{out}/users").collect()
    assert sorted(r.rank for r in users) == list(range(1, 26))
    assert "rank" in capsys.readouterr().out
    assert {r.reason for r in spark.read.parquet(f"{out}/rejects").collect()} == {
        "fewer than 4 fields", "plays is not a whole number"}
    with pytest.raises(Exception, match="exist"):
        jobs.map_ids(spark, plays_path, out)
    jobs.map_ids(spark, plays_path, out, mode="overwrite")


def test_rows_and_rejects_are_all_lines(spark, plays_path):
    parsed = readers.read_play_counts(spark, plays_path)
    once = readers.landed(parsed, "plays")
    assert once.rows.count() + once.rejects.count() == spark.read.text(plays_path).count() == 402
    assert sorted(once.rows.collect()) == sorted(parsed.rows.collect())
    assert sorted(once.rejects.collect()) == sorted(parsed.rejects.collect())


def test_find_users(spark, save, tmp_path):
    left = save("left", "1→m→20→Peru→2006", "2→f→→Peru→2006", "3")
    right = save("right", "x→m→20→Peru→2006", "y→m→20→Peru→2006", "z→f→→Peru→2006", "w→f→20")
    out = str(tmp_path / "found")
    count, first = jobs.find_users(spark, left, right, out, 2)
    assert count == 3
    assert spark.read.parquet(f"{out}/rejects_left").count() == 0
    assert [r.value for r in spark.read.parquet(f"{out}/rejects_right").collect()] == ["w\tf\t20"]
    assert [(r.a_id, r.b_id) for r in first.collect()] == [("1", "x"), ("1", "y")]


def test_tune(spark, plays_path, tmp_path):
    report = jobs.tune_model(spark, plays_path, str(tmp_path / "tuned"), ranks=(2, 3), iterations=(2,))
    assert report.tuned.results.count() == 2 and report.test_rmse > 0
    pairs = readers.read_play_counts(spark, plays_path).rows.select("user_id", "artist_id").distinct().count()
    assert sum(report.sizes.values()) == pairs
    assert readers.read_alias(spark, str(tmp_path / "tuned/user_alias"), "u", "n").count() == 25
    assert spark.read.parquet(str(tmp_path / "tuned/rejects")).count() == 2


@pytest.mark.parametrize("own_user", [False, True])
def test_train_and_suggest(spark, plays_path, save, tmp_path, own_user):
    trained, out = str(tmp_path / "trained"), str(tmp_path / "out")
    jobs.train_model(spark, plays_path, trained, rank=2, iterations=2)
    assert readers.read_catalogue(spark, f"{trained}/catalogue").count() == 15
    events = save("events", "u1→ts→a1→n→t→T", "u2→ts→a2→n→t→T", "u2→ts→none→n→t→T")
    wire = str(tmp_path / "wire")
    encode.encode_lines(spark.read.text(events)).write.parquet(wire)
    stream = topics.read_wire_files(spark, wire)
    jobs.suggest(spark, stream, trained, str(tmp_path / "c"), sink=topics.files_by_batch(out),
                 own_user=own_user, rejects=topics.files_by_batch(out + "-rejects"), available_now=True).awaitTermination()
    assert [tuple(r)[:2] for r in spark.read.parquet(out + "-rejects").collect()] == [("none", 1)]
    row = spark.read.parquet(out).collect()
    assert len(row) == 1 and row[0].message == "GRUPO RECOMENDADO >>>>> Name"


def test_command_line():
    args = cli.parser().parse_args(["tune-model", "--plays", "p", "--out", "o", "--parallelism", "3"])
    assert (args.job, args.plays, args.parallelism) == ("tune-model", "p", 3)
    args = cli.parser().parse_args(["check-events", "--servers", "h:1", "--location", "t", "--checkpoint", "c"])
    assert args.topics == "ineventos" and args.starting == "latest" and args.since == 0
    args = cli.parser().parse_args(["suggest", "--servers", "h:1", "--trained", "t", "--rejects", "r", "--checkpoint", "c",
                                    "--own-user", "yes"])
    assert args.own_user == "yes" and args.rejects == "r"
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["map-ids", "--plays", "p"])


class Reader:
    """Records how a table is read; there is no database behind it."""

    def __init__(self, bounds):
        self.settings, self.bounds = {}, bounds

    def format(self, name):
        return self

    load = lambda self: self
    first = lambda self: self.bounds

    def options(self, **settings):
        self.settings.update(settings)
        return self


class Database:
    def __init__(self, bounds):
        self.bounds, self.readers = bounds, []

    @property
    def read(self):
        self.readers.append(Reader(self.bounds))
        return self.readers[-1]

    @property
    def reads(self):
        return [reader.settings for reader in self.readers]


def test_import_splits_on_the_key_range():
    db = Database((5, 104))
    relational.read_table(db, "jdbc:x", "customers", column="id", num_partitions=8, properties={"user": "u"})
    split, bounds = db.reads
    assert bounds["dbtable"] == "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM customers) bounds"
    assert split == {"url": "jdbc:x", "dbtable": "customers", "fetchsize": "10000", "user": "u",
                     "partitionColumn": "id", "lowerBound": "5", "upperBound": "105", "numPartitions": "8"}


def test_import_without_key_or_rows_is_one_task():
    for db, settings in ((Database(None), {}), (Database((None, None)), {"column": "id", "num_partitions": 8})):
        relational.read_table(db, "jdbc:x", "customers", **settings)
        assert any("partitionColumn" not in read and read["dbtable"] == "customers" for read in db.reads)
