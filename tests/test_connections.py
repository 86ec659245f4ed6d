"""Rows over connections, progress as rows, and events that come again."""

import json
import os

import pytest
from playlens.sources import connections, storage, topics
from playlens.streaming import progress, replay
from pyspark.sql import Row

SCHEMA = "key binary, value binary"


class Recorder:
    """Connections that note what happens to them."""

    def __init__(self):
        self.notes, self.done = [], set()

    def connect(self, partition, epoch):
        recorder, rows = self, []

        class Connection:
            def send(self, row):
                rows.append(row.value)

            def commit(self):
                recorder.done.add((partition, epoch))
                recorder.notes.append(("commit", partition, epoch, *rows))

            def abort(self):
                recorder.notes.append(("abort", partition, epoch, *rows))

        return Connection()

    def committed(self, partition, epoch):
        return (partition, epoch) in self.done


def send(writer, partition, epoch, values, error=None):
    if writer.open(partition, epoch):
        for value in values:
            writer.process(Row(value=value))
    writer.close(error)


def test_one_commit_for_each_partition_and_epoch():
    recorder = Recorder()
    writer = connections.partition_writer(recorder.connect, recorder.committed)
    send(writer, 0, 1, ["a"], error=ValueError())
    send(writer, 0, 1, ["a", "b"])
    send(writer, 1, 1, [])
    send(writer, 0, 1, ["a", "b"])
    send(writer, 0, 2, ["c"])
    assert recorder.notes == [("abort", 0, 1, "a"), ("commit", 0, 1, "a", "b"), ("commit", 1, 1), ("commit", 0, 2, "c")]


def test_folder_connections(tmp_path):
    path = str(tmp_path / "out")
    connect, committed = connections.folder_connections(path)
    first, second = connect(3, 5), connect(3, 5)
    for connection in (first, second):
        connection.send(Row(value="é", n=1))
    assert not committed(3, 5)
    first.commit()
    second.commit()
    assert committed(3, 5) and not committed(3, 6)
    connect(3, 6).abort()
    assert os.listdir(path) == ["epoch-5-part-3.json"]
    assert json.loads((tmp_path / "out" / "epoch-5-part-3.json").read_text()) == {"value": "é", "n": 1}


def append(spark, path, *values):
    rows = [(None, bytearray(value.encode())) for value in values]
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(path)


def test_repeated_epoch_over_connections(spark, tmp_path):
    wire, out, checkpoint = (str(tmp_path / name) for name in ("wire", "out", "c"))
    append(spark, wire, "a", "b", "b")
    rows = topics.read_wire_files(spark, wire).selectExpr("cast(value as string) value")

    def run():
        writer = connections.connection_writer(rows, *connections.folder_connections(f"file://{out}"))
        topics.start(spark, writer, checkpoint, available_now=True).awaitTermination()
        return sorted(r.value for r in spark.read.schema("value string").json(out).collect())

    assert run() == ["a", "b", "b"]
    storage.delete(spark, f"{checkpoint}/commits/0")
    files = {name: os.stat(f"{out}/{name}").st_mtime_ns for name in os.listdir(out)}
    assert run() == ["a", "b", "b"]
    assert files == {name: os.stat(f"{out}/{name}").st_mtime_ns for name in os.listdir(out)}
    append(spark, wire, "c")
    assert run() == ["a", "b", "b", "c"]


def test_failing_connection_stops_the_stream_and_is_tried_again(spark, tmp_path):
    wire, out, checkpoint = (str(tmp_path / name) for name in ("wire", "out", "c"))
    append(spark, wire, "a", "b")
    rows = topics.read_wire_files(spark, wire).selectExpr("cast(value as string) value")
    connect, committed = connections.folder_connections(out)

    def broken(partition, epoch):
        connection = connect(partition, epoch)
        connection.commit = lambda: (_ for _ in ()).throw(OSError("connection lost"))
        return connection

    with pytest.raises(Exception, match="connection lost"):
        topics.start(spark, connections.connection_writer(rows, broken, committed), checkpoint, available_now=True).awaitTermination()
    topics.start(spark, connections.connection_writer(rows, connect, committed), checkpoint, available_now=True).awaitTermination()
    assert sorted(r.value for r in spark.read.schema("value string").json(out).collect()) == ["a", "b"]


def test_progress_of_a_run(spark, tmp_path):
    wire, path = str(tmp_path / "wire"), str(tmp_path / "progress")
    append(spark, wire, "a", "b", "c")
    log = progress.ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        rows = topics.read_wire_files(spark, wire, max_files=1)
        query = topics.start(spark, topics.file_writer(rows, str(tmp_path / "out")), str(tmp_path / "c"), name="x", available_now=True)
        query.awaitTermination()
        log.wait(str(query.runId))
    finally:
        spark.streams.removeListener(log)
    found = progress.read_progress(spark, path).where("query = 'x'").collect()
    assert sum(r.input_rows for r in found) == 3 and len({r.batch for r in found}) == len(found) >= 2
    assert {r.run for r in found} == {str(query.runId)}
    with pytest.raises(TimeoutError):
        log.wait("no such run", 0.01)


def test_events_that_come_again(spark, tmp_path):
    """Within one micro-batch, in a later one, and after a restart; others with the same user stay."""
    wire, out, checkpoint = (str(tmp_path / name) for name in ("wire", "out", "c"))

    def run():
        once = replay.without_repeats(topics.read_wire_files(spark, wire, max_files=1), "1 hour")
        topics.start(spark, topics.file_writer(once, out), checkpoint, available_now=True).awaitTermination()
        return sorted(bytes(r.value).decode() for r in spark.read.schema(SCHEMA).parquet(out).collect())

    append(spark, wire, "u\t1", "u\t1", "u\t2")
    append(spark, wire, "u\t2", "v\t1")
    assert run() == ["u\t1", "u\t2", "v\t1"]
    append(spark, wire, "u\t1", "u\t3")
    assert run() == ["u\t1", "u\t2", "u\t3", "v\t1"]
