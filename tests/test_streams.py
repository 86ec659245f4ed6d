"""Streams over files: equal to the batch result, also when stopped and started again."""

import random

import pytest
from playlens.operators import counting
from playlens.sources import topics
from playlens.streaming import archive, counter, replay, suggest
from pyspark.sql import functions as F

LINE = "{}\t2009-05-04T23:08:57Z\t{}\tName\tt\tTrack"


class Topic:
    """A folder of wire files that grows, and a stream over it."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path, self.tmp_path = spark, str(tmp_path / "topic"), tmp_path
        self.append([])

    def append(self, texts):
        rows = [(None, bytearray(text.encode())) for text in texts]
        df = self.spark.createDataFrame(rows, "key binary, value binary")
        df.coalesce(1).write.mode("append").parquet(self.path)

    def play(self, *users, artist="a1"):
        self.append([LINE.format(user, artist) + "\t" for user in users])

    def read(self):
        return topics.read_wire_files(self.spark, self.path, max_files=1)

    def run(self, writer, checkpoint="c"):
        query = topics.start(self.spark, writer, str(self.tmp_path / checkpoint), available_now=True)
        query.awaitTermination()
        return query


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


def table(spark, *users):
    return spark.createDataFrame([(u, f"B{u}") for u in users], "user_id string, banner string")


def count(topic, users, every=10, generation=0):
    out = str(topic.tmp_path / "messages")
    stream = counter.banner_stream(topic.read(), users, every, generation)
    query = topic.run(topics.batch_writer(stream, topics.files_by_batch(out), mode="update"))
    rows = topic.spark.read.schema(stream.schema).parquet(out)
    return query, sorted((r.user_id, r.play_no) for r in rows.collect())


def test_counter_over_restarts_equals_batch(topic, spark):
    """A third of the events are those of one user, and some batches cross several multiples."""
    rng = random.Random(5)
    users = table(spark, "hot", *map(str, range(20)))
    seen = {}
    for stop in range(3):
        for _ in range(2):
            batch = ["hot" if rng.random() < 0.33 else str(rng.randrange(25)) for _ in range(400)]
            for user in batch:
                seen[user] = seen.get(user, 0) + 1
            topic.play(*batch)
        _, found = count(topic, users)
        counts = spark.createDataFrame(list(seen.items()), "user_id string, n bigint")
        expected = counting.banners_due(counts, users)
        assert found == sorted((r.user_id, r.play_no) for r in expected.collect()), stop
    assert sum(user == "hot" for user, _ in found) == seen["hot"] // 10


@pytest.mark.parametrize("plays,messages", [(9, 0), (10, 1), (20, 2), (21, 2)])
def test_number_of_messages(topic, spark, plays, messages):
    topic.play(*["u"] * plays)
    _, found = count(topic, table(spark, "u"))
    assert len(found) == messages


def test_message_and_key(topic, spark):
    topic.play("u", "u")
    count(topic, table(spark, "u"), every=2)
    row = spark.read.parquet(str(topic.tmp_path / "messages")).first()
    assert (row.message, row.value, row.key) == ("Usuario: u. Banner: Bu", "Usuario: u. Banner: Bu", "u:2")


def test_payloads_without_text_and_unknown_users(topic, spark):
    topic.append(["", "\n\n", "\nu\tx", "  ", "\t\t", "u\tonly", "x\ty"])
    query, found = count(topic, table(spark, "u"), every=1)
    assert found == [("u", 1)]
    events = [p.observedMetrics[counter.EVENTS_METRIC].events for p in query.recentProgress if p.numInputRows]
    assert sum(events) == 4
    out = str(topic.tmp_path / "rejects")
    topic.run(topics.file_writer(counter.reject_stream(topic.read(), table(spark, "u")), out), "c2")
    assert sorted((r.user_id, r.n) for r in spark.read.parquet(out).collect()) == [("", 1), ("  ", 1), ("x", 1)]


def test_broken_bytes_do_not_stop_the_stream(topic, spark):
    broken = [(None, bytearray(b"u\tx\xff\xfe")), (None, bytearray(b"\xff\tx")), (None, None)]
    spark.createDataFrame(broken, "key binary, value binary").write.mode("append").parquet(topic.path)
    assert count(topic, table(spark, "u"), every=1)[1] == [("u", 1)]


def test_unknown_user_is_counted_from_when_known(topic, spark):
    topic.play(*["u"] * 3)
    assert count(topic, table(spark, "other"), every=2)[1] == []
    topic.play("u")
    assert count(topic, table(spark, "other", "u"), every=2)[1] == []
    topic.play("u")
    assert count(topic, table(spark, "other", "u"), every=2)[1] == [("u", 2)]


def test_clock_that_goes_back_stops_the_stream(topic, spark):
    users = table(spark, "u")
    topic.play(*["u"] * 5)
    count(topic, users, every=3, generation=1)
    topic.play(*["u"] * 2)
    with pytest.raises(Exception, match="higher generation"):
        count(topic, users, every=3, generation=0)
    assert count(topic, users, every=3, generation=2)[1] == [("u", 3), ("u", 6)]


def test_plays_are_summed_before_they_are_shuffled(topic, spark):
    topic.play(*["u"] * 500, *["v"] * 20)
    wire = spark.read.parquet(topic.path)
    partial = counter.partial_counts(wire.select(F.lit("u").alias("user_id")))
    assert [r.n for r in partial.collect()] == [520]


def test_batch_counts_have_one_row_per_user(spark, topic):
    users = spark.range(300_000, numPartitions=6).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 120000 as string)) user_id")
    found = counter.batch_counts(users)
    expected = users.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    assert found.count() == expected.count()
    assert found.exceptAll(expected).count() == 0


def test_archive_keeps_every_payload(topic, spark):
    topic.play("u", "v")
    topic.append(["broken", "\t"])
    for fmt in ("text", "parquet"):
        out = str(topic.tmp_path / fmt)
        topic.run(archive.archive_writer(topic.read(), out, fmt), "c" + fmt)
        archived = spark.read.format(fmt).load(out)
        assert "arrival_date" in archived.columns
        values = [r.value if fmt == "text" else bytes(r.value).decode() for r in archived.collect()]
        assert sorted(values) == sorted([LINE.format("u", "a1") + "\t", LINE.format("v", "a1") + "\t", "broken", "\t"])


def test_archive_keeps_keys_and_bytes_that_are_no_text(topic, spark):
    import glob

    spark.createDataFrame([(bytearray(b"k\xff"), bytearray(b"v\xfe\xff"))], "key binary, value binary").write.parquet(
        str(topic.tmp_path / "bytes"))
    stream = topics.read_wire_files(spark, str(topic.tmp_path / "bytes"))
    kept, text = str(topic.tmp_path / "kept"), str(topic.tmp_path / "text")
    topic.run(archive.archive_writer(stream, kept, "parquet"), "c1")
    row = spark.read.parquet(kept).first()
    assert (bytes(row.key), bytes(row.value)) == (b"k\xff", b"v\xfe\xff")
    topic.run(archive.archive_writer(stream, text, "text"), "c2")
    (file,) = glob.glob(f"{text}/*/part-*")
    assert open(file, "rb").read() == b"v\xfe\xff\n"


def test_replay(topic, spark, tmp_path):
    for name, text in (("1", "u\tts\ta\tn\tt\tT"), ("2", "short\tline"), ("3", "v\tts\ta\tn\t\t")):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(str(tmp_path / "in"))
    stream = replay.replay_files(spark, str(tmp_path / "in"))
    topic.run(topics.file_writer(stream, str(tmp_path / "out")))
    wire = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((bytes(r.key), bytes(r.value)) for r in wire.collect()) == [
        (b"u\t", b"u\tts\ta\tn\tt\tT\t"), (b"v\t", b"v\tts\ta\tn\t\t\t")]


CATALOGUE = [("a1", 0, "One"), ("a1", 0, "Uno"), ("a2", 1, None), ("a3", 2, "Three")]


def scorer(spark):
    """Scores by item, for user 7 the other way round."""
    scores = spark.createDataFrame([(0, 0.1), (1, 0.9), (2, 0.5)], "item int, s double")
    sign = F.when(F.col("user") == 7, -1).otherwise(1)
    return lambda pairs: pairs.join(scores, "item").select("user", "item", (sign * F.col("s")).alias("prediction"))


def suggestions(topic, spark, **settings):
    catalogue = spark.createDataFrame(CATALOGUE, "artist_id string, item bigint, artist_name string")
    out = str(topic.tmp_path / "suggested")
    topic.run(suggest.suggestion_writer(topic.read(), catalogue, scorer(spark), topics.files_by_batch(out), **settings))
    rows = spark.read.parquet(out).orderBy("batch_id").collect()
    return [(r.user, r.item, r.message) for r in rows]


def test_one_recommendation_per_batch(topic, spark):
    topic.play(*["u"] * 30, artist="a1")
    topic.append([LINE.format("u", a) for a in ("a1", "a2", "a3", "none")] + ["", "short"])
    topic.play("u", artist="none")
    topic.append([LINE.format("u", a) for a in ("a3", "a1")])
    assert suggestions(topic, spark) == [
        (0, 0, "GRUPO RECOMENDADO >>>>> One"),
        (0, 1, "GRUPO RECOMENDADO >>>>> 1"),
        (0, 2, "GRUPO RECOMENDADO >>>>> Three"),
    ]


def test_recommendation_for_the_user_of_the_event(topic, spark):
    topic.append([LINE.format("u7", a) for a in ("a3", "a1")] + [LINE.format("none", "a2")])
    users = spark.createDataFrame([("u7", 7)], "user_id string, user bigint")
    assert suggestions(topic, spark, user_ids=users) == [(7, 0, "GRUPO RECOMENDADO >>>>> One")]


def test_artists_without_number(topic, spark):
    topic.append([LINE.format("u", a) for a in ("a1", "x", "x")])
    catalogue = spark.createDataFrame(CATALOGUE, "artist_id string, item bigint, artist_name string")
    missing = suggest.unlisted_artists(suggest.played(spark.read.parquet(topic.path)), catalogue)
    assert [tuple(r) for r in missing.collect()] == [("x", 2)]
    out = str(topic.tmp_path / "unlisted")
    assert suggestions(topic, spark, rejects=topics.files_by_batch(out)) == [(0, 0, "GRUPO RECOMENDADO >>>>> One")]
    assert [(r.artist_id, r.n) for r in spark.read.parquet(out).collect()] == [("x", 2)]


class Recorder:
    """Takes the place of a reader or writer and keeps what it is told."""

    def __init__(self):
        self.options, self.calls = {}, []

    def option(self, key, value):
        self.options[key] = value
        return self

    def __getattr__(self, name):
        if name in ("readStream", "writeStream", "read", "write"):
            return self

        def call(*args, **settings):
            self.calls.append((name, *args))
            self.options.update(settings)
            return self

        return call


def test_topic_settings():
    source = Recorder()
    topics.read_topics(source, "h:1", ["in1", "in2"], "earliest", 99, 500)
    assert source.options == {"kafka.bootstrap.servers": "h:1", "subscribe": "in1,in2",
                              "startingOffsets": "earliest", "startingTimestamp": 99, "maxOffsetsPerTrigger": 500}
    assert ("format", "kafka") in source.calls and ("select", "key", "value") in source.calls
    sink = Recorder()
    topics.topic_writer(sink, "h:1", "out", mode="update")
    assert sink.options == {"kafka.bootstrap.servers": "h:1", "topic": "out"}
    assert ("outputMode", "update") in sink.calls
    batch = Recorder()
    topics.write_topic(batch, "h:1", "out")
    assert batch.calls == [("format", "kafka"), ("save",)]


def test_trigger_interval(topic, spark):
    topic.play("u")
    writer = topics.file_writer(topic.read(), str(topic.tmp_path / "copy"))
    query = topics.start(spark, writer, str(topic.tmp_path / "c"), name="copy", interval="100 milliseconds")
    try:
        query.processAllAvailable()
        assert query.name == "copy" and query.isActive
    finally:
        query.stop()
    assert spark.read.parquet(str(topic.tmp_path / "copy")).count() == 1
