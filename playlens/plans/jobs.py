"""The programs: each reads files or a topic, runs the operators and writes what others read.

==================  ==============================================================
job                 work
==================  ==============================================================
``prepare_users``   clean users, match banners, fill the user table
``map_ids``         number users and artists, write the maps
``find_users``      count users two profile files share, show the first pairs
``tune_model``      try recommender settings, report the errors, write the aliases
``train_model``     fit the final recommender, write the artist catalogue
``check_events``    stream: a banner message on every tenth play
``reject_events``   stream: the events it leaves out
``count_plays``     stream: the running total of each user
``present_plays``   the counters a stream holds now
``suggest``         stream: recommend the best artist of each micro-batch
``replay``          publish a file of events to a topic
``archive_topic``   keep the raw topic
``roll_archive``    pack its files into large ones
==================  ==============================================================
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playlens import constants
from playlens.operators import cohort, ids, ratings, recommend
from playlens.operators.banners import match_banners
from playlens.session import pin, session_conf
from playlens.sources import files, lines, topics, user_table
from playlens.streaming import archive, counter, replay as replay_stream, suggest as suggest_stream


def prepare_users(spark: SparkSession, users_path: str, banners_path: str, out: str,
                  location: str, load_ts: int | None = None, imported: bool = False,
                  buckets: int = user_table.BUCKETS, **loading) -> int:
    """Clean users and their banners under a run stamp, then into the user table at ``location``.

    ``imported`` users are the parquet of ``import_table``, others are text lines. Of several rows
    of a user the one registered last counts. ``loading``: settings of ``user_table.upsert_users``.
    """
    load_ts = files.now_millis() if load_ts is None else load_ts
    if imported:
        users = lines.users_of_table(spark.read.parquet(users_path))
    else:
        users = lines.read_users(spark, users_path)
    users = lines.landed(users, "users")
    banners = lines.read_banners(spark, banners_path)
    clean = files.write_stamped(users.rows, f"{out}/users", load_ts)
    files.write_stamped(users.rejects, f"{out}/user_rejects", load_ts)
    files.write_stamped(banners.rejects, f"{out}/banner_rejects", load_ts)
    # Read on from what was written: the text is not parsed again.
    matched = pin(match_banners(spark.read.schema(users.rows.schema).parquet(clean), banners.rows), "matched")
    files.write_stamped(matched.select("user_id", "banner"), f"{out}/user_banner", load_ts)
    user_table.upsert_users(
        spark, location, matched, load_ts, order_by=F.struct("date", "extra", "banner"), buckets=buckets,
        **loading)
    return load_ts


def _plays(spark: SparkSession, path: str, out: str, mode: str) -> DataFrame:
    """Play counts, read and parsed once; the lines left out go to ``out/rejects``."""
    parsed = lines.landed(lines.read_play_counts(spark, path), "plays")
    files.write_rejects(parsed.rejects, f"{out}/rejects", mode)
    return parsed.rows


def map_ids(spark: SparkSession, plays_path: str, out: str, mode: str = "error") -> None:
    """Maps of users and artists to 1, 2, ... as tab-separated text; prints ten of each."""
    plays = _plays(spark, plays_path, out, mode)
    for key, folder in (("user_id", "users"), ("artist_id", "artists")):
        ranks = ids.dense_ids(plays, key, "rank", start=1)
        ranks.orderBy("rank").show(10, truncate=False)
        files.write_id_map(ranks, f"{out}/{folder}", mode)


def find_users(spark: SparkSession, left_path: str, right_path: str, out: str, n: int = 50,
               mode: str = "error") -> tuple[int, DataFrame]:
    """Number of matching pairs, and the first ``n`` of them; lines left out go to ``out/rejects_…``."""
    sides = []
    for name, path in (("left", left_path), ("right", right_path)):
        parsed = lines.landed(lines.read_profiles(spark, path), f"profiles-{name}")
        files.write_rejects(parsed.rejects, f"{out}/rejects_{name}", mode)
        sides.append(parsed.rows)
    return cohort.count_matches(*sides).first()[0], cohort.first_matches(*sides, n)


class TuneReport(NamedTuple):
    tuned: recommend.Tuned
    sizes: dict[int, int]
    test_rmse: float


def tune_model(spark: SparkSession, plays_path: str, out: str, mode: str = "error",
               **settings) -> TuneReport:
    """Split the ratings, try the grid on the first two parts, judge the best on the third."""
    rated = ratings.rate(_plays(spark, plays_path, out, mode))
    files.write_alias(rated.user_ids, f"{out}/user_alias", mode)
    files.write_alias(rated.artist_ids, f"{out}/artist_alias", mode)
    split = pin(ratings.assign_split(rated.triples), "ratings", partition_by=("split",))
    training, validation, test = (
        split.filter(F.col("split") == part).drop("split") for part in range(3)
    )
    tuned = recommend.tune(training, validation, **settings)
    test_rmse = recommend.rmse(recommend.score(tuned.model, test)).first()["rmse"]
    sizes = {row["split"]: row["n"] for row in ratings.split_sizes(split).collect()}
    return TuneReport(tuned, sizes, test_rmse)


def train_model(spark: SparkSession, plays_path: str, out: str, mode: str = "error",
                **settings) -> recommend.ALSModel:
    """Final model in ``out/model``, catalogue in ``out/catalogue``, user ids in ``out/user_alias``."""
    plays = _plays(spark, plays_path, out, mode)
    rated = ratings.rate(plays)
    files.write_catalogue(ids.artist_catalogue(plays, rated.artist_ids), f"{out}/catalogue", mode)
    files.write_alias(rated.user_ids, f"{out}/user_alias", mode)
    model = recommend.train(pin(rated.triples, "ratings"), **settings)
    recommend.save_model(model, f"{out}/model")
    return model


class Following(NamedTuple):
    """A stream that lands plays of the users known at the time, and one that counts what has landed."""

    landing: StreamingQuery
    counting: StreamingQuery

    def processAllAvailable(self) -> None:
        self.landing.processAllAvailable()
        self.counting.processAllAvailable()

    def stop(self) -> None:
        self.landing.stop()
        self.counting.stop()

    def awaitTermination(self) -> None:
        """Wait for both; when one ends by an error, the other is stopped and the error raised."""
        try:
            while self.landing.isActive and self.counting.isActive:
                self.landing.awaitTermination(1)
            if not self.landing.isActive:
                self.landing.awaitTermination()
            self.counting.awaitTermination()
        finally:
            self.stop()


def _land(spark: SparkSession, wire: DataFrame, location: str, out: str, checkpoint: str,
          rejects: str | None = None, **starting) -> StreamingQuery:
    """Start the landing stream, with as many partitions as the user table has buckets: a micro-batch then reads the
    table as it lies, without a shuffle or sort."""
    last = user_table.latest(spark, location)
    settings = {
        "spark.sql.shuffle.partitions": str(last.buckets if last else user_table.BUCKETS),
        "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    }
    sink = counter.landing_sink(location, out, rejects)
    with session_conf(spark, settings):
        return topics.start(spark, topics.batch_writer(counter.event_users(wire), sink), checkpoint, **starting)


def _follow(spark: SparkSession, wire: DataFrame, location: str, checkpoint: str, writer, rejects: str | None = None,
            **starting) -> Following:
    """Land plays below ``checkpoint`` and count them; ``writer`` makes the counter's writer from what has landed."""
    landed = f"{checkpoint}/landed"
    landing = _land(spark, wire, location, landed, f"{checkpoint}/landing", rejects, **starting)
    if starting.get("available_now"):
        landing.awaitTermination()
    counting = topics.start(spark, writer(counter.read_landed(spark, landed)), counter_checkpoint(checkpoint), **starting)
    return Following(landing, counting)


def counter_checkpoint(checkpoint: str) -> str:
    """Where the counter of ``check_events`` or ``count_plays`` keeps its state, for ``counter.plays_in_state``."""
    return f"{checkpoint}/counting"


def count_plays(spark: SparkSession, wire: DataFrame, location: str, out: str, checkpoint: str,
                **starting) -> Following:
    """Running totals as (user_id, plays) files per micro-batch; ``counter.latest_plays`` reads them."""

    def writer(landed: DataFrame):
        return topics.batch_writer(counter.landed_plays_stream(landed), topics.files_by_batch(out), mode="update")

    return _follow(spark, wire, location, checkpoint, writer, **starting)


def check_events(spark: SparkSession, wire: DataFrame, location: str, checkpoint: str, *,
                 servers: str | None = None, sink: topics.Sink | None = None, rejects: str | None = None,
                 every: int = constants.PLAYS_PER_BANNER, once_within: str | None = None, **starting) -> Following:
    """Banner messages to the banner topic, or to ``sink``.

    Users are those of the newest load when a micro-batch is read: a load counts for the running
    stream. Plays of others are not counted and go to ``rejects`` as (user_id, n), if asked for.
    Events delivered again are counted again, unless their bytes came at most ``once_within`` ago.
    """
    if once_within:
        wire = replay_stream.without_repeats(wire, once_within)

    def writer(landed: DataFrame):
        messages = counter.landed_banner_stream(landed, every)
        if sink is None:
            return topics.topic_writer(messages.select("key", "value"), servers, constants.BANNER_TOPIC, mode="update")
        return topics.batch_writer(messages, sink, mode="update")

    return _follow(spark, wire, location, checkpoint, writer, rejects, **starting)


def reject_events(spark: SparkSession, wire: DataFrame, location: str, out: str, checkpoint: str,
                  **starting) -> StreamingQuery:
    """Events ``check_events`` leaves out, as (user_id, n) files; users are those of the newest load."""
    return _land(spark, wire, location, f"{checkpoint}/landed", f"{checkpoint}/landing", out, **starting)


def present_plays(spark: SparkSession, checkpoint: str, out: str, mode: str = "error") -> None:
    """The present counter of every user of a ``check_events`` or ``count_plays`` stream, as (user_id, plays)."""
    plays = counter.plays_in_state(spark, counter_checkpoint(checkpoint))
    files.put(plays, out, mode, lambda df, to, how: df.write.mode(how).parquet(to))


def suggest(spark: SparkSession, wire: DataFrame, trained: str, checkpoint: str, *,
            servers: str | None = None, sink: topics.Sink | None = None,
            own_user: bool = False, rejects: topics.Sink | None = None, **starting) -> StreamingQuery:
    """A recommendation per micro-batch to the recommendation topic, or to ``sink``.

    ``trained`` is the folder ``train_model`` wrote; ``own_user`` scores for the user of the
    event instead of the fixed user; ``rejects`` gets the artists that cannot be scored.
    """
    # Sorted by item, so that looking up one name reads a few row groups.
    catalogue = pin(lines.read_catalogue(spark, f"{trained}/catalogue").orderBy("item"), "catalogue")
    scorer = suggest_stream.model_scorer(recommend.load_model(f"{trained}/model"))
    user_ids = None
    if own_user:
        user_ids = pin(lines.read_alias(spark, f"{trained}/user_alias", "user_id", "user"), "user-ids")
    writer = suggest_stream.suggestion_writer(
        wire, catalogue, scorer, sink or suggest_stream.to_topic(servers), user_ids, rejects
    )
    return topics.start(spark, writer, checkpoint, **starting)


def replay(spark: SparkSession, path: str, checkpoint: str, *, servers: str | None = None,
           out: str | None = None, max_files: int = 1, **starting) -> StreamingQuery:
    """Events of text files to the event topic, or to parquet files in ``out``."""
    wire = replay_stream.replay_files(spark, path, max_files)
    writer = topics.file_writer(wire, out) if out else replay_stream.replay_writer(wire, servers)
    return topics.start(spark, writer, checkpoint, **starting)


def archive_topic(spark: SparkSession, wire: DataFrame, out: str, checkpoint: str,
                  fmt: str = "text", **starting) -> StreamingQuery:
    return topics.start(spark, archive.archive_writer(wire, out, fmt), checkpoint, **starting)


def roll_archive(spark: SparkSession, path: str, out: str, fmt: str = "text", target: int = constants.ROLL_BYTES,
                 final: bool = False) -> int:
    """Pack what ``archive_topic`` wrote to ``path`` into files of ``target`` bytes below ``out``, and delete what was packed
    a day ago or before; ``archive.read_archive`` reads both."""
    archive.drop_rolled(spark, path, out)
    return archive.roll(spark, path, out, fmt, target, final)
