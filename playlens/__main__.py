"""``python -m playlens <job> --name value ...`` runs a job; see ``playlens.plans.jobs``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from playlens import constants
from playlens.operators import recommend
from playlens.plans import jobs
from playlens.session import build_session, clear_scratch
from playlens.sources import files, relational, topics, user_table


def _topic(spark: SparkSession, args: argparse.Namespace):
    """The stream; ``--since`` (milliseconds) counts afresh from a time, on a new checkpoint."""
    return topics.read_topics(spark, args.servers, args.topics.split(","), args.starting, args.since or None)


def _import(spark: SparkSession, args: argparse.Namespace) -> None:
    relational.import_table(spark, args.url, args.table, args.out, files.now_millis(),
                            column=args.column, num_partitions=args.partitions)


def _find(spark: SparkSession, args: argparse.Namespace) -> None:
    count, first = jobs.find_users(spark, args.left, args.right, args.out, mode=args.mode)
    print("size:", count)
    first.show(50, truncate=False)


def _tune(spark: SparkSession, args: argparse.Namespace) -> None:
    report = jobs.tune_model(spark, args.plays, args.out, args.mode,
                             parallelism=args.parallelism, blocks=args.blocks)
    report.tuned.results.show(truncate=False)
    print(f"best: rank {report.tuned.rank}, iterations {report.tuned.iterations}, "
          f"validation RMSE {report.tuned.rmse}, test RMSE {report.test_rmse}")


def _prepare(spark: SparkSession, args: argparse.Namespace, imported: bool) -> None:
    jobs.prepare_users(spark, args.users, args.banners, args.out, args.location, imported=imported, buckets=args.buckets,
                       keep=args.keep, keep_millis=args.keep_hours * 3_600_000)


def _suggest(spark: SparkSession, args: argparse.Namespace) -> None:
    jobs.suggest(
        spark, _topic(spark, args), args.trained, args.checkpoint, servers=args.servers,
        own_user=args.own_user == "yes", rejects=topics.files_by_batch(args.rejects),
    ).awaitTermination()


TOPIC = ["servers", "checkpoint", f"topics={constants.EVENT_TOPIC}", "since:0"]
USERS = ["users", "banners", "out", "location", f"buckets:{user_table.BUCKETS}", f"keep:{user_table.KEPT}",
         f"keep-hours:{user_table.KEPT_MILLIS // 3_600_000}"]
BLOCKS = f"blocks:{recommend.BLOCKS}"

JOBS = {
    "import-table": (_import, ["url", "table", "out", "column=", "partitions:1"]),
    "prepare-users": (lambda spark, a: _prepare(spark, a, False), USERS),
    "prepare-imported-users": (lambda spark, a: _prepare(spark, a, True), USERS),
    "map-ids": (lambda spark, a: jobs.map_ids(spark, a.plays, a.out, a.mode), ["plays", "out", "mode=error"]),
    "find-users": (_find, ["left", "right", "out", "mode=error"]),
    "tune-model": (_tune, ["plays", "out", "mode=error", "parallelism:1", BLOCKS]),
    "train-model": (
        lambda spark, a: jobs.train_model(spark, a.plays, a.out, a.mode, blocks=a.blocks),
        ["plays", "out", "mode=error", BLOCKS],
    ),
    "check-events": (
        lambda spark, a: jobs.check_events(
            spark, _topic(spark, a), a.location, a.checkpoint, servers=a.servers, rejects=a.rejects,
            once_within=a.once_within
        ).awaitTermination(),
        [*TOPIC, "location", "rejects=", "once-within=", "starting=latest"],
    ),
    "present-plays": (
        lambda spark, a: jobs.present_plays(spark, a.checkpoint, a.out, a.mode), ["checkpoint", "out", "mode=error"]),
    "reject-events": (
        lambda spark, a: jobs.reject_events(
            spark, _topic(spark, a), a.location, a.out, a.checkpoint
        ).awaitTermination(),
        [*TOPIC, "location", "out", "starting=latest"],
    ),
    "count-plays": (
        lambda spark, a: jobs.count_plays(
            spark, _topic(spark, a), a.location, a.out, a.checkpoint
        ).awaitTermination(),
        [*TOPIC, "location", "out", "starting=latest"],
    ),
    "suggest": (_suggest, [*TOPIC, "trained", "rejects", "own-user=no", "starting=latest"]),
    "replay": (
        lambda spark, a: jobs.replay(
            spark, a.path, a.checkpoint, servers=a.servers, max_files=a.max_files
        ).awaitTermination(),
        ["path", "servers", "checkpoint", "max-files:1"],
    ),
    "archive-topic": (
        lambda spark, a: jobs.archive_topic(
            spark, _topic(spark, a), a.out, a.checkpoint, a.format
        ).awaitTermination(),
        [*TOPIC, "out", "format=text", "starting=earliest"],
    ),
    "roll-archive": (
        lambda spark, a: print("files:", jobs.roll_archive(spark, a.path, a.out, a.format, a.bytes, a.final == "yes")),
        ["path", "out", "format=text", f"bytes:{constants.ROLL_BYTES}", "final=no"],
    ),
}


def parser() -> argparse.ArgumentParser:
    """Options without a mark are required; ``name=default`` is text, ``name:default`` a number."""
    top = argparse.ArgumentParser(prog="playlens", description=__doc__)
    commands = top.add_subparsers(dest="job", required=True)
    for job, (_, options) in JOBS.items():
        command = commands.add_parser(job)
        for option in options:
            if ":" in option:
                name, default = option.split(":")
                command.add_argument(f"--{name}", type=int, default=int(default))
            elif "=" in option:
                name, default = option.split("=")
                command.add_argument(f"--{name}", default=default or None)
            else:
                command.add_argument(f"--{option}", required=True)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"playlens {args.job}")
    try:
        JOBS[args.job][0](spark, args)
    finally:
        clear_scratch(spark)


if __name__ == "__main__":
    main()
