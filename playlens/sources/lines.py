"""Tab-separated text to typed rows; lines that do not fit come out as rejects with a reason."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens import constants, schemas
from playlens.functions import messages, text
from playlens.session import pin


class Parsed(NamedTuple):
    """``rows`` are typed; ``rejects`` are ``(value, reason)``. Both read the same lines.

    ``judged`` has both in one pass: the columns of a row, and value and reason of a reject.
    """

    rows: DataFrame
    rejects: DataFrame
    judged: DataFrame


def landed(parsed: Parsed, label: str) -> Parsed:
    """The same, from a table written once: the lines are read and parsed a single time."""
    rejected = F.col("reason").isNotNull()
    written = pin(parsed.judged.withColumn("rejected", rejected), label, partition_by=("rejected",))
    names = [name for name in parsed.judged.columns if name not in ("value", "reason")]
    return Parsed(written.filter("NOT rejected").select(names),
                  written.filter("rejected").select("value", "reason"), written.drop("rejected"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the files a path or glob names, in column ``value``."""
    return spark.read.text(path)


def _parsed(lines: DataFrame, reason: Column, columns: list[Column]) -> Parsed:
    judged = lines.withColumn("reason", reason)
    return Parsed(
        judged.filter(F.col("reason").isNull()).select(*columns),
        judged.filter(F.col("reason").isNotNull()).select("value", "reason"),
        judged.select(F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"), "reason", *columns),
    )


def _split(lines: DataFrame, parts: Column, keep=text.has_text) -> DataFrame:
    """(value, parts). The explode of one element stops the optimizer from moving later filters
    below the split, where they would split each line once more per condition."""
    return lines.filter(keep(F.col("value"))).select("value", F.explode(F.array(parts)).alias("parts"))


def _columns(ddl: str) -> list[Column]:
    """Text columns in the order of the schema, taken by position."""
    return [
        text.field(F.col("parts"), position).alias(name)
        for position, name in enumerate(schemas.names(ddl))
    ]


def parse_users(lines: DataFrame) -> Parsed:
    """User lines: exactly five fields once empty ones at the end are gone; age may be empty."""
    return _users(_split(lines, text.fields(F.col("value"))))


def users_of_table(table: DataFrame) -> Parsed:
    """Users of an imported table, columns by position, under the same rules as lines."""
    filled = [text.or_empty(F.col(name).cast("string")) for name in table.columns]
    last = F.greatest(*[F.when(cell != "", n).otherwise(0) for n, cell in enumerate(filled, 1)], F.lit(0))
    row = table.select(F.array(*filled).alias("all"), last.alias("last"))
    return _users(row.select(F.array_join("all", text.TAB).alias("value"),
                             F.slice("all", F.lit(1), F.col("last")).alias("parts")))


def _users(split: DataFrame) -> Parsed:
    parts = F.col("parts")
    age = text.field(parts, 2)
    reason = F.when(
        F.size(parts) != 5, F.format_string(constants.USER_WIDTH_ERROR, F.size(parts))
    ).when((age != "") & text.whole_number(age).isNull(), F.lit("age is not a whole number"))
    columns = _columns(schemas.USER)
    columns[2] = text.whole_number(age).alias("age")
    return _parsed(split, reason, columns)


def parse_banners(lines: DataFrame) -> Parsed:
    """Banner lines: both bounds may be empty, the rest may not be missing."""
    parts = F.col("parts")
    low, high = text.field(parts, 0), text.field(parts, 1)

    def bad(bound: Column) -> Column:
        return (bound != "") & text.whole_number(bound).isNull()

    reason = F.when(F.size(parts) < 4, F.lit("fewer than 4 fields")).when(
        bad(low) | bad(high), F.lit("age bound is not a whole number")
    )
    columns = _columns(schemas.BANNER)
    columns[0] = text.whole_number(low).alias("min_age")
    columns[1] = text.whole_number(high).alias("max_age")
    parsed = _parsed(_split(lines, text.fields(F.col("value"))), reason, columns)
    return parsed._replace(rows=parsed.rows.distinct())


def parse_profiles(lines: DataFrame) -> Parsed:
    """Profile lines: lines with an id only are dropped, those of two to four fields rejected."""
    split = _split(lines, text.fields(F.col("value"))).filter(F.size("parts") > 1)
    reason = F.when(F.size("parts") < 5, F.lit("fewer than 5 fields"))
    columns = [text.or_empty(column).alias(name) for column, name in
               zip(_columns(schemas.PROFILE), schemas.names(schemas.PROFILE))]
    return _parsed(split, reason, columns)


def parse_play_counts(lines: DataFrame) -> Parsed:
    """Play-count lines: four fields, the last a number that blanks may surround."""
    parts = F.col("parts")
    plays = text.whole_number(F.trim(text.field(parts, 3)))
    reason = F.when(F.size(parts) < 4, F.lit("fewer than 4 fields")).when(
        plays.isNull(), F.lit("plays is not a whole number")
    )
    columns = _columns(schemas.PLAY_COUNT)
    columns[3] = plays.alias("plays")
    return _parsed(_split(lines, text.fields(F.col("value"))), reason, columns)


def parse_events(lines: DataFrame) -> Parsed:
    """Event lines of a file: exactly six fields, any of which may be empty."""
    split = _split(lines, text.all_fields(F.col("value")), lambda value: F.lit(True))
    return _parsed(split, _six_fields(F.size("parts")), _columns(schemas.EVENT))


def parse_wire(wire: DataFrame) -> Parsed:
    """Events as published: bytes in ``value`` with one tab more at the end than a file line."""
    payloads = wire.select(messages.payload(F.col("value")).alias("value"))
    split = _split(payloads, text.all_fields(F.col("value")), messages.first_line_filled)
    width = F.size("parts")
    closed = text.field(F.col("parts"), width - 1) == ""
    return _parsed(split, _six_fields(F.when(closed, width - 1).otherwise(width)),
                   _columns(schemas.EVENT))


def _six_fields(width: Column) -> Column:
    return F.when(width != 6, F.concat(F.lit("6 fields expected, got "), width))


def read_users(spark: SparkSession, path: str) -> Parsed:
    return parse_users(read_lines(spark, path))


def read_banners(spark: SparkSession, path: str) -> Parsed:
    return parse_banners(read_lines(spark, path))


def read_profiles(spark: SparkSession, path: str) -> Parsed:
    return parse_profiles(read_lines(spark, path))


def read_play_counts(spark: SparkSession, path: str) -> Parsed:
    return parse_play_counts(read_lines(spark, path))


def read_events(spark: SparkSession, path: str) -> Parsed:
    return parse_events(read_lines(spark, path))


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Artist catalogue as written by ``write_catalogue``."""
    parts = text.all_fields(F.col("value"))
    return read_lines(spark, path).select(
        text.field(parts, 0).alias("artist_id"),
        text.field(parts, 1).try_cast("bigint").alias("item"),
        F.nullif(text.field(parts, 2), F.lit("")).alias("artist_name"),
    )


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """Id map as written by ``write_id_map``."""
    return spark.read.csv(path, schema=schemas.ID_MAP, sep=text.TAB)


def read_alias(spark: SparkSession, path: str, key: str, id_name: str) -> DataFrame:
    """Aliases as written by ``write_alias``; the id is what follows the last comma."""
    value = F.col("value")
    return read_lines(spark, path).select(
        F.substring(value, F.lit(1), F.length(value) - F.length(F.substring_index(value, ",", -1)) - 1)
        .alias(key),
        F.substring_index(value, ",", -1).cast("bigint").alias(id_name),
    )
