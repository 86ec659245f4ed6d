"""Queries of the batch operators."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens import constants
from playlens.functions.messages import payload
from playlens.operators import cohort, counting, ids, ratings, recommend
from playlens.operators.banners import match_banners, match_many_banners
from playlens.plans import standins as s
from playlens.plans.registry import query
from playlens.plans.standins import Tables
from playlens.session import pin, scratch_path
from playlens.sources import files, lines, user_table
from playlens.streaming.replay import encode_lines

MESSAGE_SQL = "'Usuario: ' || user_id || '. Banner: ' || banner AS message"


def with_age_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("age", F.coalesce(F.col("age").cast("string"), F.lit("")))


# Text lines to typed rows.

CLEAN_USERS_SQL = """
    SELECT CAST(c_custkey AS VARCHAR) AS user_id, lower(c_mktsegment) AS gender,
           CASE WHEN c_acctbal >= 0 THEN CAST(CAST(floor(c_acctbal / 100) AS INTEGER) AS VARCHAR)
                ELSE '' END AS age,
           CAST(c_nationkey AS VARCHAR) AS "date", c_name AS extra
    FROM customer
    WHERE c_nationkey <> 7 AND c_mktsegment <> 'HOUSEHOLD'
      AND NOT (c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 0)"""


@query(CLEAN_USERS_SQL)
def clean_users(t: Tables) -> DataFrame:
    return with_age_text(lines.parse_users(t.user_lines).rows)


@query("""
    WITH user_lines AS (
        SELECT c_custkey || chr(9) || lower(c_mktsegment) || chr(9)
               || CASE WHEN c_acctbal >= 0 THEN CAST(CAST(floor(c_acctbal / 100) AS INTEGER) AS VARCHAR)
                       WHEN c_mktsegment = 'AUTOMOBILE' THEN 'n/a' ELSE '' END
               || chr(9) || c_nationkey || chr(9)
               || CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE c_name END
               || CASE WHEN c_nationkey = 7 THEN chr(9) || 'more' ELSE '' END AS value,
               CASE WHEN c_nationkey = 7 THEN 'Error en Usuario, tamaño: 6'
                    WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Error en Usuario, tamaño: 4'
                    WHEN c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 0
                    THEN 'age is not a whole number' END AS reason
        FROM customer)
    SELECT value, reason FROM user_lines WHERE reason IS NOT NULL""")
def user_rejects(t: Tables) -> DataFrame:
    return lines.parse_users(t.user_lines).rejects


@query("""
    SELECT DISTINCT CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS min_age,
           CASE WHEN p_partkey % 5 <> 0 THEN p_size + 10 END AS max_age, p_brand AS gender, p_type AS banner
    FROM part WHERE p_partkey % 11 <> 0 AND (p_partkey % 5 = 0 OR p_partkey % 7 <> 0)""")
def banner_parse(t: Tables) -> DataFrame:
    return lines.parse_banners(t.banner_lines).rows


@query("""
    SELECT CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 7 = 0 THEN 'x' ELSE CAST(p_size AS VARCHAR) END
           || chr(9) || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE CAST(p_size + 10 AS VARCHAR) END
           || chr(9) || p_brand || CASE WHEN p_partkey % 11 = 0 THEN '' ELSE chr(9) || p_type END AS value,
           CASE WHEN p_partkey % 11 = 0 THEN 'fewer than 4 fields'
                ELSE 'age bound is not a whole number' END AS reason
    FROM part WHERE p_partkey % 11 = 0 OR (p_partkey % 5 <> 0 AND p_partkey % 7 = 0)""")
def banner_rejects(t: Tables) -> DataFrame:
    return lines.parse_banners(t.banner_lines).rejects


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS user_id, lower(c_mktsegment) AS gender,
           CASE WHEN c_acctbal >= 0 THEN CAST(CAST(floor(c_acctbal / 100) AS INTEGER) AS VARCHAR)
                ELSE '' END AS age,
           CAST(c_nationkey AS VARCHAR) AS "date", c_name AS extra
    FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""")
def imported_users(t: Tables) -> DataFrame:
    """Users as a database has them: typed, some without the last column."""
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    table = t.table("customer").select(
        "c_custkey",
        F.lower(segment),
        F.when(balance >= 0, F.floor(balance / 100).cast("int")),
        "c_nationkey",
        F.when(segment != "HOUSEHOLD", F.col("c_name")),
    )
    table = table.toDF("id", "gender", "age", "since", "name")
    return with_age_text(lines.users_of_table(table).rows)


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS id, lower(c_mktsegment) AS gender,
           CASE WHEN c_acctbal < 0 THEN ''
                ELSE CAST(CAST(floor(c_acctbal / 100) AS INTEGER) AS VARCHAR) END AS age,
           CAST(c_nationkey AS VARCHAR) AS country, c_name AS registered
    FROM customer
    WHERE c_mktsegment <> 'HOUSEHOLD' AND NOT (c_mktsegment = 'FURNITURE' AND c_acctbal < 0)""")
def profile_parse(t: Tables) -> DataFrame:
    return lines.parse_profiles(t.profile_lines).rows


@query("""
    SELECT c_custkey || chr(9) || 'furniture' || chr(9) || CAST(floor(c_acctbal / 100) AS INTEGER)
           AS value, 'fewer than 5 fields' AS reason
    FROM customer WHERE c_mktsegment = 'FURNITURE' AND c_acctbal < 0""")
def profile_rejects(t: Tables) -> DataFrame:
    return lines.parse_profiles(t.profile_lines).rejects


@query(f"""
    WITH {s.PLAYS_SQL}
    SELECT user_id, artist_id, artist_name, plays FROM plays
    WHERE l_linenumber <> 7 OR l_returnflag = 'N'""")
def play_parse(t: Tables) -> DataFrame:
    return lines.parse_play_counts(t.play_lines).rows


@query(f"""
    WITH {s.PLAYS_SQL}
    SELECT user_id || chr(9) || artist_id || chr(9) || artist_name
           || CASE WHEN l_returnflag = 'R' THEN chr(9) || 'x' ELSE '' END AS value,
           CASE WHEN l_returnflag = 'R' THEN 'plays is not a whole number'
                ELSE 'fewer than 4 fields' END AS reason
    FROM plays WHERE l_linenumber = 7 AND l_returnflag IN ('R', 'A')""")
def play_rejects(t: Tables) -> DataFrame:
    return lines.parse_play_counts(t.play_lines).rejects


VALID_EVENTS_SQL = f"""
    WITH {s.EVENTS_SQL}
    SELECT user_id || chr(9) AS key, head || tail || chr(9) AS value
    FROM event_lines WHERE event_type <> 'error'"""


@query(VALID_EVENTS_SQL)
def event_validate(t: Tables) -> DataFrame:
    wire = encode_lines(t.mixed_event_lines)
    return wire.select(payload(F.col("key")).alias("key"), payload(F.col("value")).alias("value"))


@query(f"""
    WITH {s.EVENTS_SQL}
    SELECT head AS value, '6 fields expected, got 4' AS reason
    FROM event_lines WHERE event_type = 'error'""")
def event_rejects(t: Tables) -> DataFrame:
    return lines.parse_events(t.mixed_event_lines).rejects


@query(f"""
    WITH {s.EVENTS_SQL}
    SELECT user_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", artist_id,
           event_type AS artist_name,
           CASE WHEN event_type = 'view' THEN '' ELSE 't' || artist_id END AS track_id,
           CASE WHEN event_type = 'view' THEN '' ELSE 'Track ' || event_id END AS track_name
    FROM plays_seen WHERE event_type <> 'error'""")
def wire_parse(t: Tables) -> DataFrame:
    return lines.parse_wire(encode_lines(t.mixed_event_lines)).rows


# Banners and cohorts.


@query(f"WITH {s.USER_BANNER_SQL} SELECT user_id, banner FROM user_banner")
def banner_match(t: Tables) -> DataFrame:
    return match_banners(t.users, t.banners).select("user_id", "banner")


PART_BANNERS_SQL = """part_banners AS (
    SELECT CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_size END AS lo,
           CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_size + p_partkey % 13 END AS hi,
           ['BUILDING', 'MACHINERY', 'FURNITURE', 'AUTOMOBILE', 'HOUSEHOLD'][p_partkey % 5 + 1] AS gender,
           'P' || p_partkey || ';' AS banner
    FROM part)"""


@query(f"""
    WITH {PART_BANNERS_SQL}, {s.USERS_SQL}
    SELECT u.user_id, coalesce(string_agg(DISTINCT b.banner, '' ORDER BY b.banner), '') AS banner
    FROM users u LEFT JOIN part_banners b ON upper(u.gender) = b.gender
         AND ((b.lo < u.age AND b.hi >= u.age) OR (u.age IS NULL AND b.lo IS NULL AND b.hi IS NULL))
    GROUP BY u.user_id""")
def banner_intervals(t: Tables) -> DataFrame:
    """A banner for each part, matched by elementary intervals of age."""
    key, size = F.col("p_partkey"), F.col("p_size")
    genders = F.array(*map(F.lit, ("BUILDING", "MACHINERY", "FURNITURE", "AUTOMOBILE", "HOUSEHOLD")))
    bounded = key % 9 != 0
    banners = t.table("part").select(
        F.when(bounded, size).alias("min_age"), F.when(bounded, size + key % 13).cast("int").alias("max_age"),
        F.get(genders, (key % 5).cast("int")).alias("gender"), F.concat(F.lit("P"), key, F.lit(";")).alias("banner"))
    return match_many_banners(t.users, banners).select("user_id", "banner")


@query(f"WITH {s.PROFILES_SQL} SELECT * FROM pairs")
def cohort_match(t: Tables) -> DataFrame:
    return cohort.match_profiles(t.supplier_profiles, t.customer_profiles)


@query(f"WITH {s.PROFILES_SQL} SELECT count(*) AS n_pairs FROM pairs")
def cohort_pair_count(t: Tables) -> DataFrame:
    return cohort.count_matches(t.supplier_profiles, t.customer_profiles)


@query(f"WITH {s.PROFILES_SQL} SELECT * FROM pairs ORDER BY a_id, b_id LIMIT 50")
def cohort_first_50(t: Tables) -> DataFrame:
    return cohort.first_matches(t.supplier_profiles, t.customer_profiles, 50)


# Ids and catalogue.


@query(f'WITH {s.IDS_SQL} SELECT user_id, "user" + 1 AS rank FROM user_ids')
def user_ids(t: Tables) -> DataFrame:
    return ids.dense_ids(t.plays, "user_id", "rank", start=1)


@query(f"WITH {s.IDS_SQL} SELECT artist_id, item + 1 AS rank FROM artist_ids")
def artist_ids(t: Tables) -> DataFrame:
    return ids.dense_ids(t.plays, "artist_id", "rank", start=1)


@query(f"WITH {s.IDS_SQL} SELECT artist_id, item FROM artist_ids")
def artist_index(t: Tables) -> DataFrame:
    return ids.dense_ids(t.plays, "artist_id", "item")


@query(f"WITH {s.IDS_SQL} SELECT user_id, \"user\" + 1 AS rank FROM user_ids ORDER BY 2 LIMIT 10")
def first_ids(t: Tables) -> DataFrame:
    return ids.dense_ids(t.plays, "user_id", "rank", start=1).orderBy("rank").limit(10)


@query(f"""
    WITH {s.PLAYS_SQL}
    SELECT count(DISTINCT artist_id) AS n_rows, count(DISTINCT artist_id) AS n_keys,
           count(DISTINCT artist_id) AS n_ids
    FROM plays""")
def unique_artist_ids(t: Tables) -> DataFrame:
    return ids.gapped_ids(t.plays, "artist_id", "item").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("artist_id").alias("n_keys"),
        F.count_distinct("item").alias("n_ids"),
    )


CATALOGUE_SQL = f"""
    WITH {s.IDS_SQL}
    SELECT DISTINCT artist_id, item, artist_name FROM plays JOIN artist_ids USING (artist_id)"""


def catalogue(t: Tables) -> DataFrame:
    return ids.artist_catalogue(t.artist_names, ids.dense_ids(t.plays, "artist_id", "item"))


@query(CATALOGUE_SQL)
def artist_catalog(t: Tables) -> DataFrame:
    return catalogue(t)


# Totals and ratings.


@query(f"WITH {s.PLAYS_SQL} SELECT user_id, CAST(sum(plays) AS BIGINT) AS plays FROM plays GROUP BY 1")
def plays_by_user(t: Tables) -> DataFrame:
    return ratings.plays_by(t.plays, "user_id")


@query(f"WITH {s.PLAYS_SQL} SELECT artist_id, CAST(sum(plays) AS BIGINT) AS plays FROM plays GROUP BY 1")
def plays_by_artist(t: Tables) -> DataFrame:
    return ratings.plays_by(t.plays, "artist_id")


@query(f"WITH {s.PLAYS_SQL} SELECT user_id, artist_id, count(*) AS n FROM plays GROUP BY 1, 2")
def plays_by_pair(t: Tables) -> DataFrame:
    return ratings.count_by_pair(t.plays)


def triples(t: Tables) -> DataFrame:
    return ratings.rate(t.plays).triples


@query(f"WITH {s.RATINGS_SQL} SELECT * FROM ratings")
def rating_triples(t: Tables) -> DataFrame:
    return triples(t)


@query(f"""
    WITH {s.PLAYS_SQL}, {s.USERS_SQL}
    SELECT user_id, artist_id, CAST(sum(plays) AS BIGINT) AS plays
    FROM plays WHERE user_id NOT IN (SELECT user_id FROM users WHERE age IS NOT NULL)
    GROUP BY 1, 2""")
def unrated_pairs(t: Tables) -> DataFrame:
    users = ids.dense_ids(t.users_with_age, "user_id", "user")
    pairs = pin(ratings.plays_by_pair(t.plays), "pairs")
    return ratings.unrated_pairs(pairs, users, ids.dense_ids(pairs, "artist_id", "item"))


def split_ratings(t: Tables) -> DataFrame:
    """Ratings with ``split``, written once in a folder per split."""
    return pin(ratings.assign_split(triples(t)), "ratings", partition_by=("split",))


@query(f"WITH {s.SPLIT_SQL} SELECT split, count(*) AS n FROM split GROUP BY 1")
def split_sizes(t: Tables) -> DataFrame:
    return ratings.split_sizes(ratings.assign_split(triples(t)))


@query(f"""
    WITH {s.RATINGS_SQL}
    SELECT count(*) AS n_rows, count(*) AS n_pairs, TRUE AS shares_fit FROM ratings""")
def random_split_sizes(t: Tables) -> DataFrame:
    """Spark's own random split: the parts hold every rating once, in shares within five standard
    deviations of the weights."""
    parts = ratings.random_split(pin(triples(t), "ratings"))
    together = reduce(DataFrame.unionAll, (part.withColumn("part", F.lit(n)) for n, part in enumerate(parts)))
    weights = F.array(*map(F.lit, constants.SPLIT_WEIGHTS))
    total = sum(constants.SPLIT_WEIGHTS)
    share = F.get(weights, "part") / total
    sizes = together.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    all_rows = together.groupBy("user", "item").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_pairs"))
    fit = F.abs(F.col("n") - F.col("n_rows") * share) <= 5 * F.sqrt(F.col("n_rows") * share * (1 - share))
    return sizes.join(F.broadcast(all_rows)).groupBy("n_rows", "n_pairs").agg(F.every(fit).alias("shares_fit"))


@query(f"""
    WITH {s.RATINGS_SQL}
    SELECT "user", arg_max(item, plays * 10000000 - item) AS item, CAST(max(plays) AS DOUBLE) AS prediction
    FROM ratings GROUP BY 1""")
def top_artist_per_user(t: Tables) -> DataFrame:
    """The artist each user plays most; the smaller number on ties."""
    return recommend.top_item_per_user(
        triples(t).select("user", "item", F.col("plays").cast("double").alias("prediction"))
    )


@query(f"""
    WITH {s.SPLIT_SQL},
    means AS (SELECT item, avg(plays) AS prediction FROM split WHERE split = 0 GROUP BY 1),
    scored AS (SELECT s.plays, m.prediction FROM split s LEFT JOIN means m USING (item)
               WHERE s.split = 1)
    SELECT count(*) AS n_all, count(prediction) AS n_scored,
           round(sqrt(sum((prediction - plays) ** 2) / count(*)), 6) AS rmse
    FROM scored""")
def rmse_item_mean(t: Tables) -> DataFrame:
    rated = split_ratings(t)
    means = rated.filter("split = 0").groupBy("item").agg(F.avg("plays").alias("prediction"))
    scored = rated.filter("split = 1").join(means, "item", "left")
    return recommend.rmse(scored).select("n_all", "n_scored", F.round("rmse", 6).alias("rmse"))


# Plays counted, banners due.

EVERY_NTH_SQL = f"""
    WITH {s.USER_BANNER_SQL}, {s.NUMBERED_SQL}
    SELECT user_id, play_no, banner, {MESSAGE_SQL}
    FROM numbered JOIN user_banner USING (user_id) WHERE play_no % 10 = 0"""


@query(EVERY_NTH_SQL)
def every_nth_banner(t: Tables) -> DataFrame:
    return counting.banners_due(counting.event_counts(t.events), match_banners(t.users, t.banners))


@query(f"""
    WITH {s.USER_BANNER_SQL}, {s.NUMBERED_SQL}
    SELECT user_id, event_id, play_no, {MESSAGE_SQL}
    FROM numbered JOIN user_banner USING (user_id) WHERE play_no % 10 = 0""")
def every_nth_event(t: Tables) -> DataFrame:
    """The event behind each banner.

    Unknown users leave after the numbering, when a tenth of the rows is left: they have no
    influence on the numbers of others.
    """
    events = t.events.select("event_id", "ts", "user_id")
    due = counting.every_nth(counting.number_plays(events, ["ts", "event_id"]))
    banners = match_banners(t.users, t.banners).select("user_id", "banner")
    return due.join(banners, "user_id").select(
        "user_id",
        "event_id",
        "play_no",
        counting.banner_message(F.col("user_id"), F.col("banner")).alias("message"),
    )


@query(f"WITH {s.NUMBERED_SQL} SELECT event_id, user_id, play_no FROM numbered")
def running_play_count(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "ts", "user_id")
    return counting.number_plays(events, ["ts", "event_id"]).drop("ts")


@query(f"WITH {s.NUMBERED_SQL} SELECT event_id, user_id, play_no FROM numbered")
def running_play_count_ranges(t: Tables) -> DataFrame:
    """The same with a limit at the mean number of events, so that the events of about half the users are numbered over ranges."""
    events = t.events.select("event_id", "ts", "user_id")
    mean = counting.event_counts(events).agg(F.avg("n")).first()[0] or 1
    return counting.number_plays(events, ["ts", "event_id"], hot_events=int(mean)).drop("ts")


UNKNOWN_USERS_SQL = f"""
    WITH {s.USERS_SQL}
    SELECT CAST(user_id AS VARCHAR) AS user_id, count(*) AS n FROM events
    WHERE CAST(user_id AS VARCHAR) NOT IN (SELECT user_id FROM users WHERE age IS NOT NULL)
    GROUP BY 1"""


@query(UNKNOWN_USERS_SQL)
def unknown_users(t: Tables) -> DataFrame:
    return counting.unknown_users(counting.event_counts(t.events), t.users_with_age)


@query(f"""
    WITH {s.USER_BANNER_SQL}, {s.NUMBERED_SQL}, later AS (
        SELECT CAST(user_id AS VARCHAR) AS user_id, row_number() OVER (
               PARTITION BY user_id ORDER BY ts, event_id) AS play_no
        FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00')
    SELECT user_id, play_no, banner, {MESSAGE_SQL}
    FROM later JOIN user_banner USING (user_id) WHERE play_no % 10 = 0""")
def every_nth_since(t: Tables) -> DataFrame:
    later = counting.since(t.events, F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return counting.banners_due(counting.event_counts(later), match_banners(t.users, t.banners))


@query("""
    SELECT strftime(time_bucket(INTERVAL '2 seconds', ts), '%Y-%m-%d %H:%M:%S') AS start,
           count(*) AS n
    FROM events GROUP BY 1""")
def events_per_batch(t: Tables) -> DataFrame:
    counts = counting.events_per_interval(t.events)
    return counts.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


# Files and tables, written and read back.


@query(f'WITH {s.IDS_SQL} SELECT user_id AS id, "user" + 1 AS rank FROM user_ids')
def id_map_files(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "id-map")
    files.write_id_map(ids.dense_ids(t.plays, "user_id", "rank", start=1), path)
    return lines.read_id_map(t.spark, path)


@query(f"WITH {s.IDS_SQL} SELECT artist_id || ',' || item AS value FROM artist_ids")
def alias_files(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "alias")
    files.write_alias(ids.dense_ids(t.plays, "artist_id", "item"), path)
    return lines.read_lines(t.spark, path)


@query(CATALOGUE_SQL)
def catalogue_files(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "catalogue")
    files.write_catalogue(catalogue(t), path)
    return lines.read_catalogue(t.spark, path)


@query(CLEAN_USERS_SQL)
def clean_user_files(t: Tables) -> DataFrame:
    """User lines written as text, read by glob, cleaned and stored under a run stamp."""
    raw, clean = scratch_path(t.spark, "raw-users"), scratch_path(t.spark, "clean-users")
    t.user_lines.write.text(raw)
    files.write_stamped(lines.read_users(t.spark, f"{raw}/*").rows, clean, 1)
    return with_age_text(files.read_stamped(t.spark, clean, 1))


@query(f"""
    WITH {s.USER_BANNER_SQL},
    counted AS (SELECT CAST(user_id AS VARCHAR) AS user_id, count(*) AS n FROM events GROUP BY 1)
    SELECT u.user_id, CASE WHEN u.age IS NULL THEN 'NEW' ELSE banner END AS banner,
           CASE WHEN u.age IS NULL THEN 0 ELSE coalesce(n, 0) END AS plays
    FROM users u JOIN user_banner USING (user_id) LEFT JOIN counted USING (user_id)""")
def user_table_merge(t: Tables) -> DataFrame:
    """Users of a new load get its banner and a counter of zero; the others keep theirs."""
    counts = counting.event_counts(t.events)
    current = match_banners(t.users, t.banners).join(counts, "user_id", "left").select(
        "user_id", "banner", F.coalesce("n", F.lit(0)).alias("plays")
    )
    load = t.users.filter(F.col("age").isNull()).select("user_id", F.lit("NEW").alias("banner"))
    return user_table.merge_users(current, load)


@query(f"""
    WITH {s.USER_BANNER_SQL}
    SELECT u.user_id, CASE WHEN u.gender = 'machinery' THEN 'NEW' ELSE banner END AS banner,
           CAST(0 AS BIGINT) AS plays
    FROM users u JOIN user_banner USING (user_id)""")
def user_table_loads(t: Tables) -> DataFrame:
    """Two loads into the user table, the second by a session of its own that knows the folder only."""
    location = scratch_path(t.spark, "user-table")
    user_table.upsert_users(t.spark, location, match_banners(t.users, t.banners), 1, buckets=4)
    for (name,) in t.spark.sql("SHOW TABLES LIKE 'playlens_users_*'").select("tableName").collect():
        t.spark.sql(f"DROP TABLE IF EXISTS {name}")  # files stay; the catalog of another program has none
    renewed = t.users.filter(F.col("gender") == "machinery")
    user_table.upsert_users(t.spark, location, renewed.withColumn("banner", F.lit("NEW")), 2, buckets=4)
    return user_table.current_users(t.spark, location)


@query(f"""
    WITH {s.USER_BANNER_SQL}, loads AS (
        SELECT user_id, banner, k FROM user_banner, range(0, 5) r(k) WHERE CAST(user_id AS BIGINT) % 7 >= k)
    SELECT user_id, CASE WHEN max(k) = 0 THEN max(banner) ELSE 'L' || max(k) END AS banner, CAST(0 AS BIGINT) AS plays
    FROM loads GROUP BY user_id""")
def user_table_deltas(t: Tables) -> DataFrame:
    """Five loads, each of fewer users than the one before, with the deltas of three merged after the fourth."""
    location, users = scratch_path(t.spark, "user-table"), pin(match_banners(t.users, t.banners), "matched")
    for k in range(5):
        load = users.filter(F.col("user_id").cast("bigint") % 7 >= k)
        load = load.withColumn("banner", F.lit(f"L{k}")) if k else load
        user_table.upsert_users(t.spark, location, load, k + 1, buckets=4, delta_share=100.0)
        if k == 3:
            user_table.compact(t.spark, location)
    return user_table.current_users(t.spark, location)


@query(f"""
    WITH {s.USER_BANNER_SQL}
    SELECT DISTINCT CAST(e.user_id AS VARCHAR) AS user_id, coalesce(b.banner, '?') AS banner,
           coalesce(b.plays, -1) AS plays
    FROM events e LEFT JOIN (
        SELECT user_id, banner, CAST(0 AS BIGINT) AS plays
        FROM user_banner JOIN users USING (user_id) WHERE age IS NOT NULL) b
      ON CAST(e.user_id AS VARCHAR) = b.user_id""")
def user_lookup(t: Tables) -> DataFrame:
    """Banner and counter of each user seen in the events; users without age are not held."""
    held = match_banners(t.users.filter(F.col("age").isNotNull()), t.banners).select(
        "user_id", "banner", F.lit(0).cast("bigint").alias("plays")
    )
    found = user_table.lookup_users(held, t.events.select("user_id").distinct())
    return found.select(
        "user_id",
        F.coalesce("banner", F.lit("?")).alias("banner"),
        F.coalesce("plays", F.lit(-1)).cast("bigint").alias("plays"),
    )


@query(f"""
    WITH {s.USER_BANNER_SQL}
    SELECT banner, count(*) AS n FROM user_banner GROUP BY 1""")
def sql_views(t: Tables) -> DataFrame:
    """Stand-ins as temporary views, asked in SQL."""
    name = f"user_banner_{uuid.uuid4().hex}"
    match_banners(t.users, t.banners).createOrReplaceTempView(name)
    counts = t.spark.sql(f"SELECT banner, count(*) AS n FROM {name} GROUP BY banner")
    t.spark.catalog.dropTempView(name)  # the plan has what it needs
    return counts


@query(f"WITH {s.USER_BANNER_SQL} SELECT user_id, banner FROM user_banner")
def user_banner_files(t: Tables) -> DataFrame:
    """User and banner stored under the run stamp of now, beside an empty earlier run."""
    path, stamp = scratch_path(t.spark, "user-banner"), files.now_millis()
    matched = match_banners(t.users, t.banners).select("user_id", "banner")
    files.write_stamped(matched.limit(0), path, stamp - 1)
    files.write_stamped(matched, path, stamp)
    return files.read_stamped(t.spark, path, stamp)


@query(f'WITH {s.IDS_SQL} SELECT user_id AS id, "user" + 1 AS rank FROM user_ids')
def failed_replacement(t: Tables) -> DataFrame:
    """A map whose replacement fails in the middle of the write: the rows of before are still there."""
    path, ranks = scratch_path(t.spark, "id-map"), ids.dense_ids(t.plays, "user_id", "rank", start=1)
    files.write_id_map(ranks, path)
    broken = ranks.withColumn("rank", F.when(F.col("rank") % 5 == 0, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(0))
    try:
        files.write_id_map(broken, path, mode="overwrite")
    except PySparkException:
        return lines.read_id_map(t.spark, path)
    raise AssertionError("the replacement should have failed")


@query(f'WITH {s.IDS_SQL} SELECT user_id AS id, "user" + 1 AS rank FROM user_ids')
def replaced_files(t: Tables) -> DataFrame:
    """A map written over another one: only the later is left."""
    path = scratch_path(t.spark, "id-map")
    files.write_id_map(ids.dense_ids(t.plays, "artist_id", "rank", start=1), path)
    files.write_id_map(ids.dense_ids(t.plays, "user_id", "rank", start=1), path, mode="overwrite")
    return lines.read_id_map(t.spark, path)
