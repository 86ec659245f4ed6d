"""Users, profiles, play counts and play events taken from the given tables.

=============  =====================================================================
domain table   taken from
=============  =====================================================================
users          customer: gender from the market segment, age from the balance
profiles       supplier against customer: country and region, age and gender from the balance
play counts    orders, lineitem and part: customer, part, part name, quantity
play events    events: user, time, artist from the JSON property ``k``
banners        fixed rows
=============  =====================================================================

Every DataFrame here has a twin: a SQL common table expression of the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.functions.text import TAB

# Fixed rows: min_age, max_age, gender, banner.
BANNER_ROWS = """
    (-10, 20, 'BUILDING', 'A'), (20, 60, 'BUILDING', 'B'), (40, 90, 'BUILDING', 'C'),
    (-10, 100, 'MACHINERY', 'D'), (NULL, NULL, 'BUILDING', 'N'), (NULL, NULL, 'FURNITURE', 'P')
"""


class Tables:
    """The given tables of one folder and the stand-ins made from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def banners(self) -> DataFrame:
        return self.spark.sql(
            f"SELECT * FROM VALUES {BANNER_ROWS} AS b(min_age, max_age, gender, banner)"
        )

    @cached_property
    def users(self) -> DataFrame:
        balance = F.col("c_acctbal")
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("user_id"),
            F.lower("c_mktsegment").alias("gender"),
            F.when(balance >= 0, F.floor(balance / 100).cast("int")).alias("age"),
        )

    @cached_property
    def users_with_age(self) -> DataFrame:
        return self.users.filter(F.col("age").isNotNull()).select("user_id")

    def profiles(self, table: str, letter: str) -> DataFrame:
        """Profiles of customers or suppliers; ``letter`` starts the names of the columns."""
        balance, place = F.col(f"{letter}_acctbal"), self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select("n_nationkey", "n_name", "r_name")
        return self.table(table).join(
            place, F.col(f"{letter}_nationkey") == F.col("n_nationkey")
        ).select(
            F.col(f"{letter}_name").alias("id"),
            F.when(balance < 0, "f").otherwise("m").alias("gender"),
            F.when(balance < 0, "").otherwise(F.floor(balance / 1000).cast("string")).alias("age"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("registered"),
        )

    @cached_property
    def supplier_profiles(self) -> DataFrame:
        return self.profiles("supplier", "s")

    @cached_property
    def customer_profiles(self) -> DataFrame:
        return self.profiles("customer", "c")

    @cached_property
    def plays(self) -> DataFrame:
        return self._plays.select("user_id", "artist_id", "artist_name", "plays")

    @cached_property
    def artist_names(self) -> DataFrame:
        """(artist_id, artist_name) of all parts. A play has every name of its part, so the names of the artists in ``plays``
        are these, and need no second join of lines and orders."""
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("artist_id"), F.col("p_name").alias("artist_name"))

    @cached_property
    def _plays(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_linenumber"
        )
        parts = self.table("part").select("p_partkey", "p_name")
        joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
            parts, F.col("l_partkey") == F.col("p_partkey")
        )
        return joined.select(
            F.col("o_custkey").cast("string").alias("user_id"),
            F.col("l_partkey").cast("string").alias("artist_id"),
            F.col("p_name").alias("artist_name"),
            F.col("l_quantity").cast("int").alias("plays"),
            "l_returnflag",
            "l_linenumber",
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            "ts",
            F.col("user_id").cast("string").alias("user_id"),
            F.get_json_object("props", "$.k").alias("artist_id"),
            "event_type",
        )

    # Text lines, with rows that the readers must drop or reject among them.

    @cached_property
    def user_lines(self) -> DataFrame:
        """Some without last field, some with a sixth, some with an age that is no number."""
        segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
        age = F.when(balance >= 0, F.floor(balance / 100).cast("string")).otherwise(
            F.when(segment == "AUTOMOBILE", "n/a").otherwise("")
        )
        line = F.concat_ws(
            TAB,
            F.col("c_custkey").cast("string"),
            F.lower(segment),
            age,
            F.col("c_nationkey").cast("string"),
            F.when(segment == "HOUSEHOLD", "").otherwise(F.col("c_name")),
            F.when(F.col("c_nationkey") == 7, "more"),
        )
        return self.table("customer").select(line.alias("value"))

    @cached_property
    def banner_lines(self) -> DataFrame:
        """Banners of parts: some without bounds, some with a bound that is no number, some cut short."""
        key, size = F.col("p_partkey"), F.col("p_size")
        low = F.when(key % 5 == 0, "").when(key % 7 == 0, "x").otherwise(size.cast("string"))
        high = F.when(key % 5 == 0, "").otherwise((size + 10).cast("string"))
        line = F.concat_ws(TAB, low, high, "p_brand", F.when(key % 11 != 0, F.col("p_type")))
        return self.table("part").select(line.alias("value"))

    @cached_property
    def profile_lines(self) -> DataFrame:
        """Some with an id only, some cut after the age."""
        segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
        own, negative = segment != "HOUSEHOLD", balance < 0
        full = own & ~(negative & (segment == "FURNITURE"))
        line = F.concat_ws(
            TAB,
            F.col("c_custkey").cast("string"),
            F.when(own, F.lower(segment)),
            F.when(own, F.when(negative & full, "").otherwise(
                F.floor(balance / 100).cast("string"))),
            F.when(full, F.col("c_nationkey").cast("string")),
            F.when(full, F.col("c_name")),
        )
        return self.table("customer").select(line.alias("value"))

    @cached_property
    def play_lines(self) -> DataFrame:
        """Blanks before the number; some without number, some with a word in its place."""
        last = F.col("l_linenumber") == 7
        plays = F.when(last & (F.col("l_returnflag") == "R"), "x").when(
            ~last | (F.col("l_returnflag") != "A"), F.concat(F.lit(" "), F.col("plays"))
        )
        return self._plays.select(
            F.concat_ws(TAB, "user_id", "artist_id", "artist_name", plays).alias("value")
        )

    @cached_property
    def event_lines(self) -> DataFrame:
        """(event_id, ts, value): lines of six fields, the last two empty for views."""
        view = F.col("event_type") == "view"
        line = F.concat_ws(
            TAB,
            "user_id",
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "artist_id",
            "event_type",
            F.when(view, "").otherwise(F.concat(F.lit("t"), F.col("artist_id"))),
            F.when(view, "").otherwise(F.concat(F.lit("Track "), F.col("event_id"))),
        )
        return self.events.select("event_id", "ts", line.alias("value"), "event_type")

    @cached_property
    def mixed_event_lines(self) -> DataFrame:
        """The same, but those of errors end after the fourth field."""
        cut = F.substring_index("value", TAB, 4)
        value = F.when(F.col("event_type") == "error", cut).otherwise(F.col("value"))
        return self.event_lines.select("event_id", "ts", value.alias("value"))


# The same rows in SQL.

BANNERS_SQL = f"banners AS (SELECT * FROM (VALUES {BANNER_ROWS}) AS b(lo, hi, gender, banner))"

USERS_SQL = """users AS (
    SELECT CAST(c_custkey AS VARCHAR) AS user_id, lower(c_mktsegment) AS gender,
           CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 100) AS INTEGER) END AS age
    FROM customer)"""

USER_BANNER_SQL = f"""{BANNERS_SQL}, {USERS_SQL}, user_banner AS (
    SELECT u.user_id, coalesce(string_agg(DISTINCT b.banner, '' ORDER BY b.banner), '') AS banner
    FROM users u LEFT JOIN banners b ON upper(u.gender) = b.gender
         AND ((b.lo < u.age AND b.hi >= u.age)
              OR (u.age IS NULL AND b.lo IS NULL AND b.hi IS NULL))
    GROUP BY u.user_id)"""

def _profiles_sql(table: str, letter: str) -> str:
    return f"""
    SELECT {letter}_name AS id, CASE WHEN {letter}_acctbal < 0 THEN 'f' ELSE 'm' END AS gender,
           CASE WHEN {letter}_acctbal < 0 THEN ''
                ELSE CAST(CAST(floor({letter}_acctbal / 1000) AS BIGINT) AS VARCHAR) END AS age,
           n_name AS country, r_name AS registered
    FROM {table} JOIN nation ON {letter}_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey"""


PROFILES_SQL = f"""pairs AS (
    SELECT a.id AS a_id, a.gender AS a_gender, a.age AS a_age, a.country AS a_country,
           a.registered AS a_registered, b.id AS b_id, b.gender AS b_gender, b.age AS b_age,
           b.country AS b_country, b.registered AS b_registered
    FROM ({_profiles_sql("supplier", "s")}) a JOIN ({_profiles_sql("customer", "c")}) b
      ON a.registered = b.registered AND a.country = b.country AND a.gender = b.gender
     AND a.age = b.age)"""

PLAYS_SQL = """plays AS (
    SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS artist_id,
           p_name AS artist_name, CAST(l_quantity AS INTEGER) AS plays, l_returnflag, l_linenumber
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)"""

IDS_SQL = f"""{PLAYS_SQL},
    user_ids AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS "user"
                 FROM (SELECT DISTINCT user_id FROM plays)),
    artist_ids AS (SELECT artist_id, row_number() OVER (ORDER BY artist_id) - 1 AS item
                   FROM (SELECT DISTINCT artist_id FROM plays))"""

RATINGS_SQL = f"""{IDS_SQL},
    ratings AS (SELECT CAST("user" AS INTEGER) AS "user", CAST(item AS INTEGER) AS item,
                       CAST(sum(plays) AS BIGINT) AS plays
                FROM plays JOIN user_ids USING (user_id) JOIN artist_ids USING (artist_id)
                GROUP BY ALL)"""

SPLIT_SQL = f"""{RATINGS_SQL},
    buckets AS (SELECT *, ((CAST("user" AS BIGINT) * 2654435761 + CAST(item AS BIGINT) * 40503)
                           % 1000003) % 1000 AS bucket FROM ratings),
    split AS (SELECT "user", item, plays,
                     CASE WHEN bucket < 600 THEN 0 WHEN bucket < 800 THEN 1 ELSE 2 END AS split
              FROM buckets)"""

EVENTS_SQL = """plays_seen AS (
    SELECT event_id, ts, CAST(user_id AS VARCHAR) AS user_id,
           regexp_extract(props, '"k": *([0-9]+)', 1) AS artist_id, event_type
    FROM events),
    event_lines AS (
    SELECT event_id, event_type, user_id,
           user_id || chr(9) || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || chr(9) || artist_id || chr(9)
           || event_type AS head,
           CASE WHEN event_type = 'view' THEN chr(9) || chr(9)
                ELSE chr(9) || 't' || artist_id || chr(9) || 'Track ' || event_id END AS tail
    FROM plays_seen)"""

NUMBERED_SQL = """numbered AS (
    SELECT event_id, CAST(user_id AS VARCHAR) AS user_id,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS play_no
    FROM events)"""
