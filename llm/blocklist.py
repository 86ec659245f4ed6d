"""URL rules by sort-merge range join: rules on hosts and path prefixes, the longest that fits wins.

A host written with its labels reversed and closed by a dot (``example.org`` as ``org.example.``)
makes "host or subdomain" a prefix, and a prefix is an interval of sorted keys. Intervals of
prefixes are nested or apart. So each rule carries the stack of the rules whose interval encloses
its own; sweeping urls and rule starts in key order, the stack of the last start seen holds every
rule that can be active, and those whose interval has ended by then are passed over. Among the
active ones those with a fitting path remain.

The sweep is a window over sorted keys. So that no group of urls is tied to one task, urls are
dealt over ``lanes`` by their content and every lane sees all rule starts.

A null url, or one without ``://``, has an empty host and path, which no rule fits; it gets the
verdict ``default``. Repeated rows each give a row. An empty rule table leaves every url at
``default``. Rules with a null host or path are ignored; equal (host, path) pairs count once,
block before allow. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import table
from playlens.session import shuffle_partitions

LANES = 64

#: The rules of the query.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``, else empty."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def key_of(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def stacks(rules: DataFrame) -> DataFrame:
    """Per rule host key: the rules (key, rule, path, verdict, length) whose interval encloses it."""
    rules = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict")
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .withColumn("key", key_of(F.col("host")))
    )
    # A key's enclosing keys are its own prefixes that end at a dot.
    labels = F.split("key", r"\.", -1)
    inside = rules.select("key").distinct().select(
        "key",
        F.explode(F.transform(
            F.sequence(F.lit(1), F.size(labels) - 1),
            lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")),
        )).alias("outer"),
    )
    rule = F.struct(
        F.col("o.key").alias("key"),
        F.concat("o.host", "o.path").alias("rule"),
        F.col("o.path").alias("path"),
        F.col("o.verdict").alias("verdict"),
    )
    return (
        inside.alias("i").join(rules.alias("o"), F.col("i.outer") == F.col("o.key"))
        .groupBy("i.key").agg(F.sort_array(F.collect_list(rule)).alias("stack"))
    )


def filter_urls(
    pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
    default: str = "allow", lanes: int | None = None,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, the rule that decides or null, verdict.

    ``lanes``: tasks that sweep; as many as there are shuffle partitions, LANES at least. Each takes all rule starts.
    """
    lanes = lanes or max(LANES, shuffle_partitions(pages.sparkSession))
    url_ = F.col(url).cast("string")
    points = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.coalesce(host_of(url_), F.lit("")).alias("host"),
        F.coalesce(path_of(url_), F.lit("")).alias("path"),
    )
    starts = stacks(rules)
    points = points.select(
        F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(lanes)).alias("lane"),
        key_of(F.col("host")).alias("key"),
        F.lit(1).alias("kind"), "page_id", "host", "path",
        F.lit(None).cast(starts.schema["stack"].dataType).alias("stack"),
    )
    starts = starts.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"),
        "key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("page_id"),
        F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"), "stack",
    )
    sweep = Window.partitionBy("lane").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = (
        points.unionByName(starts)
        .withColumn("stack", F.last("stack", ignorenulls=True).over(sweep))
        .where("kind = 1")
    )
    fits = F.filter(
        "stack", lambda r: F.startswith(F.col("key"), r["key"]) & F.startswith(F.col("path"), r["path"])
    )
    # Longest first; of equally long ones the longer host.
    best = F.array_max(F.transform(fits, lambda r: F.struct(
        F.length(r["rule"]).alias("length"), F.length(r["key"]).alias("host_length"),
        r["rule"].alias("rule"), r["verdict"].alias("verdict"),
    )))
    return swept.withColumn("best", best).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def op3_url_filters(spark, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages"), rules)


SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), url AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(rhost, rpath, rverdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), hits AS (
  SELECT page_id, rhost || rpath AS rule, rverdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS place
  FROM url JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT u.page_id, u.host, u.path, h.rule, coalesce(h.rverdict, 'allow') AS verdict
FROM url u LEFT JOIN hits h ON u.page_id = h.page_id AND h.place = 1
"""
