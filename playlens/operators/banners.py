"""Which banners a user gets: by gender and age range."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions.text import or_empty
from playlens.session import pin


def match_banners(users: DataFrame, banners: DataFrame) -> DataFrame:
    """``users`` with ``banners`` (sorted array) and ``banner`` (the same joined without separator).

    The gender is compared in upper case for the user and as it is for the banner. An age must
    lie in (min_age, max_age]; a user without age gets the banners without bounds. Users
    without any banner keep an empty array and an empty text.

    The range comparison runs once per distinct (gender, age), not once per user, so users are
    neither multiplied nor shuffled while that small result fits a broadcast; when it does
    not, the planner sees its size and shuffles, with the skew handling of adaptive execution.
    """
    keyed = users.withColumn("_gender", F.upper(or_empty(F.col("gender"))))
    kinds = keyed.select("_gender", F.col("age").alias("_age")).distinct()
    offers = banners.select("min_age", "max_age", F.col("gender").alias("_for"), "banner")
    in_range = (F.col("min_age") < F.col("_age")) & (F.col("max_age") >= F.col("_age"))
    no_age = F.col("_age").isNull() & F.col("min_age").isNull() & F.col("max_age").isNull()
    matched = (
        kinds.join(offers, (F.col("_gender") == F.col("_for")) & (in_range | no_age))
        .groupBy(F.col("_gender").alias("_kind_gender"), F.col("_age").alias("_kind_age"))
        .agg(F.array_sort(F.collect_set("banner")).alias("banners"))
    )
    return _offered(users, keyed, matched)


def match_many_banners(users: DataFrame, banners: DataFrame) -> DataFrame:
    """As ``match_banners``, for tables of so many banners that comparing each with every distinct age is too much.

    The bounds of a gender cut the ages into elementary intervals (from, to]. Sorted by value, bounds and ages are numbered by
    the bounds before them: an age lies in the interval of its number, and a banner covers those from its lower to its
    upper bound. So banners meet ages by equality of (gender, interval), and only those meet that match. The numbering is
    one window over the distinct bounds and ages of a gender, which are few beside the users.
    """
    keyed = users.withColumn("_gender", F.upper(or_empty(F.col("gender"))))
    kinds = keyed.select("_gender", F.col("age").alias("_age")).distinct()
    offers = banners.select("min_age", "max_age", F.col("gender").alias("_for"), "banner").distinct()
    ranged = offers.filter("min_age < max_age")
    bounds = ranged.select("_for", F.explode(F.array("min_age", "max_age")).alias("value")).distinct()
    ages = kinds.filter("_age IS NOT NULL").select(F.col("_gender").alias("_for"), F.col("_age").alias("value"))
    # Bounds below a value; the same for a bound and for an age of that value.
    below = Window.partitionBy("_for").orderBy("value").rangeBetween(Window.unboundedPreceding, -1)
    points = bounds.withColumn("bound", F.lit(1)).unionByName(ages.withColumn("bound", F.lit(0)))
    numbered = pin(points.withColumn("number", F.coalesce(F.sum("bound").over(below), F.lit(0)).cast("int")), "points")
    number = numbered.filter("bound = 1").select("_for", "value", "number")
    low, high = (number.select("_for", F.col("value").alias(f"{end}_age"), F.col("number").alias(end)) for end in ("min", "max"))
    # With i bounds below a lower bound, the first age above it has i + 1; an age at the upper bound has its number.
    covered = ranged.join(low, ["_for", "min_age"]).join(high, ["_for", "max_age"]).select(
        "_for", "banner", F.explode(F.sequence(F.col("min") + 1, F.col("max"))).alias("number"))
    in_interval = numbered.filter("bound = 0").join(covered, ["_for", "number"]).select(
        "_for", F.col("value").alias("_age"), "banner")
    no_age = kinds.filter("_age IS NULL").join(
        offers.filter("min_age IS NULL AND max_age IS NULL"), F.col("_gender") == F.col("_for")).select("_for", "_age", "banner")
    matched = (
        in_interval.unionByName(no_age)
        .groupBy(F.col("_for").alias("_kind_gender"), F.col("_age").alias("_kind_age"))
        .agg(F.array_sort(F.collect_set("banner")).alias("banners"))
    )
    return _offered(users, keyed, matched, long_texts=True)


def _offered(users: DataFrame, keyed: DataFrame, matched: DataFrame, long_texts: bool = False) -> DataFrame:
    """``users`` with the banners of their kind.

    The text is joined once per kind and stored beside the array, so that a reader of the text alone neither reads
    the arrays nor carries them to the users. With ``long_texts`` the length is a key of the join, negative: where it sorts,
    the longest texts of a task come first. A file writer that plans its memory by the rows it has seen, as that of
    Parquet, takes too many long rows after a run of short ones.
    """
    text = F.array_join("banners", "")
    matched = pin(matched.withColumn("_text", text).withColumn("_order", -F.length(text)), "banners-by-kind")
    kind = ["_kind_gender", "_kind_age"]
    same_kind = (F.col("_gender") == F.col("_kind_gender")) & F.col("age").eqNullSafe(F.col("_kind_age"))
    if long_texts:
        lengths = matched.select(*kind, F.col("_order").alias("_length"))
        keyed = keyed.join(lengths, same_kind, "left").drop(*kind).withColumn("_length", F.coalesce("_length", F.lit(0)))
        same_kind = (F.col("_length") == F.col("_order")) & same_kind
    return keyed.join(matched, same_kind, "left").select(
        *[F.col(name) for name in users.columns],
        F.coalesce(F.col("banners"), F.array().cast("array<string>")).alias("banners"),
        F.coalesce(F.col("_text"), F.lit("")).alias("banner"),
    )
