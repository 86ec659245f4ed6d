"""Mixing sources to target weights: Efraimidis-Spirakis sampling within each source.

Targets: the sources, in code point order with null last, weigh 5, 2, 1, repeating, and share
``share_percent`` of all words; none may get more than ``most`` times its own words, and what is
cut off is shared again by weight. In closed form: every source gets min(cap, weight x level) for
one level, found by a prefix sum over the sources sorted by cap over weight.

A source of S words with target T takes every document floor(T / S) times; the rest is drawn from
its documents sorted by exponential key -ln(u) / quality, u being a hash of the id, so a document
of double quality is twice as likely to come next. A prefix sum of sizes runs until the rest is
used up; the document at the border gives the words that are left of it.

A source may hold a third of all rows, so the prefix sum has two levels: rows are dealt into ranges of
(source, key) of equal size, summed within each, and shifted by the sums of the source's ranges before.

Null texts have size 0 and take 0. A null source is a source of its own. Rows with equal ids, or
null ones, have equal keys and are ordered by size; equal rows share out what they take in any
order, so the rows of the result are the same on every run. No rows, no result. Further columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import WORD, table
from playlens.operators.ids import numbered_in_order
from playlens.session import pin, shuffle_partitions

WEIGHTS = (5, 2, 1)


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size in words, and the number of symbols."""
    text_ = F.col(text).cast("string")
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(text_, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.regexp_count(text_, F.lit("[#*$%&|<>]")), F.lit(0)).cast("long").alias("symbols"),
    )


def quality_weight() -> Column:
    """Between 0 and 1: short texts and texts full of symbols weigh less."""
    return (F.least(F.col("size"), F.lit(200)) + 20) / (220.0 + 2200.0 * F.col("symbols") / (F.col("size") + 1))


def uniform(doc_id: str = "doc_id") -> Column:
    """A number above 0 and up to 1, from the id alone."""
    digits = F.conv(F.substr(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(1), F.lit(12)), 16, 10)
    return (digits.cast("double") + 1) / float(1 << 48)


def targets(per_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = 150, most: int = 2) -> DataFrame:
    """source, source_size, target of each source of ``per_source`` (source, source_size): one row per source.

    Works in whole numbers until the last division, so it gives the same doubles everywhere.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, rest = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    level = F.struct("open", "weights")
    return (
        per_source.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
        # 100 times what is left for this source and those with a higher level, and their weights.
        .withColumn("open", share_percent * F.sum("source_size").over(everything)
                    - 100 * F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(rest))
        .withColumn("capped", 100 * F.col("cap") * F.col("weights") <= F.col("open") * F.col("weight"))
        .withColumn("first", F.first(F.when(~F.col("capped"), level), ignorenulls=True).over(
            by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .select(
            "source", "source_size",
            F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
                (F.col("weight") * F.col("first.open")).cast("double") / (100 * F.col("first.weights")).cast("double")
            ).alias("target"),
        )
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share_percent: int = 150, most: int = 2,
    quality: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken."""
    key = -F.log(uniform()) / (quality if quality is not None else quality_weight())
    keyed = pin(sizes(docs, doc_id, text, source).withColumn("key", key).drop("symbols"), "mix")
    # Cut at quantiles of the keys there are, whatever the quality weights.
    keyed = numbered_in_order(
        keyed, ["source", "key", "doc_id", "size"], shuffle_partitions(docs.sparkSession), "mix-ranges")
    per_range = keyed.groupBy("source", "_part").agg(F.sum("size").alias("range_size"))
    per_source = per_range.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    budget = targets(per_source, weights, share_percent, most)
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        per_range.withColumn("shift", F.coalesce(F.sum("range_size").over(earlier), F.lit(0))).alias("b")
        .join(budget.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
        .select("b.source", "_part", "shift", "source_size", "target")
    )
    inside = Window.partitionBy("source", "_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    keyed = keyed.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    budget_words = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget_words / F.col("source_size"))).otherwise(0).cast("long")
    left = budget_words - epochs * F.col("source_size") - F.col("shift") - F.col("before")
    return (
        keyed.alias("k").join(shifts.alias("s"), F.col("k.source").eqNullSafe(F.col("s.source"))
                              & (F.col("k._part") == F.col("s._part")))
        .select(
            "doc_id", "k.source", "size", "source_size", "target",
            (epochs * F.col("size") + F.greatest(F.lit(0), F.least("size", left))).cast("long").alias("taken"),
        )
    )


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0)::BIGINT AS symbols FROM documents
), keyed AS (
  SELECT doc_id, source, size,
    -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 1) / 281474976710656.0)
      / ((least(size, 200) + 20) / (220.0 + 2200.0 * symbols / (size + 1))) AS k FROM sized
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, 2 * source_size AS cap,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM totals
), levels AS (
  SELECT *, 150 * (SELECT sum(source_size) FROM totals)
      - 100 * coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open,
    sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM weighed
), marked AS (
  SELECT *, 100 * cap * weights <= open * weight AS capped FROM levels
), targets AS (
  SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE (weight
    * (SELECT max(open) FILTER (NOT capped AND weights = (SELECT max(weights) FILTER (NOT capped) FROM marked)) FROM marked))::DOUBLE
    / (100 * (SELECT max(weights) FILTER (NOT capped) FROM marked))::DOUBLE END AS target FROM marked
), placed AS (
  SELECT k.doc_id, k.size, t.source_size, t.target, floor(t.target)::BIGINT AS words,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.k, k.doc_id, k.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE (words // source_size) * size
    + greatest(0, least(size, words - (words // source_size) * source_size - before)) END::BIGINT AS taken
FROM placed
"""
