"""Benchmark decontamination: hash set of the benchmark's word windows, scanned over every text.

Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters. A window is ``size``
consecutive words of an item; an item of fewer words is one window. The scan goes over every window
of every text:

1. The longest word of each benchmark window, and that word with its successor, go into two hash sets of at most
   ``most_bits`` bits whatever the benchmark. Tasks look up each word of a text; windows around a word and
   successor that are both there are candidates. A larger benchmark only lets more false candidates by.
2. The words of the candidates are verified by joining them with the windows themselves. The planner
   broadcasts that table while it is below spark.sql.autoBroadcastJoinThreshold, and shuffles both
   sides beyond.
3. Hits meet per document, of which no text is moved. Documents without a candidate take no part in the join.

A null or empty text has no words, no hits and the digest of no items. Null and empty items are no
windows. An id and text that occur in several rows are one document with one row; an id with
different texts has a row for each. Null ids are an id like others. Items with equal ids count once.
Without benchmark rows nothing is contaminated. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.tables import table
from playlens.session import pin

SIZE = 10
MOST_BITS = 1 << 21

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words; null and empty texts have none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _APART)
    return F.filter(parts, lambda w: w != "")


def _hash(words: Column, at: Column, size: int) -> Column:
    """Hash of ``size`` words from the one-based place ``at``."""
    return F.xxhash64(*(F.get(words, at + (k - 1)) for k in range(size)))


def _text(words: Column, at: Column, size: Column | int) -> Column:
    return F.array_join(F.slice(words, at, F.lit(size) if isinstance(size, int) else size), " ")


def windows(items: DataFrame, size: int) -> DataFrame:
    """item_id, length and words of each distinct window of the items."""
    length = F.least(F.size("words"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    return (
        items.withColumn("words", words_of(F.col("text"))).where(F.size("words") > 0)
        .select("item_id", length.alias("length"), "words", F.explode(starts).alias("at"))
        .select("item_id", "length", _text(F.col("words"), F.col("at"), F.col("length")).alias("window"))
        .distinct()
    )


def anchor(window: Column, length: int) -> Column:
    """Place of the longest word of a window, among those that have a successor in it."""
    parts = F.split(window, " ")
    places = F.sequence(F.lit(1), F.lit(max(1, length - 1)))
    return F.array_max(F.transform(places, lambda at: F.struct(F.length(F.get(parts, at - 1)), at.alias("at"))))["at"]


def bit_set(spark: SparkSession, places: DataFrame, bits: int) -> DataFrame:
    """One row with the longs of a set of ``bits`` bits, from their places."""
    longs = (
        places.groupBy(F.shiftrightunsigned("place", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("long"))
    )
    every = spark.range(bits // 64).withColumnRenamed("id", "at").join(longs, "at", "left")
    pairs = F.array_sort(F.collect_list(F.struct("at", F.coalesce("long", F.lit(0)).alias("long"))))
    return every.agg(F.transform(pairs, lambda pair: pair["long"]).alias("longs"))


def _place(words: Column, at: Column, size: int, bits: int) -> Column:
    return F.pmod(_hash(words, at, size), F.lit(bits))


def _candidates(length: int, bits: int) -> Column:
    """Place and words of the windows that hold an anchor: its word, then it and its successor, have their bits set."""
    pair = min(2, length)
    starts = F.when(
        F.size("words") >= length, F.sequence(F.lit(1), F.size("words") - (pair - 1))
    ).otherwise(F.array().cast("array<int>"))
    found = F.filter(starts, lambda at: (
        _bit(F.get("places", at - 1) % F.lit(bits), F.col(f"words_{length}"))
        & _bit(_place(F.col("words"), at, pair, bits), F.col(f"pairs_{length}"))
    ))
    around = F.array_distinct(F.flatten(F.transform(found, lambda at: F.sequence(
        F.greatest(F.lit(1), at - (length - pair)), F.least(at, F.size("words") - (length - 1))))))
    return F.transform(around, lambda at: F.struct(
        at.alias("at"), F.lit(length).alias("length"), _text(F.col("words"), at, length).alias("window")))


def hit_documents(
    docs: DataFrame, items: DataFrame, size: int = SIZE, most_bits: int = MOST_BITS,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans [from, to), text_hash."""
    items = items.select(
        F.col(item_id).cast("string").alias("item_id"), F.col(item_text).cast("string").alias("text")
    ).where(F.col("item_id").isNotNull())
    found = pin(windows(items, size), "windows")
    # One row per length, at most ``size`` of them.
    lengths = {row["length"]: row["n"] for row in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    text_ = F.col(text).cast("string")
    base = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text_).alias("text_hash"), words_of(text_).alias("words")
    ).withColumn("places", F.transform("words", lambda w: F.pmod(F.xxhash64(w), F.lit(most_bits))))
    candidates = []
    for length, n in sorted(lengths.items()):
        bits = min(most_bits, max(1 << 12, 1 << (64 * n - 1).bit_length()))
        at, parts = anchor(F.col("window"), length), F.split("window", " ")
        anchored = found.where(F.col("length") == length).select(at.alias("at"), parts.alias("parts"))
        for name, size in (("words", 1), ("pairs", min(2, length))):
            places = anchored.select(_place(F.col("parts"), F.col("at"), size, bits).alias("place"))
            base = base.withColumn(f"{name}_{length}", bit_set(docs.sparkSession, places, bits).scalar())
        candidates.append(_candidates(length, bits))
    kind = "array<struct<at:int,length:int,window:string>>"
    # Written, so that the texts are scanned once: every document goes on by itself, its candidates to the join.
    scanned = pin(base.select(
        "doc_id", "text_hash", F.size("words").cast("long").alias("n_words"),
        (F.concat(*candidates).cast(kind) if candidates else F.array().cast(kind)).alias("candidates"),
    ), "scanned")
    per_window = found.groupBy("length", "window").agg(F.collect_set("item_id").alias("items"))
    hits = (
        scanned.where(F.size("candidates") > 0).select("doc_id", "text_hash", "n_words", F.explode("candidates").alias("c")).alias("s")
        .join(per_window.alias("w"), (F.col("s.c.window") == F.col("w.window")) & (F.col("s.c.length") == F.col("w.length")))
        .select("doc_id", "text_hash", "n_words", "items", F.struct(
            F.col("c.at").alias("at"), (F.col("c.at") + F.col("c.length")).alias("to")).alias("hit"))
    )
    none = scanned.select(
        "doc_id", "text_hash", "n_words", F.lit(None).cast("array<string>").alias("items"),
        F.lit(None).cast("struct<at:int,to:int>").alias("hit"))
    met = none.unionByName(hits).groupBy("doc_id", "text_hash", "n_words").agg(
        F.sort_array(F.collect_set("hit")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    # Hits in order of place; the words that each adds to those before.
    merged = F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
        lambda so_far, h: F.struct(
            (so_far["n"] + F.greatest(F.lit(0), h["to"] - F.greatest(h["at"], so_far["to"]))).alias("n"),
            F.greatest(so_far["to"], h["to"]).alias("to"),
        ),
    )["n"]
    return met.select(
        "doc_id", "n_words", merged.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
        F.col("hits").alias("spans"), "text_hash",
    )


def _bit(place: Column, longs: Column) -> Column:
    long = F.get(longs, F.shiftrightunsigned(place, 6).cast("int"))
    shifted = F.call_function("shiftrightunsigned", long, place.bitwiseAND(F.lit(63)).cast("int"))
    return shifted.bitwiseAND(F.lit(1)) == 1


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    return hit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans", "text_hash")
