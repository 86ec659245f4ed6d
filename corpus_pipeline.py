"""The corpus pipeline: quality rules, line dedup, near duplicates, decontamination, mixing to target weights."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.decontaminate import hit_documents
from llm.line_dedup import dedup_lines, free_names
from llm.mixing import mix
from llm.ngram_join import near_duplicates
from llm.quality import keep_good
from llm.tables import table
from playlens.operators.ids import numbered_in_order
from playlens.session import pin, shuffle_partitions

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; null and empty texts are among them. Each row is judged by itself, whatever its id;
    long texts whole. No rows give none; further columns stay."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the blocks of lines that an earlier document has; those left without a word go.

    Rows of one id are one document: they delete nothing from each other. Rows with a null id, null and empty texts stay as
    they are. ``n_chars`` is counted again where lines went. No rows give none; further columns stay, whatever their names.
    """
    left = dedup_lines(docs)
    lines, gone = left.columns[-2:]
    left = left.where((F.col(gone) == 0) | (F.col(gone) < F.col(lines)))
    n_chars = F.when(F.col(gone) == 0, F.col("n_chars")).otherwise(F.length("text"))
    return left.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def _identified(docs: DataFrame, row: str) -> DataFrame:
    """``docs`` with a number of its own for each row: the id, and for rows with a null id or one that a row before has,
    in order of id and text, numbers above all ids. They are few, or the table has no ids; only they are sorted."""
    often = pin(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").select("doc_id"), "repeated-ids")
    if often.isEmpty():
        return docs.withColumn(row, F.col("doc_id").cast("long"))
    unique = docs.join(often, "doc_id", "left_anti").where("doc_id IS NOT NULL").select(docs.columns)
    odd = docs.join(often.where("doc_id IS NOT NULL"), "doc_id", "left_semi").select(docs.columns).unionByName(
        docs.where("doc_id IS NULL"))
    # By place, since the names added below might be taken.
    held = [f"c{k}" for k in range(len(docs.columns))]
    own, text = (F.col(held[docs.columns.index(name)]) for name in ("doc_id", "text"))
    odd = odd.toDF(*held).withColumns({"own": own, "hash": F.xxhash64(text), "content": text})
    placed = numbered_in_order(odd, ["own", "hash", "content"], shuffle_partitions(docs.sparkSession), "odd-rows")
    # Above all ids: a range of numbers for each partition.
    base = docs.agg(F.coalesce(F.max(F.col("doc_id").cast("long")), F.lit(0))).first()[0] + 1
    placed = placed.withColumn("number", F.lit(base) + F.shiftleft(F.col("_part").cast("long"), 40) + F.col("_pos"))
    firsts = placed.where("own IS NOT NULL").groupBy("own").agg(F.min("number").alias("first"))
    number = F.when(F.col("number") == F.col("first"), F.col("own").cast("long")).otherwise(F.col("number")).alias(row)
    placed = placed.join(firsts, "own", "left").select(*held, number).toDF(*docs.columns, row)
    return unique.withColumn(row, F.col("doc_id").cast("long")).unionByName(placed)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows whose texts are linked by links one stays, that with the least id.

    Rows with a null id, and further rows of an id, come after all others, by id and text; so of rows repeated under one id,
    or under none, one stays. Texts without a word, null ones too, are linked with nothing and all stay. No rows give
    none; further columns stay, whatever their names.
    """
    (row,) = free_names(docs.columns, "row")
    rows = _identified(docs, row)
    gone = near_duplicates(rows, doc_id=row).where("component_id < doc_id").select(F.col("doc_id").alias(row))
    return rows.join(gone, row, "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go: all rows of an id of which one text is hit. A null id is an id like
    others, but judged by its text alone. Null and empty texts stay. No rows give none; further columns stay."""
    (text_hash,) = free_names(docs.columns, "text_hash")
    hit = hit_documents(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select("doc_id", "text_hash").distinct()
    hit = pin(hit, "hit")
    kept = docs.join(hit.select("doc_id").where("doc_id IS NOT NULL").distinct(), "doc_id", "left_anti").withColumn(
        text_hash, F.xxhash64(F.col("text").cast("string")))
    unnamed = hit.where("doc_id IS NULL").select(F.col("text_hash").alias("_hit"))
    return kept.join(unnamed, kept["doc_id"].isNull() & (kept[text_hash] == unnamed["_hit"]), "left_anti").select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document; documents that it doesn't take have 0, null and empty texts among them. A null source
    is a source; rows of one id are rows like others. No rows give none; further columns are left out."""
    return mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_join", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: zstandard ratios, alignment and components have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
