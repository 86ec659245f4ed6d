"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from llm import blocklist, decontaminate, html, line_dedup, mixing, ngram_join, quality, substring_dedup, suffix_dedup, toxicity
from pyspark.sql import functions as F

LONG = " ".join(f"w{k % 9973}" for k in range(60_000))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta", "a"),
    (1, "alpha beta gamma delta epsilon zeta eta theta", "a"),
    (2, None, None),
    (3, "", "a"),
    (None, "alpha beta gamma delta epsilon zeta eta theta", "b"),
    (None, None, None),
    (4, LONG, "b"),
    (5, LONG + " tail", "b"),
    (6, " \t\n\r ", None),
    (7, "é   x\x1cy", "c"),
]
SCHEMA = "doc_id long, text string, source string"
EXTRA = ("n", "key", "at", "token", "gone", "keys", "n_words", "size", "target", "bucket", "signature", "component_id", "keep")


def docs_of(spark, rows=ROWS):
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.withColumns({name: F.lit("clash") for name in EXTRA})


ITEMS = "item_id long, text string"
LABELS = "doc_id long, quality int, toxic int"


def decontaminated(docs):
    spark = docs.sparkSession
    return decontaminate.hit_documents(docs, spark.createDataFrame([(9, "gamma delta"), (None, "x"), (8, None)], ITEMS))


def scored(docs):
    labels = docs.sparkSession.createDataFrame([(1, 1, 1), (3, 0, 0), (4, None, None), (None, 1, 1)], LABELS)
    return toxicity.score(docs, toxicity.learn(docs, labels))


OPERATORS = {
    "ngram_join": ngram_join.near_duplicates,
    "substring": substring_dedup.dedup_substrings,
    "suffix": suffix_dedup.dedup_passages,
    "quality": quality.quality,
    "keep_good": quality.keep_good,
    "toxicity": scored,
    "mixing": mixing.mix,
    "decontamination": decontaminated,
    "lines": line_dedup.dedup_lines,
}
#: These give a row per document or kept row, the others a row per row.
FEWER = {"decontamination": 9, "keep_good": 0}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(spark, name):
    got = OPERATORS[name](docs_of(spark)).collect()
    if name != "keep_good":
        assert len(got) == FEWER.get(name, len(ROWS))


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_no_rows(spark, name):
    assert OPERATORS[name](docs_of(spark, [])).collect() == []


def by_id(frame, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in frame.collect() if r["doc_id"] is not None}


def test_ngram_join_values(spark):
    got = by_id(ngram_join.near_duplicates(docs_of(spark)), "n_shingles", "component_id")
    assert got[1] == (4, 1) and got[2] == (0, 2) and got[3] == (0, 3) and got[6] == (0, 6)
    assert got[4][1] == got[5][1] == 4
    rows = ngram_join.near_duplicates(docs_of(spark)).where("doc_id IS NULL").collect()
    assert sorted((r.n_shingles, r.component_id or 0) for r in rows) == [(0, 0), (4, 1)]


def test_substring_values(spark):
    got = by_id(substring_dedup.dedup_substrings(docs_of(spark)), "n_words", "n_removed")
    assert got[1] == (8, 0) and got[2] == (0, 0) and got[4] == (60_000, 0) and got[5] == (60_001, 60_000)
    assert got[7][0] == 2


def test_suffix_values(spark):
    got = by_id(suffix_dedup.dedup_passages(docs_of(spark)), "n_words", "n_removed")
    assert got[4] == (60_000, 0) and got[5] == (60_001, 60_000) and got[1] == (8, 0)


def test_mixing_values(spark):
    rows = mixing.mix(docs_of(spark)).collect()
    assert sum(r.taken for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows), abs=3)
    assert {r.source_size for r in rows if r.source is None} == {0}


def test_decontamination_values(spark):
    got = by_id(decontaminated(docs_of(spark)), "n_words", "n_hit", "n_items", "contaminated")
    assert got[1] == (8, 2, 1, True) and got[2] == (0, 0, 0, False)
    none = docs_of(spark).sparkSession.createDataFrame([], ITEMS)
    assert not any(r.contaminated for r in decontaminate.hit_documents(docs_of(spark), none).collect())


def test_keep_good_keeps_columns(spark):
    good = "The quick study of many words shows how a plain text of some length passes, since nothing in it repeats at all here."
    frame = docs_of(spark, [(1, good, "a"), (2, "short", "a")])
    (row,) = quality.keep_good(frame).collect()
    assert row.doc_id == 1 and row.keep == "clash" and row.text == good


def test_lines_keep_columns(spark):
    rows = line_dedup.dedup_lines(docs_of(spark)).collect()
    assert all(r.gone == "clash" for r in rows)
    assert all(r.n_removed == 0 for r in rows if r.doc_id != 5)


def test_scores(spark):
    rows = scored(docs_of(spark)).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)


PAGES = "page_id long, url string, html string, text string, host string, key string"


def test_pages(spark):
    rows = [(1, None, None, "x", "x", "x"), (1, None, None, "x", "x", "x"), (None, "http://a.org/", "<p>t", "x", "x", "x"),
            (2, "http://a.org/", "<p>" + "long text " * 200_000, "x", "x", "x")]
    pages = spark.createDataFrame(rows, PAGES)
    got = html.extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 1), (1, 0), (1, 0), (2, 1_999_999)]
    rules = spark.createDataFrame([("org", "/", "block"), ("org", "/", "allow"), (None, "/", "block"), ("ORG", None, "block")],
                                  "host string, path string, verdict string")
    got = blocklist.filter_urls(pages, rules, lanes=3).collect()
    assert sorted((r.page_id or 0, r.rule or "", r.verdict) for r in got) == [
        (0, "org/", "block"), (1, "", "allow"), (1, "", "allow"), (2, "org/", "block")]
    assert {r.verdict for r in blocklist.filter_urls(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert html.extract(pages.limit(0)).collect() == [] == blocklist.filter_urls(pages.limit(0), rules).collect()
