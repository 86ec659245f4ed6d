"""Each stage of the pipeline on odd rows: nulls, repeated ids and rows, empty and long texts, clashing names, no rows."""

import random

import corpus_pipeline
import pytest
from llm import line_dedup
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)
EXTRA = ("n_lines", "n_removed", "__gone", "_part", "row", "text_hash", "id", "Version", "component_id", "n", "first", "c0")


def prose(seed, n=120):
    r = random.Random(seed)
    letters = "etaoinshrdlu"
    words = ["".join(r.choice(letters) for _ in range(r.randrange(2, 9))) for _ in range(n)]
    return ". ".join(" ".join(words[k:k + 12]) for k in range(0, n, 12)) + "."


ONE, TWO, THREE = prose(1), prose(2), prose(3)
LONG = "\n".join(prose(100 + k) for k in range(300))


def docs_of(spark, rows):
    frame = spark.createDataFrame([(i, t, None, "s" if i else None, None if t is None else len(t)) for i, t in rows], SCHEMA)
    return frame.withColumns({name: F.lit(f"extra {name}") for name in EXTRA})


def kept(frame):
    assert frame.columns == [*SCHEMA.replace(",", "").split()[::2], *EXTRA]
    rows = frame.collect()
    assert all(r[name] == f"extra {name}" for r in rows for name in EXTRA)
    return sorted(((r.doc_id, r.text) for r in rows), key=repr)


@pytest.fixture
def sf_dir(spark, tmp_path):
    items = [("i", " ".join(ONE.split()[20:40])), (None, "x"), ("n", None), ("e", "")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


ODD = [(None, None), (1, None), (2, ""), (3, " \n\t"), (None, "")]


def test_quality_rules(spark, sf_dir):
    got = kept(STAGES["quality_rules"](spark, docs_of(spark, [*ODD, (4, ONE), (4, ONE), (None, TWO), (5, LONG), (6, "w " * 300)]), sf_dir))
    assert got == sorted([(4, ONE), (4, ONE), (None, TWO), (5, LONG)], key=repr)


def test_line_dedup(spark, sf_dir):
    lines = f"{ONE}\n{TWO}"
    rows = [*ODD, (4, lines), (4, lines), (7, f"{TWO}\nown line"), (8, ONE), (None, ONE), (9, LONG), (10, f"new\n{LONG}")]
    got = kept(STAGES["line_dedup"](spark, docs_of(spark, rows), sf_dir))
    assert got == sorted([*ODD, (4, lines), (4, lines), (7, "own line"), (None, ONE), (9, LONG), (10, "new")], key=repr)


def test_near_dedup(spark, sf_dir):
    near = ONE.replace(ONE.split()[50], "other")
    rows = [*ODD, (5, ONE), (5, ONE), (5, TWO), (None, ONE), (None, near), (None, THREE), (None, THREE), (9, near), (9, "short"),
            (11, LONG), (12, LONG + " tail")]
    got = kept(STAGES["ngram_join"](spark, docs_of(spark, rows), sf_dir))
    texts = sorted(t for i, t in got if (i, t) not in ODD)
    assert texts == sorted([ONE, TWO, THREE, "short", LONG]) and (5, ONE) in got and (None, THREE) in got and (11, LONG) in got
    assert sum((i, t) in ODD for i, t in got) == len(ODD)


def test_near_dedup_of_rows_without_ids(spark, sf_dir):
    rows = [(None, ONE)] * 40 + [(None, TWO)] + [(None, None)] * 3
    got = kept(STAGES["ngram_join"](spark, docs_of(spark, rows), sf_dir))
    assert got == sorted([(None, ONE), (None, TWO), *[(None, None)] * 3], key=repr)


def test_decontamination(spark, sf_dir):
    rows = [*ODD, (4, ONE), (4, TWO), (5, TWO), (None, ONE), (None, TWO), (6, LONG + "\n" + ONE), (7, THREE), (7, THREE)]
    got = kept(STAGES["decontamination"](spark, docs_of(spark, rows), sf_dir))
    assert got == sorted([*ODD, (5, TWO), (None, TWO), (7, THREE), (7, THREE)], key=repr)


def test_mixing(spark, sf_dir):
    rows = STAGES["mixing"](spark, docs_of(spark, [*ODD, (4, ONE), (4, ONE), (None, TWO), (5, LONG)]), sf_dir).collect()
    assert len(rows) == 9 and all(0 <= r.taken <= 2 * r["size"] for r in rows)
    assert {r.taken for r in rows if r["size"] == 0} == {0}


@pytest.mark.parametrize("name", STAGES)
def test_no_rows(spark, sf_dir, name):
    assert STAGES[name](spark, docs_of(spark, []), sf_dir).collect() == []


def test_all_earlier_holders(spark):
    """Line dedup against pairs found plainly: the first holder of each key, and the first that has it once."""
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    lines = {i: [x for x in (t or "").split("\n") if x.split()] for i, t in docs.items()}
    held = {}
    for i, own in lines.items():
        for at in range(len(own)):
            words, key = 0, []
            for line in own[at:]:
                key.append(line.strip(" \t\r\x0b\x0c"))
                words += len(line.split())
                if words >= 10:
                    held.setdefault(tuple(key), {}).setdefault(i, []).append(at)
                    break
    earlier = {i: set() for i in docs}
    for holders in held.values():
        firsts = {min(holders), min((i for i, at in holders.items() if len(at) == 1), default=None)} - {None}
        for i in holders:
            earlier[i] |= {first for first in firsts if first < i}
    expected = {}
    for i, own in lines.items():
        stripped = [x.strip(" \t\r\x0b\x0c") for x in own]
        gone = set()
        for j in earlier[i]:
            other = [x.strip(" \t\r\x0b\x0c") for x in lines[j]]
            gone |= set(line_dedup.common_places(stripped, [len(x.split()) for x in own], other, 10))
        expected[i] = [x for k, x in enumerate(own) if k not in gone]
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: [x for x in r.text.split("\n") if x.split()] for r in line_dedup.dedup_lines(frame).collect()}
    assert got == expected and sum(map(len, lines.values())) - sum(map(len, expected.values())) == 881
