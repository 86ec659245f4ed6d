"""The manifest against a plain tree: every leaf, proof and root."""

import collections
import hashlib
import random
import zlib

import pyarrow.dataset
import pytest
from llm import merkle
from llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k:k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def brute(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
    by_source = collections.defaultdict(list)
    for row in rows:
        by_source[row["source"]].append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in sources:
        members = sorted(by_source[source], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees.append((members, levels([leaf(r, r["text"]) for r in members])))
    top = levels([tree[-1][0] for _, tree in trees])
    out = []
    for number, (members, tree) in enumerate(trees):
        for place, row in enumerate(members):
            way = []
            for nodes, at in ((tree, place), (top, number)):
                for level in nodes[:-1]:
                    run = at // 3 * 3
                    way.append((level[run:at], level[at + 1:run + 3]))
                    at //= 3
            text = row["text"]
            if text is not None and row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(row, text)
            for left, right in way:
                node = sha("".join(left) + node + "".join(right))
            proof = sha("".join("".join(left + right) for left, right in way))
            out.append((row["doc_id"], tree[0][place], tree[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=lambda r: tuple(map(str, r)))


def manifest_of(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS tree", "1 AS at", "'y' AS path", "2 AS n", "'z' AS level")
    path = str(tmp_path / "documents.parquet")
    frame.write.mode("overwrite").parquet(path)
    got = QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).collect()
    return sorted(map(tuple, got), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table(spark, sf):
    rows = pyarrow.dataset.dataset(f"/root/testdata/{sf}/documents.parquet").to_table().to_pylist()
    got = QUERIES["op13_merkle_manifest"](spark, f"/root/testdata/{sf}").collect()
    assert sorted(map(tuple, got), key=lambda r: tuple(map(str, r))) == brute(rows)
    assert 0 < sum(r.verified for r in got) < len(got)


@pytest.mark.parametrize("n,n_sources", [(1, 1), (2, 1), (3, 3), (10, 10), (82, 1), (244, 2), (300, 250)])
def test_odd_rows(spark, tmp_path, n, n_sources):
    """Nulls everywhere, repeated ids and rows, empty and long texts, sources of one row and of many, clashing names."""
    r = random.Random(n)
    texts = [None, "", "a\nb", "long\n" * 30_000]
    rows = [
        {"doc_id": r.choice([None, i, i, i // 2]), "text": r.choice([*texts, f"é\n{i}"]), "lang": r.choice([None, "", "x"]),
         "source": r.choice([None, *map(str, range(n_sources))]), "n_chars": r.choice([None, i])}
        for i in range(n)
    ]
    assert manifest_of(spark, tmp_path, rows) == brute(rows)


def test_no_rows(spark, tmp_path):
    assert manifest_of(spark, tmp_path, []) == []


def test_other_width(spark):
    """Every path leads from its leaf to the one root, also with five nodes a run."""
    docs = spark.createDataFrame([(i, f"t{i}", None, f"s{i % 7}", i) for i in range(400)], SCHEMA)
    made = merkle.manifest(docs, fan=5)
    roots = made.leaves.select(merkle.folded(merkle.F.col("leaf"), merkle.F.col("path")).alias("root")).distinct().collect()
    assert [bytes(r.root) for r in roots] == [made.root] and made.leaves.count() == 400
