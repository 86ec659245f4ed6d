"""Merkle manifest of a data set, with a proof per row found by pointer jumping.

A row is a leaf: the digest of its fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and
its value. Within a source, leaves ascend by id; every ``fan`` consecutive nodes, the last run
perhaps fewer, become the digest of their digests, until one node is left. The sources' nodes, by
source with null first, likewise give the root. Digests are SHA-256 of the inputs' lowercase hex
text; tables hold them as 32 bytes.

The tree is built some levels a shuffle, in groups of ``fan ** LEVELS`` leaves. Every node then
holds a *segment*: the siblings on its way to an ancestor, at first its parent. Joining the nodes
with themselves doubles that distance and appends the ancestor's segment. In round k only nodes at
least 2^k above their deepest leaf can be such ancestors, so the tables shrink by the power fan^(2^k),
and an ancestor is shared by at most fan^(2^k) nodes: no key is hot unless its table is so small
that the planner, which knows its size, broadcasts it. Texts are read once and never shuffled.

Sources of any size are cut by ranges of (source, id, leaf), so none rests on one task. Null ids
come first; rows of equal ids follow their digests, and rows equal in all fields are
interchangeable. A null source is a source of its own, and null, empty and long texts are values
like others. No rows: no manifest. Further columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import CRC_SQL, crc_sql, table
from playlens.operators.ids import dense_ids, numbered_in_order
from playlens.session import pin, shuffle_partitions

FAN = 3
#: Levels of the tree built from one shuffle.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# A node is named by its tree (a source's number, or TOP), its level there and its place in that level.
TOP = -1
_NODE = ("tree", "level", "at")
_STEP = "struct<left:binary,right:binary>"


class Manifest(NamedTuple):
    """``leaves``: doc_id, source, leaf, other, subroot, path (left and right siblings from the leaf to the root).

    ``root`` is None, and ``leaves`` empty, where there are no rows.
    """

    leaves: DataFrame
    root: bytes | None


def digest(content: Column) -> Column:
    """SHA-256 as bytes."""
    return F.unhex(F.sha2(content, 256))


def as_hex(digests: Column) -> Column:
    """One or more digests as lowercase hex text."""
    return F.lower(F.hex(digests))


def leaf(fields: list[Column]) -> Column:
    """The digest of a row; lengths before the values keep fields apart."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (source, doc_id, leaf, other) with ``tree``, the source's number, ``at``, the place in it, and ``n``, its rows."""
    placed = numbered_in_order(rows, ["source", "doc_id", "leaf"], shuffle_partitions(rows.sparkSession), "leaves")
    trees = dense_ids(placed, "source", "tree")
    runs = placed.groupBy("source", "_part").agg(F.min("_pos").alias("first"), F.count("*").alias("size"))
    same = Window.partitionBy("source")
    earlier = same.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A run per range and source, so a source has at most as many as there are ranges.
    runs = runs.withColumn("shift", F.coalesce(F.sum("size").over(earlier), F.lit(0)) - F.col("first")).withColumn(
        "n", F.sum("size").over(same))
    runs = pin(runs.alias("r").join(trees.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        "r.source", "_part", "shift", "n", "tree"), "runs")
    here = (F.col("p._part") == F.col("r._part")) & F.col("p.source").eqNullSafe(F.col("r.source"))
    return placed.alias("p").join(runs.alias("r"), here).select(
        "doc_id", "p.source", "leaf", "other", "tree", (F.col("_pos") + F.col("shift")).alias("at"), "n")


def _grown(nodes: DataFrame, fan: int) -> DataFrame:
    """Up to LEVELS levels above ``nodes`` (tree, level, at, n nodes in that level, digest, height), in groups of nodes that
    share an ancestor: of each node the same columns, ``steps`` (levels above ``nodes``), and its siblings ``left`` and ``right``."""
    groups = nodes.groupBy("tree", "level", "n", F.expr(f"at div {fan ** LEVELS}").alias("group")).agg(
        F.array_sort(F.collect_list(F.struct("at", "digest", "height"))).alias("nodes0"))
    made = []
    for k in range(LEVELS + 1):
        # A level of one node has no run; the last level's runs are made by the next call.
        alone = F.ceil(F.col("n") / fan ** k) <= 1
        runs = F.expr(f"transform(sequence(0, cast(ceil(size(nodes{k}) / {fan}) as int) - 1), r -> slice(nodes{k}, r * {fan} + 1, {fan}))")
        if k < LEVELS:
            none = F.expr("cast(array() as array<array<struct<at:bigint,digest:binary,height:int>>>)")
            groups = groups.withColumn(f"runs{k}", F.when(alone | (F.size(f"nodes{k}") == 0), none).otherwise(runs))
            groups = groups.withColumn(f"nodes{k + 1}", F.expr(
                f"transform(runs{k}, r -> named_struct('at', r[0].at div {fan}, 'digest', unhex(sha2(lower(hex("
                "aggregate(r, X'', (all, x) -> concat(all, x.digest)))), 256)), 'height', array_max(r.height) + 1))"))
            made.append(F.expr(
                f"flatten(transform(runs{k}, r -> transform(r, (x, i) -> named_struct('steps', {k}, 'at', x.at, "
                "'digest', x.digest, 'height', x.height, 'left', aggregate(slice(r, 1, i), X'', (all, y) -> concat(all, y.digest)), "
                f"'right', aggregate(slice(r, i + 2, {fan}), X'', (all, y) -> concat(all, y.digest))))))"))
        else:
            alone = F.lit(True)
        # Without siblings: the only node of its level, or one whose siblings lie in other groups.
        last = F.expr(f"transform(nodes{k}, x -> named_struct('steps', {k}, 'at', x.at, 'digest', x.digest, "
                      "'height', x.height, 'left', cast(null as binary), 'right', cast(null as binary)))")
        made.append(F.when(alone, last).otherwise(F.slice(last, 1, 0)))
    return groups.select("tree", "level", "n", F.explode(F.concat(*made)).alias("node")).select(
        "tree", "level", "n", "node.*")


def _tree(nodes: DataFrame, fan: int) -> tuple[DataFrame, DataFrame]:
    """All nodes below the roots of ``nodes`` (tree, at, n, digest, height) with left, right and whether their parent is a root;
    and the roots (tree, digest, height)."""
    nodes = nodes.withColumn("level", F.lit(0))
    inner, roots = [], []
    while True:
        grown = pin(_grown(nodes, fan), "nodes")
        level = (F.col("level") + F.col("steps")).alias("level")
        last = F.expr(f"n <= power({fan}D, steps + 1)").alias("last")
        inner.append(grown.where("left IS NOT NULL").select("tree", level, "at", "digest", "height", "left", "right", last))
        above = grown.where("left IS NULL").select(
            "tree", level, "at", F.expr(f"cast(ceil(n / power({fan}D, steps)) as bigint)").alias("n"), "digest", "height")
        roots.append(above.where("n = 1").select("tree", "digest", "height"))
        nodes = above.where("n > 1")
        if nodes.isEmpty():
            break
    union = DataFrame.unionByName
    both = inner[0], roots[0]
    for more, ends in zip(inner[1:], roots[1:]):
        both = union(both[0], more), union(both[1], ends)
    return both


def _segments(nodes: DataFrame, fan: int) -> DataFrame:
    """``nodes`` with ``up`` (the parent's name) and ``path`` (one step); the root of a source's tree is a leaf of the top one."""
    up = F.struct("tree", (F.col("level") + 1).alias("level"), F.expr(f"at div {fan}").alias("at"))
    top = F.struct(F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("at"))
    return nodes.select(
        *_NODE, "digest", "height", F.when(F.col("last") & (F.col("tree") != TOP), top).otherwise(up).alias("up"),
        F.array(F.struct("left", "right")).cast(f"array<{_STEP}>").alias("path"))


def _jump(rows: DataFrame, ancestors: DataFrame) -> DataFrame:
    """``rows`` (up, path, subroot, ...) one segment of ``ancestors`` further."""
    kept = [name for name in rows.columns if name not in ("up", "path", "subroot")]
    far = ancestors.select(
        *[F.col(name).alias(f"_{name}") for name in _NODE], F.col("up").alias("_up"), F.col("path").alias("_path"),
        F.col("subroot").alias("_subroot"))
    same = [F.col(f"up.{name}") == F.col(f"_{name}") for name in _NODE]
    return rows.join(far, same).select(
        *kept, F.col("_up").alias("up"), F.concat("path", "_path").alias("path"),
        F.coalesce("subroot", "_subroot").alias("subroot"))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, other: Column | None = None, fan: int = FAN,
             doc_id: str = "doc_id", source: str = "source") -> Manifest:
    """The manifest of ``docs``; ``other`` is a digest to carry along with each leaf, as of a received copy."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        leaf([F.col(name) for name in fields]).alias("leaf"),
        (other if other is not None else F.lit(None).cast("binary")).alias("other"))
    rows = pin(_numbered(rows), "numbered")
    leaves = rows.select("tree", "at", "n", F.col("leaf").alias("digest"), F.lit(0).alias("height"))
    below, subroots = _tree(leaves, fan)
    subroots = pin(subroots, "subroots")
    count = subroots.count()
    if not count:
        empty = rows.select("doc_id", "source", "leaf", "other", F.col("leaf").alias("subroot"))
        return Manifest(empty.withColumn("path", F.array().cast(f"array<{_STEP}>")), None)
    above, root = _tree(subroots.select(
        F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("at"), F.lit(count).alias("n"), "digest", "height"), fan)
    root = root.first()

    # All nodes one step from their parents; a leaf of the top tree is the subroot on its rows' way.
    here = F.when((F.col("tree") == TOP) & (F.col("level") == 0), F.col("digest"))
    columns = [*_NODE, "height", "up", "path", "subroot"]
    nodes = _segments(below.unionByName(above), fan).withColumn("subroot", here).select(columns)
    # The root is its own ancestor by no step.
    levels = above.agg(F.max("level")).first()[0]
    top = docs.sparkSession.range(1).select(
        F.lit(TOP).cast("bigint").alias("tree"), F.lit(0 if levels is None else levels + 1).alias("level"),
        F.lit(0).cast("bigint").alias("at"), F.lit(root["height"]).alias("height"), F.lit(root["digest"]).alias("digest"))
    top = top.withColumns({
        "up": F.struct(*_NODE), "path": F.array().cast(f"array<{_STEP}>"), "subroot": here}).select(columns)

    # Leaves: of a source's tree, or of the top one if the source has a single row.
    alone = F.col("n") == 1
    named = rows.withColumns({
        "_tree": F.when(alone, F.lit(TOP)).otherwise(F.col("tree")), "_at": F.when(alone, F.col("tree")).otherwise(F.col("at"))})
    everything = pin(nodes.unionByName(top), "segments-1")
    first = everything.where("height = 0").select(F.col("tree").alias("_tree"), F.col("at").alias("_at"), "up", "path", "subroot")
    paths = named.join(first, ["_tree", "_at"]).select("doc_id", "source", "leaf", "other", "up", "path", "subroot")
    reach, ancestors = 1, everything.where("height >= 1").select(columns)
    while root["height"]:
        paths = _jump(paths, ancestors)
        # The last jump may go nowhere, from the root to itself; it brings the digest of a subroot that is the root.
        if reach >= root["height"]:
            break
        reach *= 2
        ancestors = pin(_jump(ancestors.where(f"height >= {reach} OR height = {root['height']}"), ancestors), f"segments-{reach}")
    return Manifest(paths.drop("up"), bytes(root["digest"]))


def folded(leaf_: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(path, leaf_, lambda node, step: digest(as_hex(F.concat(step["left"], node, step["right"]))))


def proof(path: Column) -> Column:
    """All siblings on the way, left to right, level by level."""
    return F.aggregate(path, F.lit(b""), lambda all_, step: F.concat(all_, step["left"], step["right"]))


def tampered(docs: DataFrame) -> Column:
    """The leaf of a copy whose line feeds are gone where 2 divides the crc32 of the id."""
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    return leaf([*(F.col(name) for name in FIELDS[:-1]), F.coalesce(text, F.col("text"))])


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = manifest(docs, other=tampered(docs))
    root = F.lit(None if made.root is None else made.root.hex()).cast("string")
    back = as_hex(folded(F.col("other"), F.col("path")))
    return made.leaves.select(
        "doc_id", as_hex(F.col("leaf")).alias("leaf"), as_hex(F.col("subroot")).alias("subroot"), root.alias("root"),
        F.sha2(as_hex(proof(F.col("path"))), 256).alias("proof_sha256"), back.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


def _levels_sql(name: str, first: str) -> str:
    return f"""{name} AS (
  {first}
  UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 3, n
)"""


SQL = f"""
WITH RECURSIVE {CRC_SQL}, leaves AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
    {_leaf_sql(f"(CASE WHEN {crc_sql('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")} AS other
  FROM documents, crc
), numbered AS (
  SELECT *, (dense_rank() OVER (ORDER BY source NULLS FIRST) - 1)::BIGINT AS tree, count(*) OVER (PARTITION BY source) AS n,
    (row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1)::BIGINT AS pos FROM leaves
), {_levels_sql("nodes", "SELECT tree, 0::BIGINT AS level, pos, n, leaf AS digest FROM numbered")}, subroots AS (
  SELECT tree, digest AS subroot FROM nodes WHERE n = 1
), {_levels_sql("tops", "SELECT (-1)::BIGINT AS tree, 0::BIGINT AS level, tree AS pos, (SELECT count(*) FROM subroots) AS n, "
                        "subroot AS digest FROM subroots")}, steps AS (
  SELECT tree, level, pos,
    coalesce(string_agg(digest, '') OVER (before ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER (before ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM (SELECT * FROM nodes UNION ALL SELECT * FROM tops) WHERE n > 1
  WINDOW before AS (PARTITION BY tree, level, pos // 3 ORDER BY pos)
), ways AS (
  SELECT k.tree, k.pos, list(s.l || '|' || s.r ORDER BY s.tree < 0, s.level) AS way
  FROM numbered k JOIN steps s ON (s.tree = k.tree AND s.pos = k.pos // (3 ** s.level)::BIGINT)
    OR (s.tree = -1 AND s.pos = k.tree // (3 ** s.level)::BIGINT) GROUP BY k.tree, k.pos
), proven AS (
  SELECT doc_id, leaf, subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
    sha256(replace(array_to_string(coalesce(way, []), ''), '|', '')) AS proof_sha256,
    list_reduce([other] || coalesce(way, []), lambda d, s: sha256(split_part(s, '|', 1) || d || split_part(s, '|', 2))) AS folded_root
  FROM numbered JOIN subroots USING (tree) LEFT JOIN ways USING (tree, pos)
)
SELECT *, folded_root = root AS verified FROM proven
"""
