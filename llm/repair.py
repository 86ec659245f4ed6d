"""Conversation structure repair: the cheapest edits that give roles ``(s?(ua)+)?``, as an audit of letters.

Rows of a conversation are taken by turn, nulls first; ties by role, then by the digest of the text.
The first of these faults counts: *blank* (nothing but white space), *duplicate* (role and text of an
earlier row), *truncated* (the last character that is no white space is none of ``.!?``). Edits: Keep
costs 0, Rerole to user or assistant 3, Delete 4 and is the only one for a blank or duplicate row,
Insert of an empty user or assistant row 3, anywhere; a truncated row that stays adds 3. Among the
cheapest the audit that is ASCII-least counts. An audit determines the repaired rows: their number is
odd only where the first is a kept system row, and after it user and assistant alternate.

The search is a dynamic program over rows and the place in the pattern. The audits of its states
share their beginnings as linked nodes with a parent, a skew-binary ancestor far above (binary
lifting with one link a node) and a rolling hash. Equal costs are settled at the longest common
prefix, found over those ancestors by comparing hashes; no string is built before the end. Equal
beginnings are the same node, which shows a collision of hashes; nodes themselves are compared then.

A conversation's rows are sorted by Spark, which spills, and stream through one task: its audit is
one cell and the digest of its repaired rows is sequential, so more tasks would not shorten it. Of
each row one byte waits there until the audit is known; texts pass one by one in a second stream.

Null roles and texts count as one space, so such a text is blank and such a role illegal; a null id
is a conversation of its own. Empty texts are blank, texts of any length are judged whole, repeated
rows are duplicates. No rows: no result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import CRC_SQL, crc_sql, table
from playlens.session import pin

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3

# A row as one byte: four times its role, plus its fault.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

# Places in the pattern: nothing yet, after s, after u, after a. What may follow by role, and what a new role must be.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
KEPT = {SYSTEM: {START: AFTER_S}, USER: {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, ASSISTANT: {AFTER_U: AFTER_A}, OTHER: {}}
MADE = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
ROLES = {AFTER_U: "user", AFTER_A: "assistant"}

_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79A8C6E
#: Audits of short conversations that a task remembers, and how short these are.
REMEMBERED, SHORT = 1 << 16, 64


class Trail:
    """An audit: a letter after another audit. Each letter is put after an audit once, so equal audits are one object."""

    __slots__ = ("parent", "letter", "depth", "far", "hash")

    def __init__(self, parent: Trail | None = None, letter: str = ""):
        self.letter = letter
        if parent is None:
            self.parent, self.far, self.depth, self.hash = self, self, 0, 0
            return
        self.parent, self.depth = parent, parent.depth + 1
        self.hash = (parent.hash * _BASE + ord(letter)) % _PRIME
        far = parent.far
        # Two equal leaps in a row become one.
        self.far = far.far if parent.depth - far.depth == far.depth - far.far.depth else parent

    def text(self) -> str:
        letters, node = [], self
        while node.depth:
            letters.append(node.letter)
            node = node.parent
        return "".join(reversed(letters))


def _ancestor(node: Trail, depth: int) -> Trail:
    while node.depth > depth:
        node = node.far if node.far.depth >= depth else node.parent
    return node


def _by_hash(x: Trail, y: Trail) -> bool:
    return x.hash == y.hash


def _by_identity(x: Trail, y: Trail) -> bool:
    return x is y


def before(a: Trail, b: Trail, same=_by_hash) -> bool:
    """Is the audit ``a`` ASCII-less than ``b``?"""
    depth = min(a.depth, b.depth)
    x, y = _ancestor(a, depth), _ancestor(b, depth)
    if same(x, y):
        if x is not y:
            return before(a, b, _by_identity)
        return a.depth < b.depth
    while not same(x, y):
        if same(x.far, y.far):
            below = x, y
            x, y = x.parent, y.parent
        else:
            x, y = x.far, y.far
    if x is not y:
        return before(a, b, _by_identity)
    return below[0].letter < below[1].letter


class Best(NamedTuple):
    cost: int
    trail: Trail

    def then(self, letter: str, extra: int = 0) -> Best:
        return Best(self.cost + COSTS[letter] + extra, Trail(self.trail, letter))


def _better(one: Best | None, other: Best | None) -> Best | None:
    if one is None or other is None:
        return one or other
    if one.cost != other.cost:
        return one if one.cost < other.cost else other
    return one if one.trail is other.trail or before(one.trail, other.trail) else other


def _with_inserts(states: list[Best | None]) -> list[Best | None]:
    """The states after any inserts: one changes the place, two at most reach another; a round trip never pays."""
    start, after_s, after_u, after_a = states
    reached = after_u
    for state in (start, after_s):
        if state:
            reached = _better(reached, state.then(INSERT))
    return [start, after_s, _better(reached, after_a and after_a.then(INSERT)),
            _better(after_a, reached and reached.then(INSERT))]


def solve(codes: bytes) -> tuple[int, str]:
    """Cost and audit of a conversation given as one byte a row."""
    states: list[Best | None] = [Best(0, Trail()), None, None, None]
    for code in codes:
        role, fault = divmod(code, 4)
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        following: list[Best | None] = [None] * 4
        for place, state in enumerate(_with_inserts(states)):
            if state is None:
                continue
            following[place] = _better(following[place], state.then(DELETE))
            if fault in (BLANK, DUPLICATE):
                continue
            if place in KEPT[role]:
                to = KEPT[role][place]
                following[to] = _better(following[to], state.then(KEEP, extra))
            following[MADE[place]] = _better(following[MADE[place]], state.then(REROLE, extra))
        states = following
    states = _with_inserts(states)
    best = _better(states[START], states[AFTER_A])
    return best.cost, best.trail.text()


def prepared(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, mark (digest of the text), without nulls in role and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("mark"))


def _coded(rows: DataFrame) -> DataFrame:
    """``rows`` (of ``prepared``) by conversation and in order, each with its code and without its text."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    fault = F.when(trimmed == "", BLANK).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    slim = rows.select("conv_id", "turn", "role", "mark", role.alias("kind"), fault.alias("fault"))
    # One shuffle: what is partitioned by the conversation is so by conversation, role and text as well.
    same = Window.partitionBy("conv_id", "role", "mark").orderBy("turn")
    fault = F.when((F.col("fault") != BLANK) & (F.col("seen") > 1), DUPLICATE).otherwise(F.col("fault"))
    # Of equal rows of a turn the first seen comes first.
    return (
        slim.repartition("conv_id").withColumn("seen", F.row_number().over(same))
        .withColumn("code", (4 * F.col("kind") + fault).cast("int"))
        .sortWithinPartitions("conv_id", "turn", "role", "mark", "seen").select("conv_id", "turn", "code")
    )


AUDITS = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): AUDITS; gaps are turn numbers missing between others."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, str]] = {}

        def judged(conv_id: int | None, codes: bytearray, turns: list[int]) -> tuple:
            codes = bytes(codes)
            found = known.get(codes)
            if found is None:
                found = solve(codes)
                if len(codes) <= SHORT:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[codes] = found
            faults = [sum(codes.count(4 * role + fault) for role in range(4)) for fault in (BLANK, DUPLICATE, TRUNCATED)]
            illegal = sum((a >> 2, b >> 2) not in LEGAL for a, b in zip(codes, codes[1:]))
            first, last, distinct = turns
            gaps = min(last - first + 1 - distinct, (1 << 63) - 1) if distinct else 0
            return (conv_id, gaps, *faults, illegal, *found)

        def table_of(done: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64()] * 7 + [pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*done), types)],
                names=[part.split()[0] for part in AUDITS.split(", ")])

        current, codes, turns = None, bytearray(), [0, 0, 0]
        for batch in batches:
            done = []
            for conv_id, turn, code in zip(*(column.to_pylist() for column in batch.columns)):
                if codes and conv_id != current:
                    done.append(judged(current, codes, turns))
                    codes, turns = bytearray(), [0, 0, 0]
                current = conv_id
                codes.append(code)
                if turn is not None:
                    if not turns[2]:
                        turns = [turn, turn, 1]
                    elif turn != turns[1]:
                        turns = [turns[0], turn, turns[2] + 1]
            if done:
                yield table_of(done)
        if codes:
            yield table_of([judged(current, codes, turns)])

    return _coded(prepared(rows)).mapInArrow(work, AUDITS)


REPAIRED = "conv_id long, place long, edit string, role string, text string"


def repair(rows: DataFrame, found: DataFrame) -> DataFrame:
    """REPAIRED: the rows that stay or are put in by the audits ``found``, each conversation in order and in one partition."""
    texts = prepared(rows).select("conv_id", F.lit(1).alias("part"), "turn", "role", "mark", "text")
    nothing = F.lit(None)
    letters = found.select(
        "conv_id", F.lit(0).alias("part"), nothing.cast("long").alias("turn"), nothing.cast("string").alias("role"),
        nothing.cast("binary").alias("mark"), F.col("audit").alias("text"))
    both = letters.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "mark")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place = "", 0, START, 0
        for batch in batches:
            out: list[tuple] = []

            def put(conv_id: int | None, letter: str, role: str, text: str) -> None:
                nonlocal place
                place += 1
                out.append((conv_id, place, letter, role, text))

            def inserts(conv_id: int | None) -> None:
                nonlocal at, state
                while at < len(audit) and audit[at] == INSERT:
                    state = MADE[state]
                    put(conv_id, INSERT, ROLES[state], "")
                    at += 1

            for conv_id, part, role, text in zip(*(column.to_pylist() for column in batch.columns)):
                if part == 0:
                    audit, at, state, place = text, 0, START, 0
                    continue
                if at == 0:
                    inserts(conv_id)
                letter, at = audit[at], at + 1
                if letter == KEEP:
                    state = KEPT[{"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]][state]
                    put(conv_id, letter, role, text)
                elif letter == REROLE:
                    state = MADE[state]
                    put(conv_id, letter, ROLES[state], text)
                inserts(conv_id)
            if out:
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*out), types)],
                    names=[part.split()[0] for part in REPAIRED.split(", ")])

    return both.select("conv_id", "part", "role", "text").mapInArrow(work, REPAIRED)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the rows of ``repair`` as ``role:text``, joined by line feeds; read as they lie there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table_of(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([row[0] for row in done], pa.int64()), pa.array([row[1] for row in done], pa.string())],
                names=["conv_id", "repaired_sha256"])

        current, content = None, None
        for batch in batches:
            done = []
            for conv_id, place, role, text in zip(*(column.to_pylist() for column in batch.columns)):
                if place == 1:
                    if content:
                        done.append((current, content.hexdigest()))
                    current, content = conv_id, hashlib.sha256()
                else:
                    content.update(b"\n")
                content.update(f"{role}:{text}".encode())
            if done:
                yield table_of(done)
        if content:
            yield table_of([(current, content.hexdigest())])

    return repaired.select("conv_id", "place", "role", "text").mapInArrow(work, "conv_id long, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by the crc32 of ``conv_id:turn``, nulls being one space."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", "role", "text", kind.alias("kind")).where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(known("role")).alias("role"), text.alias("text"),
        F.explode(times).alias("time")).drop("time")


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    rows = damaged(conversations)
    found = pin(audits(rows), "audits")
    shown = digests(repair(rows, found))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    numbers = [F.coalesce(name, F.lit(0)).cast("long").alias(name)
               for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (
        every.alias("e").join(found.alias("f"), F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
        .join(shown.alias("s"), F.col("e.conv_id").eqNullSafe(F.col("s.conv_id")), "left")
        .select("e.conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))
    )


_SPACES_SQL = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

SQL = f"""
WITH RECURSIVE {CRC_SQL}, known AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), kinds AS (
  SELECT conv_id, turn, role, text, {crc_sql("k")} % 20 AS kind FROM known, crc
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
    rtrim(text, {_SPACES_SQL}) AS trimmed, left(role, 1) AS kind
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged)
), judged AS (
  SELECT *, CASE WHEN trimmed = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(kind) OVER (PARTITION BY conv_id ORDER BY i) || kind NOT IN ('su', 'ua', 'au') AS illegal
  FROM placed
), inserts(place, reached, letters, price, shown) AS (
  VALUES (0, 0, '', 0, ''), (1, 1, '', 0, ''), (2, 2, '', 0, ''), (3, 3, '', 0, ''),
    (0, 2, 'I', 3, chr(10) || 'user:'), (1, 2, 'I', 3, chr(10) || 'user:'), (3, 2, 'I', 3, chr(10) || 'user:'),
    (2, 3, 'I', 3, chr(10) || 'assistant:'), (0, 3, 'II', 6, chr(10) || 'user:' || chr(10) || 'assistant:'),
    (1, 3, 'II', 6, chr(10) || 'user:' || chr(10) || 'assistant:')
), edits(place, kind, letter, price, following, role) AS (
  VALUES (0, 's', 'K', 0, 1, NULL), (0, 'u', 'K', 0, 2, NULL), (1, 'u', 'K', 0, 2, NULL), (3, 'u', 'K', 0, 2, NULL),
    (2, 'a', 'K', 0, 3, NULL), (0, NULL, 'R', 3, 2, 'user'), (1, NULL, 'R', 3, 2, 'user'), (2, NULL, 'R', 3, 3, 'assistant'),
    (3, NULL, 'R', 3, 2, 'user'), (0, NULL, 'D', 4, 0, NULL), (1, NULL, 'D', 4, 1, NULL), (2, NULL, 'D', 4, 2, NULL),
    (3, NULL, 'D', 4, 3, NULL)
), states(conv_id, i, place, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 'shown': ''}} FROM judged
  UNION ALL
  SELECT s.conv_id, s.i + 1, e.following, min({{
    'cost': s.best.cost + n.price + e.price + (CASE WHEN j.fault = 'truncated' AND e.letter <> 'D' THEN 3 ELSE 0 END),
    'audit': s.best.audit || n.letters || e.letter,
    'shown': s.best.shown || n.shown || (CASE WHEN e.letter = 'D' THEN ''
      ELSE chr(10) || coalesce(e.role, j.role) || ':' || j.text END)}})
  FROM states s JOIN inserts n ON n.place = s.place
    JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.i = s.i + 1
    JOIN edits e ON e.place = n.reached AND (e.kind IS NULL OR e.kind = j.kind)
      AND (e.letter = 'D' OR j.fault NOT IN ('blank', 'duplicate'))
  GROUP BY s.conv_id, s.i, e.following
), totals AS (
  SELECT conv_id, max(i) AS n, count(DISTINCT turn) AS turns, max(turn) - min(turn) + 1 AS span,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM judged GROUP BY conv_id
), ends AS (
  SELECT t.conv_id, min({{'cost': s.best.cost + n.price, 'audit': s.best.audit || n.letters, 'shown': s.best.shown || n.shown}}) AS best
  FROM totals t JOIN states s ON s.conv_id IS NOT DISTINCT FROM t.conv_id AND s.i = t.n
    JOIN inserts n ON n.place = s.place AND n.reached IN (0, 3) GROUP BY t.conv_id
)
SELECT c.conv_id, coalesce(span - turns, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(best.shown[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
