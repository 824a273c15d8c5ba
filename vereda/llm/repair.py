"""Conversation structure repair: the cheapest edits that make a logged conversation
an optional system turn and then pairs of user and assistant turns.

Rows are shuffled by conversation and sorted by turn inside the tasks (secondary
sort). Each task streams its rows through ``mapInPandas`` and carries, across Arrow
batches, the cheapest way into each of four states with its running digest. Way
back pointers take four bytes a row; those of a conversation beyond ``BLOCK`` rows
leave the task as compressed blocks, a row of the stored output each, and a second
stream walks them from the last block to the first.

A conversation's digest is one running hash over its repaired rows, so its rows
pass one task in order whatever the plan; memory does not grow with them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from bindings.common import Catalog
from vereda.session import materialize

catalog = Catalog()

#: rows whose back pointers a task holds before it spills them
BLOCK = 4096
#: costs of the edits, and of an undeleted truncated row
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: states: nothing yet, system, user, assistant; the state and role that follow by a user or assistant turn
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
LETTERS = "DKR"
#: inserts before a row that can be needed, and those that end a conversation in a full pair
INSERTS = {q: [0, 1, 2] if q in (NOTHING, SYSTEM) else [0, 1] for q in NEXT}
CLOSING = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
UNREACHED = 0xFF
SPACES = " \t\n\x0b\f\r"


def prepared(rows: DataFrame) -> DataFrame:
    """``key, turn, role, text, present`` of ``conv_id, turn, role, text``; a NULL role or text is one space."""
    return rows.select(
        F.col("conv_id").cast("string").alias("key"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], F.lit(True).alias("present"),
    )


def damage(rows: DataFrame) -> DataFrame:
    """``prepared`` rows with a fault by CRC-32 of ``conv_id:turn`` modulo 20: 0 marks a
    row as absent, 1 empties its text, 2 takes ``[.!?]`` from it, 3 repeats it, 4 makes it a user's."""
    rows = prepared(rows)
    null_as_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.withColumn("fault", F.crc32(F.concat(null_as_space("key"), F.lit(":"), null_as_space("turn"))) % 20)
    fault = F.col("fault")
    return rows.select(
        "key", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (fault != 0).alias("present"), F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def secondary_sorted(rows: DataFrame) -> DataFrame:
    """Rows with their first fault, by conversation and turn, after one shuffle. A row is
    a duplicate if an earlier one of its conversation has its role and text: equal rows
    are neighbours in a first sort of the same partitions."""
    alike = W.partitionBy("key").orderBy(F.col("present").desc(), "role", "text", F.col("turn").asc_nulls_first())
    before = F.lag(F.struct("role", "text")).over(alike)
    end = F.rtrim("text", F.lit(SPACES))
    fault = (
        F.when(F.length(end) == 0, "blank")
        .when(F.col("duplicate"), "duplicate")
        .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    return (
        rows.repartition("key")
        .withColumn("duplicate", F.coalesce(before == F.struct("role", "text"), F.lit(False)))
        .withColumn("fault", fault)
        .select("key", F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNull().alias("no_turn"), "role", "text", "present", F.coalesce("fault", F.lit("")).alias("fault"))
        .sortWithinPartitions("key", F.col("no_turn").desc(), "turn", "role", "text", F.col("fault") == "duplicate")
    )


class Way:
    """The cheapest way into a state: its cost, its place among the ways by the letters
    of its edits, and the digest of what it has kept."""

    __slots__ = ("cost", "place", "digest", "rows")

    def __init__(self, cost: int, place: int, digest, rows: int):
        self.cost, self.place, self.digest, self.rows = cost, place, digest, rows

    def wrote(self, lines: list[str]) -> tuple:
        digest = self.digest.copy()
        for n, line in enumerate(lines, self.rows):
            digest.update(("\n" if n else "").encode() + line.encode("utf-8", "surrogatepass"))
        return digest, self.rows + len(lines)


def inserted(state: int, n: int) -> tuple[int, list[str]]:
    lines = []
    for _ in range(n):
        state = NEXT[state]
        lines.append(f"{ROLE[state]}:")
    return state, lines


class Repair:
    """One conversation, row by row."""

    def __init__(self):
        self.ways: list[Way | None] = [Way(0, 0, hashlib.sha256(), 0), None, None, None]
        self.links = bytearray()
        self.blocks = 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.turns, self.least, self.most, self.last_turn = 0, None, None, None
        self.last_role: str | None = None

    def moves(self, role: str, fault: str) -> Iterator[tuple[tuple, int, int, int, str, int]]:
        """(cost, place, letters), state reached, state left, inserts, letter, state before the row."""
        for left, way in enumerate(self.ways):
            if way is None:
                continue
            for n in INSERTS[left]:
                at = inserted(left, n)[0]
                base = way.cost + n * INSERT
                steps = [("D", at, DELETE)]
                if fault not in ("blank", "duplicate"):
                    late = TRUNCATED if fault == "truncated" else 0
                    steps.append(("R", NEXT[at], REROLE + late))
                    if role[:1] == ROLE[NEXT[at]][0]:
                        steps.append(("K", NEXT[at], late))
                    elif role[:1] == "s" and at == NOTHING:
                        steps.append(("K", SYSTEM, late))
                for letter, to, cost in steps:
                    yield (base + cost, way.place, "I" * n + letter), to, left, n, letter, at

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if fault:
            self.counts[fault] += 1
        if self.last_role is not None and self.last_role + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.last_role = role[:1]
        if turn is not None:
            self.turns += turn != self.last_turn
            self.least = turn if self.least is None else self.least
            self.most = self.last_turn = turn
        best: list = [None] * 4
        for move in self.moves(role, fault):
            if best[move[1]] is None or move[0] < best[move[1]][0]:
                best[move[1]] = move
        # no way's letters begin another's: all end in the letter of this row
        order = sorted((m[0][1:], q) for q, m in enumerate(best) if m)
        place = {q: i for i, (_, q) in enumerate(order)}
        ways: list[Way | None] = [None] * 4
        for q, move in enumerate(best):
            if move is None:
                self.links.append(UNREACHED)
                continue
            (cost, _, _), to, left, n, letter, at = move
            lines = inserted(left, n)[1]
            if letter != "D":
                lines.append(f"{role if letter == 'K' else ROLE[to]}:{text}")
            ways[q] = Way(cost, place[q], *self.ways[left].wrote(lines))
            self.links.append(left | n << 2 | LETTERS.index(letter) << 4)
        self.ways = ways

    def spilled(self) -> bytes:
        out = zlib.compress(bytes(self.links), 1)
        self.links.clear()
        self.blocks += 1
        return out

    def end(self) -> tuple[int, int, str, str]:
        """Cost, state, closing letters and digest of the cheapest repair."""
        cost, _, q = min((w.cost + INSERT * CLOSING[q], w.place, q) for q, w in enumerate(self.ways) if w)
        digest, _ = self.ways[q].wrote(inserted(q, CLOSING[q])[1])
        return cost, q, "I" * CLOSING[q], digest.hexdigest()

    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.turns


def walk_back(links: bytes, state: int) -> tuple[str, int]:
    """The letters of the way through a block that ends in ``state``, and the state it begins in."""
    parts = []
    for i in range(len(links) - 4, -4, -4):
        link = links[i + state]
        parts.append("I" * (link >> 2 & 3) + LETTERS[link >> 4])
        state = link & 3
    return "".join(reversed(parts)), state


STREAM = (
    "key string, block int, links binary, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, state int, audit string, repaired_sha256 string"
)


def stream(sorted_rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each conversation, and before it its spilled blocks. ``block`` is the
    number of a spilled block, and for the conversation's row how many there are; its
    ``audit`` is whole if there are none, else only the closing letters."""
    names = [x.split()[0] for x in STREAM.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, now, out = None, None, []

        def close():
            cost, state, closing, digest = now.end()
            if now.blocks and now.links:
                out.append((key, now.blocks, now.spilled(), *[None] * 9))
            audit = closing if now.blocks else walk_back(bytes(now.links), state)[0] + closing
            out.append((key, now.blocks, None, now.gaps(), *now.counts.values(), cost, state, audit, digest))

        for frame in frames:
            for own, turn, no_turn, role, text, present, fault in frame.itertuples(index=False, name=None):
                if now is None or own != key:
                    if now is not None:
                        close()
                    key, now = own, Repair()
                if present:
                    now.add(None if no_turn else turn, role, text, fault)
                    if len(now.links) >= 4 * block:
                        out.append((key, now.blocks, now.spilled(), *[None] * 9))
            yield pd.DataFrame(out, columns=names).astype({c: "Int64" for c in (*names[3:9], "block", "state")})
            out = []
        if now is not None:
            close()
            yield pd.DataFrame(out, columns=names).astype({c: "Int64" for c in (*names[3:9], "block", "state")})

    return sorted_rows.mapInPandas(run, STREAM)


def spilled_audits(found: DataFrame) -> DataFrame:
    """``key, audit`` of the conversations with spilled blocks, walked from the last block to the first."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = 0
        for frame in frames:
            out = []
            for key, block, links, end, audit in frame.itertuples(index=False, name=None):
                if links is None:
                    state = int(end)
                    out.append((key, block, audit))
                else:
                    letters, state = walk_back(zlib.decompress(links), state)
                    out.append((key, block, letters))
            yield pd.DataFrame(out, columns=["key", "block", "part"])

    # a conversation's own row has the highest number, so it comes first
    back = found.where("links IS NOT NULL OR block > 0").select("key", "block", "links", "state", "audit")
    back = back.repartition("key").sortWithinPartitions("key", F.col("block").desc())
    parts = back.mapInPandas(run, "key string, block int, part string")
    whole = F.array_sort(F.collect_list(F.struct("block", "part")))
    return parts.groupBy("key").agg(F.concat_ws("", F.transform(whole, lambda x: x["part"])).alias("audit"))


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``:
    a row for each conversation of ``prepared`` or ``damage``d rows.

    Rows go by turn, NULL turns first; rows of one turn by role and text. ``audit`` has
    a letter for each edit, Delete, Insert, Keep or Rerole, the ASCII-least of the
    cheapest. Repeated rows are duplicates. A NULL ``conv_id`` is a conversation. Rows
    that are not ``present`` only show that their conversation exists; one without other
    rows has zeros, an empty audit and the digest of nothing. No rows give no rows. A
    task holds one row's text at a time and ``block`` rows' pointers.
    """
    found = materialize(stream(secondary_sorted(rows), block), "repair")
    audits = materialize(spilled_audits(found), "repair-audits").select(F.col("key").alias("spilled_key"), F.col("audit").alias("spilled_audit"))
    own = found.where("links IS NULL").join(audits, F.col("key").eqNullSafe(F.col("spilled_key")), "left")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return own.select("key", *names, F.when(F.col("block") > 0, F.col("spilled_audit")).otherwise(F.col("audit")).alias("audit"), "repaired_sha256")


def repaired_rows(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``key, position, turn, role, text``: the conversations as ``repair``'s audits leave
    them; inserted rows have no turn."""
    by_turn = W.partitionBy("key").orderBy(*_order())
    numbered = rows.where("present").withColumn("row", F.row_number().over(by_turn))
    edits = audits.where("audit <> ''").select("key", F.posexplode(F.split("audit", "")).alias("at", "letter"))
    edits = edits.withColumn("row", F.sum((F.col("letter") != "I").cast("int")).over(W.partitionBy("key").orderBy("at")))
    same = F.col("e.key").eqNullSafe(F.col("n.key")) & (F.col("e.row") == F.col("n.row")) & (F.col("e.letter") != "I")
    kept = edits.alias("e").where("letter <> 'D'").join(numbered.alias("n"), same, "left").select("e.key", "at", "letter", "turn", "role", "text")
    line = W.partitionBy("key").orderBy("at")
    first = F.first(F.struct("letter", F.substring("role", 1, 1).alias("initial"))).over(line)
    place = F.row_number().over(line) - 1
    kept = kept.withColumn("position", place).withColumn("system", (first["letter"] == "K") & (first["initial"] == "s"))
    role = F.when((F.col("position") - F.coalesce(F.col("system"), F.lit(False)).cast("int")) % 2 == 0, "user").otherwise("assistant")
    return kept.select("key", "position", "turn", F.when(F.col("letter") == "K", F.col("role")).otherwise(role).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _sql() -> str:
    """The same in SQL: CRC-32 bit by bit, and one step of a recursion for each row that
    keeps the cheapest way into each state."""
    crc = "xor(acc, b)"
    for k in range(8):
        crc = f"list_transform([{crc}], lambda c{k}: xor(c{k} >> 1, 3988292384 * (c{k} & 1)))[1]"
    return rf"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS name FROM conversations),
hashed AS (
  SELECT *, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(1, octet_length(name) + 1), lambda i: ('0x' || substr(hex(name), 2 * i - 1, 2))::BIGINT),
    lambda acc, b: {crc})) % 20 AS k FROM source),
damaged AS (
  SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))),
numbered AS (
  SELECT *, min(i) OVER (PARTITION BY conv_id, role, text) < i AS seen, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS tail
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)),
faults AS (
  SELECT *, left(role, 1) AS r, CASE WHEN tail = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN right(tail, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM numbered),
-- ways over inserts before a row, then over the row: state left, at, reached
nexts(q, nq) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
inserts AS (
  SELECT q, q AS at, 0 AS n, '' AS lines FROM nexts
  UNION ALL SELECT q, nq, 1, chr(10) || CASE nq WHEN 2 THEN 'user:' ELSE 'assistant:' END FROM nexts
  UNION ALL SELECT q, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:' FROM nexts WHERE q < 2),
ways AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i + 1, to_q, min(c), first(a ORDER BY c, a), first(l ORDER BY c, a) FROM (
    SELECT w.conv_id, w.i, s.to_q, w.cost + 5 * n.n + s.c + CASE WHEN s.e <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END AS c,
      w.audit || repeat('I', n.n) || s.e AS a,
      w.lines || n.lines || CASE s.e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text ELSE chr(10) || CASE s.to_q WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text END AS l
    FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    JOIN inserts n ON n.q = w.q
    JOIN (SELECT q AS at, q AS to_q, 'D' AS e, 2 AS c, NULL AS r FROM nexts
          UNION ALL SELECT q, nq, 'R', 1, NULL FROM nexts
          UNION ALL SELECT q, nq, 'K', 0, CASE nq WHEN 2 THEN 'u' ELSE 'a' END FROM nexts
          UNION ALL SELECT 0, 1, 'K', 0, 's') s
      ON s.at = n.at AND (s.e = 'D' OR f.fault NOT IN ('blank', 'duplicate')) AND (s.e <> 'K' OR s.r = f.r)) GROUP BY conv_id, i, to_q),
ends AS (
  SELECT conv_id, min(c) AS cost, first(a ORDER BY c, a) AS audit, first(l ORDER BY c, a) AS lines FROM (
    SELECT w.conv_id, cost + 5 * m AS c, audit || repeat('I', m) AS a, w.lines || x AS l FROM ways w
    JOIN (VALUES (0, 0, ''), (1, 2, chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 1, chr(10) || 'assistant:'), (3, 0, '')) e(q, m, x) ON e.q = w.q
    WHERE i = (SELECT count(*) FROM faults f WHERE f.conv_id IS NOT DISTINCT FROM w.conv_id)) GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM faults) GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, cost, audit, sha256(substr(lines, 2)) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""


@catalog.add(_sql())
def op13_repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by rule and repaired."""
    rows = damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return repair(rows).select(F.col("key").cast("long").alias("conv_id"), *[c for c in "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()])
