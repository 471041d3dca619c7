"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``. An item (i, q) says that
the first i rows are edited and the roles kept so far have brought the pattern to state q. Keeping, re-roling
and deleting row i lead from (i, q) to (i + 1, q'), an inserted row to (i, q'); each deduction adds a cost and
a letter. Its result is never less than its premise by (cost, audit), and two derivations of one item with equal
costs are never prefixes of each other (each has i letters besides its insertions, which cost), so items leave
the agenda in their final value: the first goal item popped is the cheapest repair, ties by least audit.

Rows are dealt by ranges of (conversation, turn, hash of role and text, row), so a conversation that holds any
part of the table is spread over many tasks. Whole conversations inside a range are solved where they lie. The
others become pieces of at most ``PIECE_ROWS`` rows: what is seen first where is found by one aggregate over
keys; each piece gives its counts and its lightest derivations from every state to every state; pieces are
joined in order, ``FAN`` at a time, by composing these; a last pass streams the pieces of a conversation
in order through its audit and one hash, one piece in memory at a time (a SHA-256 has no other way). One
result row holds the audit of its conversation, which is as long as that.

Rows of a conversation are ordered by turn, nulls first, then by the hash of role and text. A null role or text
is one space, so a row with a null text is blank. A null conversation id is a conversation of its own. Repeated
rows are duplicates. Texts of any length are kept whole. Further columns are ignored, whatever their names.
An empty table gives no row.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemart.llm import common
from tidemart.session import stored

PIECE_ROWS = 512
PIECE_CHARS = 1 << 20
FAN_BITS = 6
FAN = 1 << FAN_BITS
PART_BITS = 40

BEGIN, SYSTEM, USER, ASSISTANT = range(4)
STATES = (BEGIN, SYSTEM, USER, ASSISTANT)
STEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
DONE = (BEGIN, ASSISTANT)
# The role that the pattern wants next; a system row is only ever kept.
WANTED = ("user", "user", "assistant", "user")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
MOST = (1 << 63) - 1

_NOT_BLANK = re.compile(r"[^\x20\x09-\x0D]")
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PIECE = ("turns array<bigint>, roles array<string>, texts array<string>, keys array<binary>")
_ANSWER = (", ".join(f"{c} bigint" for c in _COUNTS)
           + ", audit string, repaired_sha256 string, first bigint, lines array<struct<role:string,text:string>>")
_SUMMARY = ("rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, tail string, "
            "low bigint, high bigint, turns bigint, costs array<bigint>, audits array<string>")


class Line(NamedTuple):
    turn: int | None
    role: str
    text: str
    key: bytes


class Part(NamedTuple):
    """Counts of neighbouring rows, and their lightest derivations from state to state (a row per start)."""

    rows: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    head: str
    tail: str
    low: int | None
    high: int | None
    turns: int
    ways: tuple[dict[int, tuple[int, str]], ...]

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else min(self.high - self.low + 1 - self.turns, MOST)


def faults(lines: Iterable[Line], new: set[bytes] | None = None) -> list[str]:
    """The first fault of each line or an empty text; ``new`` are the keys no earlier piece has."""
    seen: set[bytes] = set()
    found = []
    for line in lines:
        body = line.text.rstrip(common.SPACES)
        if not body:
            found.append("blank")
        elif line.key in seen or (new is not None and line.key not in new):
            found.append("duplicate")
        else:
            found.append("" if body[-1] in ".!?" else "truncated")
        seen.add(line.key)
    return found


def lightest(rows: list[tuple[str, str]], start: int, goals: tuple[int, ...], first: bool) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the goal items (all rows, state), from one start; only the first goal if asked.

    ``rows`` has the initial of the role and the fault of each row.
    """
    agenda = [(0, "", 0, start)]
    final: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str]] = {}
    while agenda:
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == len(rows):
            if state in goals:
                found[state] = (cost, audit)
                if first:
                    break
        else:
            initial, fault = rows[i]
            derived = [(DELETE, "D", state)]
            if fault not in ("blank", "duplicate"):
                more = TRUNCATED if fault else 0
                if (kept := STEP[state].get(initial)) is not None:
                    derived.append((more, "K", kept))
                derived.append((REROLE + more, "R", STEP[state][WANTED[state][0]]))
            for price, letter, after in derived:
                if (i + 1, after) not in final:
                    heapq.heappush(agenda, (cost + price, audit + letter, i + 1, after))
        after = STEP[state][WANTED[state][0]]
        if (i, after) not in final:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", i, after))
    return found


def summary(lines: list[Line], found: list[str], ways: tuple[dict[int, tuple[int, str]], ...]) -> Part:
    initials = [line.role[:1] or " " for line in lines]
    turns = [line.turn for line in lines if line.turn is not None]
    return Part(
        len(lines), found.count("blank"), found.count("duplicate"), found.count("truncated"),
        sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        initials[0] if lines else "", initials[-1] if lines else "",
        turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), ways)


def whole(lines: list[Line]) -> Part:
    found = faults(lines)
    rows = [(line.role[:1], fault) for line, fault in zip(lines, found)]
    return summary(lines, found, (lightest(rows, BEGIN, DONE, True),))


def piece(lines: list[Line], new: set[bytes]) -> Part:
    found = faults(lines, new)
    rows = [(line.role[:1], fault) for line, fault in zip(lines, found)]
    return summary(lines, found, tuple(lightest(rows, start, STATES, False) for start in STATES))


def joined(a: Part, b: Part) -> Part:
    """Two parts that follow each other as one."""
    if not a.rows or not b.rows:
        return a if a.rows else b
    ways = []
    for from_a in a.ways:
        best: dict[int, tuple[int, str]] = {}
        for middle, (cost, audit) in from_a.items():
            for end, (more, rest) in b.ways[middle].items():
                if end not in best or (cost + more, audit + rest) < best[end]:
                    best[end] = (cost + more, audit + rest)
        ways.append(best)
    known = [x for x in (a.low, b.low) if x is not None]
    highs = [x for x in (a.high, b.high) if x is not None]
    return Part(
        a.rows + b.rows, a.blank + b.blank, a.duplicate + b.duplicate, a.truncated + b.truncated,
        a.illegal + b.illegal + (a.tail + b.head not in LEGAL), a.head, b.tail,
        known[0] if known else None, highs[-1] if highs else None,
        a.turns + b.turns - (a.high is not None and a.high == b.low), tuple(ways))


class Script:
    """Plays an audit over the rows of a conversation, in any number of calls."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, BEGIN
        self.hash, self.written = hashlib.sha256(), 0

    def _write(self, role: str, text: str) -> tuple[str, str]:
        self.hash.update((("\n" if self.written else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.written += 1
        self.state = STEP[self.state][role[0]]
        return role, text

    def insertions(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._write(WANTED[self.state], "")

    def lines(self, lines: Iterable[Line]) -> Iterator[tuple[str, str]]:
        for line in lines:
            yield from self.insertions()
            letter = self.audit[self.at]
            self.at += 1
            if letter != "D":
                yield self._write(line.role if letter == "K" else WANTED[self.state], line.text)


def _answer(part: Part, cost: int, audit: str, digest: str) -> dict:
    return {"gaps": part.gaps, "blank": part.blank, "duplicate": part.duplicate, "truncated": part.truncated,
            "illegal": part.illegal, "cost": cost, "audit": audit, "repaired_sha256": digest}


def _solved(lines: list[Line], texts: bool) -> dict:
    part = whole(lines)
    (cost, audit), = part.ways[0].values()
    script = Script(audit)
    out = [*script.lines(lines), *script.insertions()]
    more = {"first": 0, "lines": [{"role": r, "text": t} for r, t in out]} if texts else {}
    return _answer(part, cost, audit, script.hash.hexdigest()) | more


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _deal(schema: pa.Schema, texts: bool, piece_rows: int):
    """Sorted rows of a range to answers of the conversations that lie in it and pieces of all others."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        held: list[Line] = []
        current, chars, inside, pieces, opened = None, 0, False, 0, False

        def cut() -> dict:
            nonlocal held, chars, pieces
            row = {"conv": current, "piece": part << PART_BITS | pieces,
                   "turns": [x.turn for x in held], "roles": [x.role for x in held],
                   "texts": [x.text for x in held], "keys": [x.key for x in held]}
            held, chars, pieces = [], 0, pieces + 1
            return row

        def close() -> dict | None:
            """A conversation has ended inside the range."""
            nonlocal held, chars
            if not inside or opened:
                return cut()
            row = {"conv": current, **_solved(held, texts)}
            held, chars = [], 0
            return row

        started = False
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                conv, turn, role, text, key, copies = row
                if not started:
                    current, started = conv, True
                elif conv != current:
                    out.append(close())
                    current, inside, opened = conv, True, False
                for _ in range(copies):
                    held.append(Line(turn, role, text, key))
                    chars += len(text)
                    if len(held) >= piece_rows or chars >= PIECE_CHARS:
                        out.append(cut())
                        opened = True
                if len(out) >= FAN:
                    yield _table(out, schema)
                    out = []
        if started:
            out.append(cut())
        if out:
            yield _table(out, schema)
    return deal


def _lines(row: dict) -> list[Line]:
    return [Line(*x) for x in zip(row["turns"], row["roles"], row["texts"], row["keys"])]


def _fields(part: Part) -> dict:
    costs = [way.get(end, (None, None))[0] for way in part.ways for end in STATES]
    audits = [way.get(end, (None, None))[1] for way in part.ways for end in STATES]
    return {**part._asdict(), "costs": costs, "audits": audits}


def _part(row) -> Part:
    cells = list(zip(row["costs"], row["audits"]))
    ways = tuple({end: (int(c), a) for end, (c, a) in zip(STATES, cells[4 * start:4 * start + 4]) if a is not None}
                 for start in STATES)
    ends = [None if pd.isna(row[c]) else int(row[c]) for c in ("low", "high")]
    counts = [int(row[c]) for c in ("rows", "blank", "duplicate", "truncated", "illegal")]
    return Part(*counts, row["head"], row["tail"], *ends, int(row["turns"]), ways)


def _pieces(schema: pa.Schema):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = piece(_lines(row), set(row["new"] or ()))
                fields = {k: v for k, v in _fields(part).items() if k != "ways"}
                yield _table([{"conv": row["conv"], "place": row["place"], **fields}], schema)
    return work


def _join_parts(columns: list[str]):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        part = reduce(joined, [_part(row) for row in rows.to_dict("records")])
        fields = _fields(part) | {"conv": rows["conv"].iloc[0], "place": rows["place"].iloc[0] >> FAN_BITS}
        out = pd.DataFrame({c: pd.Series([fields[c]], dtype=object) for c in columns})
        return out
    return work


def _play(schema: pa.Schema, texts: bool):
    """A conversation's result row, then its pieces in order: one hash over the repaired lines."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answer, script = None, None

        def end() -> dict:
            first, rest = script.written, list(script.insertions())
            lines = {"first": first, "lines": [{"role": r, "text": t} for r, t in rest]} if texts else {}
            return {**answer, "repaired_sha256": script.hash.hexdigest(), **lines}

        for batch in batches:
            for row in batch.to_pylist():
                if row["place"] < 0:
                    if script:
                        yield _table([end()], schema)
                    script = Script(row["audit"])
                    answer = {c: row[c] for c in ("conv", *_COUNTS, "audit")}
                    continue
                first = script.written
                lines = [{"role": r, "text": t} for r, t in script.lines(_lines(row))]
                if texts and lines:
                    yield _table([{"conv": row["conv"], "first": first, "lines": lines}], schema)
        if script:
            yield _table([end()], schema)
    return work


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _schema(conv: T.DataType, text: str) -> T.StructType:
    return T.StructType([T.StructField("conv", conv)] + list(T._parse_datatype_string(text).fields))


def _solve(rows: DataFrame, texts: bool, piece_rows: int) -> DataFrame:
    """Answers (one row per conversation with an audit; lines of repaired rows if ``texts``)."""
    common.arrow_rows(rows.sparkSession)
    kind = rows.schema["conv"].dataType
    answer = _schema(kind, _ANSWER)
    dealt_schema = _schema(kind, f"piece bigint, {_PIECE}, {_ANSWER}")
    order = ["conv", "turn", "key", "row"]
    ranges = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order)
    dealt = stored(ranges.sortWithinPartitions(*order).drop("row").mapInArrow(
        _deal(_arrow(dealt_schema), texts, piece_rows), dealt_schema), "conversations-dealt")
    done = dealt.where("piece IS NULL").select(*answer.fieldNames())
    return done.unionByName(_solve_pieces(dealt.where("piece IS NOT NULL"), kind, answer, texts))


def _solve_pieces(pieces: DataFrame, kind: T.DataType, answer: T.StructType, texts: bool) -> DataFrame:
    """The same for conversations in several pieces; numbers of pieces follow the order of their rows."""
    part = F.shiftright("piece", PART_BITS)
    # One row per range: as many as shuffle partitions.
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = stored(pieces.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
                   .select("part", "n", before.alias("before")), "conversations-ranges")
    number = F.col("before") + F.col("piece").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    placed = pieces.join(F.broadcast(parts), part == F.col("part")).select(
        "conv", number.alias("place"), "turns", "roles", "texts", "keys")
    first = (placed.select("conv", "place", F.explode("keys").alias("key"))
             .groupBy("conv", "key").agg(F.min("place").alias("place"))
             .groupBy(F.col("place").alias("at")).agg(F.collect_list("key").alias("new")))
    summary_schema = _schema(kind, f"place bigint, {_SUMMARY}")
    level = placed.join(first, F.col("place") == F.col("at"), "left").drop("at").mapInArrow(
        _pieces(_arrow(summary_schema)), summary_schema)
    left = (parts.agg(F.sum("n")).first()[0] or 0) - 1
    while True:
        level = stored(level.groupBy("conv", F.shiftright("place", FAN_BITS).alias("_group")).applyInPandas(
            _join_parts(summary_schema.fieldNames()), summary_schema), "conversations-level")
        left >>= FAN_BITS
        if left <= 0:
            break
    least = "array_min(filter(array({}), x -> x.cost IS NOT NULL))".format(", ".join(
        f"named_struct('cost', costs[{end}], 'audit', audits[{end}])" for end in DONE))
    found = level.withColumn("way", F.expr(least)).select(
        "conv", F.lit(-1).cast("bigint").alias("place"),
        F.expr(f"CASE WHEN low IS NULL THEN 0 ELSE coalesce(try_add(try_subtract(high, low), 1 - turns), {MOST}) END").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", F.col("way.cost").alias("cost"), F.col("way.audit").alias("audit"))
    every = found.unionByName(placed, allowMissingColumns=True)
    return every.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(
        _play(_arrow(answer), texts), answer)


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    who, what = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role, text))
    key = F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, what), 256))
    times = F.coalesce(F.col(copies).cast("int"), F.lit(0)) if copies else F.lit(1)
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), who.alias("role"),
                       what.alias("text"), key.alias("key"), times.alias("copies"))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           copies: str | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per conversation: faults counted, the cheapest repair's cost and audit, the hash of its lines.

    ``copies`` names a column with how often a row occurs; a conversation whose rows all have 0 is empty.
    """
    found = _solve(_prepared(rows, conv, turn, role, text, copies), False, piece_rows)
    return found.select(F.col("conv").alias(conv), *_COUNTS, "audit", "repaired_sha256")


def repaired_rows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text", copies: str | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The repaired conversations themselves: (conversation, position from 0, role, text)."""
    found = _solve(_prepared(rows, conv, turn, role, text, copies), True, piece_rows)
    lines = found.select("conv", "first", F.posexplode("lines").alias("at", "line"))
    return lines.select(F.col("conv").alias(conv), (F.col("first") + F.col("at")).alias("position"),
                        "line.role", "line.text")


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage by crc32(``conv_id:turn``) % 20: dropped rows stay with 0 copies."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    kind = F.crc32(F.concat_ws(":", conv, turn).cast("binary")) % 20
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair(damaged(common.table(spark, sf_dir, "conversations")), copies="copies")


# The same by dynamic programming over the rows of all conversations at once. Two insertions in a row suffice:
# a third leads back to a state that was there for less. The checksum goes byte by byte through its table.
SQL = r"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce([i] || range(8), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crcs
    FROM (SELECT unnest(range(256)) AS i)),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
            lambda x: CAST(ord(x) AS BIGINT)) AS codes
    FROM conversations),
hashed AS (
    SELECT * EXCLUDE (codes, crcs), xor(list_reduce([4294967295] || codes, lambda c, b:
        xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
    FROM keyed, crc_table),
live AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM hashed, (SELECT unnest(range(2)) AS copy) WHERE kind <> 0 AND copy <= CAST(kind = 3 AS INTEGER)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i,
        NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS is_cut
    FROM live),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS is_again FROM ranked),
lines AS (
    SELECT *, left(role, 1) AS initial, is_blank OR is_again AS goes, NOT is_blank AND NOT is_again AND is_cut AS cut,
        lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS next_initial
    FROM seen),
counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_again AND NOT is_blank) AS duplicate,
        count(*) FILTER (cut) AS truncated,
        count(*) FILTER (next_initial IS NOT NULL AND initial || next_initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM lines GROUP BY conv_id),
steps AS (
    SELECT * FROM (VALUES ('b', 's', 's'), ('b', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')) t(q, role, after)),
chart(conv_id, i, q, best) AS (
    SELECT conv_id, 0::BIGINT, q, best FROM counts,
        (VALUES ('b', {'cost': 0::BIGINT, 'audit': ''}), ('u', {'cost': 3, 'audit': 'I'}), ('a', {'cost': 6, 'audit': 'II'})) t(q, best)
    UNION ALL
    (WITH edited AS (
        SELECT c.conv_id, c.i + 1 AS i, e.after AS q,
            min({'cost': best.cost + e.cost, 'audit': best.audit || e.letter}) AS best
        FROM chart c JOIN lines l ON l.conv_id IS NOT DISTINCT FROM c.conv_id AND l.i = c.i,
        LATERAL (
            SELECT 4 AS cost, 'D' AS letter, c.q AS after
            UNION ALL SELECT CASE WHEN l.cut THEN 3 ELSE 0 END, 'K', s.after FROM steps s
            WHERE s.q = c.q AND s.role = l.initial AND NOT l.goes
            UNION ALL SELECT CASE WHEN l.cut THEN 6 ELSE 3 END, 'R', s.after FROM steps s
            WHERE s.q = c.q AND s.role <> 's' AND NOT l.goes) e
        GROUP BY 1, 2, 3),
    inserted AS (
        SELECT * FROM edited
        UNION ALL SELECT conv_id, i, after, {'cost': best.cost + 3, 'audit': best.audit || 'I'}
        FROM edited JOIN steps USING (q) WHERE role <> 's'
        UNION ALL SELECT conv_id, i, 'a', {'cost': best.cost + 6, 'audit': best.audit || 'II'}
        FROM edited WHERE q <> 'u')
    SELECT conv_id, i, q, min(best) FROM inserted GROUP BY 1, 2, 3)),
chosen AS (
    SELECT k.conv_id, any_value(k) AS counted, min(best) AS best
    FROM counts k JOIN chart c ON c.conv_id IS NOT DISTINCT FROM k.conv_id AND c.i = k.n AND c.q IN ('b', 'a')
    GROUP BY k.conv_id),
letters AS (
    SELECT conv_id, k, best.audit[k] AS letter, len(replace(best.audit[1:k], 'I', '')) - 1 AS i,
        len(replace(best.audit[1:k], 'D', '')) - 1 AS nth
    FROM (SELECT conv_id, best, unnest(range(1, len(best.audit) + 1)) AS k FROM chosen)),
written AS (
    SELECT a.conv_id, a.k, nth, letter, text, role, max(CASE WHEN nth = 0 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END)
        OVER (PARTITION BY a.conv_id) AS system
    FROM letters a LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM a.conv_id AND l.i = a.i AND letter <> 'I'
    WHERE letter <> 'D'),
repaired AS (
    SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (nth - system) % 2 = 0 THEN 'user' ELSE 'assistant' END
        || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS repaired
    FROM written GROUP BY conv_id)
SELECT o.conv_id, coalesce(c.counted.gaps, 0) AS gaps, coalesce(c.counted.blank, 0) AS blank, coalesce(c.counted.duplicate, 0) AS duplicate,
    coalesce(c.counted.truncated, 0) AS truncated, coalesce(c.counted.illegal, 0) AS illegal, coalesce(c.best.cost, 0) AS cost,
    coalesce(c.best.audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN chosen c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id"""
