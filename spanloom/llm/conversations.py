"""Repair of conversation structure at least cost.

A repaired conversation is empty or has the roles ``s?(ua)+``. Turns are kept, given another role, deleted, and empty ones
inserted; of the cheapest edits those with the ASCII-least audit are made.

Turns are numbered by a range sort and cut into segments of SEGMENT rows. A recursive DuckDB query inside hash-partitioned
batches of whole segments solves them: each recursion advances one turn for all segments of the batch, keeping the least cost
and audit per start and grammar state. (Equal costs over the same turns never leave one audit a proper prefix of another, so
least audits stay least when segments are joined.) Joining a conversation's segments needs one row a segment
and pair of states; the turns themselves are then read in order, as a stream, with the audit that was found. A task never holds more than a batch,
however long a conversation is.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import duckdb
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import lookup, staged, table
from spanloom.llm.oracle import crc_sql
from spanloom.llm.ordered import batched, ranked, rows_of

SEGMENT, BATCH_ROWS = 256, 8192
#: Costs of the edits, and of a truncated turn that stays.
RENAME, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
_SPACE = " \t\n\x0b\x0c\r"
#: Grammar states: nothing yet (0), after the system turn (1), a user turn (2), an assistant turn (3).
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}
_ROLES = {"u": "user", "a": "assistant"}
_END = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}


def _inserts(state: int) -> list[tuple[str, int]]:
    """What can be inserted before a turn, and the state after; nothing that comes back to the same state."""
    out, seen = [("", state)], {state}
    while (state := _NEXT[state, _WANTED[state]]) not in seen:
        seen.add(state)
        out.append((f"{out[-1][0]}I", state))
    return out


def moves() -> list[tuple[int, str, str, int, int, int]]:
    """State, letters, the first character of the role that must be there (empty: any), whether the turn stays, cost, next state."""
    out = []
    for state in range(4):
        for letters, s in _inserts(state):
            cost = INSERT * len(letters)
            out.append((state, letters + "D", "", 0, cost + DELETE, s))
            out.append((state, letters + "R", "", 1, cost + RENAME, _NEXT[s, _WANTED[s]]))
            out += [(state, letters + "K", c, 1, cost, to) for (at, c), to in _NEXT.items() if at == s]
    return out


_MOVES = ", ".join(f"({s}, '{x}', '{c}', {stays}, {cost}, {to})" for s, x, c, stays, cost, to in moves())
#: turns: c (segment), pos (from 0), init, fault; segments: c, first (starts in state 0 only), size.
SOLVE = f"""
WITH RECURSIVE moves(state, letters, need, stays, cost, next) AS (VALUES {_MOVES}),
best(c, start, pos, state, cost, audit) AS (
  SELECT c, s, 0, s, 0::BIGINT, '' FROM segments, (VALUES (0), (1), (2), (3)) AS starts(s) WHERE s = 0 OR NOT first
  UNION ALL
  SELECT c, start, pos + 1, next, least_one.cost, least_one.audit FROM (
    SELECT b.c, b.start, b.pos, m.next, min({{'cost': b.cost + m.cost + CASE WHEN m.stays = 1 AND t.fault = {TRUNCATED} THEN {CUT_SHORT} ELSE 0 END, 'audit': b.audit || m.letters}}) AS least_one
    FROM best b JOIN turns t ON t.c = b.c AND t.pos = b.pos
    JOIN moves m ON m.state = b.state AND (m.stays = 0 OR t.fault NOT IN ({BLANK}, {DUPLICATE})) AND (m.need = '' OR m.need = t.init)
    GROUP BY b.c, b.start, b.pos, m.next)
)
SELECT b.c, b.start, b.state, b.cost, b.audit FROM best b JOIN segments s ON s.c = b.c AND s.size = b.pos
"""
_SOLVED = pa.schema([("grp", pa.string()), ("seg", pa.int64()), ("start", pa.int32()), ("state", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])


def solve(con: duckdb.DuckDBPyConnection, segments: list[tuple], turns: list[tuple]) -> list[tuple]:
    """(c, start, state, cost, audit) of each segment (c, first, size), from its turns (c, pos, init, fault)."""
    of = lambda rows, names, types: pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
    con.register("segments", of(segments, ["c", "first", "size"], [pa.int64(), pa.bool_(), pa.int64()]))
    con.register("turns", of(turns, ["c", "pos", "init", "fault"], [pa.int64(), pa.int64(), pa.string(), pa.int32()]))
    return con.execute(SOLVE).fetchall()


def _solved(batches):
    con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})

    def out():
        names, segments, turns = [], [], []
        for (grp, seg), rows in groupby(rows_of(batches), key=lambda r: r[:2]):
            before = len(turns)
            turns += [(len(names), at, init, fault) for _, _, at, init, fault in rows]
            segments.append((len(names), seg == 0, len(turns) - before))
            names.append((grp, seg))
            if len(turns) >= BATCH_ROWS:
                yield from ((*names[c], *x) for c, *x in solve(con, segments, turns))
                names, segments, turns = [], [], []
        if turns:
            yield from ((*names[c], *x) for c, *x in solve(con, segments, turns))

    return batched(out(), _SOLVED)


# ------------------------------------------------------------------ segments to conversations
def _better(x, y):
    """The lesser of (cost, pieces), pieces as (earlier pieces, audit) of equally many segments."""
    if y is None or x[0] != y[0]:
        return x if y is None or x[0] < y[0] else y
    a, b, mine, other = x[1], y[1], [], []
    while a is not b:  # what both share was compared before
        mine.append(a[1])
        other.append(b[1])
        a, b = a[0], b[0]
    return x if "".join(reversed(mine)) < "".join(reversed(other)) else y


def join_segments(segments) -> tuple[int, str]:
    """Least cost and audit of a conversation, from the (start, state, cost, audit) of each segment in order."""
    live = {0: (0, None)}
    for rows in segments:
        new: dict = {}
        for start, state, cost, audit in rows:
            if start in live:
                new[state] = _better((live[start][0] + cost, (live[start][1], audit)), new.get(state))
        live = new
    best = None
    for state, (cost, pieces) in live.items():
        best = _better((cost + _END[state][0], (pieces, _END[state][1])), best)
    cost, at = best
    out = []
    while at is not None:
        out.append(at[1])
        at = at[0]
    return cost, "".join(reversed(out))


def _joined(batches):
    def out():
        for grp, rows in groupby(rows_of(batches), key=lambda r: r[0]):
            yield grp, *join_segments([r[2:] for r in x] for _, x in groupby(rows, key=lambda r: r[1]))

    return batched(out(), pa.schema([("grp", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))


# ------------------------------------------------------------------ repair
_SUMMARY = pa.struct([(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])
_OUT = pa.schema([("grp", pa.string()), ("at", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()), ("summary", _SUMMARY)])
_OUT_DDL = "grp string, at long, edit string, role string, text string, summary struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string>"


def _conversation(rows):
    """The edits of one conversation, then its summary; rows: see repair."""
    cost, audit, letter, state, at, fault = 0, "", 0, 0, 0, 0
    counts, illegal, before, turns, low, high = [0] * 4, 0, None, 0, None, None

    def inserted():
        nonlocal letter, state, at
        while audit[letter : letter + 1] == "I":
            role = _WANTED[state]
            letter, state, at = letter + 1, _NEXT[state, role], at + 1
            yield at, "I", _ROLES[role], "", None

    for _, _, kind, turn, role, text, mark, own_cost, own_audit in rows:
        if kind == 1:
            cost, audit = own_cost, own_audit
        elif kind == 2:
            fault = mark
            counts[fault] += 1
        elif kind == 3:
            illegal += before is not None and before + role[:1] not in ("su", "ua", "au")
            before = role[:1]
            if turn is not None:
                low, turns, high = turn if low is None else low, turns + (turn != high), turn
            yield from inserted()
            edit, letter, at = audit[letter], letter + 1, at + 1
            if edit == "R":
                role = _ROLES[_WANTED[state]]
            if edit != "D":
                state = _NEXT[state, role[:1]]
            yield at, edit, role, text, None
    yield from inserted()
    gaps = 0 if low is None else high - low + 1 - turns
    yield at + 1, None, None, None, dict(zip(_SUMMARY.names, (gaps, *counts[1:], illegal, cost, audit), strict=True))


def _repaired(batches):
    return batched(((grp, *x) for grp, rows in groupby(rows_of(batches), key=lambda r: r[0]) for x in _conversation(rows)), _OUT)


def _group(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("-"))


def repair(spark: SparkSession, turns: DataFrame, ids: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The edits of every conversation, in order: grp, at (from 1), edit (K, R, D, I), role and text after it, and, in a
    last row whose edit is null, summary (gaps, blank, duplicate, truncated, illegal, cost, audit).

    turns: conv_id, turn, role, text, other columns are ignored. ids: conv_id, the conversations to answer for, with or without turns. grp is ``=`` and
    the id, or ``-`` for null. A null role or text is one space; turns go by number, null first, equal ones by role, the text's
    first 64 characters and its digest; a turn that repeats role and text of an earlier one is a duplicate whatever its number. An empty role can't be
    kept. Texts of any length pass through unread but for their last character. No turns: only the summary, of zeros and an empty audit. Rows of a conversation are neighbours in one partition of the result.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = turns.select(_group(F.col("conv_id")).alias("grp"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("digest", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    order = [F.col("turn").asc_nulls_first(), F.substring("role", 1, 64).asc(), F.substring("text", 1, 64).asc(), F.col("digest").asc()]
    rows = staged(spark, ranked(spark, staged(spark, rows), "grp", order))
    last = F.right(F.rtrim(F.col("text"), F.lit(_SPACE)), F.lit(1))
    marks = rows.select("grp", "idx", "digest", F.substring("role", 1, 1).alias("init"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("short"))
    first = staged(spark, rows.groupBy("grp", "digest").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("copies")))
    fault = F.when(F.col("blank"), BLANK).when(F.col("idx") > F.col("first"), DUPLICATE).when(F.col("short"), TRUNCATED).otherwise(0)
    marks = staged(spark, lookup(marks, first, ["grp", "digest"], "copies", rows.count()).select("grp", "idx", "init", fault.cast("int").alias("fault")))
    seg = F.floor(F.col("idx") / segment).cast("long")
    segments = marks.select("grp", seg.alias("seg"), (F.col("idx") - seg * segment).alias("at"), "init", "fault").repartition("grp", "seg").sortWithinPartitions("grp", "seg", "at")
    solved = segments.mapInArrow(_solved, "grp string, seg long, start int, state int, cost long, audit string")
    audits = solved.repartition("grp").sortWithinPartitions("grp", "seg").mapInArrow(_joined, "grp string, cost long, audit string")

    def part(df: DataFrame, kind: int, **have: str) -> DataFrame:
        types = {"pos": "long", "turn": "long", "role": "string", "text": "string", "fault": "int", "cost": "long", "audit": "string"}
        cols = [F.col(have[c]).alias(c) if c in have else F.lit(-1 if c == "pos" else None).cast(t).alias(c) for c, t in types.items()]
        return df.select("grp", cols[0], F.lit(kind).alias("kind"), *cols[1:])

    read = (
        part(ids.select(_group(F.col("conv_id")).alias("grp")).distinct(), 0)
        .unionByName(part(staged(spark, audits), 1, cost="cost", audit="audit"))
        .unionByName(part(marks, 2, pos="idx", fault="fault"))
        .unionByName(part(rows, 3, pos="idx", turn="turn", role="role", text="text"))
    )
    return read.repartition("grp").sortWithinPartitions("grp", "pos", "kind").mapInArrow(_repaired, _OUT_DDL)


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage: by crc32 of ``conv_id:turn`` (null: one space) modulo 20."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = turns.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"), copies.alias("copies"), kind.alias("kind"))
    return rows.where("kind <> 0").select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


_DIGESTS = pa.schema([("grp", pa.string()), *[(c, pa.int64()) for c in _SUMMARY.names[:-1]], ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _digests(batches):
    """Of each conversation's edits in order: its summary and the hash of what stays."""

    def out():
        said, empty = hashlib.sha256(), True
        for grp, _, edit, role, text, summary in rows_of(batches):
            if summary is not None:
                yield grp, *summary.values(), said.hexdigest()
                said, empty = hashlib.sha256(), True
            elif edit != "D":
                said.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False

    return batched(out(), _DIGESTS)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's counts, cost, audit and hash of every conversation after damage; other cases as in ``repair``."""
    turns = table(spark, sf_dir, "conversations")
    edits = repair(spark, damaged(turns), turns.select("conv_id"))
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    out = edits.mapInArrow(_digests, f"grp string, {counts}, audit string, repaired_sha256 string")
    return out.select(F.when(F.col("grp") != "-", F.substring("grp", 2, 40)).cast("long").alias("conv_id"), *[c for c in out.columns if c != "grp"])


def _lines(letters: str, state: int) -> tuple[str, str]:
    """The lines of inserted turns before a turn, and the role that the turn gets if it is renamed."""
    lines = ""
    for _ in letters[:-1]:
        lines += f"\\n{_ROLES[_WANTED[state]]}:"
        state = _NEXT[state, _WANTED[state]]
    return lines, _ROLES[_WANTED[state]]


_SQL_MOVES = ", ".join("({}, '{}', '{}', {}, {}, {}, E'{}', '{}')".format(*m, *_lines(m[1], m[0])) for m in moves())
_SQL_ENDS = ", ".join(f"({s}, {cost}, '{x}', E'{_lines(x + 'K', s)[0]}')" for s, (cost, x) in _END.items())
_KEY = "(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))"
OP12_SQL = f"""
WITH RECURSIVE moves(state, letters, need, stays, cost, next, lines, renamed) AS (VALUES {_SQL_MOVES}),
ends(state, cost, letters, lines) AS (VALUES {_SQL_ENDS}),
kinds AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc_sql(_KEY)} % 20 AS kind FROM conversations),
harmed AS (
  SELECT coalesce('=' || conv_id, '-') AS grp, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY turn NULLS FIRST, role, text) - 1 AS pos, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last FROM harmed
),
turns AS MATERIALIZED (
  SELECT *, role[1:1] AS init, lag(role[1:1]) OVER (PARTITION BY grp ORDER BY pos) || role[1:1] AS pair,
         CASE WHEN last = '' THEN 1 WHEN row_number() OVER (PARTITION BY grp, role, text ORDER BY pos) > 1 THEN 2 WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM numbered
),
counts AS (
  SELECT grp, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY grp
),
best(grp, pos, state, p) AS (
  SELECT grp, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 'lines': ''}} FROM counts
  UNION ALL
  SELECT b.grp, b.pos + 1, m.next, min({{'cost': b.p.cost + m.cost + CASE WHEN m.stays = 1 AND t.fault = 3 THEN 1 ELSE 0 END, 'audit': b.p.audit || m.letters,
         'lines': b.p.lines || m.lines || CASE right(m.letters, 1) WHEN 'D' THEN '' WHEN 'R' THEN E'\\n' || m.renamed || ':' || t.text ELSE E'\\n' || t.role || ':' || t.text END}})
  FROM best b JOIN turns t ON t.grp = b.grp AND t.pos = b.pos
  JOIN moves m ON m.state = b.state AND (m.stays = 0 OR t.fault NOT IN (1, 2)) AND (m.need = '' OR m.need = t.init)
  GROUP BY b.grp, b.pos, m.next
),
done AS (
  SELECT b.grp, min({{'cost': b.p.cost + e.cost, 'audit': b.p.audit || e.letters, 'lines': b.p.lines || e.lines}}) AS p
  FROM best b JOIN counts c ON c.grp = b.grp AND c.n = b.pos JOIN ends e ON e.state = b.state GROUP BY b.grp
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(d.p.cost, 0) AS cost, coalesce(d.p.audit, '') AS audit, sha256(coalesce(d.p.lines[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.grp = coalesce('=' || o.conv_id, '-') LEFT JOIN done d ON d.grp = c.grp
"""
