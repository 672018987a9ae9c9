"""Repair of conversations: faults of their turns, and the cheapest edits that give them a regular order of roles.

Roles must read `(s?(ua)+)?` by their initials. States of that grammar: 0 nothing yet, 1 after the system turn, 2 after a user's, 3 after an
assistant's; 0 and 3 may end. Conversations are dealt to partitions by the hash of their id and sorted by turn; in each, slices of SLICE rows are
given to a recursive DuckDB query, of which every recursion takes one more turn of all conversations of the slice and keeps the least cost and
audit of each state. A conversation that goes on in the next slice hands over its four states, each with its cost, its audit and a running hash of
the repaired turns, so one of any length needs the memory of a slice and of its own audit. Its repaired hash is one sequence, so one task reads it.

Null roles and texts are one space; rows without an id are one conversation. A missing turn comes first. Rows of one turn are taken by role, then
text. Rows that repeat role and text of one before are duplicates, whatever their turns. A role that is empty has no initial and no place in the grammar.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .spread import small_batches

SLICE = 8192
SPACE = " \t\n\x0b\x0c\r"
#: Costs of edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: State after a turn of each role, by the state before it.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {"u": "user", "a": "assistant"}
ENDS = (0, 3)


def due(state: int) -> str:
    """The role that a rerole or an insertion gives in a state."""
    return "a" if state == 2 else "u"


def inserted(state: int) -> list[tuple[int, str, int]]:
    """(state, edits, cost) after no, one or two insertions; more would only repeat states."""
    one = NEXT[state, due(state)]
    two = NEXT[one, due(one)]
    return [(state, "", 0), (one, "I", INSERT), (two, "II", 2 * INSERT)]


def moves() -> list[tuple[int, int, str, str, int]]:
    """(state, state after, kind, edits, cost) of the insertions before a row and its own edit; kind is D, R, or the initial that is kept.

    As every row's edits end with its own, no audit of the first n rows begins another, so the least of each state stays the least when more is added.
    """
    out = []
    for state in range(4):
        for mid, more, extra in inserted(state):
            out += [(state, mid, "D", more + "D", extra + DELETE), (state, NEXT[mid, due(mid)], "R", more + "R", extra + REROLE)]
            out += [(state, to, c, more + "K", extra) for (at, c), to in NEXT.items() if at == mid]
    return out


def finish(states: dict[int, tuple[int, str]]) -> tuple[int, str, int, str]:
    """Least (cost, audit) with the insertions at the end, the state that it comes from, and these."""
    return min((cost + extra, audit + more, state, more) for state, (cost, audit, *_) in states.items() for end, more, extra in inserted(state) if end in ENDS)


WALK = f"""
WITH RECURSIVE walk(conv, state, p, cost, place, start, audit) USING KEY (conv, state) AS (
  SELECT conv, state, -1::BIGINT, cost, place, start, audit FROM starts
  UNION
  SELECT conv, dest, p, best.cost, best.place, best.start, best.audit FROM (
    SELECT w.conv, m.dest, w.p + 1 AS p,
      min({{'cost': w.cost + m.cost + CASE WHEN r.truncated AND m.kind <> 'D' THEN {TRUNCATED} ELSE 0 END, 'place': w.place, 'audit': w.audit || m.edits, 'start': w.start}}) AS best
    FROM walk w JOIN turns r ON r.conv = w.conv AND r.p = w.p + 1
    JOIN moves m ON m.state = w.state AND (m.kind = 'D' OR NOT (r.blank OR r.duplicate) AND (m.kind = 'R' OR m.kind = r.initial))
    GROUP BY w.conv, m.dest, w.p
  )
)
SELECT w.conv, w.state, w.cost, w.place, w.start, w.audit FROM walk w JOIN (SELECT conv, max(p) AS p FROM turns GROUP BY conv) USING (conv, p) ORDER BY conv, state
"""
COUNTS = """
SELECT conv, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal,
  min(turn) AS low, max(turn) AS high, count(*) FILTER (fresh) AS distinct_turns FROM turns GROUP BY conv ORDER BY conv
"""


def marked(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) in order, each with its first fault, its initial, whether its turn is new and whether its role may not follow the one before."""
    own, order = Window.partitionBy("conv_id"), [F.col("turn").asc_nulls_first(), "role", "text"]
    given = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")).repartition("conv_id")
    placed = given.select("*", F.row_number().over(own.orderBy(*order)).alias("pos"))
    seen = placed.select("*", F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("pos")).alias("_nth"))
    end = F.rtrim("text", F.lit(SPACE))
    before = own.orderBy("pos")
    initial = F.substring("role", 1, 1)
    blank = end == ""
    duplicate = ~blank & (F.col("_nth") > 1)
    pair = F.concat(F.lag(initial).over(before), initial)
    return seen.select(
        "conv_id", "pos", "turn", "role", "text", initial.alias("initial"), blank.alias("blank"), duplicate.alias("duplicate"),
        (~blank & ~duplicate & ~F.substring(end, -1, 1).isin(".", "!", "?")).alias("truncated"),
        F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
        (F.col("turn").isNotNull() & F.coalesce(F.lag("turn").over(before) != F.col("turn"), F.lit(True))).alias("fresh"),
    ).sortWithinPartitions("conv_id", "pos")


class Running:
    """The conversation that the last slice ended in: for each state its cost, audit and hash, and the counts so far."""

    def __init__(self) -> None:
        self.states = {0: (0, "", hashlib.sha256())}
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "distinct_turns"), 0)
        self.low = self.high = None

    def count(self, row: dict) -> None:
        for k in self.counts:
            self.counts[k] += row[k]
        if row["low"] is not None:
            self.low = row["low"] if self.low is None else min(self.low, row["low"])
            self.high = row["high"] if self.high is None else max(self.high, row["high"])

    def result(self) -> dict:
        cost, audit, state, more = finish(self.states)
        h = replay(self.states[state][2], state, more, [], state != 0)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.counts["distinct_turns"]
        return {"gaps": gaps, **{k: v for k, v in self.counts.items() if k != "distinct_turns"}, "cost": cost, "audit": audit, "repaired_sha256": h.hexdigest()}


def edited(state: int, edits: str, rows: list[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Repaired (role, text) from a state on."""
    at = iter(rows)
    for e in edits:
        if e == "D":
            next(at)
            continue
        role, text = next(at) if e != "I" else ("", "")
        if e != "K":
            role = NAMES[due(state)]
        state = NEXT[state, role[:1]]
        yield role, text


def replay(h, state: int, edits: str, rows: list[tuple[str, str]], begun: bool):  # noqa: ANN001, ANN201
    """The hash h, carried on over the repaired turns; begun says whether it holds some already."""
    for role, text in edited(state, edits, rows):
        h.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
        begun = True
    return h


def walk(con: duckdb.DuckDBPyConnection, turns: pa.Table, carried: list[Running]) -> None:
    """Takes the turns of one slice; carried[c] is what is known of conversation c, and is brought forward."""
    starts = []
    for c, run in enumerate(carried):
        for place, (state, (cost, _, _)) in enumerate(sorted(run.states.items(), key=lambda x: x[1][1])):
            starts.append((c, state, cost, place, state, ""))
    names = ["conv", "state", "cost", "place", "start", "audit"]
    con.register("starts", pa.table({n: pa.array(v, t) for n, v, t in zip(names, zip(*starts, strict=True), [pa.int64()] * 5 + [pa.string()], strict=True)}))
    con.register("turns", turns.drop_columns(["role", "text"]))
    roles, texts, convs = (turns[c].to_pylist() for c in ("role", "text", "conv"))
    ends: dict[int, list[tuple]] = {}
    for conv, state, cost, _, start, audit in con.execute(WALK).fetchall():
        ends.setdefault(conv, []).append((state, cost, start, audit))
    at = 0
    for row in con.execute(COUNTS).to_arrow_table().to_pylist():
        run, n = carried[row["conv"]], 0
        while at + n < len(convs) and convs[at + n] == row["conv"]:
            n += 1
        rows = list(zip(roles[at : at + n], texts[at : at + n], strict=True))
        at += n
        before = run.states
        chosen = finish({state: (cost, before[start][1] + audit) for state, cost, start, audit in ends[row["conv"]]})[2]
        open_ended = row["conv"] == len(carried) - 1
        run.states = {}
        for state, cost, start, audit in ends[row["conv"]]:
            if open_ended or state == chosen:
                h = replay(before[start][2].copy(), start, audit, rows, start != 0)
                run.states[state] = (cost, before[start][1] + audit, h)
        run.count(row)


def repair(rows: DataFrame, slice_rows: int = SLICE) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation with rows; other columns are not read."""
    kind = pa.int64() if rows.schema["conv_id"].dataType.typeName() in ("long", "integer", "short", "byte") else pa.string()
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv_id", kind), *[(n, pa.int64()) for n in names], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB"})
        con.execute("CREATE TABLE moves (state BIGINT, dest BIGINT, kind VARCHAR, edits VARCHAR, cost BIGINT)")
        con.executemany("INSERT INTO moves VALUES (?, ?, ?, ?, ?)", moves())
        key, last, held, n = None, None, [], 0

        def take() -> Iterator[pa.RecordBatch]:
            """Works off the rows held; all conversations but the last are done then, if another follows the last one held before."""
            nonlocal key, last, held, n
            table = pa.Table.from_batches(held)
            ids = table["conv_id"].to_pylist()
            known, conv, seq, p, done = [], [], [], 0, []
            for k, i in enumerate(ids):
                if k == 0 and last is not None and i == key:
                    known.append(last)
                elif k == 0 or i != ids[k - 1]:
                    if k == 0 and last is not None:
                        done.append((key, last))
                    known.append(Running())
                    p = 0
                conv.append(len(known) - 1)
                seq.append(p)
                p += 1
            firsts = [ids[k] for k in range(len(ids)) if seq[k] == 0]
            turns = table.drop_columns(["conv_id"]).append_column("conv", pa.array(conv, pa.int64())).append_column("p", pa.array(seq, pa.int64()))
            walk(con, turns, known)
            done += list(zip(firsts, known, strict=True))[:-1]
            key, last, held, n = ids[-1], known[-1], [], 0
            if done:
                yield pa.RecordBatch.from_pylist([{"conv_id": i, **r.result()} for i, r in done], schema)

        for batch in batches:
            for cut in range(0, batch.num_rows, slice_rows):
                part = batch.slice(cut, slice_rows)
                if n and n + part.num_rows > slice_rows:
                    yield from take()
                held.append(part)
                n += part.num_rows
        if n:
            yield from take()
        if last is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": key, **last.result()}], schema)

    small_batches(rows.sparkSession)
    given = marked(rows.withColumn("conv_id", F.col("conv_id").cast("long" if kind == pa.int64() else "string"))).drop("pos")
    kinds = ", ".join(f"{n} long" for n in names)
    return given.mapInArrow(run, f"conv_id {'long' if kind == pa.int64() else 'string'}, {kinds}, audit string, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults set by a checksum of id and turn: 0 of 20 drops a row, 1 empties its text, 2 takes its stops, 3 repeats it, 4 makes it the user's."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fate = F.crc32(key) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    told: list[Column] = [
        F.col("conv_id"), F.col("turn"), F.when(fate == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).when(fate == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ]
    return rows.select(*told).drop("_copy")


def repaired_conversations(given: DataFrame, rows: DataFrame) -> DataFrame:
    """repair() of rows for every conversation of given, those without rows as empty ones."""
    ids = given.select(F.col("conv_id").alias("_id")).distinct()
    done = repair(rows)
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    joined = ids.join(done, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(F.col("_id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
