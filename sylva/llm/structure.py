"""Conversation structure repair by iterative-deepening A*.

A well-formed conversation has the roles ``(system? (user assistant)+)?``, told by their first letters. A
row is blank (nothing but white space), a duplicate (its role and text stood earlier in the
conversation) or truncated (its last character that is no white space ends no sentence); the first of these that
holds counts. Edits turn a conversation into a well-formed one: keep a row (K, cost 0), give it the
other speaking role (R, 2), delete it (D, 3; blank and duplicate rows must go) or insert an empty turn
(I, 2); a truncated row that stays adds 1. The cheapest edits are wanted and, of several, those whose letters
sort first.

The search goes depth first through the edits in the order of their letters, under a bound on the total
cost that starts at a lower bound and rises to the least cost that was cut off. A node is a row and the
state of the pattern; a table keeps for each node that failed the least cost by which it could still
succeed, so that no node is searched twice with the same means. The first accepting path is the answer. A longer
conversation is searched in blocks of ``BLOCK`` rows from its end: a block's goal costs are the costs
that the next block found from each state, which is exact (a block ends with its last row, so that no
path of a block begins another one and the letters of a block decide before those of the next).

Faults are found by Spark: a window over equal (conversation, role, text) marks duplicates, one over the
conversation numbers its rows by turn (NULL first), role and text. Each conversation then streams
through one task twice in one sort: first a few bytes per row, which the search needs (a byte per row is
held), then the texts, which the edits are applied to one by one; texts are never held as a whole.

NULL roles and texts are one space; rows without conv_id form one conversation; a NULL turn sorts
first and counts in no gap. Very long texts pass as they are. Rows that tie by turn go by role and text,
repeated rows are duplicates. An empty table gives an empty one. Only the four columns are read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import read

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
#: Rows per block of the search.
BLOCK = 32
RUN_CHARS = 4_000_000
#: States of the pattern: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that the next speaking turn leads to.
_SPOKEN = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: What is inserted behind the last row to end well.
_TAIL = ("", "II", "I", "")
#: Codes of a row: what its role's first letter is, and bits for a fault.
_OTHER, _S, _U, _A = range(4)
_GONE, _CUT = 4, 8
_KEPT = {(_S, START): SYSTEM, (_U, START): USER, (_U, SYSTEM): USER, (_U, ASSISTANT): USER, (_A, USER): ASSISTANT}
FAULTS = ("blank", "duplicate", "truncated")


def search(rows: bytes, start: int, goal: tuple[int, ...]) -> tuple[int, str, int]:
    """(cost, letters, last state) of the cheapest, then first, edits of ``rows`` from the state
    ``start``; ending in a state costs what ``goal`` says."""
    n = len(rows)
    # a lower bound: blank and duplicate rows go, truncated ones cost something either way
    low = [min(goal)] * (n + 1)
    for i in range(n - 1, -1, -1):
        low[i] = low[i + 1] + (DELETE if rows[i] & _GONE else min(TRUNCATED, DELETE) if rows[i] & _CUT else 0)
    least: dict[int, int] = {}  # by node (row * 4 + state): a cost below which no way on leads to a goal
    path: list[str] = []
    ends: list[int] = []

    def visit(i: int, state: int, left: int) -> int:
        """0 if a goal was reached with at most ``left``, else the least cost that was cut off."""
        if i == n:
            if goal[state] > left:
                return goal[state]
            ends.append(state)
            return 0
        node = i * 4 + state
        known = least.get(node, low[i])
        if known > left:
            return known
        row = rows[i]
        extra = TRUNCATED if row & _CUT else 0
        over = 1 << 60
        for letter, cost, j, to in (
                ("D", DELETE, i + 1, state), ("I", INSERT, i, _SPOKEN[state]),
                ("K", KEEP + extra, i + 1, -1 if row & _GONE else _KEPT.get((row & 3, state), -1)),
                ("R", REROLE + extra, i + 1, -1 if row & _GONE else _SPOKEN[state])):
            if to < 0:
                continue
            if cost > left:
                over = min(over, cost)
                continue
            path.append(letter)
            cut = visit(j, to, left - cost)
            if not cut:
                return 0
            path.pop()
            over = min(over, cut + cost)
        least[node] = over
        return over

    bound = max(low[0], 0)
    while True:
        cut = visit(0, start, bound)
        if not cut:
            return bound, "".join(path), ends[0]
        bound = cut


def cheapest(rows: bytes, block: int = BLOCK) -> tuple[int, str]:
    """(cost, letters) of the edits of a whole conversation."""
    goal = tuple(INSERT * len(t) for t in _TAIL)
    ways: list[list[tuple[int, str, int] | None]] = []
    for begin in reversed(range(0, len(rows), block)):
        found = [search(rows[begin: begin + block], s, goal) if begin or s == START else None for s in range(4)]
        goal = tuple(w[0] if w else 0 for w in found)
        ways.append(found)
    letters, state = [], START
    for found in reversed(ways):
        way = found[state]
        letters.append(way[1])
        state = way[2]
    return goal[START], "".join(letters) + _TAIL[state]


class _Conversation:
    """One conversation: first its codes, then its texts."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.codes = bytearray()
        self.counts = dict.fromkeys(FAULTS, 0)
        self.illegal = self.turns = 0
        self.low = self.high = self.letters = None
        self.before = ""

    def code(self, turn, role: str, fault: str | None) -> None:
        initial = role[:1]
        if self.codes and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.codes.append({"s": _S, "u": _U, "a": _A}.get(initial, _OTHER) | (_GONE if fault in FAULTS[:2] else _CUT if fault else 0))
        if fault:
            self.counts[fault] += 1
        if turn is not None and turn != self.high:  # rows come by turn
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def solve(self) -> None:
        self.cost, self.letters = cheapest(bytes(self.codes))
        self.codes = bytearray()
        self.at = self.made = 0
        self.state = START

    def inserts(self) -> Iterator[tuple]:
        while self.letters[self.at: self.at + 1] == "I":
            yield self._put("I", None, "")

    def _put(self, letter: str, role: str | None, text: str) -> tuple:
        self.at += 1
        self.state = _KEPT[({"s": _S, "u": _U, "a": _A}[role[0]], self.state)] if letter == "K" else _SPOKEN[self.state]
        self.made += 1
        return self.made - 1, letter, role if letter == "K" else _ROLE[self.state], text

    def edit(self, role: str, text: str) -> Iterator[tuple]:
        """The rows made of the next row, and of what is inserted before it."""
        if self.letters is None:
            self.solve()
        yield from self.inserts()
        letter = self.letters[self.at]
        if letter == "D":
            self.at += 1
        else:
            yield self._put(letter, role, text)

    def report(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, **self.counts, "illegal": self.illegal, "cost": self.cost, "audit": self.letters}


_COUNTS = ("gaps", *FAULTS, "illegal", "cost")


def marked(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (without NULL), fault and the number of the row in its conversation."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    same = Window.partitionBy("conv_id", "role", F.sha2("text", 256)).orderBy(F.col("turn").asc_nulls_first())
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), FAULTS[0]).when(F.col("_nth") > 1, FAULTS[1]) \
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), FAULTS[2])
    rows = rows.withColumn("_nth", F.row_number().over(same)).withColumn("fault", fault)
    whole = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "_nth")
    return rows.withColumn("row", F.row_number().over(whole)).drop("_nth")


def repair(turns: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, seq (from 0), edit (K, R or I), role and text; and
    behind them one row per conversation with a NULL seq, which holds the counts of its faults, the
    cost and the audit (the letters of all edits)."""
    # codes first (without texts), then the rows themselves, in one sort within the partitions of the window
    twice = marked(turns).withColumn("phase", F.explode(F.array(F.lit(0), F.lit(1)))) \
        .withColumn("text", F.when(F.col("phase") == 1, F.col("text"))).sortWithinPartitions("conv_id", "phase", "row") \
        .select("conv_id", "phase", "turn", "role", "fault", "text")
    conv = turns.schema["conv_id"].dataType
    schema = StructType([StructField("conv_id", conv), StructField("seq", LongType()), *[StructField(c, StringType()) for c in ("edit", "role", "text")],
                         *[StructField(c, LongType()) for c in _COUNTS], StructField("audit", StringType())])

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, size, kind = None, [], 0, pa.int64()
        nothing = (None,) * (len(_COUNTS) + 1)

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [kind, pa.int64(), *[pa.string()] * 3, *[pa.int64()] * len(_COUNTS), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=schema.names)

        def close() -> None:
            rows.extend((current.conv_id, *made, *nothing) for made in current.inserts())
            report = current.report()
            rows.append((current.conv_id, None, None, None, None, *[report[c] for c in _COUNTS], report["audit"]))

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for first in range(0, batch.num_rows, 256):  # few texts as Python strings at once
                for conv_id, phase, turn, role, fault, text in zip(*[c.to_pylist() for c in batch.slice(first, 256).columns], strict=True):
                    if current is None or current.conv_id != conv_id:
                        if current is not None:
                            close()
                        current = _Conversation(conv_id)
                    if phase == 0:
                        current.code(turn, role, fault)
                    else:
                        rows.extend((current.conv_id, *made, *nothing) for made in current.edit(role, text))
                        size += len(text)
                if size >= RUN_CHARS or len(rows) >= 4096:
                    yield batch_of()
                    rows, size = [], 0
        if current is not None:
            close()
            yield batch_of()

    return twice.mapInArrow(repaired, schema)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The turns of the repaired conversations."""
    return repair(turns).where("seq IS NOT NULL").select("conv_id", "seq", "role", "text", "edit")


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation of what ``repair`` returns: its report and the SHA-256 of its repaired
    ``role:text`` lines, read in the order in which they came."""
    names = ["conv_id", *_COUNTS, "audit"]
    schema = StructType([*repaired.select(*names).schema.fields, StructField("repaired_sha256", StringType())])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = hashlib.sha256()
        for batch in batches:
            rows, digested_rows = [], []
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("seq", "role", "text")]
            for first in range(0, batch.num_rows, 256):
                for k, (seq, role, text) in enumerate(zip(*[c.slice(first, 256).to_pylist() for c in columns], strict=True), first):
                    if seq is None:
                        rows.append(k)
                        digested_rows.append(digest.hexdigest())
                        digest = hashlib.sha256()
                    else:
                        digest.update(f"{chr(10) if seq else ''}{role}:{text}".encode())
            closing = batch.take(pa.array(rows, type=pa.int64()))
            yield pa.RecordBatch.from_arrays([*[closing.column(closing.schema.get_field_index(c)) for c in names],
                                              pa.array(digested_rows, type=pa.string())], names=schema.names)

    return repaired.mapInArrow(digested, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """The damage of the query: by crc32(conv_id:turn) % 20, 0 drops a row, 1 empties its text, 2 takes
    its sentence ends, 3 repeats it, 4 makes it a user's. A NULL is one space, in the key too."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    times: Column = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return turns.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
                        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                        F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy")


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = digests(repair(damaged(given)))
    every = given.select(F.col("conv_id").alias("_of")).distinct()
    none = hashlib.sha256().hexdigest()
    return every.join(found, F.col("_of").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_of").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))


#: By dynamic programming: per row and state the least of (cost, letters), with up to two turns inserted before
#: a row. Costs and letters are one string, so that the least string is the answer; crc32 by its polynomial.
ORACLE = r"""
WITH RECURSIVE given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
tbl AS (SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS t),
crc AS (SELECT given.*, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda c: unicode(c)::BIGINT)),
        lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 20 AS kind FROM given, tbl),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM crc, (SELECT unnest(range(2)) AS copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
same AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged),
numbered AS (SELECT *, row_number() OVER w AS k, lag(substr(role, 1, 1)) OVER w AS before
    FROM same WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth)),
faults AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault FROM numbered),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (k > 1 AND before || substr(role, 1, 1) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faults GROUP BY conv_id),
spoken AS (SELECT * FROM (VALUES ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')) AS v(state, next)),
before_row AS (SELECT state, 0 AS ins, state AS at, []::VARCHAR[] AS made FROM spoken
    UNION ALL SELECT state, 1, next, [CASE next WHEN 'u' THEN 'user:' ELSE 'assistant:' END] FROM spoken
    UNION ALL SELECT a.state, 2, b.next, [CASE a.next WHEN 'u' THEN 'user:' ELSE 'assistant:' END, CASE b.next WHEN 'u' THEN 'user:' ELSE 'assistant:' END]
        FROM spoken a JOIN spoken b ON b.state = a.next),
dp AS (SELECT conv_id, 0::BIGINT AS k, '' AS state, '0000000' AS best, []::VARCHAR[] AS made FROM counts
    UNION ALL
    SELECT conv_id, k, state, min(way) AS best, arg_min(made, way) AS made FROM (
        SELECT f.conv_id, f.k, m.state,
            lpad((substr(d.best, 1, 7)::INT + 2 * b.ins + m.cost)::VARCHAR, 7, '0') || substr(d.best, 8) || repeat('I', b.ins) || m.letter AS way,
            list_concat(d.made, b.made, CASE m.letter WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text]
                ELSE [CASE m.state WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text] END) AS made
        FROM dp d JOIN faults f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.k = d.k + 1 JOIN before_row b ON b.state = d.state JOIN spoken s ON s.state = b.at,
            LATERAL (SELECT unnest([
                {'letter': 'D', 'cost': 3, 'state': b.at, 'ok': true},
                {'letter': 'K', 'cost': CASE WHEN f.fault IS NULL THEN 0 ELSE 1 END, 'state': substr(f.role, 1, 1), 'ok': coalesce(f.fault = 'truncated', true)
                    AND (b.at || substr(f.role, 1, 1)) IN ('s', 'u', 'su', 'ua', 'au') AND substr(f.role, 1, 1) IN ('s', 'u', 'a')
                    AND NOT (b.at <> '' AND substr(f.role, 1, 1) = 's')},
                {'letter': 'R', 'cost': CASE WHEN f.fault IS NULL THEN 2 ELSE 3 END, 'state': s.next, 'ok': coalesce(f.fault = 'truncated', true)}], recursive := true)) m
        WHERE m.ok) GROUP BY conv_id, k, state),
ends AS (SELECT d.conv_id, lpad((substr(best, 1, 7)::INT + 2 * b.ins)::VARCHAR, 7, '0') || substr(best, 8) || repeat('I', b.ins) AS best,
        list_concat(d.made, b.made) AS made
    FROM dp d JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id AND c.n = d.k JOIN before_row b ON b.state = d.state WHERE b.at IN ('', 'a')),
answer AS (SELECT conv_id, min(best) AS best, arg_min(made, best) AS made FROM ends GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(substr(best, 1, 7)::BIGINT, 0) AS cost,
    coalesce(substr(best, 8), '') AS audit, sha256(coalesce(array_to_string(made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN answer a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
"""
