"""Conversation repair: depth-first branch and bound over edits, least (cost, audit) first."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.common import give_back, pieces, small_batches

# What damage the remainder of the row's checksum means, and the divisor.
DROPPED, EMPTIED, UNPUNCTUATED, REPEATED, AS_USER = range(5)
DIVISOR = 20

# Costs of the edits, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# Faults of a row, as stored in its symbol.
NO_FAULT, BLANK, DUPLICATE, CUT = range(4)
# A row's symbol: four times the class of its role's initial, plus its fault.
INITIALS = "?sua"
# Where the role sequence stands: nothing yet, after the system turn, after a user, an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
# The place after keeping a role of each class, from each place; None where the grammar
# (s?(ua)+)? has no such step.
NEXT = (
    (None, SYSTEM, USER, None),
    (None, None, USER, None),
    (None, None, None, ASSISTANT),
    (None, None, USER, None),
)
# The role that may stand next, for rows that get a role and inserted ones.
WANTED = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
_FAR = 1 << 60
# Rows of one turn go by role, then by the hash of their text; equal ones can't be told apart.
_ORDER = ["turn", "role", "digest"]


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after damage, by the checksum of `conv_id:turn`; dropped ones are marked.

    Null ids, turns, roles and texts count as one space in the checksum and in the row; the
    columns conv_id and turn keep their nulls.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    mark = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % DIVISOR
    rows = conversations.select(
        "conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), mark.alias("mark")
    )
    text = (
        F.when(F.col("mark") == EMPTIED, F.lit(""))
        .when(F.col("mark") == UNPUNCTUATED, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    copies = F.when(F.col("mark") == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("mark") == AS_USER, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("mark") == DROPPED).alias("dropped"),
        F.explode(copies).alias("copy"),
    )


def classified(rows: DataFrame) -> DataFrame:
    """Small rows (conv_id, turn, role, digest, nth, symbol) in place of texts.

    A row is blank, or else a duplicate (its role and text stood earlier in the conversation),
    or else truncated. The first of equal rows is found by a window over them; texts themselves
    are not shuffled. A dropped row has no symbol, but keeps its conversation in the result.
    """
    digest = F.sha2("text", 256)
    # The last character that is no white space; the dot of the pattern's class is literal.
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    initial = F.substring("role", 1, 1)
    of_role = F.lit(0)
    for at, letter in enumerate(INITIALS[1:], 1):
        of_role = F.when(initial == letter, at).otherwise(of_role)
    known = rows.select(
        "conv_id",
        "turn",
        "role",
        digest.alias("digest"),
        "copy",
        "dropped",
        of_role.alias("initial"),
        last.alias("last"),
    )
    equal = Window.partitionBy("conv_id", "role", "digest", "dropped").orderBy(
        F.asc_nulls_first("turn"), "copy"
    )
    fault = (
        F.when(F.col("last") == "", BLANK)
        .when(F.col("nth") > 1, DUPLICATE)
        .when(~F.col("last").isin(".", "!", "?"), CUT)
        .otherwise(NO_FAULT)
    )
    symbol = F.when(~F.col("dropped"), F.col("initial") * 4 + fault)
    return known.withColumn("nth", F.row_number().over(equal)).select(
        "conv_id", "turn", "role", "digest", "nth", symbol.alias("symbol")
    )


class Found(NamedTuple):
    cost: int
    audit: str


def suffix_bounds(symbols: bytes) -> list[tuple[int, int, int, int]]:
    """For every row and place, a lower bound of what the rows from there on cost.

    From the back: a row costs at least its cheapest edit, and from each place the grammar lets it
    go on with, that place's bound; inserted turns are paid where a row needs another place.
    """
    # At the end the sequence is empty or stands after an assistant; other places need inserts.
    bounds = [(0, 2 * INSERT, INSERT, 0)]
    for symbol in reversed(symbols):
        initial, fault = symbol >> 2, symbol & 3
        after = bounds[-1]
        extra = TRUNCATED if fault == CUT else 0
        here = []
        for place in range(4):
            least = DELETE + after[place]
            if fault in (NO_FAULT, CUT):
                least = min(least, REROLE + extra + after[WANTED[place]])
                following = NEXT[place][initial]
                if following is not None:
                    least = min(least, extra + after[following])
            here.append(least)
        # Inserts lead from place to place: user after a start, a system or an assistant turn,
        # assistant after a user.
        for _ in range(2):
            here = [min(here[p], INSERT + here[WANTED[p]]) for p in range(4)]
        bounds.append(tuple(here))
    return bounds[::-1]


def cheapest(symbols: bytes) -> Found:
    """The least (cost, audit) over all edits that make the roles match the grammar.

    Depth first with an explicit stack. A node is a row and a place in the grammar; its branches
    are tried in ASCII order of their initials (D, I, K, R), so of two prefixes that reach a node
    at the same cost the first one is the ASCII-least (neither can begin the other: what the
    longer one had more would be inserts, which cost). Hence the node's dominance table drops every
    prefix that is not strictly cheaper than the one before, and an incumbent falls only to a
    strictly cheaper one. A prefix is also dropped where its cost and the bound of the suffix do
    not beat the incumbent. The search ends when the stack is empty: the incumbent is optimal.
    """
    n = len(symbols)
    bounds = suffix_bounds(symbols)
    # Before there is an incumbent, nothing above the root's bound can be the least.
    best_cost, best_leaf = bounds[0][START] + 1, None
    best_at = [_FAR] * (4 * (n + 1))
    # A stack entry is (row, place, cost, edit that led here, entry it came from).
    stack: list[tuple] = [(0, START, 0, "", None)]
    while stack:
        entry = stack.pop()
        row, place, cost, _, _ = entry
        node = 4 * row + place
        if cost >= best_at[node] or cost + bounds[row][place] >= best_cost:
            continue
        best_at[node] = cost
        if row == n and place in (START, ASSISTANT):
            best_cost, best_leaf = cost, entry
            continue
        wanted = WANTED[place]
        branches = []
        if row < n:
            initial, fault = symbols[row] >> 2, symbols[row] & 3
            branches.append((row + 1, place, cost + DELETE, "D", entry))
        branches.append((row, wanted, cost + INSERT, "I", entry))
        if row < n and fault in (NO_FAULT, CUT):
            extra = TRUNCATED if fault == CUT else 0
            following = NEXT[place][initial]
            if following is not None:
                branches.append((row + 1, following, cost + extra, "K", entry))
            branches.append((row + 1, wanted, cost + REROLE + extra, "R", entry))
        stack.extend(reversed(branches))
    edits = []
    entry = best_leaf
    while entry is not None:
        edits.append(entry[3])
        entry = entry[4]
    return Found(best_cost, "".join(reversed(edits)))


class _Tally:
    """What is counted of one conversation while its rows pass by in order."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.symbols = bytearray()
        self.first = self.last = None
        self.turns = 0

    def take(self, turn, symbol) -> None:
        if symbol is None:
            return
        self.symbols.append(symbol)
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1

    def row(self) -> tuple:
        symbols = bytes(self.symbols)
        faults = [s & 3 for s in symbols]
        pairs = zip(symbols, symbols[1:], strict=False)
        legal = {("s", "u"), ("u", "a"), ("a", "u")}
        illegal = sum((INITIALS[x >> 2], INITIALS[y >> 2]) not in legal for x, y in pairs)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        found = cheapest(symbols)
        counts = [faults.count(f) for f in (BLANK, DUPLICATE, CUT)]
        return self.conv_id, gaps, *counts, illegal, *found


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _audits(schema: pa.Schema):
    """One row per conversation, whose rows come one after the other in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, done = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "symbol"))
            for conv_id, turn, symbol in zip(*columns, strict=True):
                if tally is None or conv_id != tally.conv_id:
                    if tally is not None:
                        done.append(tally.row())
                    tally = _Tally(conv_id)
                tally.take(turn, symbol)
            if done:
                yield _record(done, schema)
                done = []
        if tally is not None:
            yield _record([*done, tally.row()], schema)
        give_back()

    return run


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation gaps, faults, cost and audit, from damaged (or other) rows.

    A task sees a conversation's rows in order and holds one byte of each, no texts.
    """
    small = classified(rows)
    schema = T.StructType(
        [
            small.schema["conv_id"],
            *[T.StructField(c, T.LongType()) for c in _COUNTS],
            T.StructField("audit", T.StringType()),
        ]
    )
    ordered = small.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER, "nth")
    arrow = rows.sparkSession.createDataFrame([], schema).toArrow().schema
    return ordered.select("conv_id", "turn", "symbol").mapInArrow(_audits(arrow), schema)


class _Editor:
    """Applies a conversation's audit to its rows as they pass by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """The turns to insert before the next row, as (edit, role, text)."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.place = WANTED[self.place]
            yield "I", ROLES[self.place], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self.place = WANTED[self.place]
            yield edit, ROLES[self.place], text
        elif edit == "K":
            self.place = NEXT[self.place][INITIALS.index(role[:1])]
            yield edit, role, text


def _edited(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Each conversation's audit row, and after it its rows in order, without dropped ones."""
    digest = F.sha2("text", 256)
    texts = rows.filter(~F.col("dropped")).select(
        "conv_id", "turn", "role", digest.alias("digest"), F.lit(1).alias("kind"), "text"
    )
    heads = told.withColumns(
        {
            "turn": F.lit(None).cast(rows.schema["turn"].dataType),
            "role": F.lit(None).cast("string"),
            "digest": F.lit(None).cast("string"),
            "kind": F.lit(0),
            "text": F.lit(None).cast("string"),
        }
    )
    both = heads.unionByName(texts, allowMissingColumns=True)
    return (
        both.repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", *_ORDER)
        .select(*told.columns, "kind", "role", "text")
    )


def _digests(names: list[str], schema: pa.Schema):
    """The audit rows with the hash of the repaired conversation, fed turn by turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = editor = digest = None
        lines = 0

        def feed(turns) -> None:
            nonlocal lines
            for _, role, text in turns:
                digest.update((("\n" if lines else "") + f"{role}:{text}").encode())
                lines += 1

        def closed() -> tuple:
            feed(editor.inserted())
            return *head, digest.hexdigest()

        for batch in batches:
            for part in pieces(batch, "text"):
                done = []
                told = zip(*(part.column(c).to_pylist() for c in names), strict=True)
                rest = (part.column(c).to_pylist() for c in ("kind", "role", "text"))
                for values, kind, role, text in zip(told, *rest, strict=True):
                    if kind == 0:
                        if head is not None:
                            done.append(closed())
                        head, editor = values, _Editor(values[names.index("audit")])
                        digest, lines = hashlib.sha256(), 0
                    else:
                        feed(editor.row(role, text))
                if done:
                    yield _record(done, schema)
        if head is not None:
            yield _record([closed()], schema)
        give_back()

    return run


def _turns(schema: pa.Schema):
    """The repaired turns with their place and edit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id = editor = None
        place = 0
        for batch in batches:
            for part in pieces(batch, "text"):
                out = []

                def put(turns) -> None:
                    nonlocal place
                    for edit, role, text in turns:
                        out.append((conv_id, place, edit, role, text))  # noqa: B023
                        place += 1

                columns = (part.column(c).to_pylist() for c in ("conv_id", "audit", "kind", "role", "text"))
                for key, audit, kind, role, text in zip(*columns, strict=True):
                    if kind == 0:
                        if editor is not None:
                            put(editor.inserted())
                        conv_id, editor, place = key, _Editor(audit), 0
                    else:
                        put(editor.row(role, text))
                if out:
                    yield _record(out, schema)
        if editor is not None and (rest := list(editor.inserted())):
            yield _record([(conv_id, place + i, *turn) for i, turn in enumerate(rest)], schema)

    return run


def repaired_digests(rows: DataFrame) -> DataFrame:
    """Per conversation of the damaged rows: gaps, blank, duplicate, truncated, illegal, cost,
    audit and repaired_sha256.

    Rows without text go to their conversation's task first, which finds the edits; then texts
    pass by once, in order, and are hashed as they do. So a conversation of any length takes a
    byte a row, and no task holds its texts. The hash of a conversation is one sequence and is
    made by one task.

    Null roles and texts are one space. A role that does not begin with s, u or a (an empty one,
    too) can't be kept as it is. Rows of one turn are ordered by role, then by the SHA-256 of the
    text; rows alike in all columns are copies. A conversation that lost all rows has zeros, an
    empty audit and the hash of nothing; rows without conv_id are one conversation. An empty table
    gives no rows; other columns are left out.
    """
    small_batches(rows.sparkSession)
    told = audits(rows)
    schema = T.StructType([*told.schema.fields, T.StructField("repaired_sha256", T.StringType())])
    arrow = rows.sparkSession.createDataFrame([], schema).toArrow().schema
    return _edited(rows, told).mapInArrow(_digests(told.columns, arrow), schema)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I), role and text."""
    small_batches(rows.sparkSession)
    schema = T.StructType(
        [
            rows.schema["conv_id"],
            T.StructField("place", T.LongType()),
            *[T.StructField(c, T.StringType()) for c in ("edit", "role", "text")],
        ]
    )
    arrow = rows.sparkSession.createDataFrame([], schema).toArrow().schema
    return _edited(rows, audits(rows).select("conv_id", "audit")).mapInArrow(_turns(arrow), schema)


def undamaged(conversations: DataFrame) -> DataFrame:
    """Rows as `repaired_turns` takes them, for conversations that are to be repaired as they are."""
    return conversations.select(
        "conv_id",
        "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.lit(False).alias("dropped"),
        F.lit(0).alias("copy"),
    )
