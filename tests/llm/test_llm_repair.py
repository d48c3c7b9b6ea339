"""Conversation repair against plain Python: enumeration, and a recursion over suffixes."""

import hashlib
import itertools
import re
import zlib
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flightlake.llm import queries, repair
from flightlake.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")
SPACES = " \t\n\v\f\r"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damaged(rows):
    """Plain damage: {conv_id: [(turn, role, text)]}, in order."""
    out = {}
    for conv_id, turn, role, text in rows:
        mine = out.setdefault(conv_id, [])
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest())
    return {c: sorted(mine, key=order) for c, mine in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        kept = text.strip(SPACES)
        out.append(
            "blank" if not kept
            else "duplicate" if (role, text) in seen
            else "truncated" if kept[-1] not in ".!?"
            else ""
        )
        seen.add((role, text))
    return out


def recursive(initials, found):
    """Least (cost, audit) by recursion over suffixes."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    next_role = {"": "u", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, state, inserts):
        options = []
        if i == len(initials):
            if state in ("", "a"):
                options.append((0, ""))
        else:
            cost, audit = best(i + 1, state, 0)
            options.append((3 + cost, "D" + audit))
            if found[i] in ("", "truncated"):
                extra = found[i] == "truncated"
                if (state, initials[i]) in step:
                    cost, audit = best(i + 1, step[state, initials[i]], 0)
                    options.append((extra + cost, "K" + audit))
                cost, audit = best(i + 1, next_role[state], 0)
                options.append((2 + extra + cost, "R" + audit))
        if inserts < 2:
            cost, audit = best(i, next_role[state], inserts + 1)
            options.append((2 + cost, "I" + audit))
        return min(options, default=(10**9, "Z"))

    return best(0, "", 0)


def enumerated(initials, found):
    """Least (cost, audit) by trying all edits, with up to two inserts anywhere."""
    insert = [("", 0, "")] + [("I" * n, 2 * n, r) for n in (1, 2) for r in map("".join, itertools.product("ua", repeat=n))]
    slots = [insert]
    for role, fault in zip(initials, found, strict=True):
        options = [("D", 3, "")]
        if fault in ("", "truncated"):
            extra = fault == "truncated"
            options += [("K", extra, role)] + [("R", 2 + extra, r) for r in "ua"]
        slots += [options, insert]
    return min(
        (sum(c for _, c, _ in edits), "".join(e for e, _, _ in edits))
        for edits in itertools.product(*slots)
        if GRAMMAR.fullmatch("".join(r for _, _, r in edits))
    )


def symbols(initials, found):
    codes = {"": repair.NO_FAULT, "blank": repair.BLANK, "duplicate": repair.DUPLICATE, "truncated": repair.CUT}
    return bytes(
        4 * max(0, repair.INITIALS.find(r)) + codes[f] for r, f in zip(initials, found, strict=True)
    )


CASES = st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from(["", "", "truncated", "blank", "duplicate"])))


@pytest.mark.parametrize("n", range(4))
def test_every_short_conversation(n):
    for initials in itertools.product("suax", repeat=n):
        for found in itertools.product(["", "truncated", "blank"], repeat=n):
            got = tuple(repair.cheapest(symbols(initials, found)))
            assert got == recursive(initials, found)
            if n <= 2:
                assert got == enumerated(initials, found)


@settings(max_examples=400, deadline=None)
@given(CASES)
def test_any_conversation(case):
    initials, found = [r for r, _ in case], [f for _, f in case]
    cost, audit = repair.cheapest(symbols(initials, found))
    assert (cost, audit) == recursive(tuple(initials), tuple(found))
    bounds = repair.suffix_bounds(symbols(initials, found))
    assert bounds[0][repair.START] <= cost


def test_long_conversation_is_searched_in_linear_time():
    pattern = bytes([8, 12, 8, 8, 13, 0, 12, 11, 6, 12, 12, 15]) * 20_000
    found = repair.cheapest(pattern)
    assert sum(c != "I" for c in found.audit) == len(pattern)


def plain(rows):
    out = {}
    for conv_id, mine in damaged(rows).items():
        found = faults(mine)
        initials = [r[:1] for _, r, _ in mine]
        turns = {t for t, _, _ in mine if t is not None}
        cost, audit = recursive(tuple(initials), tuple(found))
        kept = [c for c in audit if c != "D"]
        lines, row = [], 0
        for edit in audit:
            place = len(lines) - len(kept) % 2
            if edit == "I":
                lines.append(f"{('user', 'assistant')[place % 2]}:")
                continue
            _, role, text = mine[row]
            row += 1
            if edit != "D":
                lines.append(f"{role if edit == 'K' else ('user', 'assistant')[place % 2]}:{text}")
        out[conv_id] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[found.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def check(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    got = repair.repaired_digests(repair.damage(frame)).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == plain(rows)
    assert len(got) == len({r[0] for r in rows})


ODD = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"), (1, 1, "assistant", "Yes!"), (1, 1, "assistant", "Yes!"),
    (2, None, None, None), (2, None, "user", "a"), (2, 7, "", "No role."), (2, 3, "System", "Upper."),
    (None, 1, "user", "Lost."), (None, None, "assistant", "Found?"), (None, 1, "user", "Lost."),
    (3, 5, "system", " \t\n"), (4, 0, "user", "line\nbreak: é 🙂."), (4, 9, "assistant", "a "), (4, 4, "x", "?"),
]


def test_odd_rows(spark):
    check(spark, ODD)


def test_conversations_that_lose_everything(spark):
    gone = [(c, t, "user", "Hello.") for c in range(400) for t in range(1) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    check(spark, gone)
    assert plain(gone)[gone[0][0]] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_long_conversations_over_many_batches(spark):
    roles = ["system", "user", "assistant", "tool", None]
    rows = [(c, t, roles[(t * t + c) % 5], ["Fine.", "Cut", "", "Why?", f"Turn {t}."][(t + c) % 5]) for c in range(3) for t in range(400)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_repaired_turns_follow_the_grammar(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, SF, "conversations").collect()]
    frame = repair.damage(spark.createDataFrame(rows, SCHEMA))
    turns = {}
    for r in repair.repaired_turns(frame).collect():
        turns.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    want = plain(rows)
    for conv_id, mine in turns.items():
        mine.sort()
        assert [p for p, _, _ in mine] == list(range(len(mine)))
        assert GRAMMAR.fullmatch("".join(r[0] for _, r, _ in mine))
        text = "\n".join(f"{r}:{t}" for _, r, t in mine)
        assert hashlib.sha256(text.encode()).hexdigest() == want[conv_id][-1]


def test_undamaged_conversations(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."), (2, 0, "assistant", "First.")]
    got = repair.repaired_digests(repair.undamaged(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r.conv_id: (r.cost, r.audit) for r in got} == {1: (0, "KK"), 2: (2, "IK")}


def test_no_rows_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repaired_digests(repair.damage(empty)).count() == 0
    more = spark.createDataFrame([(*r, "x", 1) for r in ODD], f"{SCHEMA}, cost string, kind int")
    got = repair.repaired_digests(repair.damage(more)).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == plain(ODD)


def test_query(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, SF, "conversations").collect()]
    got = queries.op13_repair(spark, SF).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == plain(rows)
