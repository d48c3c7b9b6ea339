"""Chat formatting: turns rendered with marks, read back, and escaped until both agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import text_or_empty

# The marks of the template.
START = "<|im_start|>"
END = "<|im_end|>"
TAIL = END + "\n"

# A mark, with any number of backslashes already inside: escaping adds one, reading takes one.
_MARKED = r"<(\\*)\|(?=im_(?:start|end)\|>)"
_ESCAPED = r"<\\(\\*)\|(?=im_(?:start|end)\|>)"
# Roles stand on one line, so their line breaks and `<` are written as codes.
_ROLE_CODES = (("%", "%25"), ("\n", "%0A"), ("<", "%3C"))


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, _MARKED, r"<$1\\|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "<$1|")


def escape_role(role: Column) -> Column:
    for plain, code in _ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for plain, code in reversed(_ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def render(turns: Column, escaped: bool) -> Column:
    """The turns (role, text) of a conversation as one text."""
    body = (lambda t: escape_text(t["text"])) if escaped else (lambda t: t["text"])
    lines = F.transform(
        turns,
        lambda t: F.concat(
            F.lit(START), escape_role(t["role"]), F.lit("\n"), body(t), F.lit(TAIL)
        ),
    )
    return F.array_join(lines, "")


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text; null where it breaks the grammar.

    conversation := turn*, turn := START role LF text END LF, and neither role nor text holds a
    mark.
    """
    parts = F.split(formatted, START.replace("|", r"\|"), -1)
    bodies = F.slice(parts, F.lit(2), F.size(parts))
    closed = F.forall(
        bodies,
        lambda b: b.endswith(TAIL)
        & (F.instr(b, END) == F.length(b) - len(TAIL) + 1)
        & (F.instr(b, "\n") <= F.length(b) - len(TAIL)),
    )
    turns = F.transform(
        bodies,
        lambda b: F.struct(
            unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
            unescape_text(
                b.substr(
                    F.instr(b, "\n") + 1, F.length(b) - len(TAIL) - F.instr(b, "\n")
                )
            ).alias("text"),
        ),
    )
    return F.when((F.element_at(parts, 1) == "") & closed, turns)


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, escaped, turns (read back), and loss_spans (start, length).

    A conversation is rendered as it is and read back; where that differs from its turns, it is
    rendered with its marks escaped and read back again, which agrees by construction: escaping
    leaves no mark in a text and reading undoes it. A difference would raise an error rather
    than return.

    Turns are ordered by turn (null first), then role, then text. Null role and text are empty;
    a null conv_id is a conversation of its own; repeated rows are repeated turns; an empty
    table gives no rows. Extra columns are ignored. loss_spans are the places of the assistant
    texts in `formatted`, counted in characters from 1 as they stand there.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        text_or_empty("role").alias("role"),
        text_or_empty("text").alias("text"),
    )
    chats = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("rows"))
    chats = chats.select(
        "conv_id",
        F.transform(
            "rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))
        ).alias("source"),
    )
    plain = chats.withColumn("plain", render(F.col("source"), escaped=False))
    agreed = F.coalesce(parse(F.col("plain")) == F.col("source"), F.lit(False))
    formatted = (
        plain.withColumn("escaped", ~agreed)
        .withColumn(
            "formatted",
            F.when(F.col("escaped"), render(F.col("source"), escaped=True)).otherwise(
                F.col("plain")
            ),
        )
        .withColumn("back", parse(F.col("formatted")))
    )
    checked = F.when(
        F.coalesce(F.col("back") == F.col("source"), F.lit(False)), F.col("back")
    ).otherwise(
        F.raise_error(F.lit("a formatted conversation does not read back as its turns")).cast(
            "array<struct<role:string,text:string>>"
        )
    )
    return formatted.select(
        "conv_id",
        "formatted",
        "escaped",
        checked.alias("turns"),
        _loss_spans(F.col("formatted")).alias("loss_spans"),
    )


def _loss_spans(formatted: Column) -> Column:
    parts = F.split(formatted, START.replace("|", r"\|"), -1)
    bodies = F.slice(parts, F.lit(2), F.size(parts))
    empty = F.array().cast("array<struct<start:int,length:int>>")

    def step(state, body):
        head = F.instr(body, "\n")
        start = state["at"] + len(START) + head
        span = F.struct(
            start.cast("int").alias("start"),
            (F.length(body) - len(TAIL) - head).cast("int").alias("length"),
        )
        mine = F.substring_index(body, "\n", 1) == "assistant"
        return F.struct(
            (state["at"] + len(START) + F.length(body)).cast("int").alias("at"),
            F.when(mine, F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    initial = F.struct(F.lit(1).cast("int").alias("at"), empty.alias("spans"))
    return F.aggregate(bodies, initial, step, lambda s: s["spans"])


def digests(chats: DataFrame) -> DataFrame:
    """What a formatted conversation holds, as counts and hashes of what is read back. The loss
    figures are those of the text under the mask: its spans, cut out of `formatted` and
    unescaped."""
    loss = F.array_join(
        F.transform(
            "loss_spans",
            lambda s: unescape_text(F.col("formatted").substr(s["start"], s["length"])),
        ),
        "",
    )
    all_turns = F.array_join(
        F.transform(
            "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
        ),
        "",
    )
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
