"""Conversations as training text: turn order checked by a finite-state machine, loss flags per segment.

A template declares, per role, what stands before and after a text and whether the text is learned.
Control strings all begin with ``<`` or ``[``; both signs are escaped inside texts (``~1`` and ``~2``,
``~`` itself ``~0``), so no text can close a turn or open one, and the original comes back exactly.
All is built of SQL functions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.running import cut_out, running


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """roles: how each role is written. other: roles not listed; their name stands before the text, in one line.

    moves: from a state, ``start`` or the role before, the roles that may follow. last: roles that may end.
    """

    roles: dict[str, Turn] = field(
        default_factory=lambda: {"system": Turn("<<SYS>>", "<</SYS>>"), "user": Turn("[INST]", "[/INST]"), "assistant": Turn("<s>", "</s>", True)}
    )
    other: Turn = Turn("<role>", "</role>")
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    last: tuple[str, ...] = ("assistant",)


DEFAULT = Template()
_ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"))


def escape(text: Column) -> Column:
    for plain, code in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _by_role(role: Column, template: Template, value) -> Column:
    out = F.lit(value(template.other))
    for name, turn in template.roles.items():
        out = F.when(role == name, F.lit(value(turn))).otherwise(out)
    return out


def _segments(turn: Column, template: Template) -> Column:
    """before, text, after of one turn; a blank stands on both sides of the text."""
    role = turn["role"]
    listed = role.isin(list(template.roles))
    name = F.when(listed, F.lit("")).otherwise(F.concat(F.replace(escape(role), F.lit("\n"), F.lit("~3")), F.lit("\n")))
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return F.array(
        part(F.concat(_by_role(role, template, lambda t: t.before + " "), name), F.lit(False)),
        part(escape(turn["text"]), _by_role(role, template, lambda t: t.loss)),
        part(F.concat(F.lit(" "), _by_role(role, template, lambda t: t.after)), F.lit(False)),
    )


def format_conversations(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """(conv_id, turn, role, text, ...) -> conv_id, valid, bad_turn, segments, formatted, loss_spans.

    segments is an array of (text, loss); formatted is their concatenation, loss_spans the (start,
    length) in code points of the segments that are learned. valid tells whether the roles follow the
    moves of the template; bad_turn is the place, from 0, of the first turn that does not, null if only
    the end is wrong or nothing is. Conversations with a wrong order are formatted all the same.
    Turns are ordered by turn, nulls first, ties by role, then text. Null texts count as empty, null
    roles as a role with an empty name. Rows with a null conv_id are one conversation. Other columns
    are not read. A conversation is one training example, so it has to fit one row; rows of different
    conversations are never brought together.
    """
    clean = turns.select(
        "conv_id", F.struct(F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t")
    )
    grouped = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    allowed = F.array(*[F.lit(f"{state}>{role}") for state, after in template.moves.items() for role in after])

    def move(state: Column, turn: Column) -> Column:
        fits = F.array_contains(allowed, F.concat(state["role"], F.lit(">"), turn["role"]))
        return F.struct(turn["role"].alias("role"), (state["at"] + 1).alias("at"), F.coalesce(state["bad"], F.when(~fits, state["at"])).alias("bad"))

    start = F.struct(F.lit("start").alias("role"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))
    checked = grouped.withColumn("state", F.aggregate("turns", start, move)).withColumn("segments", F.flatten(F.transform("turns", lambda t: _segments(t, template))))

    spans = "array<struct<start:int,length:int>>"
    learned = lambda at, s: F.when(s["loss"], F.array(F.struct(at.alias("start"), F.length(s["text"]).alias("length")))).otherwise(F.array().cast(spans))
    return checked.select(
        "conv_id",
        (F.col("state.bad").isNull() & F.col("state.role").isin(list(template.last))).alias("valid"),
        F.col("state.bad").alias("bad_turn"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        running(F.col("segments"), F.lit(0), lambda at, s: at + F.length(s["text"]), learned, spans).alias("loss_spans"),
    )


def read_back(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """conv_id, valid, bad_turn, turns (role, text) and learned (the texts under the loss mask), from formatted and loss_spans alone."""
    every = [*template.roles.values(), template.other]
    quote = lambda strings: "|".join("".join("\\" + c if not c.isalnum() else c for c in s) for s in strings)
    pattern = F.lit(rf"({quote(t.before for t in every)}) ([^<\[]*+)(?:{quote(t.after for t in every)})")
    pieces = F.arrays_zip(F.regexp_extract_all("formatted", pattern, F.lit(1)).alias("sign"), F.regexp_extract_all("formatted", pattern, F.lit(2)).alias("body"))

    def turn(piece: Column) -> Column:
        body = F.substring(piece["body"], F.lit(1), F.length(piece["body"]) - 1)  # without the blank behind the text
        role = unescape(F.replace(F.substring_index(body, "\n", 1), F.lit("~3"), F.lit("\n")))
        text = F.substring(body, F.instr(body, "\n") + 1, F.length(body))
        for name, declared in template.roles.items():
            role = F.when(piece["sign"] == declared.before, F.lit(name)).otherwise(role)
        text = F.when(piece["sign"] == template.other.before, text).otherwise(body)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    texts = cut_out(F.col("formatted"), F.col("loss_spans"), lambda s: s["start"], lambda s: s["start"] + s["length"])
    learned = F.transform(texts, unescape)
    return formatted.select("conv_id", "valid", "bad_turn", F.transform(pieces, turn).alias("turns"), learned.alias("learned"), F.length("formatted").cast("bigint").alias("formatted_chars"))


def digests(read: DataFrame) -> DataFrame:
    """Counts and digests of what was read back, and the state machine's verdict."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("learned", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
        "bad_turn",
    )
