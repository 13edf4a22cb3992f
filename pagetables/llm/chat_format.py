"""Chat formatting: a finite-state machine over roles and a declarative template.

A conversation's turns are put in order, its roles run through the machine, and its
text is written out as segments, each with a flag that says whether it counts for
the loss. Control strings inside texts are escaped so that only the template itself
marks turns; the output can be read back to the turns it was made from.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import let


@dataclass(frozen=True)
class Template:
    """Marks around a turn, the roles whose text counts for the loss, the machine's
    steps as (state, role) pairs, each leading to the state of the role's name, the
    states it may end in, and control strings that must not stand in a text."""

    begin: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    steps: tuple[tuple[str, str], ...] = (
        ("", "system"),
        ("", "user"),
        ("system", "user"),
        ("user", "assistant"),
        ("assistant", "user"),
    )
    final: tuple[str, ...] = ("assistant",)
    control: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    )


CHATML = Template()


def quoted(literal: str) -> str:
    """A literal inside a Java pattern."""
    return re.sub(r"([^A-Za-z0-9\s])", r"\\\1", literal)


def escaped(text: Column, control: tuple[str, ...]) -> Column:
    """Backslashes doubled, and one put after the first character of a control string."""
    at = "|".join(f"{quoted(c[0])}(?={quoted(c[1:])})" for c in control)
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({at})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escaped_role(role: Column, control: tuple[str, ...]) -> Column:
    """As a text; a line end, which closes the role, gets a backslash too."""
    return F.replace(escaped(role, control), F.lit("\n"), F.lit("\\\n"))


def last_state(roles: Column, template: Template) -> Column:
    """The state after all roles; null once a step does not exist."""
    known = F.create_map(*(F.lit(x) for s, r in template.steps for x in (f"{s}>{r}", r)))
    return F.aggregate(
        roles, F.lit(""), lambda state, role: F.try_element_at(known, F.concat(state, F.lit(">"), role))
    )


def format_chats(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: Template = CHATML,
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` (array of ``text``, ``loss``),
    ``formatted`` (all segments' text) and ``valid`` (the machine took every role and
    ended where it may).

    Turns go by number; turns of one number by role, then text, and rows that come
    twice are two turns. Null texts and roles count as empty; rows without a number
    come first. Rows without a conversation are one conversation together. Invalid
    conversations are formatted like others. A conversation is one row, as long as it
    is. Other columns are not read.
    """
    given = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    ordered = given.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments_of(t: Column) -> Column:
        head = F.concat(F.lit(template.begin), escaped_role(t["role"], template.control), F.lit("\n"))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(
                escaped(t["text"], template.control).alias("text"),
                t["role"].isin(*template.loss_roles).alias("loss"),
            ),
            F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss")),
        )

    state = last_state(F.col("turns.role"), template)
    made = ordered.select(
        "conv_id",
        let(
            F.flatten(F.transform("turns", segments_of)),
            lambda s: F.struct(s.alias("segments"), F.array_join(s["text"], "").alias("formatted")),
        ).alias("made"),
        F.coalesce(state.isin(*template.final), F.lit(False)).alias("valid"),
    )
    return made.select("conv_id", "made.segments", "made.formatted", "valid")


def read_back(chats: DataFrame, formatted: str, segments: str, template: Template = CHATML) -> DataFrame:
    """``chats`` with ``turns`` (array of ``role``, ``text``), parsed from the formatted
    text, and ``loss_text``, the unescaped text of the segments under the loss."""
    head = r"(?s)^((?:[^\\\n]++|\\.)*+)\n(.*)$"

    def turn(piece: Column) -> Column:
        body = F.substring(piece, len(template.begin) + 1, 2**31 - 1)
        return F.struct(
            unescaped(F.regexp_extract(body, head, 1)).alias("role"),
            unescaped(F.regexp_extract(body, head, 2)).alias("text"),
        )

    pieces = F.split(F.col(formatted), quoted(template.end))
    turns = F.transform(F.filter(pieces, lambda p: p != ""), turn)
    under_loss = F.filter(F.col(segments), lambda s: s["loss"])["text"]
    return chats.select(
        "*", turns.alias("turns"), F.array_join(F.transform(under_loss, unescaped), "").alias("loss_text")
    )
