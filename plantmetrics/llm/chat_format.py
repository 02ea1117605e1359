"""Conversations to one training string each, in column expressions only.

A `Template` declares how a turn is marked, which roles carry loss, which strings are control strings, and which role may
follow which. A finite-state machine walks the roles: its state is the role it came to, so a move depends on a turn and the one
before it. Every move emits the turn's three segments with a loss flag each and says whether the machine accepts it; the first
refused turn is `refused_at`, and a conversation is valid if there is none and its last turn leads to a final state.

Control strings inside a text are escaped: a backslash is doubled, and a backslash goes behind the first character of every
control string. So no control string is left inside a text, and taking away the escapes gives the text back.

Defined cases: a null text or role is empty; turns are ordered by (turn, role, text) with nulls first, repeated rows are
repeated turns; a null conversation id is one conversation; an order that the machine refuses gives valid = false and is
formatted all the same, with the loss flags of its roles; an empty table gives no rows; other columns are never read. A conversation is one output string, so it
has to fit a Spark string (2 GB).
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    open: str = "<|im_start|>"
    middle: str = "\n"
    close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    )
    #: State to the roles it accepts; a role is the name of the state it leads to.
    machine: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    final: tuple[str, ...] = ("assistant",)


def escape(text: Column, template: Template) -> Column:
    anywhere = "|".join(re.escape(c) for c in template.controls)
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, rf"(?=(?:{anywhere}))(.)", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _moves(turns: Column, template: Template) -> Column:
    """Array of struct(accepted, segments), one per turn."""
    known = [f"{state}\n{role}" for state, after in template.machine.items() for role in after]

    def move(t: Column, i: Column) -> Column:
        state = F.when(i > 0, F.get(turns, i - 1)["role"]).otherwise("")
        mark = F.concat(F.lit(template.open), F.url_encode(t["role"]), F.lit(template.middle))
        segments = F.array(
            F.struct(mark.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"], template).alias("text"), t["role"].isin(*template.loss_roles).alias("loss")),
            F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")),
        )
        return F.struct(F.concat(state, F.lit("\n"), t["role"]).isin(known).alias("accepted"), segments.alias("segments"))

    return F.transform(turns, move)


def format_conversations(
    df: DataFrame, template: Template = Template(), conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv, n_turns, valid, refused_at (turn from 1, else NULL) and segments (array of text and loss) per conversation.

    The segments joined are the training string.
    """
    rows = df.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("row"),
    )
    grouped = rows.groupBy("conv").agg(F.sort_array(F.collect_list("row")).alias("turns"))

    walked = grouped.withColumn("moves", _moves(F.col("turns"), template))
    refused = F.nullif(F.array_position(F.transform("moves", lambda m: m["accepted"]), F.lit(False)), F.lit(0).cast("long"))
    return walked.select(
        F.col("conv").alias(conv), F.size("turns").cast("long").alias("n_turns"),
        (refused.isNull() & F.element_at("turns", -1)["role"].isin(*template.final)).alias("valid"), refused.alias("refused_at"),
        F.flatten(F.transform("moves", lambda m: m["segments"])).alias("segments"),
    )


def training_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """Text under the loss mask with the escapes taken away."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def parse(formatted: Column, template: Template = Template()) -> Column:
    """Array of (role, text) read from a training string."""
    pieces = F.split(formatted, re.escape(template.close), -1)
    whole = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, len(template.open) + 1, 2**31 - 1)
        name = F.substring_index(body, template.middle, 1)
        rest = F.substr(body, F.length(name) + len(template.middle) + 1)
        return F.struct(F.url_decode(name).alias("role"), unescape(rest).alias("text"))

    return F.transform(whole, turn)
