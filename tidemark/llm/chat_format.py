"""Chat formatting with Spark expressions: one training string and one loss mask per conversation.

A conversation's turns are collected as structs and sorted. Neighbouring turns of one role are
merged into a block, `start role body texts end` with `between` between its texts, and the
blocks are joined. Control strings inside roles and texts get a backslash behind their first
character, so that what is written can be read back exactly.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "\\"


@dataclass(frozen=True)
class Template:
    """Control strings around a block of turns. None may be empty, hold a backslash, or hold the
    first character of another one behind its own first place."""

    start: str = "[INST]"
    body: str = "[/INST]"
    between: str = "<s>"
    end: str = "</s>"

    def __post_init__(self):
        firsts = {c[:1] for c in self.controls}
        if len(set(self.controls)) < 4 or any(not c or MARK in c or firsts & set(c[1:]) for c in self.controls):
            raise ValueError(f"control strings that cannot be escaped: {self.controls}")
        if any(a != b and b.startswith(a) for a in self.controls for b in self.controls):
            raise ValueError("a control string begins with another one")

    @property
    def controls(self) -> tuple[str, str, str, str]:
        return self.start, self.body, self.between, self.end

    def _marked(self, mark: str) -> str:
        """Pattern of the place, or of the backslash, behind the first character of a control string."""
        return "|".join(f"(?<={re.escape(c[0])}){mark}(?=\\\\*{re.escape(c[1:])})" for c in self.controls)

    def escape(self, text: Column) -> Column:
        """`text` without control strings: each has one more backslash behind its first character."""
        return F.regexp_replace(text, self._marked(""), MARK * 2)

    def unescape(self, text: Column) -> Column:
        """What `escape` was given."""
        return F.regexp_replace(text, self._marked(MARK * 2), "")


INSTRUCT = Template()
IM = Template("<|im_start|>", "<|im_sep|>", "<|im_next|>", "<|im_end|>")


def _literal(control: str) -> Column:
    """A pattern for exactly `control`."""
    return F.lit(re.escape(control))


def format_chat(
    df: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: Template = INSTRUCT,
    learned: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: `conv_id`, `blocks` (array of role and texts), `formatted`, `loss_mask`.

    `loss_mask` has one struct per turn, in order: `skip` characters (code points) of `formatted`
    outside the loss, `take` inside, `rest` outside again; all of them add up to its length.
    Only the texts of the roles in `learned` are inside, not what stands around or between them.

    Turns are sorted by `turn`, null first; equal numbers by role and text, so repeated rows stand
    side by side and stay. A null role or text counts as empty. Rows with a null `conv_id` are one
    conversation. An empty table gives an empty one; further columns are not looked at. A
    conversation becomes one string and so has to fit in a row; texts travel once, to it.
    """
    turns = df.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # A block begins where the role changes and ends before the next one.
    first = "filter(sequence(1, size(turns)), i -> i = 1 OR element_at(turns, i).role <> element_at(turns, i - 1).role)"
    cut = sorted_turns.withColumn("first", F.expr(first))
    merged = cut.withColumn(
        "blocks",
        F.expr(
            "transform(first, (s, k) -> named_struct('role', element_at(turns, s).role, "
            "'texts', transform(slice(turns, s, coalesce(get(first, k + 1), size(turns) + 1) - s), t -> t.text)))"
        ),
    )
    ready = merged.select(
        "conv_id",
        "blocks",
        F.transform(
            "blocks",
            lambda b: F.struct(
                F.concat(F.lit(template.start), template.escape(b["role"]), F.lit(template.body)).alias("head"),
                F.transform(b["texts"], template.escape).alias("texts"),
                b["role"].isin(*learned).alias("learned"),
            ),
        ).alias("written"),
    )
    between, end = len(template.between), len(template.end)

    def block(b: Column) -> Column:
        return F.concat(b["head"], F.array_join(b["texts"], template.between), F.lit(template.end))

    def mask(b: Column) -> Column:
        def of_turn(t: Column, k: Column) -> Column:
            lead = F.when(k == 0, F.length(b["head"])).otherwise(F.lit(between))
            tail = F.when(k == F.size(b["texts"]) - 1, F.lit(end)).otherwise(F.lit(0))
            inside = F.length(t)
            return F.struct(
                F.when(b["learned"], lead).otherwise(lead + inside).cast("long").alias("skip"),
                F.when(b["learned"], inside).otherwise(F.lit(0)).cast("long").alias("take"),
                tail.cast("long").alias("rest"),
            )

        return F.transform(b["texts"], of_turn)

    return ready.select(
        "conv_id",
        "blocks",
        F.array_join(F.transform("written", block), "").alias("formatted"),
        F.flatten(F.transform("written", mask)).alias("loss_mask"),
    )


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """Turns of a formatted conversation, as an array of `role` and `text`: what went in, in order."""
    blocks = F.split(formatted, _literal(template.end), -1)

    def turns(block: Column) -> Column:
        parts = F.split(block, _literal(template.body), -1)
        role = template.unescape(F.substr(parts[0], F.lit(len(template.start) + 1)))
        return F.transform(F.split(parts[1], _literal(template.between), -1), lambda t: F.struct(role.alias("role"), template.unescape(t).alias("text")))

    # Behind the last end there is nothing.
    return F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), turns))


def read_loss(formatted: Column, loss_mask: Column, template: Template = INSTRUCT) -> Column:
    """What is inside the loss mask of a formatted conversation, unescaped, one text per turn."""
    ahead = f"(?={re.escape(template.start)}|{re.escape(template.between)})"
    # One piece per turn, so that no piece is looked for from the beginning of the whole.
    pieces = F.split(formatted, F.lit(ahead), -1)
    inside = F.zip_with(pieces, loss_mask, lambda p, m: F.substr(p, (m["skip"] + 1).cast("int"), m["take"].cast("int")))
    return F.transform(inside, template.unescape)
