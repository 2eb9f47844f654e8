"""Chat formatting: conversations to one training text each, with the loss mask beside it.

Relational throughout: the turn structs of a conversation are collected and sorted, adjacent turns of one
role are merged by array expressions in one linear pass, and the text is put together by concatenation.
Only built-in expressions are used.

Every role and text is escaped, so a control string inside a text can never be read as markup: a backslash
becomes two, and each control string gets one backslash after its first character. A run of backslashes is
therefore of even length unless it stands inside an escaped control string, which makes this reversible
by plain replacements. Merged turns keep their borders as a control string of their own, outside the mask.

Defined results: rows are ordered by turn, then role, then text (null turns first); repeated rows are turns
of their own. Null role or text counts as empty. Rows with a null ``conv_id`` form one conversation. An
empty table gives no rows. A conversation becomes one value, so it must fit a row (2 GB).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Control strings of a format; none may contain a backslash or be part of another."""

    open: str = "<|im_start|>"
    close: str = "<|im_end|>"
    part: str = "<|im_part|>"
    learned_role: str = "assistant"
    others: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")

    def controls(self) -> list[str]:
        return [self.open, self.close, self.part, *self.others]


CHAT = Template()
_NEWLINE = ("\n", "<\\n>")  # in roles, whose end is a newline


def escape(text: Column, template: Template = CHAT) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in template.controls():
        text = F.replace(text, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return text


def unescape(text: Column, template: Template = CHAT) -> Column:
    for control in template.controls():
        text = F.replace(text, F.lit(f"{control[0]}\\{control[1:]}"), F.lit(control))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def format_conversations(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """``conv_id``, ``formatted`` and ``segments``: ``formatted`` cut where the mask changes.

    Each segment is ``(text, loss)``; the segment texts put together are ``formatted``.
    """
    texts = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    turns = texts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    # positions at which a role begins, and behind them the end of the list
    starts = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    bounded = turns.withColumn("starts", starts).withColumn("ends", F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("turns"))))
    merged = F.transform(
        F.arrays_zip("starts", "ends"),
        lambda x: F.struct(
            F.get("turns", x["starts"])["role"].alias("role"),
            F.transform(F.slice("turns", x["starts"] + 1, x["ends"] - x["starts"]), lambda t: escape(t["text"], template)).alias("parts"),
        ),
    )

    def segments(turn: Column) -> Column:
        head = F.concat(F.lit(template.open), F.replace(escape(turn["role"], template), *map(F.lit, _NEWLINE)), F.lit("\n"))
        learned = turn["role"] == template.learned_role
        body = F.flatten(
            F.transform(
                turn["parts"],
                lambda part, i: F.array(
                    F.struct(F.when(i == 0, head).otherwise(F.lit(template.part)).alias("text"), F.lit(False).alias("loss")),
                    F.struct(part.alias("text"), learned.alias("loss")),
                ),
            )
        )
        return F.concat(body, F.array(F.struct(F.lit(template.close + "\n").alias("text"), F.lit(False).alias("loss"))))

    cut = bounded.withColumn("merged", merged).select("conv_id", F.flatten(F.transform("merged", segments)).alias("segments"))
    return cut.select("conv_id", F.array_join(F.col("segments")["text"], "").alias("formatted"), "segments")


def read_turns(formatted: Column, template: Template = CHAT) -> Column:
    """The turns in ``formatted``, as an array of ``(role, text)``: undoes :func:`format_conversations`."""
    blocks = F.filter(F.split(formatted, _literal(template.close + "\n")), lambda x: x != "")

    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        escaped = F.replace(F.substring(head, len(template.open) + 1, F.length(head)), *map(F.lit, _NEWLINE[::-1]))
        role = unescape(escaped, template)
        body = F.substring(block, F.length(head) + 2, F.length(block))
        return F.transform(
            F.split(body, _literal(template.part)), lambda p: F.struct(role.alias("role"), unescape(p, template).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def _literal(text: str) -> str:
    """A pattern that matches ``text`` itself."""
    return "".join(f"\\x{ord(c):02x}" for c in text)


def learned_text(segments: Column, template: Template = CHAT) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescape(s["text"], template)), "")
