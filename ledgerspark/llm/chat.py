"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted; runs of the same role are merged into one
message; messages are concatenated. Control strings inside texts and roles are escaped by a backslash after
their first character (an already escaped one gets one more), which ``unescape`` takes back exactly.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turns summed at a time when offsets are accumulated, so that a very long conversation costs no square.
SCAN_BLOCK = 512


@dataclass(frozen=True)
class ChatTemplate:
    """message = turn + role + body + text [+ more + text ...] + end. ``guarded``: further strings to escape."""

    turn: str = "<|turn|>"
    body: str = "<|text|>"
    more: str = "<|more|>"
    end: str = "</s>"
    guarded: tuple[str, ...] = ("<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    trained_roles: tuple[str, ...] = ("assistant",)

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.turn, self.body, self.more, self.end, *self.guarded)

    def _heads_and_tails(self) -> tuple[str, str]:
        heads = "".join(sorted({re.escape(c[0]) for c in self.controls}))
        tails = "|".join(re.escape(c[1:]) for c in self.controls)
        return heads, tails

    def escape(self, text: Column) -> Column:
        heads, tails = self._heads_and_tails()
        return F.regexp_replace(text, rf"([{heads}])(\\*)(?={tails})", r"$1\\$2")

    def unescape(self, text: Column) -> Column:
        heads, tails = self._heads_and_tails()
        return F.regexp_replace(text, rf"([{heads}])\\(\\*)(?={tails})", "$1$2")


def _running(values: Column) -> Column:
    """Sums of all earlier elements, for each element of an array of longs."""
    zero = F.array(F.lit(0).cast("long"))

    def scan(xs: Column) -> Column:
        return F.aggregate(xs, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    starts = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values), F.lit(SCAN_BLOCK))).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda b: scan(F.slice(values, b, SCAN_BLOCK)))
    carried = scan(F.transform(blocks, lambda b: F.element_at(b, -1)))
    return F.flatten(F.zip_with(blocks, F.slice(carried, 1, F.size(blocks)), lambda b, c: F.transform(F.slice(b, 1, F.size(b) - 1), lambda x: x + c)))


def format_chat(turns: DataFrame, template: ChatTemplate = ChatTemplate(), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: its formatted text and the spans a trainer may learn from.

    Returns ``conv_col, formatted string, loss_spans array<struct<start long, len long>>``; spans count code
    points of ``formatted`` from 0, one per turn of a trained role, and cover its escaped text alone.
    Nulls: a null text or role is empty, null turn numbers come first, null conversation ids form one
    conversation. Ties in turn are ordered by role and text; repeated rows stay. Other columns are ignored.
    An empty table gives an empty table. The output of a conversation is one row, so its turns must fit in one.
    """
    t = template
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    grouped = turns.select(F.col(conv_col).alias("conv"), turn.alias("t")).groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("s"))
    s = F.col("s")
    n = F.size(s)
    changes = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(s, i)["role"] != F.get(s, i - 1)["role"]))
    runs = grouped.withColumn("starts", changes).withColumn("esc", F.transform(s, lambda x: t.escape(x["text"])))
    starts, esc = F.col("starts"), F.col("esc")

    def message(p: Column, j: Column) -> Column:
        after = F.coalesce(F.get(starts, j + 1), n)
        texts = F.slice(esc, p + 1, after - p)
        return F.concat(F.lit(t.turn), t.escape(F.get(s, p)["role"]), F.lit(t.body), F.array_join(texts, t.more), F.lit(t.end))

    def lead(x: Column, i: Column) -> Column:
        header = F.length(t.escape(x["role"])) + len(t.turn) + len(t.body)
        new = (i == 0) | (x["role"] != F.get(s, i - 1)["role"])
        return F.when(new, header + F.when(i == 0, 0).otherwise(len(t.end))).otherwise(len(t.more)).cast("long")

    parts = runs.select(
        "conv",
        F.array_join(F.transform(starts, message), "").alias("formatted"),
        F.transform(s, lead).alias("leads"),
        F.transform(esc, lambda x: F.length(x).cast("long")).alias("lens"),
        F.transform(s, lambda x: x["role"].isin(*t.trained_roles)).alias("trained"),
    )
    steps = F.zip_with("leads", "lens", lambda a, b: a + b)
    offsets = parts.withColumn("steps", steps).withColumn("before", _running(F.col("steps")))
    spans = F.zip_with(F.arrays_zip("before", "leads"), F.arrays_zip("lens", "trained"), lambda a, b: F.struct((a["before"] + a["leads"]).alias("start"), b["lens"].alias("len"), b["trained"].alias("trained")))
    kept = F.transform(F.filter(spans, lambda x: x["trained"]), lambda x: F.struct(x["start"].alias("start"), x["len"].alias("len")))
    return offsets.select(F.col("conv").alias(conv_col), "formatted", kept.alias("loss_spans"))


def parse_chat(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The turns of a formatted text again: array<struct<role, text>>, one for each turn that went in."""
    t = template

    def turns(message: Column) -> Column:
        halves = F.split(F.substr(message, F.lit(len(t.turn) + 1)), re.escape(t.body), -1)
        return F.transform(F.split(F.get(halves, F.lit(1)), re.escape(t.more), -1), lambda x: F.struct(t.unescape(F.get(halves, F.lit(0))).alias("role"), t.unescape(x).alias("text")))

    pieces = F.split(formatted, re.escape(t.end), -1)
    return F.flatten(F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turns))


def masked_text(formatted: Column, spans: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """All text under the loss mask, unescaped and joined with nothing between."""
    return F.array_join(F.transform(spans, lambda x: template.unescape(F.substr(formatted, (x["start"] + 1).cast("int"), x["len"].cast("int")))), "")
