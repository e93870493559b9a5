"""Chat formatting of typed content parts.

A message is a role and an ordered array of parts, each of type text, image, audio or document. ``PartVisitor`` has one method
per type that says what a part becomes: the characters it adds to the turn, the attachment it refers to, if any, and how many
tokens its placeholder expands to. ``format_turns`` visits every part in order and wraps the turn in the template's marks;
``format_conversations`` joins the turns of a conversation; ``read_turns`` takes a formatted conversation apart again.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Control strings begin with ``<|``. Inside texts and roles a
backslash becomes two and ``<|`` becomes ``<\\|`` (in roles a line break becomes ``\\n``), so no text can hold a control string
and unescaping restores it exactly. The loss mask covers the text of assistant turns, as (start, length) spans in code points; a
span also tells its turn's place in the conversation and how far into the turn it begins, so that reading it needs no count from
the conversation's start.

Defined results: a null text or part list is an empty one; a null role is ''; a part of another type, or of none, is text;
turns are ordered by turn (nulls first), then role, then text, so ties and repeated rows have one order; a null conv_id is a
conversation of its own; an empty table gives an empty result; other columns are ignored.

Scale: turns are formatted one by one, before the only shuffle, which brings the turns of a conversation together, since the
result is one string per conversation. Offsets are a running sum over the sorted turns, and a conversation is split once to be read,
so time grows with its length. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART_TYPE = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # \n is a line break, any other escaped character itself; a backslash pair must not lend its second half to an n
    pairs = F.regexp_extract_all(role, F.lit(r"(?s)(\\.|[^\\])"), 1)
    return F.array_join(F.transform(pairs, lambda c: F.when(c == "\\n", "\n").when(F.length(c) == 2, F.substring(c, 2, 1)).otherwise(c)), "")


class PartVisitor:
    """What a part becomes, by its type: (characters, attachment reference or null, tokens the placeholder expands to)."""

    tile, audio_tokens_per_second, document_tokens_per_page = 28, 25, 512

    def text(self, part: Column) -> tuple[Column, Column, Column]:
        return escape(F.coalesce(part["text"], F.lit(""))), F.lit(None).cast("string"), F.lit(0)

    def image(self, part: Column) -> tuple[Column, Column, Column]:
        tiles = lambda c: F.greatest(F.lit(1), F.ceil(F.coalesce(part[c], F.lit(0)) / self.tile))
        return F.lit("<|image|>"), part["ref"], (tiles("width") * tiles("height")).cast("int")

    def audio(self, part: Column) -> tuple[Column, Column, Column]:
        return F.lit("<|audio|>"), part["ref"], F.greatest(F.lit(1), F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.audio_tokens_per_second)).cast("int")

    def document(self, part: Column) -> tuple[Column, Column, Column]:
        return F.lit("<|document|>"), part["ref"], (F.greatest(F.lit(1), F.coalesce(part["pages"], F.lit(0))) * self.document_tokens_per_page).cast("int")

    def visit(self, part: Column) -> Column:
        """struct(s, type, ref, tokens)."""
        image, audio, document, text = self.image(part), self.audio(part), self.document(part), self.text(part)
        pick = lambda k: F.when(part["type"] == "image", image[k]).when(part["type"] == "audio", audio[k]).when(
            part["type"] == "document", document[k]).otherwise(text[k])
        kind = F.when(part["type"].isin("image", "audio", "document"), part["type"]).otherwise(F.lit("text"))
        return F.struct(pick(0).alias("s"), kind.alias("type"), pick(1).alias("ref"), pick(2).alias("tokens"))


def text_part(text: Column) -> Column:
    """A message's text as its only part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).alias("ref"), F.lit(None).alias("width"),
                            F.lit(None).alias("height"), F.lit(None).alias("seconds"), F.lit(None).alias("pages"))).cast(f"array<{PART_TYPE}>")


def format_turns(messages: DataFrame, visitor: PartVisitor | None = None) -> DataFrame:
    """conv_id, turn, role, head, body, attachments from (conv_id, turn, role, parts). attachments: ordered (type, ref, tokens)."""
    visitor = visitor or PartVisitor()
    parts = F.coalesce("parts", F.array().cast(f"array<{PART_TYPE}>"))
    seen = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.transform(parts, visitor.visit).alias("seen"))
    return seen.select(
        "conv_id", "turn", "role",
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        F.array_join(F.transform("seen", lambda x: x["s"]), "").alias("body"),
        F.transform(F.filter("seen", lambda x: x["type"] != "text"), lambda x: F.struct(x["type"].alias("type"), x["ref"].alias("ref"), x["tokens"].alias("tokens"))).alias("attachments"))


def format_conversations(messages: DataFrame, visitor: PartVisitor | None = None) -> DataFrame:
    """conv_id, formatted, loss_spans (start and length in code points, turn from 0, skip: code points of the turn after its start
    mark up to the span), attachments (type, ref, tokens), expanded_tokens."""
    turns = format_turns(messages, visitor)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body", "attachments")
    size = (F.length("head") + F.length("body") + len(END) + 1).cast("long")
    turns = turns.withColumn("n", F.row_number().over(order)).withColumn("at", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size)
    turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "at", "role", "head", "body", "attachments"))).alias("t"))
    strings = F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(END + "\n")))
    spans = F.transform(F.filter("t", lambda x: x["role"] == "assistant"), lambda x: F.struct(
        (x["at"] + F.length(x["head"])).alias("start"), F.length(x["body"]).cast("long").alias("length"),
        (x["n"] - 1).alias("turn"), (F.length(x["head"]) - len(START)).alias("skip")))
    attachments = F.flatten(F.transform("t", lambda x: x["attachments"]))
    return turns.select("conv_id", F.array_join(strings, "").alias("formatted"), spans.alias("loss_spans"), attachments.alias("attachments"),
                        F.aggregate(F.transform(attachments, lambda x: x["tokens"]), F.lit(0).cast("long"), lambda a, x: a + x).alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    turns = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda x: x != "")
    cut = F.transform(turns, lambda x: F.substring(x, F.lit(1), F.length(x) - (len(END) + 1)))
    return F.transform(cut, lambda x: F.struct(
        unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
        unescape(F.substring(x, F.length(F.substring_index(x, "\n", 1)) + 2, F.length(x))).alias("text")))


def masked_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    # the pieces are a lambda's variable: as an expression they would be split again for every span
    joined = F.transform(F.array(F.split(formatted, r"<\|im_start\|>")), lambda pieces: F.array_join(F.transform(
        loss_spans, lambda s: unescape(F.substring(F.get(pieces, s["turn"] + 1), s["skip"] + 1, s["length"].cast("int")))), ""))
    return F.get(joined, F.lit(0))
