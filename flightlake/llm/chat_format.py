"""Chat formatting with typed content parts.

A message's content is a list of parts: text, image, audio or document. A
visitor (one case per type) flattens the parts of a turn, in order, into one
string: text is escaped, every other part becomes an ordered placeholder
``<|image:3|>`` that counts the attachments of the conversation, whose
reference and expanded token count are recorded. Turns are marked

    <|role|>\\n ... <|end|>\\n

Escaping: an opener ``<`` or ``[`` of a control string (``<|``, ``<s>``,
``</s>``, ``[INST]``, ``[/INST]``) gets an underscore after it, and so does an
opener that already has underscores there, so one underscore can be taken
off again and every text comes back exactly. Neighbouring text parts are joined
before they are escaped, and a role's ``|>`` gets an underscore too, so no text,
however it is cut into parts, and no role can forge a mark. ``parse_content``
reads the typed parts back: a placeholder is a mark, a text that looks like one
is escaped.

Only built-in expressions. One conversation is one output row and is
assembled in one task; turns are grouped by conversation with one shuffle.

Defined cases: a null text counts as empty, a null role as ``unknown`` (a role
is escaped like a text, and a line end in it counts as text); equal turn
numbers, and null ones (first), are ordered by role, then text; repeated rows
are turns of their own; rows without conversation id form one conversation
with a null id; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

TURN_OPEN, MARK_CLOSE, TURN_END = "<|", "|>\n", "<|end|>\n"
# Control strings of chat templates, by opener and what follows.
ROLE_CLOSE, ROLE_OPENED = r"\|(?=_*>)", r"\|_(?=_*>)"
PLACEHOLDER = r"<\|[a-z]*:\d+\|>"
CONTROL_TAIL = r"(?:\||/?s>|/?INST\])"
ESCAPE = rf"([<\[])(?=_*{CONTROL_TAIL})"
UNESCAPE = rf"([<\[])_(?=_*{CONTROL_TAIL})"
# Tokens that an attachment expands to: a fixed number plus one per unit
# (image tiles, audio seconds, document pages).
EXPANSION = {"image": (85, 170), "audio": (2, 25), "document": (4, 700)}
ASSISTANT = "assistant"

PART = "struct<type:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, "$1_")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), ROLE_CLOSE, "|_")


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(role, ROLE_OPENED, "|"))


def text_part(text: Column) -> Column:
    """A content list with one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text.cast("string"), F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units")))


def expanded_tokens(part: Column) -> Column:
    """Token count of an attachment part; unknown types count their fixed share as a document."""
    base, unit = EXPANSION["document"]
    cost = F.lit(base) + unit * F.coalesce(part["units"], F.lit(1))
    for kind, (b, u) in EXPANSION.items():
        cost = F.when(part["type"] == kind, F.lit(b) + u * F.coalesce(part["units"], F.lit(1))).otherwise(cost)
    return cost.cast("long")


def is_text(part: Column) -> Column:
    return F.coalesce(part["type"] == "text", F.lit(False))


def joined_texts(parts: Column) -> Column:
    """A content list whose neighbouring text parts are one part; null: empty."""
    def add(acc: Column, p: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        both = F.concat(F.coalesce(last["text"], F.lit("")), F.coalesce(p["text"], F.lit("")))
        whole = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), text_part(both).cast(f"array<{PART}>"))
        return F.when((F.size(acc) > 0) & is_text(p) & F.coalesce(is_text(last), F.lit(False)), whole).otherwise(F.concat(acc, F.array(p)))
    empty = F.array().cast(f"array<{PART}>")
    return F.when(F.size(parts) > 1, F.aggregate(parts, empty, add)).otherwise(F.coalesce(parts, empty))


def visit(part: Column, place: Column) -> Column:
    """The flat form of one part; ``place`` numbers the conversation's attachments."""
    kind = F.coalesce(F.regexp_replace(part["type"], "[^a-z]", ""), F.lit("unknown"))
    mark = F.concat(F.lit("<|"), kind, F.lit(":"), place.cast("string"), F.lit("|>"))
    return F.when(is_text(part), escape(F.coalesce(part["text"], F.lit("")))).otherwise(mark)


def conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  content: Column | None = None, text: str = "text") -> DataFrame:
    """One row per conversation: ``conv`` and ``turns`` (role, parts) in order."""
    parts = text_part(F.col(text)) if content is None else joined_texts(content.cast(f"array<{PART}>"))
    one = F.struct(F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("unknown")).alias("role"),
                   parts.cast(f"array<{PART}>").alias("parts"))
    return rows.select(F.col(conv), one.alias("t")).groupBy(conv).agg(F.sort_array(F.collect_list("t")).alias("turns"))


def format_conversations(grouped: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``conv``, ``formatted``, ``mask`` (start and length of every assistant
    body, in characters) and ``attachments`` (place, turn, type, ref, units, tokens)."""
    def numbered(turns: Column) -> Column:
        # running attachment number at the start of each turn, in one pass
        return F.aggregate(
            turns, F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("at")),
            lambda a, t: F.struct((a["n"] + F.size(F.filter(t["parts"], lambda p: ~is_text(p)))).alias("n"),
                                  F.concat(a["at"], F.array(a["n"])).alias("at")))["at"]

    def body(parts: Column, first: Column) -> Column:
        def place(i: Column) -> Column:
            return first + F.size(F.filter(F.slice(parts, F.lit(1), i), lambda p: ~is_text(p)))
        return F.array_join(F.transform(parts, lambda p, i: visit(p, place(i))), "")

    has_attachment = F.exists("turns", lambda t: F.exists(t["parts"], lambda p: ~is_text(p)))
    starts = F.when(has_attachment, let(F.col("turns"), numbered)).otherwise(F.array_repeat(F.lit(0), F.size("turns")))
    pieces = F.zip_with("turns", starts, lambda t, n: F.struct(
        t["role"].alias("role"), body(t["parts"], n).alias("body"), n.alias("n"), t["parts"].alias("parts")))
    g = grouped.select(conv, pieces.alias("pieces"))
    turns = F.transform("pieces", lambda p: F.struct(
        F.concat(F.lit(TURN_OPEN), escape_role(p["role"]), F.lit(MARK_CLOSE)).alias("head"), p["body"].alias("body"),
        (p["role"] == ASSISTANT).alias("learn")))
    g = g.withColumn("marked", turns)

    def spans(marked: Column) -> Column:
        # start of each body, by a running length
        run = F.aggregate(
            marked, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,size:int>>").alias("out")),
            lambda a, m: F.struct(
                (a["at"] + F.length(m["head"]) + F.length(m["body"]) + len(TURN_END)).alias("at"),
                F.when(m["learn"], F.concat(a["out"], F.array(F.struct((a["at"] + F.length(m["head"])).alias("start"), F.length(m["body"]).alias("size")))))
                .otherwise(a["out"]).alias("out")))
        return run["out"]

    attachments = F.when(F.exists("pieces", lambda p: F.exists(p["parts"], lambda x: ~is_text(x))), F.flatten(F.transform("pieces", lambda p, i: F.transform(
        F.filter(p["parts"], lambda x: ~is_text(x)),
        lambda x, k: F.struct((p["n"] + k).alias("place"), i.alias("turn"), x["type"].alias("type"), x["ref"].alias("ref"), x["units"].alias("units"),
                              expanded_tokens(x).alias("tokens")))))).otherwise(
        F.array().cast("array<struct<place:int,turn:int,type:string,ref:string,units:bigint,tokens:bigint>>"))
    return g.select(
        conv, F.array_join(F.transform("marked", lambda m: F.concat(m["head"], m["body"], F.lit(TURN_END))), "").alias("formatted"),
        let(F.col("marked"), spans).alias("mask"), attachments.alias("attachments"))


def turn_blocks(column: str) -> Column:
    blocks = F.split(F.col(column), r"<\|end\|>\n")
    return F.slice(blocks, F.lit(1), F.greatest(F.size(blocks) - 1, F.lit(0)))


def block_role(block: Column) -> Column:
    return unescape_role(block.substr(F.lit(len(TURN_OPEN) + 1), F.locate(MARK_CLOSE, block) - 1 - len(TURN_OPEN)))


def block_body(block: Column) -> Column:
    return block.substr(F.locate(MARK_CLOSE, block) + len(MARK_CLOSE), F.length(block))


def parse(formatted: DataFrame, conv: str = "conv_id", column: str = "formatted") -> DataFrame:
    """The turns (role, text) read back from the formatted string alone; a text
    holds its placeholders (:func:`parse_content` tells them from texts)."""
    turn = lambda block: F.struct(block_role(block).alias("role"), unescape(block_body(block)).alias("text"))
    return formatted.withColumn("parsed", F.transform(turn_blocks(column), turn))


def parse_content(formatted: DataFrame, column: str = "formatted", attachments: str = "attachments") -> DataFrame:
    """The turns as ``content`` (role, parts): texts as they were, neighbours joined
    and empty ones left out, and the attachments that the placeholders number."""
    def read(body: Column) -> Column:
        marks = F.regexp_extract_all(body, F.lit(f"({PLACEHOLDER})"), F.lit(1))

        def piece(text: Column, i: Column) -> Column:
            place = F.regexp_extract(F.get(marks, i), r":(\d+)", 1).cast("int")
            held = F.get(F.col(attachments), place)
            part = F.array(F.struct(held["type"].alias("type"), F.lit(None).cast("string").alias("text"), held["ref"].alias("ref"), held["units"].alias("units")))
            none = F.array().cast(f"array<{PART}>")
            return F.concat(F.when(text != "", text_part(unescape(text))).otherwise(none), F.when(i < F.size(marks), part).otherwise(none))
        return F.flatten(F.transform(F.split(body, PLACEHOLDER), piece))
    turn = lambda block: F.struct(block_role(block).alias("role"), read(block_body(block)).alias("parts"))
    return formatted.withColumn("content", F.transform(turn_blocks(column), turn))


def masked_texts(column: str = "formatted", mask: str = "mask") -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(mask, lambda m: unescape(F.col(column).substr(m["start"] + 1, m["size"])))


def round_trip(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Digests of what the formatted strings hold, read back from them."""
    p = parse(formatted, conv)
    flat = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(masked_texts(), "")
    return p.select(
        conv, F.size("parsed").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
