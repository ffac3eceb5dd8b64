"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted, adjacent turns of one role
become one block, and blocks are concatenated:

    <s>role<role>text<turn>text</s><s>role<role>text</s>

Control strings inside roles and texts get one more backslash after their first character
(``<s>`` becomes ``<\\s>``, ``<\\s>`` becomes ``<\\\\s>``), so a plain control string in the
output always belongs to the template and reading back is exact.

Defined cases: a null text is an empty one, a null role the empty role; a null turn sorts
first, equal turns by role, then text; repeated rows are repeated turns; rows with a null
conversation id form one conversation; an empty table gives an empty result. A conversation
is one row of the result, which is what bounds its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import pick

OPEN, ROLE, TURN, CLOSE = "<s>", "<role>", "<turn>", "</s>"

#: The template's control strings and those of a common instruction template.
CONTROL = r"/?s>|role>|turn>|/?INST\]"
PLAIN = rf"([<\[])(\\*)({CONTROL})"
ESCAPED = rf"([<\[])\\(\\*)({CONTROL})"

ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(PLAIN), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPED), F.lit("$1$2$3"))


def _blocks(turns: Column) -> Column:
    """Runs of turns with one role, each with its escaped role and texts."""
    count = F.size(turns)
    starts = F.filter(
        F.sequence(F.lit(0), count - 1),
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]),
    )

    def block(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(starts, k + 1), count)
        return F.struct(
            escape(F.get(turns, start)["role"]).alias("role"),
            F.transform(
                F.slice(turns, start + 1, stop - start), lambda turn: escape(turn["text"])
            ).alias("texts"),
        )

    return F.transform(starts, block)


def _written(block: Column) -> Column:
    return F.concat(
        F.lit(OPEN), block["role"], F.lit(ROLE), F.array_join(block["texts"], TURN), F.lit(CLOSE)
    )


def _assistant_spans(blocks: Column, role: str) -> Column:
    """Start and stop, in code points of the output, of each text of ``role``."""
    none = F.array().cast("array<struct<start:int,stop:int>>")
    state = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def over_text(acc: Column, text: Column) -> Column:
        stop = acc["at"] + F.length(text)
        span = F.struct(acc["at"].alias("start"), stop.alias("stop"))
        return F.struct(
            (stop + len(TURN)).alias("at"),
            F.concat(acc["spans"], F.array(span)).alias("spans"),
        )

    def over_block(acc: Column, block: Column) -> Column:
        body = acc["at"] + len(OPEN) + F.length(block["role"]) + len(ROLE)
        entered = F.struct(body.alias("at"), acc["spans"].alias("spans"))
        masked = F.aggregate(block["texts"], entered, over_text)["spans"]
        return F.struct(
            (acc["at"] + F.length(_written(block))).alias("at"),
            F.when(block["role"] == role, masked).otherwise(acc["spans"]).alias("spans"),
        )

    return F.aggregate(blocks, state, over_block)["spans"]


def format_chats(conversations: DataFrame, learned_role: str = ASSISTANT) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss_spans``, the places
    (start, stop) of the texts that a model is to learn."""
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    turn = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return (
        rows.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
        .select("conv_id", _blocks(F.col("turns")).alias("blocks"))
        .select(
            "conv_id",
            F.array_join(F.transform("blocks", _written), "").alias("formatted"),
            _assistant_spans(F.col("blocks"), learned_role).alias("loss_spans"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns in a formatted text: an array of (role, text), as they were given."""
    blocks = F.split(formatted, CLOSE)

    def turns(block: Column) -> Column:
        parts = F.split(F.substring(block, len(OPEN) + 1, 2**31 - 1), ROLE, 2)
        return F.transform(
            F.split(parts[1], TURN),
            lambda text: F.struct(
                unescape(parts[0]).alias("role"), unescape(text).alias("text")
            ),
        )

    return F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), turns))


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(
        spans,
        lambda span: unescape(
            F.substring(formatted, span["start"] + 1, span["stop"] - span["start"])
        ),
    )


def chat_digests(conversations: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from the output."""
    formatted = F.col("formatted")
    lines = F.transform(
        read_turns(formatted),
        lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n")),
    )
    return (
        format_chats(conversations)
        .select(
            "conv_id",
            formatted,
            lines.alias("lines"),
            F.array_join(masked_texts(formatted, F.col("loss_spans")), "").alias("learned"),
        )
        .select(
            "conv_id",
            F.size("lines").cast("long").alias("n_turns"),
            F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("turns_sha256"),
            F.length("learned").cast("long").alias("loss_chars"),
            F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
            F.length(formatted).cast("long").alias("formatted_chars"),
        )
    )
