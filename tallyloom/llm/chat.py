"""Chat formatting with Spark expressions only.

Template, for each run of adjacent turns of one role:

    <|im_start|>role NEWLINE text [<|im_next|> text ...] <|im_end|> NEWLINE

Adjacent turns of one role share one block; ``<|im_next|>`` marks where one
stops, so that the rows can be read back. Texts and roles are escaped first:
``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|`` (in roles also a newline
``&#10;``), so no text can hold a control string, and unescaping gives back
exactly what was there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.text_columns import let

# Turns summed up together.
FOLD = 512
SPAN = "struct<start:bigint,length:bigint,byte_start:bigint,byte_length:bigint>"
START, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("&#10;"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def format_conversations(turns: DataFrame, assistant: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, ``formatted`` text and ``loss_spans``, an
    array of the texts to be learned: (start, length) in code points, and the same
    in UTF-8 bytes (byte_start, byte_length).

    ``turns`` has conv_id, turn, role, text; other columns are ignored. Turns are
    ordered by turn, then role, then text (nulls first); repeated rows are kept.
    A null text or role is empty; a null conv_id is a conversation of its own. A
    conversation is one row of the result, hence gathered in one task as the
    format requires.
    """
    row = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    gathered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))

    def parts(turns: Column) -> Column:
        """For each turn: what precedes its text, the text, and what follows."""
        size = F.size(turns)

        def one(t: Column, k: Column) -> Column:
            before, after = F.get(turns, k - 1), F.get(turns, k + 1)
            same = (k > 0) & before["role"].eqNullSafe(t["role"])
            last = (k == size - 1) | ~after["role"].eqNullSafe(t["role"])
            opening = F.concat(F.lit(START), _escaped_role(t["role"]), F.lit("\n"))
            return F.struct(
                F.when(same, F.lit(NEXT)).otherwise(opening).alias("head"),
                escaped(t["text"]).alias("body"),
                F.when(last, F.lit(END + "\n")).otherwise(F.lit("")).alias("tail"),
                (t["role"] == assistant).alias("learned"),
            )

        return F.transform(turns, one)

    pieces = gathered.select("conv_id", let(F.col("turns"), parts).alias("parts"))
    # Where each text begins: the lengths before it, summed in one pass over FOLD turns at
    # a time and one over what those come to, so that no array grows with a conversation
    # while it is copied.
    none = F.array().cast(f"array<{SPAN}>")
    zero = F.lit(0).cast("long")
    begin = F.struct(zero.alias("at"), zero.alias("byte"), none.alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        body, body_bytes = F.length(p["body"]).cast("long"), F.octet_length(p["body"]).cast("long")
        start = acc["at"] + F.length(p["head"])
        byte = acc["byte"] + F.octet_length(p["head"])
        span = F.struct(
            start.alias("start"),
            body.alias("length"),
            byte.alias("byte_start"),
            body_bytes.alias("byte_length"),
        )
        return F.struct(
            (start + body + F.length(p["tail"])).alias("at"),
            (byte + body_bytes + F.octet_length(p["tail"])).alias("byte"),
            F.when(p["learned"], F.concat(acc["spans"], F.array(span)))
            .otherwise(acc["spans"])
            .alias("spans"),
        )

    def in_portions(parts: Column) -> Column:
        last = F.floor((F.size(parts) - 1) / FOLD).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda k: F.aggregate(F.slice(parts, k * FOLD + 1, F.lit(FOLD)), begin, step),
        )

    def put_together(portions: Column) -> Column:
        start = F.struct(
            zero.alias("at"), zero.alias("byte"), F.array().cast(f"array<array<{SPAN}>>").alias("lists")
        )

        def moved(acc: Column, portion: Column) -> Column:
            spans = F.transform(
                portion["spans"],
                lambda s: F.struct(
                    (s["start"] + acc["at"]).alias("start"),
                    s["length"].alias("length"),
                    (s["byte_start"] + acc["byte"]).alias("byte_start"),
                    s["byte_length"].alias("byte_length"),
                ),
            )
            return F.struct(
                (acc["at"] + portion["at"]).alias("at"),
                (acc["byte"] + portion["byte"]).alias("byte"),
                F.concat(acc["lists"], F.array(spans)).alias("lists"),
            )

        return F.aggregate(portions, start, moved, lambda acc: F.flatten(acc["lists"]))

    return pieces.select(
        "conv_id",
        F.array_join(
            F.transform("parts", lambda p: F.concat(p["head"], p["body"], p["tail"])), ""
        ).alias("formatted"),
        put_together(let(F.col("parts"), in_portions)).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), in order."""
    blocks = F.slice(
        F.split(formatted, r"\Q" + START + r"\E"), F.lit(2), F.greatest(F.length(formatted), F.lit(1))
    )

    def block_turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        rest = F.substring(block, F.length(role) + F.lit(2), F.length(block))
        inner = F.substring(rest, F.lit(1), F.length(rest) - F.lit(len(END) + 1))
        return F.transform(
            F.split(inner, r"\Q" + NEXT + r"\E"),
            lambda text: F.struct(
                _unescaped_role(role).alias("role"), unescaped(text).alias("text")
            ),
        )

    return F.flatten(F.transform(blocks, block_turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """What lies under the loss mask, unescaped, nothing in between.

    Cut by bytes, so that no cut has to count the characters before it.
    """

    def cut(data: Column) -> Column:
        def one(s: Column) -> Column:
            at, size = (s["byte_start"] + 1).cast("int"), s["byte_length"].cast("int")
            return unescaped(F.decode(F.substring(data, at, size), "UTF-8"))

        return F.transform(spans, one)

    return F.array_join(let(F.encode(formatted, "UTF-8"), cut), "")


def turns_digest(turns: Column) -> Column:
    """SHA-256 of role, newline, text, newline of every turn."""
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256)
