"""Chat formatting by relational means: no Python runs on the executors.

A conversation's turns are collected as structs and sorted; neighbours of one
role become one block.  A block is ``<turn ROLE>text</turn>`` and a line break,
the texts of merged turns parted by ``<next/>``.  Inside texts and roles a
backslash is written ``\\b``, ``<`` is ``\\l`` and (in roles) ``>`` is ``\\g``, so no
text can hold a control string, and what was written can be read back exactly:
a backslash of the output is always followed by one of these letters.

The loss mask is an array of (start, length) in code points of the formatted
text: exactly the texts of assistant turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docsync.llm.common import let, part_of, pieces_of, running

OPEN, CLOSE, NEXT = "<turn ", "</turn>\n", "<next/>"
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(">"), F.lit("\\g"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\g"), F.lit(">")))


def format_conversations(
    rows: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """(conv_id, formatted, loss_mask): one row a conversation.

    Turns go by ``turn``, then role, then text; a null turn is first.  A null
    text or role is empty.  Rows with a null conv_id are a conversation.
    Repeated rows are repeated turns.  No rows give no rows.
    """
    turn = F.struct(
        F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column), F.lit("")).alias("role"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    sorted_turns = (
        rows.select(F.col(conv_column).alias("conv_id"), turn.alias("t"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )
    # Each turn beside the role before it, so that blocks are found in one pass.
    roles = F.transform("turns", lambda t: t["role"])
    paired = sorted_turns.select(
        "conv_id",
        F.zip_with("turns", F.concat(F.array(F.lit(None).cast("string")), F.slice(roles, 1, F.size(roles) - 1)), lambda t, before: F.struct(t["role"].alias("role"), t["text"].alias("text"), before.alias("before"))).alias("turns"),
    )

    def piece(t: Column) -> Column:
        head = F.concat(F.lit(OPEN), escaped_role(t["role"]), F.lit(">"))
        mark = (
            F.when(t["before"].isNull(), head)
            .when(t["before"] == t["role"], F.lit(NEXT))
            .otherwise(F.concat(F.lit(CLOSE), head))
        )
        return F.struct(mark.alias("mark"), escaped(t["text"]).alias("text"), (t["role"] == LEARNED_ROLE).alias("learned"))

    pieces = paired.select("conv_id", F.transform("turns", piece).alias("pieces"))
    sizes = F.transform("pieces", lambda p: (F.length(p["mark"]) + F.length(p["text"])).cast("long"))
    spans = F.filter(
        F.zip_with(
            "pieces", running(sizes), lambda p, end: F.struct((end - F.length(p["text"])).cast("int").alias("start"), F.length(p["text"]).alias("length"), p["learned"].alias("learned"))
        ),
        lambda s: s["learned"],
    )
    mask = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    joined = F.array_join(F.transform("pieces", lambda p: F.concat(p["mark"], p["text"])), "")
    return pieces.select("conv_id", F.concat(joined, F.lit(CLOSE)).alias("formatted"), mask.alias("loss_mask"))


def parse_formatted(formatted: Column) -> Column:
    """The turns back from the formatted text: array of blocks (role, texts)."""
    whole = F.split(formatted, CLOSE, -1)
    blocks = F.slice(whole, 1, F.size(whole) - 1)

    def block(b: Column) -> Column:
        return F.struct(
            unescaped_role(F.substr(F.substring_index(b, ">", 1), F.lit(len(OPEN) + 1))).alias("role"),
            F.transform(
                F.split(F.substr(b, F.length(F.substring_index(b, ">", 1)) + 2), NEXT, -1), unescaped
            ).alias("texts"),
        )

    return F.transform(blocks, block)


def learned_text(pieces: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between; of a text cut into pieces."""
    return let(pieces, lambda p: F.array_join(F.transform(mask, lambda s: unescaped(part_of(p, s["start"], s["length"]))), ""))


def digest(formatted: DataFrame) -> DataFrame:
    """What the formatted texts say when read back; ``n_blocks`` counts merged turns."""
    read = formatted.select("conv_id", "formatted", "loss_mask", parse_formatted(F.col("formatted")).alias("blocks"))
    said = F.array_join(
        F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda t: F.concat(b["role"], F.lit("\n"), t, F.lit("\n"))))), ""
    )
    read = read.withColumn("loss", learned_text(pieces_of(F.col("formatted")), F.col("loss_mask")))
    turns = F.aggregate("blocks", F.lit(0), lambda acc, b: acc + F.size(b["texts"]))
    return read.select(
        "conv_id",
        turns.cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("blocks").cast("long").alias("n_blocks"),
    )
