"""Chat formatting by prefix-target expansion: one training example per assistant turn.

An example is the conversation up to and including one assistant turn; only that turn's text is
under the loss mask. Turns after the last assistant turn, or a conversation without one, give one
more example without a mask, so no turn is lost.

A turn is written ``<|im_start|>role LF text<|im_end|> LF``. Inside roles and texts a ``<``, any
number of backslashes and a ``|`` get one backslash more, so the two marks cannot occur there and
removing one backslash restores the text. A role's backslashes and line feeds become ``\\\\`` and ``\\n``.

Defined cases: a null role or text is empty, a null conversation id is a conversation of its own,
rows of one turn number are ordered by role and text (nulls first), repeated rows stay repeated,
an empty table gives no examples, further columns are ignored.

A conversation is one row here, as its examples and digests need all its turns in order; a
conversation of n turns makes up to n examples of up to n turns each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(unescape(role), r"\\\\"), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def format_examples(conversations: DataFrame) -> DataFrame:
    """Examples: conv_id, example, text, loss_start (code points before the mask), loss_length.

    ``example`` is the number of turns in the text; the mask of a text without trainable turn is
    null and 0 long.
    """
    none = F.lit("")
    turns = (
        conversations.select("conv_id", F.struct("turn", "role", "text").alias("row"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("row")).alias("rows"))
        .withColumn(
            "turns",
            F.transform(
                "rows",
                lambda r: F.struct(
                    (F.coalesce(r.role, none) == "assistant").alias("reply"),
                    F.concat(F.lit(START), escape_role(F.coalesce(r.role, none)), F.lit("\n")).alias("head"),
                    escape(F.coalesce(r.text, none)).alias("body"),
                ),
            ),
        )
        .withColumn("pieces", F.transform("turns", lambda t: F.concat(t.head, t.body, F.lit(END))))
    )
    exploded = turns.select("conv_id", "pieces", F.size("turns").alias("n"), F.posexplode("turns").alias("at", "turn"))
    wanted = exploded.where(F.col("turn.reply") | (F.col("at") == F.col("n") - 1))
    text = F.array_join(F.slice("pieces", F.lit(1), F.col("at") + 1), "")
    length = F.when(F.col("turn.reply"), F.char_length("turn.body")).otherwise(0)
    return wanted.select(
        "conv_id",
        (F.col("at") + 1).alias("example"),
        text.alias("text"),
        F.when(F.col("turn.reply"), F.char_length(text) - length - len(END)).alias("loss_start"),
        length.alias("loss_length"),
    )


def read_turns(text: Column) -> Column:
    """Turns (role, text) of a formatted text, as they were before formatting."""
    pieces = F.filter(F.split(text, r"<\|im_start\|>"), lambda x: x != "")
    return F.transform(
        pieces,
        lambda x: F.struct(
            unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
            unescape(
                F.substring(
                    x,
                    F.char_length(F.substring_index(x, "\n", 1)) + 2,
                    F.char_length(x) - F.char_length(F.substring_index(x, "\n", 1)) - 1 - len(END),
                )
            ).alias("text"),
        ),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of every conversation, from its formatted examples alone."""
    masked = F.when(
        F.col("loss_start").isNotNull(),
        F.struct("example", unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_length"))).alias("reply")),
    )
    per = examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("whole"),
        F.array_sort(F.collect_list(masked)).alias("replies"),
        F.sum(F.char_length("text").cast("long")).alias("formatted_chars"),
    )
    turns = read_turns(F.col("whole"))
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return (
        per.withColumn("turns", turns)
        .withColumn("loss", F.array_join(F.transform("replies", lambda r: r.reply), ""))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
            F.char_length("loss").cast("long").alias("loss_chars"),
            F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
