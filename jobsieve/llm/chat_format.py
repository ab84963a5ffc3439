"""Chat formatting: every assistant turn becomes an example of its own.

An example holds the turns up to and including one assistant turn; only that turn's text is trained on. Turns are marked as
``### role: text</turn>`` and a line feed. Backslashes, ``### `` and ``</turn>`` inside texts are escaped with backslashes, so that a marker in the output is always one of the template
and texts can be read back. Everything is column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, COLON, END = "### ", ": ", "</turn>\n"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    # Every # before ##, so that longer runs hold no mark either.
    text = F.regexp_replace(text, "#(?=##)", "#\\\\")
    return F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    """A role is also kept free of the colon that ends it: ``\\c`` stands for it."""
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*+)\\c", "$1:"))


def head(role: Column) -> Column:
    return F.concat(F.lit(HEAD), escape_role(role), F.lit(COLON))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, n_turns, and ``replies``: turn_no, start and stop (code points from 0) of every assistant text.

    ``turns`` has conv_id, turn, role, text; rows are taken by turn (ties and nulls by role and text, nulls first). A null text or role counts as empty, a
    null conv_id is a conversation of its own, repeated rows are turns of their own, an empty table gives no rows. Other columns are not read."""
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumn("head", head(F.col("role"))).withColumn("body", escape(F.col("text")))
    parts = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "head", "body")))
    convs = rows.groupBy("conv_id").agg(parts.alias("parts"))
    # Where each turn starts: the running sum of the lengths before it.
    full = F.transform("parts", lambda p: F.char_length(p["head"]) + F.char_length(p["body"]) + len(END))
    starts = F.aggregate(
        full, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")),
    )["starts"]
    replies = F.filter(
        F.transform(
            F.arrays_zip(F.col("parts"), F.col("starts")),
            lambda z, i: F.struct(
                i.alias("turn_no"), (z["starts"] + F.char_length(z["parts"]["head"])).alias("start"),
                (z["starts"] + F.char_length(z["parts"]["head"]) + F.char_length(z["parts"]["body"])).alias("stop"),
                (z["parts"]["role"] == TRAINED).alias("trained"),
            ),
        ),
        lambda r: r["trained"],
    )
    formatted = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return convs.withColumn("starts", starts).select("conv_id", formatted.alias("formatted"), F.size("parts").cast("bigint").alias("n_turns"), replies.alias("replies"))


def expand(formatted: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, turn_no, text (all turns before it and the reply), loss_start, loss_stop in code points.

    Only the characters from loss_start to loss_stop are trained on. A conversation without assistant turns has no example."""
    rows = formatted.select("conv_id", "formatted", F.explode("replies").alias("r"))
    return rows.select(
        "conv_id", F.col("r.turn_no").alias("turn_no"), F.substring("formatted", F.lit(1), F.col("r.stop") + len(END)).alias("text"),
        F.col("r.start").alias("loss_start"), F.col("r.stop").alias("loss_stop"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    blocks = F.filter(F.split(formatted, END, -1), lambda b: b != "")
    at = lambda b: F.instr(b, COLON)
    return F.transform(
        blocks,
        lambda b: F.struct(
            unescape_role(F.substring(b, F.lit(len(HEAD) + 1), at(b) - 1 - len(HEAD))).alias("role"),
            unescape(F.substring(b, at(b) + len(COLON), F.char_length(b))).alias("text"),
        ),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, what can be read back from its formatted text and from the examples made of it."""
    examples = expand(formatted).select(
        "conv_id", "turn_no", unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_stop") - F.col("loss_start"))).alias("reply")
    )
    losses = examples.groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn_no", "reply"))), lambda r: r["reply"]), "").alias("loss")
    )
    whole = formatted.withColumn("turns", read_turns(F.col("formatted"))).select(
        F.col("conv_id").alias("own_id"), F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
    loss = F.coalesce("loss", F.lit(""))
    return whole.join(losses, whole["own_id"].eqNullSafe(losses["conv_id"]), "left").select(
        F.col("own_id").alias("conv_id"), "n_turns", "turns_sha256", F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )
