"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its context, and only
that reply is trainable.  A conversation whose last turn is not the assistant's gets one more
example without a target, so that no turn is lost.  All of it is native Spark.

The template writes a turn as ``### role: text</turn>`` and a line end.  In texts and roles the
control strings are replaced by escapes that hold none of them, so that the first ``</turn>`` met is
always a turn's end, and reading back is exact:

    backslash -> \\b    </turn> -> \\e    "### " -> \\h    and in roles  ":" -> \\c
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, COLON, END = "### ", ": ", "</turn>\n"
_TEXT = [("\\", "\\b"), ("</turn>", "\\e"), ("### ", "\\h")]
_ROLE = [*_TEXT, (":", "\\c")]


def _replace(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape(c: Column, role: bool = False) -> Column:
    """``c`` without control strings."""
    return _replace(c, _ROLE if role else _TEXT)


def unescape(c: Column, role: bool = False) -> Column:
    """The inverse of ``escape``: the backslash comes last, as it came first."""
    return _replace(c, [(b, a) for a, b in (_ROLE if role else _TEXT)[::-1]])


def format_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), escape(role, True), F.lit(COLON), escape(text), F.lit(END))


def examples(turns: DataFrame, trainable: str = "assistant") -> DataFrame:
    """Prefix-target expansion of ``turns`` (conv_id, turn, role, text; other columns are not read).

    Returns one row per example: conv_id, example (from 0), target_turn (position of the reply from
    0, null for the example without a target), formatted (context and reply), loss_start and
    loss_length (code points of ``formatted`` under the loss mask), last (whether it holds the whole
    conversation).  Null roles and texts count as empty.  Turns are ordered by turn (nulls first),
    then role and text; repeated rows are repeated turns.  Rows with a null conv_id form one
    conversation.  An empty table gives no example.  A conversation is one row by its nature (its
    examples are texts of their own) and so has to fit in one.
    """
    ordered = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    whole = ordered.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    whole = whole.select("conv_id", "turns", F.transform("turns", lambda t: format_turn(t["role"], t["text"])).alias("parts"))
    n = F.size("turns")
    # Positions of the replies; the end of the conversation is one more where no reply stands there.
    targets = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (F.element_at("turns", i + 1)["role"] == trainable) | (i == n - 1))
    each = whole.select("conv_id", "turns", "parts", F.posexplode(targets).alias("example", "at"))
    reply = F.element_at("turns", F.col("at") + 1)
    is_target = reply["role"] == trainable
    text = F.array_join(F.slice("parts", F.lit(1), F.col("at") + 1), "")
    length = F.when(is_target, F.length(escape(reply["text"]))).otherwise(0)
    return each.select(
        "conv_id",
        F.col("example").cast("bigint").alias("example"),
        F.when(is_target, F.col("at").cast("bigint")).alias("target_turn"),
        text.alias("formatted"),
        length.cast("bigint").alias("loss_length"),
        (F.col("at") == n - 1).alias("last"),
    ).select(
        "conv_id", "example", "target_turn", "formatted",
        (F.length("formatted") - len(END) - F.col("loss_length")).alias("loss_start").cast("bigint"),
        "loss_length", "last",
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text), escapes undone."""
    marked = F.filter(F.split(formatted, "</turn>\n", -1), lambda p: p != "")
    colon = lambda p: F.instr(p, COLON)
    return F.transform(
        marked,
        lambda p: F.struct(
            unescape(F.substring(p, F.lit(len(HEAD) + 1), colon(p) - len(HEAD) - 1), True).alias("role"),
            unescape(F.substring(p, colon(p) + len(COLON), F.length(p))).alias("text"),
        ),
    )


def loss_text(formatted: Column, start: Column, length: Column) -> Column:
    """The text under the loss mask, escapes undone."""
    return unescape(F.substring(formatted, start.cast("int") + 1, length.cast("int")))


def digests(made: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: turns, loss text and size of all examples."""
    turns = F.when(F.col("last"), read_turns(F.col("formatted")))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    each = made.select(
        "conv_id", "example", F.length("formatted").cast("bigint").alias("chars"),
        F.size(turns).cast("bigint").alias("n"), F.sha2(said, 256).alias("sha"), "last",
        loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("loss"),
    )
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "")
    return each.groupBy("conv_id").agg(
        F.max(F.when(F.col("last"), F.col("n"))).alias("n_turns"),
        F.max(F.when(F.col("last"), F.col("sha"))).alias("turns_sha256"),
        joined.alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    ).select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
