"""Operator 5, chat formatting: prefix-target expansion, native DataFrame code.

Every assistant turn becomes an example of its own: all preceding turns are the context, and
only that reply is trainable. Turns after the last reply (or a conversation without a reply)
form one more example with nothing trainable, so the output holds every turn.

Template: ``<|im_start|>role\\n`` text ``<|im_end|>\\n``. Control strings inside texts are escaped
reversibly: a backslash goes after the first character of ``<|``, ``<s>``, ``</s>``, ``[INST]``
and ``[/INST]``, behind any backslashes that are there, so unescaping takes exactly one away.
In roles, a percent sign and a line feed become %25 and %0A, as a line feed ends the role.

Defined results: NULL text and NULL role are empty; rows of a conversation are ordered by turn,
then role and text (NULL turn first), so ties and repeated rows have one order and all count;
NULL conv_id is a conversation like any other; extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolens.llm.common import bind

# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
TARGET_ROLE = "assistant"
_CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example (its number), text (formatted), loss_start, loss_length (code points).

    One grouping by conversation; each example is built from its turns row by row.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = (conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns")))

    def formatted(t):
        head = F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))
        body = escape(t["text"])
        return F.struct(F.concat(head, body, F.lit(END + "\n")).alias("all"), F.length(head).alias("head"),
                        F.length(body).alias("body"), (t["role"] == TARGET_ROLE).alias("target"))

    ready = grouped.select("conv_id", F.transform("turns", formatted).alias("parts"))
    ends = bind(F.col("parts"), lambda p: F.filter(
        F.transform(p, lambda x, i: F.when(x["target"] | (i == F.size(p) - 1), i + 1)), lambda i: i.isNotNull()))
    cut = ready.select("conv_id", "parts", F.posexplode(ends).alias("example", "n"))
    last = F.get(F.col("parts"), F.col("n") - 1)
    text = F.array_join(F.transform(F.slice("parts", 1, F.col("n")), lambda x: x["all"]), "")
    rows = cut.select("conv_id", "example", text.alias("text"), last["head"].alias("__head"), last["body"].alias("__body"),
                      last["target"].alias("__target"))
    whole = F.col("__head") + F.col("__body") + len(END) + 1
    return rows.select(
        "conv_id", "example", "text",
        (F.length("text") - whole + F.col("__head")).alias("loss_start"),
        F.when(F.col("__target"), F.col("__body")).otherwise(F.lit(0)).alias("loss_length"))


def parse(text: Column) -> Column:
    """The turns of a formatted text as array<struct<role, text>>, read back from the string alone."""
    marked = bind(F.split(text, START.replace("|", r"\|"), -1), lambda x: F.slice(x, 2, F.size(x) - 1))

    def turn(x):
        at = F.instr(x, "\n")
        body = F.substring(x, at + 1, F.length(x) - at - len(END) - 1)
        return F.struct(unescape_role(F.substring(x, F.lit(1), at - 1)).alias("role"), unescape(body).alias("text"))

    return F.transform(marked, turn)


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: the contract's counts and digests.

    The last example holds every turn; the loss text is each example's masked part, in order.
    """
    loss = unescape(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_length")))
    rows = formatted.select("conv_id", "example", F.length("text").alias("chars"), "text", loss.alias("loss"))
    per = rows.groupBy("conv_id").agg(
        F.max(F.struct("example", "text"))["text"].alias("full"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").cast("long").alias("formatted_chars"))
    turns = parse(F.col("full"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select("conv_id", turns.alias("turns"), "loss", "formatted_chars").select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
