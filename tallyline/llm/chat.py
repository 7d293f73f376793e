"""Chat formatting by prefix-target expansion, in built-in functions only.

Every assistant turn becomes an example of its own: all turns before it as
context, and its text alone under the loss mask. Turns after the last
assistant turn, or all turns where there is none, make one last example
without a target, so that every turn can be read back.

A turn is ``<|im_start|>role``, a newline, the text, ``<|im_end|>`` and a
newline. In roles and texts a backslash is doubled, then ``<|`` becomes
``<\\|``, and in roles a newline becomes ``<\\n>``; this is undone in reverse.

Turns are taken by turn, ties by role and text, null turns first; repeated
rows are turns like any other. Null roles and texts count as empty. Rows of
null conversation id form one conversation of null id. An example is one
string, so a conversation has to fit into a task; conversations are never cut.
Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column, role: bool = False) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    if role:
        text = F.replace(text, F.lit("\n"), F.lit("<\\n>"))
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column, role: bool = False) -> Column:
    text = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    if role:
        text = F.replace(text, F.lit("<\\n>"), F.lit("\n"))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def expand(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Examples: conv_id, example (its number, from 0), n_turns, formatted, loss_start and loss_chars (code points; null without a target)."""
    empty = F.lit("")
    said = F.struct(F.col(turn).alias("turn"), F.coalesce(role, empty).alias("role"), F.coalesce(text, empty).alias("text"))
    whole = turns.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(said)).alias("turns"))
    body = lambda t: F.concat(F.lit(START), escape(t["role"], role=True), F.lit("\n"), escape(t["text"]), F.lit(END + "\n"))
    last = F.size("turns")
    targets = F.filter(F.sequence(F.lit(1), last), lambda k: (F.col("turns")[k - 1]["role"] == "assistant") | (k == last))
    each = whole.select("conv_id", F.transform("turns", body).alias("bodies"), "turns", targets.alias("targets")).select(
        "conv_id", "bodies", "turns", F.posexplode("targets").alias("example", "n_turns")
    )
    target = F.col("turns")[F.col("n_turns") - 1]
    formatted = F.array_join(F.slice("bodies", F.lit(1), F.col("n_turns")), "")
    loss = F.when(target["role"] == "assistant", F.length(escape(target["text"])))
    return each.select(
        "conv_id", "example", "n_turns", formatted.alias("formatted"), loss.cast("long").alias("loss_chars")
    ).select(
        "conv_id",
        "example",
        "n_turns",
        "formatted",
        (F.length("formatted") - len(END) - 1 - F.col("loss_chars")).cast("long").alias("loss_start"),
        "loss_chars",
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string, unescaped."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")
    inside = lambda p: F.substr(p, F.lit(len(START) + 1))
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring_index(inside(p), "\n", 1), role=True).alias("role"),
            unescape(F.substr(inside(p), F.instr(inside(p), "\n") + 1)).alias("text"),
        ),
    )


def read_loss(formatted: Column, start: Column, chars: Column) -> Column:
    """The text under the loss mask, unescaped; null without one."""
    return unescape(F.substr(formatted, (start + 1).cast("int"), chars.cast("int")))
