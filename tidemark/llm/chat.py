"""Conversations as training examples, one for every assistant turn.

An example holds all turns up to a reply, and only that reply is to be learned: ``target_start`` and
``target_chars`` give its place in the text. A conversation that does not end with a reply gets one
more example with no target, so that no turn is lost.

Turns are marked as ``<|im_start|>role`` and a line feed, the text, ``<|im_end|>`` and a line feed. In
texts and roles ``&`` and ``<|`` are escaped, so no text can end its turn or begin another, and
reading back gives the text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def conversations(turns: DataFrame) -> DataFrame:
    """(``conv_id``, ``turns``: array of role and text) by turn; equal turns by role and text. A null role or text is empty,
    a null turn comes first, and rows without a conv_id are one conversation."""
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row), _by_turn).alias("turns"))


def _by_turn(a: Column, b: Column) -> Column:
    x = F.struct(a["turn"].isNotNull(), F.coalesce(a["turn"], F.lit(0)), a["role"], a["text"])
    y = F.struct(b["turn"].isNotNull(), F.coalesce(b["turn"], F.lit(0)), b["role"], b["text"])
    return F.when(x < y, -1).when(x > y, 1).otherwise(0)


def examples(turns: DataFrame) -> DataFrame:
    """(``conv_id``, ``example``, ``text``, ``target_start``, ``target_chars``): an example for every assistant turn, numbered
    from 0. Places are code points from 0; an example without a target has null there."""
    whole = conversations(turns)
    heads = F.transform("turns", lambda t: F.concat(F.lit(START), _role(t["role"]), F.lit("\n")))
    bodies = F.transform("turns", lambda t: escape(t["text"]))
    made = whole.select("conv_id", F.transform("turns", lambda t: t["role"] == "assistant").alias("reply"),
                        heads.alias("heads"), bodies.alias("bodies"))
    size = F.zip_with("heads", "bodies", lambda h, b: F.length(h) + F.length(b) + len(END))
    ends = F.transform(size, lambda _, i: F.aggregate(F.slice(size, 1, i + 1), F.lit(0), lambda s, x: s + x))
    text = F.array_join(F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b, F.lit(END))), "")
    laid = made.select("conv_id", "reply", "bodies", text.alias("all"), ends.alias("ends"))
    last = F.size("reply") - 1
    wanted = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("reply", i) | (i == last))
    each = laid.select("conv_id", "all", "reply", "bodies", "ends", F.posexplode(wanted).alias("example", "at"))
    end = F.get("ends", F.col("at"))
    chars = F.when(F.get("reply", F.col("at")), F.length(F.get("bodies", F.col("at"))))
    return each.select("conv_id", F.col("example").cast("long").alias("example"),
                       F.substring("all", F.lit(1), end).alias("text"), (end - len(END) - chars).alias("target_start"),
                       chars.alias("target_chars"))


def parse(text: Column) -> Column:
    """The turns of an example's text as an array of role and text."""
    marked = F.filter(F.split(text, r"\<\|im_end\|\>\n"), lambda t: t != "")
    return F.transform(marked, lambda t: F.struct(
        unescape(F.replace(F.substring_index(F.substring(t, len(START) + 1, 2**31 - 1), "\n", 1), F.lit("&#10;"),
                           F.lit("\n"))).alias("role"),
        unescape(F.substring(t, F.locate("\n", t) + 1, F.lit(2**31 - 1))).alias("text")))


def target(text: Column, start: Column, chars: Column) -> Column:
    """The reply to be learned, unescaped; null without one."""
    return unescape(F.substring(text, start + 1, chars))


def digests(found: DataFrame) -> DataFrame:
    """Read back from the examples: ``conv_id``, ``n_turns``, ``turns_sha256`` (role and text of all turns, a line feed after
    each), ``loss_chars`` and ``loss_sha256`` (all replies to be learned, in order), ``formatted_chars`` (of all examples)."""
    reply = target(F.col("text"), F.col("target_start"), F.col("target_chars"))
    rows = found.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("longest"), F.sum(F.length("text")).alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("example", F.coalesce(reply, F.lit("")).alias("reply")))).alias("replies"))
    read = rows.select("conv_id", "formatted_chars", parse(F.col("longest")).alias("turns"),
                       F.array_join(F.transform("replies", lambda r: r["reply"]), "").alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       "formatted_chars")
