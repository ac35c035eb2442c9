r"""Chat logs folded into final messages and rendered by a template, with spans of what is learned from.

An event has conv_id, seq, kind, message, role and text; ``kind`` is one of

- ``message``: opens a message with its text (again: its new text);
- ``delta``: streamed text, appended to the message, which it opens if need be;
- ``edit``: replaces the text so far, later deltas are appended to the new one;
- ``regenerate``: starts the message anew with this text, usually none, and takes every message back that was
  opened between it and this event.

An event without ``message`` is a message of its own. Events of a conversation are ordered by seq, null
first; equal ones by kind (message, regenerate, edit, delta), message, role and text, so the result does not
depend on the input's order. A message stands where it was opened and has the role it was opened with. An
event of a message that was taken back changes nothing visible, but a regeneration still takes back what was
opened since. Null role or text is the empty one, a null conv_id is a conversation of its own, equal rows are
events of their own. Other columns are not read, so names cannot clash; no events give no rows.

Each turn is ``<s>...</s>`` and a line feed, with ``[INST]``, ``<<SYS>>`` or ``[ROLE]`` marks by role. A
control string inside a role or a text gets a backslash in front, and reading takes one away, so any text
comes back as it was, backslashes included. ``loss`` lists the assistant texts as (start, length) in code
points of ``formatted``.

There is one exchange, by conversation; the fold is windows within it, linear in events. A conversation is
one value of the result, so its text must fit in a task; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("message", "regenerate", "edit", "delta")
# --- fixed values: the marks of the template ---
BEGIN, END = "<s>", "</s>\n"
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>> ", " <</SYS>>"), "assistant": (" ", " ")}
NAME = ("[ROLE] ", " [/ROLE] ")
LEARNED = "assistant"
CONTROL = r"</?s>|\[/?INST\]|<</?SYS>>|\[/?ROLE\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(f"({CONTROL})"), F.lit(r"\\$1"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(rf"\\({CONTROL})"), F.lit("$1"))


def events_of(turns: DataFrame) -> DataFrame:
    """A finished conversation (conv_id, turn, role, text) as a log of whole messages."""
    return turns.select(
        "conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"), F.lit(None).cast("string").alias("message"), "role", "text"
    )


def folded(events: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the messages that stand at the end of the log, in order of position."""
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    log = events.select(
        "conv_id", "seq", kind.alias("kind"), F.col("message").cast("string").alias("message"),
        *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")),
    )
    known = F.when(F.col("kind") > 0, F.col("kind")).otherwise(F.raise_error(F.lit(f"kind must be one of {KINDS}")).cast("long"))
    order = [F.col("seq").asc_nulls_first(), known, "message", "role", "text"]
    log = log.withColumn("at", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long"))
    log = log.withColumn("alone", F.when(F.col("message").isNull(), F.col("at")))
    own = Window.partitionBy("conv_id", "message", "alone")
    base = F.max(F.when(F.col("kind") < 4, F.col("at"))).over(own)
    log = log.select(
        "conv_id", "at", "text",
        F.min("at").over(own).alias("position"),
        F.min_by("role", "at").over(own).alias("role"),
        F.max(F.when(F.col("kind") == 2, F.col("at"))).over(own).alias("cut"),
        F.coalesce(base, F.lit(0)).alias("base"),
    )
    pieces = F.array_sort(F.collect_list(F.struct("at", "text")))
    messages = log.where(F.col("at") >= F.col("base")).groupBy("conv_id", "position").agg(
        F.first("role").alias("role"), F.max("cut").alias("cut"), F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text")
    )
    before = Window.partitionBy("conv_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    messages = messages.withColumn("back_from", F.max("cut").over(before))
    standing = F.col("back_from").isNull() | (F.col("back_from") < F.col("position"))
    return messages.where(standing).select("conv_id", "position", "role", "text")


def formatted(events: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) of every conversation of the log."""
    role, text = F.col("role"), F.col("escaped")
    opened, closed = F.concat(F.lit(NAME[0]), escape(role), F.lit(NAME[1])), F.lit(" ")
    for name, (a, b) in MARKS.items():
        opened, closed = F.when(role == name, F.lit(a)).otherwise(opened), F.when(role == name, F.lit(b)).otherwise(closed)
    opened = F.concat(F.lit(BEGIN), opened)
    turns = folded(events).withColumn("escaped", escape(F.col("text")))
    turns = turns.withColumns({"turn": F.concat(opened, text, closed, F.lit(END)), "lead": F.length(opened)})
    before = Window.partitionBy("conv_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)) + F.col("lead")
    turns = turns.withColumn("span", F.when(role == LEARNED, F.struct(start.alias("start"), F.length(text).cast("long").alias("length"))))
    ordered = F.array_sort(F.collect_list(F.struct("position", "turn")))
    return turns.groupBy("conv_id").agg(
        F.array_join(F.transform(ordered, lambda t: t["turn"]), "").alias("formatted"),
        F.array_sort(F.collect_list("span")).alias("loss"),
    )


def turns_of(text: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""

    def parsed(part: Column) -> Column:
        body = F.substring(part, F.lit(1), F.length(part) - F.lit(len(END)))
        inside = lambda a, b: unescape(F.substring(body, F.lit(len(a) + 1), F.length(body) - F.lit(len(a) + len(b))))
        named = F.split(body, r" \[/ROLE\] ", 2)
        role = unescape(F.substring(named[0], F.lit(len(NAME[0]) + 1), F.length(named[0])))
        said = unescape(F.substring(named[1], F.lit(1), F.length(named[1]) - F.lit(1)))
        turn = F.struct(role.alias("role"), said.alias("text"))
        for name, (a, b) in MARKS.items():
            turn = F.when(body.startswith(a), F.struct(F.lit(name).alias("role"), inside(a, b).alias("text"))).otherwise(turn)
        return turn

    return F.transform(F.filter(F.split(text, rf"(?<!\\){BEGIN}"), lambda _, i: i > 0), parsed)


def digests(chats: DataFrame) -> DataFrame:
    """Counts and digests of the turns and of the text under the loss mask, read back from ``formatted``."""
    whole = F.col("formatted")
    learned = F.transform("loss", lambda s: unescape(F.substring(whole, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    read = chats.select("conv_id", whole, turns_of(whole).alias("turns"), F.array_join(learned, "").alias("learned"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length(whole).cast("long").alias("formatted_chars"),
    )
