"""Chat formatting: a finite-state machine over roles and a declarative template.

A conversation is its rows ordered by ``turn`` (nulls first; ties by role, then
text).  The machine's state is the role of the last turn; ``TRANSITIONS`` lists
the allowed (state, role) pairs and ``ACCEPTING`` the states a conversation may
end in.  A conversation that breaks the order is still formatted, with
``valid`` false and ``first_invalid`` set to the place of the first turn that
broke it (the number of turns when only the end state is wrong).

``TEMPLATE`` gives for each role the text before and after a turn and whether
the turn's own text is under the loss mask.  Roles the template does not name
use ``OTHER`` with the role's escaped name in it.  Inside texts (and names)
the control strings are escaped reversibly: every ``\\`` is doubled, then a
``\\`` goes into each ``</turn>`` (``<\\/turn>``) and ``### `` (``#\\## ``),
and in role names into each ``:`` + newline.  ``unescape`` undoes it:
``\\x`` becomes ``x``.  So no control string appears inside an escaped text and
the output splits back into turns without knowing where the texts were.

The output has one row per conversation: the formatted text and its segments,
each with its loss flag; the formatted text is the segments joined.
Null ``conv_id`` rows form one conversation whose id is null; null text is
empty; a null role is the empty role, which the machine never accepts.
Empty input gives empty output.  All of it is DataFrame expressions; one
conversation is one output row, so its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitecast.llm.tables import fresh

# The template and the machine.
TURN_CLOSE = "</turn>\n"
TEMPLATE = {
    "system": {"open": "### System:\n", "close": TURN_CLOSE, "loss": False},
    "user": {"open": "### User:\n", "close": TURN_CLOSE, "loss": False},
    "assistant": {"open": "### Assistant:\n", "close": TURN_CLOSE, "loss": True},
}
#: For any other role: ``### [`` + escaped name + ``]:\n``; no named role's label starts with ``[``.
OTHER = {"open": ("### [", "]:\n"), "close": TURN_CLOSE, "loss": False}
TRANSITIONS = {
    ("start", "system"),
    ("start", "user"),
    ("system", "user"),
    ("user", "assistant"),
    ("assistant", "user"),
}
ACCEPTING = {"assistant"}


def escape(text: Column, name: bool = False) -> Column:
    """``text`` with its control strings made harmless, reversibly."""
    out = F.regexp_replace(text, r"\\", r"\\\\")
    out = F.regexp_replace(out, "</turn>", r"<\\/turn>")
    out = F.regexp_replace(out, "### ", r"#\\## ")
    if name:
        out = F.regexp_replace(out, ":\n", ":\\\\\n")
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _opening(role: Column) -> Column:
    out = F.concat(F.lit(OTHER["open"][0]), escape(role, name=True), F.lit(OTHER["open"][1]))
    for name, part in TEMPLATE.items():
        out = F.when(role == name, F.lit(part["open"])).otherwise(out)
    return out


def _loss(role: Column) -> Column:
    return role.isin([name for name, part in TEMPLATE.items() if part["loss"]])


def _allowed(prev: Column, role: Column) -> Column:
    out = F.lit(False)
    for a, b in sorted(TRANSITIONS):
        out = out | ((prev == a) & (role == b))
    return out


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, first_invalid, formatted, segments.

    ``rows`` needs conv_id, turn, role, text; other columns are ignored.
    ``segments`` is an array of (text, loss) in output order.
    """
    place, prev = fresh(rows, "place", "prev")
    turns = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    turns = turns.withColumn(place, F.row_number().over(order) - 1)
    turns = turns.withColumn(prev, F.coalesce(F.lag("role").over(order), F.lit("start")))
    seg = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    turns = turns.select(
        "conv_id",
        place,
        "role",
        F.when(_allowed(F.col(prev), F.col("role")), None).otherwise(F.col(place)).alias("bad"),
        F.array(
            seg(_opening(F.col("role")), F.lit(False)),
            seg(escape(F.col("text")), _loss(F.col("role"))),
            seg(F.lit(TURN_CLOSE), F.lit(False)),
        ).alias("parts"),
    )
    convs = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.min("bad").alias("bad"),
        F.max_by("role", place).alias("last"),
        F.array_sort(F.collect_list(F.struct(F.col(place).alias("k"), F.col("parts").alias("parts")))).alias("all"),
    )
    segments = F.flatten(F.transform("all", lambda t: t["parts"]))
    end_ok = F.col("last").isin(sorted(ACCEPTING))
    return convs.select(
        "conv_id",
        "n_turns",
        (F.col("bad").isNull() & end_ok).alias("valid"),
        F.when(F.col("bad").isNotNull(), F.col("bad")).when(~end_ok, F.col("n_turns")).alias("first_invalid"),
        F.array_join(F.transform(segments, lambda s: s["text"]), "").alias("formatted"),
        segments.alias("segments"),
    )


def read_back(out: DataFrame) -> DataFrame:
    """Turns and loss text recovered from formatted conversations.

    Turns come from splitting ``formatted`` at the turn ends and headers alone;
    loss text from the segments under the mask.  Returns conv_id, turns
    (array of role, text), loss_text, formatted_chars, and ``valid``.
    """
    pieces = F.slice(F.split("formatted", TURN_CLOSE, -1), 1, F.greatest(F.size(F.split("formatted", TURN_CLOSE, -1)) - 1, F.lit(0)))
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            role_name(F.regexp_extract(p, r"(?s)^### (.*?):\n", 1)).alias("role"),
            unescape(F.regexp_extract(p, r"(?s)^### .*?:\n(.*)$", 1)).alias("text"),
        ),
    )
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return out.select(
        "conv_id",
        turns.alias("turns"),
        loss.alias("loss_text"),
        F.char_length("formatted").alias("formatted_chars"),
        "valid",
    )


def role_name(label: Column) -> Column:
    """The role of a header label: a named role's label, or ``[`` escaped name ``]``."""
    out = unescape(F.regexp_extract(label, r"(?s)^\[(.*)\]$", 1))
    for name, part in TEMPLATE.items():
        out = F.when(label == part["open"][4:-2], F.lit(name)).otherwise(out)
    return out
