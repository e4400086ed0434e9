"""Chat formatting with a declarative template and a finite-state machine over roles.

DataFrame functions only.  A conversation's rows are put in turn order; a
finite-state machine (``Template.moves``) reads the roles; the template turns every
row into text segments, each with a loss flag.  The concatenated segments are the
formatted text.  Control strings inside a role or a text are escaped, so the
formatted text can be read back without loss (``read_turns``).

Defined cases: null text and null role count as empty; rows are ordered by turn, then
role, then text, nulls first, so ties and repeated rows have one order and all of
them stay; rows with a null ``conv_id`` form one conversation; a conversation whose
roles break the machine's rules is formatted like any other and has ``valid`` false;
an empty table gives an empty result; other columns are ignored.  A conversation is
one row of the result, so its text must stay below Spark's 2 GB for a value.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Marks around a turn, the roles whose text is trained on, and the legal moves."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    control: str = "<|"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state -> roles that may follow; the state after a turn is its role
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user", "tool"),
        "tool": ("assistant", "tool"),
    })
    final: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escape(text: Column, t: Template = CHATML, newline: bool = False) -> Column:
    """Backslash before every backslash and inside every control string (and before line breaks of a role)."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    out = F.replace(out, F.lit(t.control), F.lit(t.control[0] + ESCAPE + t.control[1:]))
    return F.replace(out, F.lit("\n"), F.lit(ESCAPE + "\n")) if newline else out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def final_state(roles: Column, t: Template = CHATML) -> Column:
    """The state that the machine reaches; null once a move is illegal."""
    legal = F.create_map(*[x for s, nxt in t.moves.items()
                           for x in (F.lit(s), F.array(*map(F.lit, nxt)))])
    return F.aggregate(roles, F.lit("").cast("string"), lambda s, r: F.when(
        F.array_contains(F.try_element_at(legal, s), r), r))


def format_chats(rows: DataFrame, t: Template = CHATML) -> DataFrame:
    """One row per conversation: ``conv_id, valid, segments array<struct<text, loss>>, formatted``.

    ``rows`` has ``conv_id, turn, role, text``.
    """
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))
    pieces = F.flatten(F.transform("turns", lambda x: F.array(
        F.struct(F.concat(F.lit(t.start), escape(x["role"], t, newline=True), F.lit("\n")).alias("text"),
                 F.lit(False).alias("loss")),
        F.struct(escape(x["text"], t).alias("text"), x["role"].isin(*t.loss_roles).alias("loss")),
        F.struct(F.lit(t.end + "\n").alias("text"), F.lit(False).alias("loss")))))
    state = final_state(F.col("turns.role"), t)
    return turns.select("conv_id", F.coalesce(state.isin(*t.final), F.lit(False)).alias("valid"),
                        pieces.alias("segments")) \
        .withColumn("formatted", F.array_join("segments.text", ""))


def read_turns(formatted: Column, t: Template = CHATML) -> Column:
    """The turns of a formatted text: ``array<struct<role, text>>``, as they were before escaping."""
    quoted = "".join("\\" + c if not c.isalnum() and c not in "_<>" else c for c in t.end)
    parts = F.filter(F.split(formatted, quoted + r"\n"), lambda p: p != "")

    def turn(p: Column) -> Column:
        body = F.substr(p, F.lit(len(t.start) + 1))
        role = F.regexp_extract(body, r"(?s)^((?:[^\\\n]++|\\.)*+)\n", 1)
        return F.struct(unescape(role).alias("role"),
                        unescape(F.substr(body, F.char_length(role) + 2)).alias("text"))

    return F.transform(parts, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, in order, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
