"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame operations only.

A conversation becomes text segments with a loss flag: for every turn a marker, the escaped text and an end
marker; only the texts of the template's loss roles carry the flag. Concatenated, the segments are the
formatted text. Control strings inside texts are replaced by two-character codes (backslash and a letter; a
backslash itself is one of them), so a marker never occurs inside a text, the formatted text splits at its end
markers, and decoding the codes restores every text exactly.

The machine reads the roles in turn order; ``valid`` tells whether every move is in the template's transition
table and the last state is accepting, ``error_at`` the first turn that is not (NULL if none). Conversations
that break the order are formatted like all others and flagged, not dropped.

One output row holds one conversation, so a conversation is gathered in one place; equal or frequent
conversations are not. Defined results: NULL texts are empty, NULL roles read back as empty; roles without a
marker get a generic one that carries their name; rows of one turn number are ordered by role and text;
repeated rows are turns of their own; rows with a NULL conv_id form one conversation with NULL id; an empty
table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What marks a turn, which texts carry loss and which role may follow which."""

    names: dict[str, str] = field(default_factory=lambda: {
        "system": "System", "user": "User", "assistant": "Assistant"})
    start: str = "### "
    middle: str = ": "
    end: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: State before, role read, state after. The machine starts in "start".
    moves: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "system"), ("start", "user", "user"), ("system", "user", "user"),
        ("user", "assistant", "assistant"), ("assistant", "user", "user"),
    )
    accepting: tuple[str, ...] = ("assistant",)
    #: Control strings and their codes; the backslash comes first in escaping and last in reading.
    codes: tuple[tuple[str, str], ...] = (("\\", "\\s"), ("###", "\\h"), ("</turn>", "\\t"))


TEMPLATE = Template()


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    for control, code in template.codes:
        text = F.replace(text, F.lit(control), F.lit(code))
    return text


def unescape(text: Column, template: Template = TEMPLATE) -> Column:
    for control, code in reversed(template.codes):
        text = F.replace(text, F.lit(code), F.lit(control))
    return text


def _colon(name: Column) -> Column:
    """A generic role name without the string that ends the marker."""
    return F.replace(name, F.lit(":"), F.lit("\\c"))


def _marker(role: Column, t: Template) -> Column:
    generic = F.concat(F.lit("@"), _colon(escape(role, t)))
    name = generic
    for r, shown in t.names.items():
        name = F.when(role == r, F.lit(shown)).otherwise(name)
    return F.concat(F.lit(t.start), name, F.lit(t.middle))


def _role_of(shown: Column, t: Template) -> Column:
    role = unescape(F.replace(F.substr(shown, F.lit(2)), F.lit("\\c"), F.lit(":")), t)
    for r, name in t.names.items():
        role = F.when(shown == name, F.lit(r)).otherwise(role)
    return role


def _walk(roles: Column, t: Template) -> Column:
    """Struct (state, place, error_at) after the machine has read the roles."""
    table = F.create_map(*[x for a, r, b in t.moves for x in (F.lit(f"{a}|{r}"), F.lit(b))])

    def move(s: Column, role: Column) -> Column:
        nxt = F.when(s["error_at"].isNull(), F.try_element_at(table, F.concat(s["state"], F.lit("|"), role)))
        return F.struct(
            F.coalesce(nxt, s["state"]).alias("state"), (s["place"] + 1).alias("place"),
            F.coalesce(s["error_at"], F.when(nxt.isNull(), s["place"])).alias("error_at"),
        )

    begin = F.struct(F.lit("start").alias("state"), F.lit(0).alias("place"), F.lit(None).cast("int").alias("error_at"))
    return F.aggregate(roles, begin, move)


def format_conversations(rows: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, segments array<struct<text, loss>>, formatted, valid, error_at of every conversation."""
    t = template
    one = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = rows.select("conv_id", one.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(x: Column) -> Column:
        plain = F.lit(False)
        return F.array(
            F.struct(_marker(x["role"], t).alias("text"), plain.alias("loss")),
            F.struct(escape(x["text"], t).alias("text"), x["role"].isin(*t.loss_roles).alias("loss")),
            F.struct(F.lit(t.end).alias("text"), plain.alias("loss")),
        )

    made = turns.select(
        "conv_id", F.flatten(F.transform("turns", segments)).alias("segments"),
        _walk(F.transform("turns", lambda x: x["role"]), t).alias("walk"),
    )
    return made.select(
        "conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        (F.col("walk.error_at").isNull() & F.col("walk.state").isin(*t.accepting)).alias("valid"),
        F.col("walk.error_at").alias("error_at"),
    )


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """array<struct<role, text>> read back from a formatted text."""
    t = template
    parts = F.filter(F.split(formatted, "\\Q" + t.end + "\\E"), lambda p: p != "")

    def turn(p: Column) -> Column:
        at = F.instr(p, t.middle)
        return F.struct(
            _role_of(F.substr(p, F.lit(len(t.start) + 1), at - F.lit(len(t.start) + 1)), t).alias("role"),
            unescape(F.substr(p, at + F.lit(len(t.middle))), t).alias("text"),
        )

    return F.transform(parts, turn)


def loss_text(segments: Column, template: Template = TEMPLATE) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    kept = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template))
    return F.array_join(kept, "")
