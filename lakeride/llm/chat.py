"""Chat formatting: a declarative template, a role automaton and text segments with loss flags.

All of it is DataFrame functions. A turn is turned into segments by its role's
template; a conversation is its turns in order. Control strings that occur
inside a text are escaped, so a formatted conversation can be read back.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """role -> (opening mark, closing mark, whether its text bears loss). A role that is
    not listed, or null, is written with ``other``: its name goes between the first and
    second mark, its text up to the third.

    Every mark starts with ``<`` or ``[`` and has that character nowhere else,
    so no two marks, or mark and text, can overlap to form a third.
    """

    roles: dict[str, tuple[str, str, bool]] = field(default_factory=lambda: {
        "system": ("[SYS]", "[/SYS]", False),
        "user": ("[INST]", "[/INST]", False),
        "assistant": ("<s>", "</s>", True),
    })
    other: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/ROLE]")
    #: automaton: state -> roles that may come next; the state after a turn is its role
    order: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})

    def marks(self) -> list[str]:
        return [m for o, c, _ in self.roles.values() for m in (o, c)] + list(self.other)

    def __post_init__(self):
        marks = self.marks()
        for m in marks:
            if len(m) < 2 or m[0] not in "<[" or m.count(m[0]) > 1 or "\\" in m:
                raise ValueError(f"mark {m!r} must start with its only '<' or '[' and hold no backslash")
        if len(set(marks)) < len(marks):
            raise ValueError("marks must differ")


DEFAULT = Template()


def escape(text: Column, template: Template = DEFAULT) -> Column:
    """Doubles backslashes, then puts one after the first character of each control string."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for m in template.marks():
        out = F.replace(out, F.lit(m), F.lit(m[0] + "\\" + m[1:]))
    return out


def unescape(text: Column, template: Template = DEFAULT) -> Column:
    """The inverse of :func:`escape`: lone backslashes only occur where it put them."""
    out = text
    for m in template.marks():
        out = F.replace(out, F.lit(m[0] + "\\" + m[1:]), F.lit(m))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def _segment(text: Column, loss: bool) -> Column:
    return F.struct(text.alias("text"), F.lit(loss).alias("loss"))


def turn_segments(role: Column, text: Column, template: Template = DEFAULT) -> Column:
    """array<struct<text, loss>> of one turn: mark, text, mark."""
    body = escape(text, template)
    a, b, c = template.other
    out = F.array(_segment(F.concat(F.lit(a), escape(F.coalesce(role, F.lit("")), template), F.lit(b)), False),
                  _segment(body, False), _segment(F.lit(c), False))
    for name, (opening, closing, loss) in template.roles.items():
        out = F.when(role == name, F.array(_segment(F.lit(opening), False), _segment(body, loss),
                                           _segment(F.lit(closing), False))).otherwise(out)
    return out


def valid_order(roles: Column, template: Template = DEFAULT) -> Column:
    """Runs the automaton over an array of roles: true if every step is allowed."""
    steps = F.array(*(F.lit(f"{s}>{r}") for s, nexts in template.order.items() for r in nexts))
    return F.aggregate(
        roles, F.lit("start"),
        lambda state, role: F.when(F.array_contains(steps, F.concat(state, F.lit(">"), role)), role).otherwise(F.lit("invalid")),
        lambda state: state != "invalid")


def format_conversations(turns: DataFrame, template: Template = DEFAULT, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, segments, formatted (their texts end to end), valid.

    Turns are ordered by number (nulls first), then role, then text, so ties and
    repeated rows keep a defined place; every row is written. Invalid turn orders
    are formatted too and flagged. Null text is empty; a null role is written
    like the empty unknown role. Null conversation ids form one conversation. An
    empty table gives no rows; other columns are ignored, whatever their names.
    A task holds the turns of one conversation at a time, which is one output
    value; the work on texts is done per turn, before they meet.
    """
    one = turns.select(
        turns[conv_col].alias("conv_id"), turns[turn_col].cast("long").alias("turn"),
        turns[role_col].cast("string").alias("role"), F.coalesce(turns[text_col].cast("string"), F.lit("")).alias("text"))
    one = one.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), "text",
        turn_segments(F.col("role"), F.col("text"), template).alias("segments")).alias("t"))
    # sorting moves references, not texts; (turn, role, text) decide, the segments follow from them
    return (one.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
            .select("conv_id", F.flatten(F.col("t.segments")).alias("segments"),
                    F.array_join(F.flatten(F.col("t.segments")).getField("text"), "").alias("formatted"),
                    valid_order(F.col("t.role"), template).alias("valid")))


def read_turns(formatted: Column, template: Template = DEFAULT) -> Column:
    """array<struct<role, text>> parsed from a formatted conversation."""
    quote = lambda s: "\\Q" + s + "\\E"
    pairs = [(o, c) for o, c, _ in template.roles.values()] + [(template.other[0], template.other[2])]
    turn = "(?s)" + "|".join(f"{quote(o)}.*?{quote(c)}" for o, c in pairs)
    found = F.regexp_extract_all(formatted, F.lit(turn), F.lit(0))

    def parse(x: Column) -> Column:
        a, b, c = template.other
        inner = F.substring(x, F.lit(len(a) + 1), F.length(x) - len(a) - len(c))
        out = F.struct(unescape(F.substring_index(inner, b, 1), template).alias("role"),
                       unescape(F.substring(inner, F.locate(b, inner) + len(b), F.length(inner)), template).alias("text"))
        for name, (o, cl, _) in template.roles.items():
            out = F.when(x.startswith(o), F.struct(
                F.lit(name).alias("role"),
                unescape(F.substring(x, F.lit(len(o) + 1), F.length(x) - len(o) - len(cl)), template).alias("text"))).otherwise(out)
        return out

    return F.transform(found, parse)


def digests(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Read back from :func:`format_conversations`: the digest row of each conversation."""
    turns = read_turns(F.col("formatted"), template)
    script = F.array_join(F.transform(F.col("turns"), lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("segments", lambda s: s.loss), lambda s: unescape(s.text, template)), "")
    return (formatted.select("conv_id", "valid", turns.alias("turns"), learned.alias("learned"),
                             F.length("formatted").cast("long").alias("formatted_chars"))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(script, 256).alias("turns_sha256"),
                    F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                    "formatted_chars", "valid"))
