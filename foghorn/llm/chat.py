"""Chat formatting by a declarative template and a finite-state machine over roles.

A template states the marks, the transitions between roles and which roles bear loss. Formatting is
one expression over the ordered turns of a conversation: the machine is folded over the roles, and
each turn becomes segments (mark, text, mark) with a loss flag each. Control strings inside texts
and role names are escaped, so the formatted string can be read back without loss.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from foghorn.functions.text import let


@dataclass(frozen=True)
class Template:
    """Marks around turns, marks of roles, and the machine: state and role give the next state.

    A role without a mark of its own is written by name between ``named``. The machine begins in
    ``start``; a conversation is valid if every step is listed and it ends in a state of ``final``.
    """

    begin: str = "<s>"
    end: str = "</s>"
    marks: dict[str, str] = field(
        default_factory=lambda: {"system": "[SYS]", "user": "[INST]", "assistant": "[/INST]"}
    )
    named: tuple[str, str] = ("[ROLE]", "[/ROLE]")
    start: str = "start"
    steps: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )
    final: tuple[str, ...] = ("assistant",)
    loss: tuple[str, ...] = ("assistant",)
    escape: str = "\\"

    def controls(self) -> list[str]:
        return [self.begin, self.end, *self.marks.values(), *self.named]


CHAT = Template()


def escaped(text: Column, template: Template) -> Column:
    """The text with control strings replaced by escape and number; the escape itself by escape and ``e``."""
    out = F.replace(text, F.lit(template.escape), F.lit(template.escape + "e"))
    for i, control in enumerate(template.controls()):
        out = F.replace(out, F.lit(control), F.lit(f"{template.escape}{i};"))
    return out


def unescaped(text: Column, template: Template) -> Column:
    out = text
    for i, control in enumerate(template.controls()):
        out = F.replace(out, F.lit(f"{template.escape}{i};"), F.lit(control))
    return F.replace(out, F.lit(template.escape + "e"), F.lit(template.escape))


def role_mark(role: Column, template: Template) -> Column:
    """What opens a turn of this role."""
    known = F.lit(None).cast("string")
    for name, mark in template.marks.items():
        known = F.when(role == name, F.lit(mark)).otherwise(known)
    named = F.concat(F.lit(template.named[0]), escaped(role, template), F.lit(template.named[1]))
    return F.concat(F.lit(template.begin), F.coalesce(known, named))


def machine(turns: Column, template: Template) -> Column:
    """Whether the roles of the ordered turns are a path of the machine that ends in a final state."""

    def step(state: Column, turn: Column) -> Column:
        out = F.lit("-")
        for (at, role), to in template.steps.items():
            out = F.when((state == at) & (turn["role"] == role), F.lit(to)).otherwise(out)
        return out

    return F.aggregate(turns, F.lit(template.start), step, lambda s: s.isin(*template.final))


def format_conversations(
    rows: DataFrame,
    template: Template = CHAT,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, valid, ``segments`` (text, loss) and the string ``formatted``.

    Turns are taken by number, equal numbers by role and text, a null number first; a repeated row is
    a turn of its own. A null text or role is empty. Rows without a conversation id form one. Invalid
    conversations are formatted like any other and flagged. A conversation is one string, so its turns
    meet in one row; nothing else does. An empty table gives no rows; other columns are dropped.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    one = F.struct(F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"))
    grouped = rows.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))

    def pieces(t: Column) -> Column:
        parts = [
            (role_mark(t["role"], template), F.lit(False)),
            (escaped(t["text"], template), t["role"].isin(*template.loss)),
            (F.lit(template.end), F.lit(False)),
        ]
        return F.array(*[F.struct(p.alias("text"), loss.alias("loss")) for p, loss in parts])

    out = grouped.select(
        "conv_id",
        machine(F.col("turns"), template).alias("valid"),
        F.flatten(F.transform("turns", pieces)).alias("segments"),
    )
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column, template: Template = CHAT) -> Column:
    """The turns (role, text) of a formatted string, in order."""

    def turn(part: Column) -> Column:
        body = F.substring(part, F.lit(1), F.length(part) - len(template.end))
        opened, closed = template.named
        after = F.substring(body, F.lit(len(opened) + 1), F.length(body))
        name_end = F.instr(after, closed)
        role = unescaped(F.substring(after, F.lit(1), name_end - 1), template)
        text = F.substring(after, name_end + len(closed), F.length(after))
        for name, mark in template.marks.items():
            own = F.startswith(body, F.lit(mark))
            role = F.when(own, F.lit(name)).otherwise(role)
            text = F.when(own, F.substring(body, F.lit(len(mark) + 1), F.length(body))).otherwise(text)
        return F.struct(role.alias("role"), unescaped(text, template).alias("text"))

    literal = "".join("\\" + c if not c.isalnum() else c for c in template.begin)
    parts = F.split(formatted, literal)
    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def loss_text(segments: Column, template: Template = CHAT) -> Column:
    """All text under the loss mask, unescaped, in order."""
    kept = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"], template))
    return F.array_join(kept, "")


def conversation_digests(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """Counts and digests of what ``format_conversations`` returned, read back from it."""
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    turns = let(
        read_back(F.col("formatted"), template),
        lambda t: F.struct(
            F.size(t).cast("bigint").alias("n"), sha(F.array_join(F.transform(t, line), "")).alias("sha")
        ),
    )
    loss = let(
        loss_text(F.col("segments"), template),
        lambda x: F.struct(F.length(x).cast("bigint").alias("n"), sha(x).alias("sha")),
    )
    out = formatted.select("conv_id", "valid", "formatted", turns.alias("turns"), loss.alias("loss"))
    return out.select(
        "conv_id",
        F.col("turns.n").alias("n_turns"),
        F.col("turns.sha").alias("turns_sha256"),
        F.col("loss.n").alias("loss_chars"),
        F.col("loss.sha").alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
    )


def formatted_chars_sql(template: Template = CHAT) -> str:
    """DuckDB expression for the characters that one turn takes in the formatted string."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def esc(column: str) -> str:
        first = f"replace({column}, {quote(template.escape)}, {quote(template.escape + 'e')})"
        swaps = enumerate(template.controls())
        return reduce(
            lambda x, c: f"replace({x}, {quote(c[1])}, {quote(f'{template.escape}{c[0]};')})", swaps, first
        )

    cases = " ".join(f"WHEN {quote(r)} THEN {len(m)}" for r, m in template.marks.items())
    named = f"{len(template.named[0]) + len(template.named[1])} + length({esc('role')})"
    fixed = len(template.begin) + len(template.end)
    return f"{fixed} + CASE role {cases} ELSE {named} END + length({esc('text')})"
