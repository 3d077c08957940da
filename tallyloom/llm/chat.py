"""Chat formatting: a finite-state machine over roles, and segments with loss flags from a template.

A conversation is read in the order of ``turn`` (ties: role, then text). The machine's transitions are a
table (state, role) -> state; a turn without a transition is marked illegal and the machine goes on in the
state that the role leads to from the start. Each turn becomes three segments: opening mark, text, closing
mark; the template says which roles carry loss. Marks that occur inside a text or a role are escaped by one
backslash after their first character (marks already escaped get one more), which ``unescape`` undoes.

To follow the machine through a conversation of any length, turns are cut into blocks of BLOCK_TURNS turn
numbers. Each block is a map from the state before to the state after it, and the maps of a conversation
are chained; no task holds the texts of a whole conversation for it. Only ``assemble`` puts a conversation
into one row, since that is its result.

Defined cases: null text and null role count as empty; a role the template does not name keeps its name in
the marks and carries no loss; a null turn sorts first; repeated rows are turns of their own; rows with a
null conv_id form one conversation. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_TURNS = 256
START = "start"


@dataclass(frozen=True)
class Marks:
    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, the control strings they are made of, and the machine's transitions."""

    marks: dict[str, Marks]
    controls: tuple[str, ...]
    other: tuple[str, str, str] = ("[TURN] ", " [TEXT] ", " [/TURN]")
    transitions: dict[tuple[str, str], str] = field(default_factory=dict)
    final: tuple[str, ...] = ("assistant",)


INSTRUCT = Template(
    marks={
        "system": Marks("<<SYS>> ", " <</SYS>>"),
        "user": Marks("<s>[INST] ", " [/INST]"),
        "assistant": Marks(" ", " </s>", loss=True),
    },
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[TURN]", "[/TURN]", "[TEXT]"),
    transitions={
        (START, "system"): "system",
        (START, "user"): "user",
        ("system", "user"): "user",
        ("user", "assistant"): "assistant",
        ("assistant", "user"): "user",
    },
)


def _quote(text: str) -> str:
    return "".join("\\" + c if c in "\\[](){}.*+?^$|/<>" else c for c in text)


def _control_pattern(template: Template) -> str:
    """First character, backslashes, rest of any control string."""
    return "(" + "|".join(f"{_quote(c[0])}(?=\\\\*{_quote(c[1:])})" for c in template.controls) + r")(\\*)"


def escape(text: Column, template: Template = INSTRUCT) -> Column:
    return F.regexp_replace(text, _control_pattern(template), r"$1$2\\")


def unescape(text: Column, template: Template = INSTRUCT) -> Column:
    firsts = "|".join(f"{_quote(c[0])}(?=\\\\+{_quote(c[1:])})" for c in template.controls)
    return F.regexp_replace(text, f"({firsts})\\\\", "$1")



def _segments(role: Column, text: Column, template: Template) -> Column:
    """The three segments of a turn, as array<struct<text, loss>>."""

    def three(opening: Column, closing: Column, loss: bool) -> Column:
        parts = ((opening, False), (escape(text, template), loss), (closing, False))
        return F.array(*[F.struct(t.alias("text"), F.lit(flag).alias("loss")) for t, flag in parts])

    before, between, after = template.other
    out = three(F.concat(F.lit(before), escape(role, template), F.lit(between)), F.lit(after), False)
    for name, marks in template.marks.items():
        out = F.when(role == name, three(F.lit(marks.opening), F.lit(marks.closing), marks.loss)).otherwise(out)
    return out


def format_turns(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per turn: conv_id, block, place, turn, role, state, legal, segments.

    ``block`` and ``place`` order the turns of a conversation; ``state`` is the machine's state after the turn.
    """
    states = [START, *sorted({s for s in template.transitions.values()})]
    steps = F.create_map(*[F.lit(x) for (s, r), to in template.transitions.items() for x in (f"{s}\n{r}", to)])
    # Where a role leads to if it comes out of turn: to its usual state, or the start for unknown roles.
    usual = F.create_map(*[F.lit(x) for r in {r for _, r in template.transitions} for x in (r, r if r in states else START)])

    def legal(state: Column, role: Column) -> Column:
        return F.element_at(steps, F.concat(state, F.lit("\n"), role)).isNotNull()

    def after(state: Column, role: Column) -> Column:
        return F.coalesce(F.element_at(steps, F.concat(state, F.lit("\n"), role)), F.element_at(usual, role), F.lit(START))

    turns = conversations.select(
        "conv_id",
        "turn",
        F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / BLOCK_TURNS).cast("long").alias("block"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    # Blocks of one conversation are chained from the roles alone.
    maps = (
        turns.groupBy("conv_id", "block")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("rows"))
        .select(
            "conv_id",
            F.struct(
                "block",
                F.array(*[F.aggregate("rows", F.lit(s), lambda st, x: after(st, x["role"])) for s in states]).alias("ends"),
            ).alias("map"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("map")).alias("maps"))
    )
    number = F.create_map(*[F.lit(x) for i, s in enumerate(states) for x in (s, i + 1)])
    begin = F.aggregate(
        "maps",
        F.struct(F.lit(START).alias("state"), F.expr("cast(array() as array<struct<block: bigint, state: string>>)").alias("begins")),
        lambda acc, m: F.struct(
            F.element_at(m["ends"], F.element_at(number, acc["state"])).alias("state"),
            F.concat(acc["begins"], F.array(F.struct(m["block"].alias("block"), acc["state"].alias("state")))).alias("begins"),
        ),
    )
    begins = maps.select("conv_id", F.explode(begin["begins"]).alias("b")).select(
        F.col("conv_id").alias("conv"), F.col("b.block").alias("at"), F.col("b.state").alias("begin")
    )
    grouped = turns.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("rows"))
    blocks = grouped.join(begins, grouped.conv_id.eqNullSafe(begins.conv) & (grouped.block == begins["at"])).drop("conv", "at")
    # The states after each turn of a block; the block is of bounded length, so its list may grow in place.
    path = F.aggregate(
        "rows",
        F.array("begin"),
        lambda acc, x: F.concat(acc, F.array(after(F.element_at(acc, -1), x["role"]))),
    )
    return (
        blocks.select("conv_id", "block", "rows", path.alias("path"))
        .select("conv_id", "block", "path", F.posexplode("rows").alias("place", "row"))
        .select(
            "conv_id",
            "block",
            "place",
            "row.turn",
            "row.role",
            F.element_at("path", F.col("place") + 2).alias("state"),
            legal(F.element_at("path", F.col("place") + 1), F.col("row.role")).alias("legal"),
            _segments(F.col("row.role"), F.col("row.text"), template).alias("segments"),
        )
    )


def assemble(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation: conv_id, segments, formatted, valid.

    ``valid``: every turn legal and the last state a final one. Neighbouring segments stay apart, so the
    loss flags can be laid over the formatted text.
    """
    row = F.struct("block", "place", "state", "legal", "segments")
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    segments = F.flatten(F.transform("rows", lambda r: r["segments"]))
    return gathered.select(
        "conv_id",
        segments.alias("segments"),
        F.array_join(F.transform(segments, lambda s: s["text"]), "").alias("formatted"),
        (
            F.forall("rows", lambda r: r["legal"])
            & F.element_at("rows", -1)["state"].isin(*template.final)
        ).alias("valid"),
    )


def read_back(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns of a formatted conversation, as array<struct<role, text>>, unescaped.

    Control strings never occur inside an escaped text, so the first closing mark ends a turn.
    """
    before, between, after = template.other
    shapes = [(m.opening, m.closing) for m in template.marks.values()] + [(before, after)]
    # Longest opening first, so that a mark is not taken for the beginning of another.
    shapes.sort(key=lambda s: -len(s[0]))
    pattern = "(?s)" + "|".join(f"{_quote(o)}.*?{_quote(c)}" for o, c in shapes)

    def parse(turn: Column) -> Column:
        inner = F.substring(turn, F.lit(len(before) + 1), F.length(turn) - len(before) - len(after))
        cut = F.instr(inner, between)
        role = F.substring(inner, F.lit(1), cut - 1)
        text = F.substring(inner, cut + len(between), F.length(inner))
        out = F.struct(unescape(role, template).alias("role"), unescape(text, template).alias("text"))
        for name, m in sorted(template.marks.items(), key=lambda x: len(x[1].opening)):
            body = F.substring(turn, F.lit(len(m.opening) + 1), F.length(turn) - len(m.opening) - len(m.closing))
            mine = F.struct(F.lit(name).alias("role"), unescape(body, template).alias("text"))
            out = F.when(turn.startswith(m.opening), mine).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0)), parse)


def loss_text(segments: Column, template: Template = INSTRUCT) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescape(s["text"], template)), "")
