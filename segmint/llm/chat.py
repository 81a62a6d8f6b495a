"""Chat formatting: a finite-state machine over roles and a declarative template.

A template names the strings that start and end a turn, the roles whose text
bears loss, and the moves of the machine. Every conversation becomes a list of
text segments, each with its loss flag; together they are the formatted text.
Inside texts the escape character is put into every control string after its
first character and before every escape character, so a control string never
stands inside a formatted text other than where the template puts it, and the
turns can be read back exactly. Everything is column expressions.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


class ChatTemplate(NamedTuple):
    """``start`` holds the string that opens a turn of each role; other roles
    stand by name between the two strings of ``other``. ``moves`` tells the
    state a role leads to from each state; a role without a move is out of
    order, and so is an end in a state that is not in ``accept``."""
    start: tuple[tuple[str, str], ...] = (("system", "### System:"), ("user", "### User:"), ("assistant", "### Assistant:"))
    other: tuple[str, str] = ("### Role(", ")##")
    gap: str = " "
    end: str = "</turn>"
    after: str = "\n"
    loss: tuple[str, ...] = ("assistant",)
    first: str = "start"
    moves: tuple[tuple[str, tuple[tuple[str, str], ...]], ...] = (
        ("start", (("system", "told"), ("user", "asked"))),
        ("told", (("user", "asked"),)),
        ("asked", (("assistant", "answered"),)),
        ("answered", (("user", "asked"),)))
    accept: tuple[str, ...] = ("asked", "answered")


def controls(t: ChatTemplate) -> list[str]:
    """The control strings; an error if they could be misread."""
    out = [s for _, s in t.start] + [*t.other, t.end]
    for s in out:
        if len(s) < 2 or ESCAPE in s:
            raise ValueError(f"a control string needs two characters and no escape character: {s!r}")
    for a in (s for _, s in t.start):
        if any(a != b and b.startswith(a) for b in (*(s for _, s in t.start), t.other[0])) or a.startswith(t.other[0]):
            raise ValueError(f"{a!r} and another start cannot be told apart")
    for mark in (t.end, t.other[1]):  # what closes a text must be seen where it begins
        if any(mark[:k] == mark[-k:] for k in range(1, len(mark))):
            raise ValueError(f"{mark!r} overlaps itself")
    if ESCAPE in t.gap + t.after:
        raise ValueError("the escape character cannot stand between turns")
    return out


def escape(text: Column, t: ChatTemplate) -> Column:
    """Every place where a control string starts is broken up."""
    places = ["(?=\\\\)"] + [f"(?<=\\Q{s[0]}\\E)(?=\\Q{s[1:]}\\E)" for s in controls(t)]
    return F.regexp_replace(text, "|".join(places), "\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _table(t: ChatTemplate) -> tuple[list[str], list[list[int]]]:
    """Role names and, for each state, the next state by role; -1 is out of order."""
    states, roles = [s for s, _ in t.moves], [r for r, _ in t.start]
    for s, to in t.moves:
        for r, n in to:
            if r not in roles or n not in states:
                raise ValueError(f"the move from {s!r} by {r!r} to {n!r} names an unknown role or state")
    if t.first not in states or not set(t.accept) <= set(states):
        raise ValueError("the first and the accepted states need moves, empty ones at least")
    return roles, [[states.index(dict(to)[r]) if r in dict(to) else -1 for r in roles] + [-1] for _, to in t.moves]


def run_machine(roles: Column, t: ChatTemplate) -> Column:
    """(state, bad) after an array of roles: the state's number, and the place
    of the first role that is out of order (null: none)."""
    names, table = _table(t)
    first = [s for s, _ in t.moves].index(t.first)
    nexts = F.array(*[F.lit(x) for row in table for x in row])
    number = lambda r: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, names)), r), F.lit(0)), F.lit(len(names) + 1)) - 1

    def step(acc: Column, role: Column) -> Column:
        to = F.element_at(nexts, (acc["state"] * (len(names) + 1) + number(role) + 1).cast("int"))
        ok = acc["bad"].isNull() & (to >= 0)
        return F.struct(F.when(ok, to).otherwise(acc["state"]).alias("state"), (acc["at"] + 1).alias("at"),
                        F.when(acc["bad"].isNotNull(), acc["bad"]).when(to < 0, acc["at"]).alias("bad"))

    zero = F.struct(F.lit(first).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))
    return F.aggregate(roles, zero, step)


def segments(turns: Column, t: ChatTemplate) -> Column:
    """array<struct<text, loss>> of an array of turns with role and text."""
    def turn(x: Column) -> Column:
        named = F.concat(F.lit(t.other[0]), escape(x["role"], t), F.lit(t.other[1] + t.gap))
        head = reduce(lambda c, r: c.when(x["role"] == r[0], F.lit(r[1] + t.gap)), t.start[1:],
                      F.when(x["role"] == t.start[0][0], F.lit(t.start[0][1] + t.gap))).otherwise(named)
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(part(head, F.lit(False)), part(escape(x["text"], t), x["role"].isin(*t.loss)),
                       part(F.lit(t.end + t.after), F.lit(False)))
    return F.flatten(F.transform(turns, turn))


def read_turns(formatted: Column, t: ChatTemplate) -> Column:
    """array<struct<role, text>>: what a formatted text says."""
    closed = F.split(formatted, f"\\Q{t.end + t.after}\\E", -1)

    def turn(c: Column) -> Column:
        made = lambda role, text: F.struct(role.alias("role"), unescape(text).alias("text"))
        rest = F.split(F.substr(c, F.lit(len(t.other[0]) + 1)), f"\\Q{t.other[1] + t.gap}\\E", 2)
        known = [(c.startswith(s + t.gap), made(F.lit(r), F.substr(c, F.lit(len(s + t.gap) + 1)))) for r, s in t.start]
        out = reduce(lambda acc, k: acc.when(*k), known[1:], F.when(*known[0]))
        return out.otherwise(made(unescape(rest[0]), rest[1]))
    return F.transform(F.slice(closed, 1, F.size(closed) - 1), turn)


def format_conversations(turns: DataFrame, template: ChatTemplate = ChatTemplate(), id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, segments, formatted, valid, bad_turn) for every conversation.

    ``segments`` is array<struct<text, loss>>, ``formatted`` all its texts.
    ``valid`` says that the machine accepts the roles, ``bad_turn`` is the
    place (from 0) of the first turn out of order, null if there is none; a
    conversation that is not valid is formatted all the same. Turns go by
    number, then role, then text, null numbers first; repeated rows are turns
    of their own. A null text or role is empty. A row with a null id belongs
    to no other and is a conversation of its own. Other columns are not read;
    an empty table gives an empty table. One conversation must fit one row.
    """
    controls(template)
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    one = F.struct(F.col(f"`{turn_col}`").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    src = turns.select(F.col(f"`{id_col}`").alias("conv_id"), one.alias("one"))
    whole = src.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    whole = whole.unionByName(src.where("conv_id is null").select("conv_id", F.array("one").alias("turns")))
    accepted = [i for i, (s, _) in enumerate(template.moves) if s in template.accept]
    run = run_machine(F.transform("turns", lambda x: x["role"]), template)
    made = whole.select("conv_id", segments(F.col("turns"), template).alias("segments"), run.alias("run"))
    return made.select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                       (F.col("run.bad").isNull() & F.col("run.state").isin(*accepted)).alias("valid"), F.col("run.bad").alias("bad_turn"))


def chat_digests(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """The thin query: digests of what the formatted conversations say when
    they are read back."""
    out = format_conversations(turns, template).select(
        "*", read_turns(F.col("formatted"), template).alias("back"),
        F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "").alias("learned"))
    said = F.array_join(F.transform("back", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                      F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")


def with_example(turns: DataFrame) -> DataFrame:
    """``turns`` and the fixed conversation -7, whose texts hold control strings."""
    said = r"\### Assistant: </turn> ok"
    more = turns.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(more)


def _sql_escape(c: str, t: ChatTemplate) -> str:
    out = f"replace({c}, '\\', '\\\\')"
    for s in controls(t):
        out = f"replace({out}, '{s}', '{s[0]}\\{s[1:]}')"
    return out


def oracle(t: ChatTemplate = ChatTemplate()) -> str:
    """The thin query in SQL, for templates whose control strings do not overlap."""
    heads = " ".join(f"WHEN role = '{r}' THEN '{s}{t.gap}'" for r, s in t.start)
    named = f"'{t.other[0]}' || {_sql_escape('role', t)} || '{t.other[1]}{t.gap}'"
    loss = ", ".join(f"'{r}'" for r in t.loss)
    said = "'\\### Assistant: </turn> ok'"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', {said}), (-7, 1, 'assistant', {said})),
o AS (SELECT *, lag(role) OVER w AS prev, CASE {heads} ELSE {named} END || {_sql_escape('text', t)} || '{t.end}{t.after}' AS formatted
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role IN ({loss}) THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role IN ({loss}) THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars,
       bool_and(CASE WHEN prev IS NULL THEN role IN ('system', 'user') WHEN prev IN ('system', 'assistant') THEN role = 'user'
                     WHEN prev = 'user' THEN role = 'assistant' ELSE false END)
       AND max_by(role, turn) <> 'system' AS valid
FROM o GROUP BY conv_id"""
