"""Chat formatting: turns in order, checked by a finite-state machine, as text segments with loss flags.

A template is declared, not coded: marks around a turn, and a machine's moves,
each from a state by a role to a state, with or without loss. One fold takes the
machine through a conversation's roles; the state it ends in says whether the
order is valid, and the moves it made say which turns are learned from. Every
turn becomes three segments (mark and role, text, end mark); the conversation's
text is their concatenation. Inside texts each run "<", backslashes, "|" gets one backslash
more, so no mark can appear in a text and taking one away restores it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


class Template(NamedTuple):
    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    #: (state, role, next state, whether the role's text carries loss).
    moves: tuple[tuple[str, str, str, bool], ...] = (
        ("start", "system", "told", False),
        ("start", "user", "asked", False),
        ("told", "user", "asked", False),
        ("asked", "assistant", "answered", True),
        ("answered", "user", "asked", False),
        ("lost", "assistant", "lost", True),
    )
    first: str = "start"
    #: The states that a conversation may end in, and the one that a role leads to for which there is no move.
    final: tuple[str, ...] = ("answered",)
    astray: str = "lost"


CHATML = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role has no line end and no "<" of its own in the output."""
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def machine(turns: Column, template: Template = CHATML) -> Column:
    """(state, flags): the state after the roles of an array of turns, and a 1 or 0 for each turn's loss.

    A role without a move leads astray; its turn then counts as one made from there.
    """
    moves = F.create_map(*[F.lit(x) for state, role, after, _ in template.moves for x in (f"{state}\n{role}", after)])
    learned = F.create_map(*[F.lit(x) for state, role, _, loss in template.moves for x in (f"{state}\n{role}", "01"[loss])])

    def step(at: Column, turn: Column) -> Column:
        key, astray = F.concat(at["state"], F.lit("\n"), turn["role"]), F.concat(F.lit(f"{template.astray}\n"), turn["role"])
        after = F.coalesce(F.try_element_at(moves, key), F.lit(template.astray))
        flag = F.coalesce(F.try_element_at(learned, key), F.try_element_at(learned, astray), F.lit("0"))
        return F.struct(after.alias("state"), F.concat(at["flags"], flag).alias("flags"))

    return F.aggregate(turns, F.struct(F.lit(template.first).alias("state"), F.lit("").alias("flags")), step)


def chat_segments(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row for each conv_id of `conversations` (conv_id, turn, role, text).

    `segments` is an array of (role, kind, text, loss), kind being open, text or
    close; `formatted` is their concatenation; `valid` says whether the roles'
    order is one that the template allows (invalid ones are formatted too).
    Turns go by turn, a null one first, ties by role and text; repeated rows
    are turns each. A null text or role is empty; rows of a null conv_id are
    one conversation. Other columns are ignored. A conversation is one row, so
    its turns must fit one.
    """
    none = F.lit("")
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", none).alias("role"), F.coalesce("text", none).alias("text")
    )
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def of_turn(t: Column, flag: Column) -> Column:
        def segment(kind: str, text: Column, loss: Column) -> Column:
            return F.struct(t["role"].alias("role"), F.lit(kind).alias("kind"), text.alias("text"), loss.alias("loss"))

        opened = F.concat(F.lit(template.start), escape_role(t["role"]), F.lit("\n"))
        return F.array(
            segment("open", opened, F.lit(False)),
            segment("text", escape(t["text"]), flag == "1"),
            segment("close", F.lit(template.end), F.lit(False)),
        )

    # as many flags as turns: the empty text between the last flag and the end is no flag
    flags = F.slice(F.split("run.flags", ""), F.lit(1), F.size("turns"))
    segments = F.flatten(F.zip_with("turns", flags, of_turn))
    return (
        turns.withColumn("run", machine(F.col("turns"), template))
        .select("conv_id", F.col("run.state").isin(*template.final).alias("valid"), segments.alias("segments"))
        .select("*", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))
    )


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """The array of (role, text) that a formatted conversation holds."""
    parts = F.split(formatted, _quoted(template.end))
    # the last part is what stands after the last end mark: nothing
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        at = F.instr(part, "\n")
        role = F.substring(part, F.lit(len(template.start) + 1), at - F.lit(len(template.start) + 1))
        return F.struct(unescape_role(role).alias("role"), unescape(F.substring(part, at + 1, F.length(part))).alias("text"))

    return F.transform(parts, turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, as it was before it was escaped."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescape(s["text"])), "")


def chat_digest(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """Counts and digests, read back from formatted conversations."""
    turns = read_turns(F.col("formatted"), template)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (
        formatted.select("conv_id", "valid", "formatted", turns.alias("turns"), read_loss(F.col("segments")).alias("loss"))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(told, 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "valid",
        )
    )
