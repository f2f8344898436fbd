"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to a string. Successive prefixes of a conversation are rendered;
what a turn adds to the rendering before it is the turn's span, and two renderings that differ in the turn's text alone
show where the text stands in it. A template whose longer rendering does not begin with the shorter one rewrites
history; the turn says how many characters of earlier output were given up.

A template may declare its ``memory``: the number of turns before a turn that its addition, and anything it rewrites, depend on.
Then each prefix is rendered from so many turns back. A template that declares none has every prefix rendered from
the first turn, so that no rewriting is missed however far back it reaches; a conversation's cost then grows with the square of its
length. Turns stream through sorted partitions, one output row a turn, so a conversation of any length needs the
memory of the template. Turns are ordered by number, role and text, nulls first; null roles and texts are empty; repeated rows are
repeated turns; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

Template = Callable[[list[tuple[str, str]]], str]
LOSS_ROLES = ("assistant",)

#: Control strings of this template and of other common ones: none of them may be read out of a text.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
_ESCAPE = "\\"
_PLAIN = re.compile("|".join(f"({re.escape(c[0])})((?:{re.escape(_ESCAPE)})*)({re.escape(c[1:])})" for c in CONTROL))


def _restyle(text: str, change: Callable[[str], str]) -> str:
    def one(match: re.Match) -> str:
        head, marks, rest = (g for g in match.groups() if g is not None)
        return head + change(marks) + rest

    return _PLAIN.sub(one, text)


def escape(text: str) -> str:
    """A backslash more after the first character of every control string, escaped or not."""
    return _restyle(text, lambda marks: marks + _ESCAPE)


def unescape(text: str) -> str:
    return _restyle(text, lambda marks: marks[len(_ESCAPE):])


def marked_turns(turns: list[tuple[str, str]]) -> str:
    """The template used here."""
    return "".join(f"<|im_start|>{escape(role.replace(_ESCAPE, _ESCAPE * 2).replace(chr(10), _ESCAPE + 'n'))}\n{escape(text)}<|im_end|>\n"
                   for role, text in turns)


#: Each turn stands for itself; the one before it is rendered too, so that its end is seen to stay.
marked_turns.memory = 1


def read_turn(piece: str) -> tuple[str, str]:
    """Role and text of one turn of ``marked_turns``."""
    head, _, rest = piece.removeprefix("<|im_start|>").partition("\n")
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(head))
    return role, unescape(rest.removesuffix("<|im_end|>\n"))


def _shared(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def render_turns(turns: Iterator[tuple[str, str]], template: Template = marked_turns, memory: int | None = None) -> Iterator[tuple]:
    """For each turn: (piece, text start, text end, rewritten), offsets within the piece. ``memory`` is the template's own unless given."""
    memory = getattr(template, "memory", None) if memory is None else memory
    held: list[tuple[str, str]] = []
    before = ""
    for role, text in turns:
        if memory is not None and len(held) > memory:
            held = held[len(held) - memory:]
            before = template(held)
        now = template([*held, (role, text)])
        kept = len(before) if now.startswith(before) else _shared(before, now)
        # Two texts that differ in their first character show where the text begins and what follows it.
        one, two = template([*held, (role, "0")]), template([*held, (role, "1")])
        start = _shared(one, two)
        tail = len(one) - start - 1
        yield now[kept:], start - kept, len(now) - tail - kept, len(before) - kept
        held.append((role, text))
        before = now


_TURNS = "conv_id {kind}, place long, role string, piece string, text_start long, text_end long, loss boolean, rewritten long"


def format_turns(conversations: DataFrame, template: Template = marked_turns, loss_roles: tuple[str, ...] = LOSS_ROLES,
                 conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn, the turns of a conversation one after the other: its piece of the formatted text, where the
    turn's own text stands in it, whether that is under the loss mask, and how much earlier output it rewrote."""
    kind, memory = conversations.schema[conv].dataType.simpleString(), getattr(template, "memory", None)
    rows = conversations.select(conversations[conv].alias("conv_id"), conversations[turn].alias("turn"),
                                F.coalesce(conversations[role].cast("string"), F.lit("")).alias("role"),
                                F.coalesce(conversations[text].cast("string"), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def run(batches):
        def stream():
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    yield from zip(*(batch.column(k).slice(at, 1024).to_pylist() for k in range(3)), strict=True)

        rows_, out = stream(), []
        item = next(rows_, None)
        while item is not None:
            current = item[0]

            def own():
                nonlocal item
                while item is not None and item[0] == current:  # noqa: B023 - used up within this round
                    roles.append(item[1])
                    pair = item[1], item[2]
                    item = next(rows_, None)
                    yield pair

            roles: list[str] = []
            for place, (piece, start, end, rewritten) in enumerate(render_turns(own(), template, memory)):
                out.append({"conv_id": current, "place": place, "role": roles[place], "piece": piece, "text_start": start,
                            "text_end": end, "loss": roles[place] in loss_roles, "rewritten": rewritten})
                if len(out) == 1024:
                    yield pa.RecordBatch.from_pylist(out, schema=schema_of)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema_of)

    schema_of = to_arrow_schema(conversations.sparkSession.createDataFrame([], _TURNS.format(kind=kind)).schema)
    return rows.mapInArrow(run, _TURNS.format(kind=kind))


def digest_turns(turns: DataFrame) -> DataFrame:
    """Read the formatted turns back, one row per conversation. Takes the rows as ``format_turns`` leaves them."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    result = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites long"

    def run(batches):
        current = state = None
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                for conv, piece, start, end, loss, rewritten, place in zip(*(part.column(k).to_pylist() for k in range(7)), strict=True):
                    if state is None or conv != current or place == 0:
                        if state is not None:
                            out.append(row(current, state))
                        current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                    role, text = read_turn(piece)
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    if loss:
                        learned = unescape(piece[start:end])
                        state[2] += len(learned)
                        state[3].update(learned.encode("utf-8", "surrogatepass"))
                    state[4] += len(piece)
                    state[5] += rewritten > 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema_of)
        if state is not None:
            yield pa.RecordBatch.from_pylist([row(current, state)], schema=schema_of)

    def row(conv, state):
        return {"conv_id": conv, "n_turns": state[0], "turns_sha256": state[1].hexdigest(), "loss_chars": state[2],
                "loss_sha256": state[3].hexdigest(), "formatted_chars": state[4], "rewrites": state[5]}

    schema_of = to_arrow_schema(turns.sparkSession.createDataFrame([], result).schema)
    return turns.select("conv_id", "piece", "text_start", "text_end", "loss", "rewritten", "place").mapInArrow(run, result)


def chat_report(conversations: DataFrame) -> DataFrame:
    return digest_turns(format_turns(conversations))
