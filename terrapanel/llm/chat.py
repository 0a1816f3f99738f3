"""Chat formatting: a finite-state machine over roles and a declarative template.

``format_segments`` turns conversation rows into text segments with a loss flag
each; ``read_segments`` parses the formatted text back into turns.  Both stream
over sorted rows and hold one turn at a time, so a conversation may have any
number of turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapanel.llm.common import map_batches, shuffle_partitions

START, BROKEN = "start", "broken"


@dataclass(frozen=True)
class Template:
    """What is written around a turn, which turns may follow which, and where loss is taken.

    ``marks`` gives the strings around the texts of known roles; any other role is written out
    between ``other``.  Every turn stands between ``begin`` and ``end``.
    """

    begin: str = "<s>"
    end: str = "</s>"
    marks: dict = field(
        default_factory=lambda: {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("", "")}
    )
    other: tuple = ("[ROLE]", "[/ROLE]")
    loss_roles: tuple = ("assistant",)
    follows: dict = field(
        default_factory=lambda: {
            START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)
        }
    )
    final: tuple = ("assistant",)
    escape: str = "\\"

    def __post_init__(self) -> None:
        if sum(a == "" for a, _ in self.marks.values()) > 1:
            raise ValueError("only one role may go unmarked")
        controls = self.controls
        for a in controls:
            if len(a) < 2 or self.escape in a:
                raise ValueError(f"control string {a!r} is too short or holds the escape")
            for b in controls:
                if any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))) or (a != b and a in b):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")

    @property
    def controls(self) -> list[str]:
        found = {self.begin, self.end, *self.other}
        for pair in self.marks.values():
            found.update(x for x in pair if x)
        return sorted(found)

    def next_state(self, state: str, role: str) -> str:
        return role if role in self.follows.get(state, ()) else BROKEN


class Escaper:
    """Puts the escape after the first character of each control string, and doubles the escape.

    A text that ends in the beginning of a control string could complete one together with the
    mark behind it, so such an end gets an escape as well.  No control string is left anywhere,
    and ``undo`` gives back the text.
    """

    def __init__(self, template: Template):
        e = self.escape = template.escape
        self.hold = re.compile("|".join([re.escape(e), *map(re.escape, template.controls)]))
        starts = {c[:k] for c in template.controls for k in range(1, len(c))}
        self.tail = re.compile("(?:" + "|".join(re.escape(x) for x in sorted(starts, key=len, reverse=True)) + r")\Z")
        self.back = re.compile(re.escape(e) + "(" + re.escape(e) + ")?")

    def do(self, text: str) -> str:
        e = self.escape
        out = self.hold.sub(lambda m: e + e if m[0] == e else m[0][0] + e + m[0][1:], text)
        return out + e if self.tail.search(out) else out

    def undo(self, text: str) -> str:
        e = self.escape
        return self.back.sub(lambda m: e if m[1] else "", text)


def turn_segments(template: Template, escaper: Escaper, role: str, text: str) -> list[tuple[str, bool]]:
    if role in template.marks:
        a, b = template.marks[role]
        head = template.begin + a
    else:
        a, b = template.other
        head, b = template.begin + a + escaper.do(role) + b, ""
    return [(head, False), (escaper.do(text), role in template.loss_roles), (b + template.end, False)]


_KEY = ["_no_conv", "conv_id"]
_SEGMENTS = "_no_conv boolean, conv_id long, turn_no long, part int, text string, loss boolean, state string"


def _formatter(template: Template):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        escaper, key, state, n = Escaper(template), None, START, 0
        for frame in frames:
            rows = []
            for none, conv, role, text in zip(frame["_no_conv"], frame["conv_id"], frame["role"], frame["text"], strict=True):
                if key != (none, conv):
                    key, state, n = (none, conv), START, 0
                state = template.next_state(state, role)
                for part, (piece, loss) in enumerate(turn_segments(template, escaper, role, text)):
                    rows.append((none, conv, n, part, piece, loss, state))
                n += 1
            yield pd.DataFrame(rows, columns=["_no_conv", "conv_id", "turn_no", "part", "text", "loss", "state"])

    return run


def format_segments(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, turn_no, part, text, loss, state: the segments of each conversation in order.

    ``conversations`` has conv_id, turn, role, text; more columns are left out.  Null roles and
    texts count as empty, rows with a null conv_id are one conversation of their own, and turns
    that tie are ordered by role and text.  A turn that the machine does not allow puts it
    into the state ``broken`` for the rest of the conversation; it is formatted all the same.

    Rows are dealt by conversation and sorted; what follows streams over them.
    """
    rows = conversations.select(
        F.col("conv_id").isNull().alias("_no_conv"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    n = shuffle_partitions(conversations.sparkSession)
    dealt = rows.repartition(n, *_KEY).sortWithinPartitions(*_KEY, "turn", "role", "text")
    return map_batches(dealt, _formatter(template or Template()), _SEGMENTS)


class Reader:
    """Reads one conversation's formatted text, segment by segment, turn by turn."""

    def __init__(self, template: Template, escaper: Escaper):
        self.template, self.escaper = template, escaper
        self.text, self.mask = "", []
        self.turns, self.chars, self.loss_chars, self.state = 0, 0, 0, START
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str, loss: bool) -> None:
        if loss:
            self.mask.append((len(self.text), len(self.text) + len(piece)))
        self.text += piece
        self.chars += len(piece)
        while (at := self.text.find(self.template.end)) >= 0:
            self.turn(self.text[:at])
            rest = at + len(self.template.end)
            self.text, self.mask = self.text[rest:], [(a - rest, b - rest) for a, b in self.mask if a >= rest]

    def turn(self, body: str) -> None:
        t = self.template
        if not body.startswith(t.begin):
            raise ValueError("a turn does not begin with its mark")
        for a, b in self.mask:
            text = self.escaper.undo(body[a:b])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        body = body[len(t.begin):]
        if body.startswith(t.other[0]):
            role, _, body = body[len(t.other[0]):].partition(t.other[1])
            role = self.escaper.undo(role)
        else:
            role = next((r for r, (a, _) in t.marks.items() if a and body.startswith(a)), None)
            role = role or next(r for r, (a, _) in t.marks.items() if not a)
            a, b = t.marks[role]
            body = body[len(a): len(body) - len(b)]
        self.turns += 1
        self.state = t.next_state(self.state, role)
        self.all.update(f"{role}\n{self.escaper.undo(body)}\n".encode())

    def result(self) -> tuple:
        if self.text:
            raise ValueError("the formatted text ends inside a turn")
        return (self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.state in self.template.final)


_READ = ["_no_conv", "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]


def _reader(template: Template):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        escaper, key, reader = Escaper(template), None, None
        for frame in frames:
            rows = []
            for none, conv, text, loss in zip(frame["_no_conv"], frame["conv_id"], frame["text"], frame["loss"], strict=True):
                if key != (none, conv):
                    if reader:
                        rows.append((*key, *reader.result()))
                    key, reader = (none, conv), Reader(template, escaper)
                reader.feed(text, loss)
            yield pd.DataFrame(rows, columns=_READ)
        if reader:
            yield pd.DataFrame([(*key, *reader.result())], columns=_READ)

    return run


def read_segments(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """One row a conversation, from the formatted text alone: digests of its turns and of the text under loss.

    ``valid``: the turns follow the machine and end in a final state.  ``segments`` must still
    be as ``format_segments`` left them: whole conversations in order in a partition.
    """
    schema = ("_no_conv boolean, conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
              "loss_sha256 string, formatted_chars long, valid boolean")
    read = map_batches(segments, _reader(template or Template()), schema)
    return read.withColumn("conv_id", F.when(~F.col("_no_conv"), F.col("conv_id"))).drop("_no_conv")
