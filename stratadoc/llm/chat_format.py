"""Chat formatting with a grammar round trip.

Template: a user turn is ``<s>[INST] text [/INST]``, an assistant turn `` text </s>``, a system turn
``<<SYS>>\\ntext\\n<</SYS>>\\n\\n``, any other role ``[ROLE role] text [/ROLE]``.  A deterministic parser reads such a
string back.  A turn is first rendered as it is; if it holds a control string, or parses to anything but itself, its
backslashes and opening brackets are escaped by a backslash, until the parser recovers it exactly.

Turns are formatted row by row, so no conversation is ever gathered: a conversation's string is the concatenation of
its turns' strings in order of (turn, role, text), and digests stream over sorted rows.  The loss mask of a turn is the
range of an assistant's text in the string.

Null text and null role are empty; a null conv_id is a conversation; rows that repeat each other are turns of their own;
a text may have any length; an empty table gives no rows; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: Fixed control strings of the template.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE", "[/ROLE]")
FORMS = {"user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n\n")}
_ESCAPE, _UNESCAPE = re.compile(r"[\\\[<]"), re.compile(r"\\([\\\[<])")
#: A role's name in its tag always has its brackets and backslashes escaped.
_NAME, _NAME_BACK, _BACK = re.compile(r"[\\\[\]<]"), re.compile(r"\\([\\\[\]<])"), r"\\\g<0>"
_TAG = re.compile(r"\[ROLE ((?:\\.|[^\\\]])*)\] ", re.DOTALL)


def _unescaped(s: str) -> str:
    return _UNESCAPE.sub(r"\1", s)


def _escaped(s: str) -> str:
    return _ESCAPE.sub(r"\\\g<0>", s)


def parse(string: str, at: int = 0) -> list[tuple[str, str, int, int]] | None:
    """The turns (role, text, start and end of the text as it stands in the string); None if it isn't of the grammar."""
    out = []
    while at < len(string):
        for role, (opening, closing) in FORMS.items():
            if string.startswith(opening, at):
                start = at + len(opening)
                break
        else:
            if not (tag := _TAG.match(string, at)):
                return None
            role, closing, start = _NAME_BACK.sub(r"\1", tag[1]), " [/ROLE]", tag.end()
        end = string.find(closing, start)
        if end < 0:
            return None
        out.append((role, _unescaped(string[start:end]), start, end))
        at = end + len(closing)
    return out


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn's string, and where its text stands in it."""
    escaped = any(c in text for c in CONTROL)
    for _ in range(2):
        opening, closing = FORMS.get(role) or (f"[ROLE {_NAME.sub(_BACK, role)}] ", " [/ROLE]")
        string = opening + (_escaped(text) if escaped else text) + closing
        turns = parse(string)
        if turns and len(turns) == 1 and turns[0][:2] == (role, text):
            return string, turns[0][2], turns[0][3]
        escaped = True
    raise AssertionError((role, text))  # an escaped turn always parses to itself


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, and the turn's string with loss_start, loss_end (0, 0: no loss), a row per turn."""
    shared.small_batches(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            for part in shared.pieces(batch):
                found = [render(r, t) for r, t in zip(part.column("role").to_pylist(), part.column("text").to_pylist(), strict=True)]
                loss = [r == "assistant" for r in part.column("role").to_pylist()]
                yield pa.RecordBatch.from_pydict({"conv_id": part.column("conv_id"), "turn": part.column("turn"), "role": part.column("role"), "formatted": pa.array([f[0] for f in found], pa.string()), "loss_start": pa.array([f[1] * x for f, x in zip(found, loss, strict=True)], pa.int64()), "loss_end": pa.array([f[2] * x for f, x in zip(found, loss, strict=True)], pa.int64())})

    return rows.mapInArrow(run, "conv_id long, turn long, role string, formatted string, loss_start long, loss_end long")


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, string: str, start: int, end: int) -> None:
        for role, text, _, _ in parse(string):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        lost = _unescaped(string[start:end])
        self.loss.update(lost.encode())
        self.loss_chars += len(lost)
        self.chars += len(string)

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def digests(output: DataFrame) -> DataFrame:
    """What the formatted turns parse to, by conversation; holds one turn and one digest at a time."""

    def run(batches):
        now, done = None, []
        for batch in batches:
            for conv, string, start, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")), strict=True):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(string, start, end)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(_DIGESTS.names, d, strict=True)) for d in done], schema=_DIGESTS)
                done = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(_DIGESTS.names, now.row(), strict=True))], schema=_DIGESTS)

    ordered = output.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
