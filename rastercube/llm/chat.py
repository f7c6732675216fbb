"""Chat formatting: a finite-state machine over roles, a declarative template, loss flags on segments."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Marks:
    """What stands around a turn's text, and whether the text counts for the loss."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks of the known roles; other roles stand, escaped, between the two strings of ``named``.

    ``controls`` are the strings that must not occur inside a text. They hold no backslash,
    and none of them can arise where a mark and a text meet, since marks end and begin with
    white space there.
    """

    roles: dict[str, Marks] = field(
        default_factory=lambda: {
            "system": Marks("<<SYS>>\n", "\n<</SYS>>\n"),
            "user": Marks("[INST] ", " [/INST]"),
            "assistant": Marks("<s> ", " </s>", True),
        }
    )
    named: tuple[str, str] = ("<|", "|>\n")
    named_close: str = "\n<|>\n"
    controls: tuple[str, ...] = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<|", "|>")

    def marks(self, role: str) -> Marks:
        known = self.roles.get(role)
        return known or Marks(self.named[0] + self.escape(role) + self.named[1], self.named_close)

    def escape(self, text: str) -> str:
        """Double each backslash, then put one behind the first character of every control string."""
        return _starts(self.controls).sub(r"\1\\", text.replace("\\", "\\\\"))

    @staticmethod
    def unescape(text: str) -> str:
        return _ESCAPED.sub(r"\1", text)

    def turns(self, formatted: str) -> Iterator[tuple[str, str, int]]:
        """(role, text, end) of the whole turns at the front of a formatted text."""
        at = 0
        while at < len(formatted):
            for role, m in self.roles.items():
                if formatted.startswith(m.open, at):
                    break
            else:
                if not formatted.startswith(self.named[0], at):
                    raise ValueError(f"no turn begins at {at}")
                stop = formatted.find(self.named[1], at + len(self.named[0]))
                if stop < 0:
                    return
                role = self.unescape(formatted[at + len(self.named[0]) : stop])
                m = Marks(formatted[at : stop + len(self.named[1])], self.named_close)
            begin = at + len(m.open)
            # the mark without its white space is a control string, which no text holds
            hard = m.close.strip()
            found = formatted.find(hard, begin)
            end = found - m.close.index(hard)
            if found < 0 or len(formatted) < end + len(m.close):
                return
            at = end + len(m.close)
            yield role, self.unescape(formatted[begin:end]), at


_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_patterns: dict[tuple[str, ...], re.Pattern] = {}


def _starts(controls: tuple[str, ...]) -> re.Pattern:
    if controls not in _patterns:
        _patterns[controls] = re.compile("(?=" + "|".join(map(re.escape, controls)) + ")(.)", re.DOTALL)
    return _patterns[controls]


#: The machine: state, role -> state. What is not here is an invalid order, and stays so.
TURN_ORDER = {
    ("start", "system"): "system",
    ("start", "user"): "user",
    ("system", "user"): "user",
    ("user", "assistant"): "assistant",
    ("assistant", "user"): "user",
}


def step(state: str, role: str) -> str:
    return TURN_ORDER.get((state, role), "invalid")


def turn_segments(template: Template, role: str, text: str) -> list[tuple[str, bool]]:
    m = template.marks(role)
    return [(m.open, False), (template.escape(text), m.loss), (m.close, False)]


def format_conversations(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """Segments of every conversation: conv_id, segment, turn_no, text, loss, valid.

    A conversation's formatted text is its segments' text in the order of ``segment``; loss
    marks what a model is trained on; valid is false from the first turn on that the machine
    doesn't allow (an invalid conversation is formatted all the same).

    Rows are brought together by conv_id and sorted by turn, then role and text, by Spark's
    spilling sort; a task streams over them one row at a time, so a conversation of any
    length needs the memory of one row. Null texts and roles are empty; rows without a
    conv_id are one conversation; repeated rows are turns; an empty table gives no rows.
    Other columns are ignored.
    """
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, turn, seq, begun = None, "start", 0, 0, False
        for b in batches:
            out: list[tuple] = []
            for c, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if not begun or c != conv:
                    conv, state, turn, seq, begun = c, "start", 0, 0, True
                role, text = role or "", text or ""
                state = step(state, role)
                for s, loss in turn_segments(template, role, text):
                    out.append((c, seq, turn, s, loss, state != "invalid"))
                    seq += 1
                turn += 1
            if out:
                c, s, t, x, l, v = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(s, pa.int64()), pa.array(t, pa.int64()), pa.array(x, pa.string()), pa.array(l, pa.bool_()), pa.array(v, pa.bool_())], names)

    names = ["conv_id", "segment", "turn_no", "text", "loss", "valid"]
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(run, "conv_id bigint, segment bigint, turn_no bigint, text string, loss boolean, valid boolean")


def read_back(segments: DataFrame, template: Template | None = None, ordered: bool = False) -> DataFrame:
    """Digest of each conversation's formatted text, parsed again by its marks.

    conv_id, n_turns, turns_sha256 (role, line feed, text, line feed of each turn), loss_chars
    and loss_sha256 (text of the segments under the loss mask, unescaped), formatted_chars,
    valid. ordered: the segments come straight from format_conversations, whose partitions
    hold whole conversations in order; otherwise they are brought together again.
    """
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, now = None, None
        for b in batches:
            done = []
            for c, text, loss, valid in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if now is None or c != conv:
                    if now is not None:
                        done.append((conv, *now.end()))
                    conv, now = c, _Reader(template)
                now.take(text, loss, valid)
            if done:
                yield batch(done)
        if now is not None:
            yield batch([(conv, *now.end())])

    kinds = {"conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64(), "valid": pa.bool_()}

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)], list(kinds))

    if not ordered:
        segments = segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return segments.select("conv_id", "text", "loss", "valid").mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, valid boolean")


class _Reader:
    """Parses one conversation as its segments come; holds the text of one turn."""

    def __init__(self, template: Template):
        self.template, self.rest, self.turns, self.chars, self.loss_chars, self.valid = template, "", 0, 0, 0, True
        self.hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def take(self, text: str, loss: bool, valid: bool) -> None:
        self.chars += len(text)
        self.valid &= valid
        if loss:
            plain = self.template.unescape(text)
            self.loss_chars += len(plain)
            self.loss_hash.update(plain.encode())
        self.rest += text
        at = 0
        for role, body, end in self.template.turns(self.rest):
            self.turns += 1
            self.hash.update(f"{role}\n{body}\n".encode())
            at = end
        self.rest = self.rest[at:]

    def end(self) -> tuple:
        if self.rest:
            raise ValueError("the formatted text ends inside a turn")
        return self.turns, self.hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars, self.valid
