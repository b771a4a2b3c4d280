"""Chat formatting by a finite-state machine over roles and a declarative template.

The template gives each role the strings before and after its text and whether the
text counts for the loss. The machine reads roles in turn order and tells whether
they are in an allowed order, and where they first are not. Output is one row per
text segment with its loss flag: turns stay rows from start to end, so a
conversation of any length never becomes one group in memory.

Control strings inside a text are made harmless by a backslash after their first
character, and a backslash is doubled; reading back undoes both. No control string
can arise where a text and a marker meet, because each begins with a character
that stands nowhere else in it.

Defined results: a null text is empty; a null role is an empty name; a role the
template does not name is formatted under its name, without loss, and is out of
order; repeated turns stay, in the order of role and text; a null conversation is
one of its own; an empty table gives no segments.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Part:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Markers per role; ``other`` frames roles without an entry; ``moves`` lists the roles that may follow each, "" the start."""

    roles: dict[str, Part] = field(
        default_factory=lambda: {
            "system": Part("[SYS]", "[/SYS]"),
            "user": Part("[INST] ", " [/INST]"),
            "assistant": Part("[OUT] ", " </s>", loss=True),
        }
    )
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[/TURN]")
    start: str = "<s>"
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )

    @property
    def controls(self) -> list[str]:
        found = [x.strip() for part in self.roles.values() for x in (part.before, part.after)] + [*self.other, self.start]
        return sorted(set(found), key=lambda x: (-len(x), x))


DEFAULT = Template()


def escaped(text: Column, template: Template = DEFAULT) -> Column:
    """Native form: double backslashes, then put one after the first character of each control string."""
    controls = "|".join(re.escape(c[1:]) for c in template.controls)
    firsts = "".join(re.escape(c) for c in sorted({c[0] for c in template.controls}))
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, rf"([{firsts}])(?={controls})", "$1\\\\")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def segments(
    turns: DataFrame, template: Template = DEFAULT, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """``conv_id``, ``position``, ``part`` (0 before, 1 text, 2 after), ``segment``, ``loss`` and ``in_order``.

    ``in_order`` tells whether the machine allows the turn after the one before it.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    in_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumns({"position": F.row_number().over(in_turn).cast("bigint"), "_last": F.coalesce(F.lag("role").over(in_turn), F.lit(""))})
    first = F.when(F.col("position") == 1, template.start).otherwise("")
    name = escaped(F.col("role"), template)
    before = F.concat(F.lit(template.other[0]), name, F.lit(template.other[1]))
    after, loss, allowed = F.lit(template.other[2]), F.lit(False), F.lit(False)
    for known, part in template.roles.items():
        is_it = F.col("role") == known
        before, after = F.when(is_it, part.before).otherwise(before), F.when(is_it, part.after).otherwise(after)
        loss = F.when(is_it, part.loss).otherwise(loss)
    for state, following in template.moves.items():
        allowed = F.when(F.col("_last") == state, F.col("role").isin(*following)).otherwise(allowed)
    start_state = (F.col("position") == 1) | (F.col("_last") != "")
    parts = F.array(
        F.struct(F.lit(0).alias("part"), F.concat(first, before).alias("segment"), F.lit(False).alias("loss")),
        F.struct(F.lit(1).alias("part"), escaped(F.col("text"), template).alias("segment"), loss.alias("loss")),
        F.struct(F.lit(2).alias("part"), after.alias("segment"), F.lit(False).alias("loss")),
    )
    out = rows.select("conv_id", "position", F.explode(parts).alias("_s"), (allowed & start_state).alias("in_order"))
    return out.select("conv_id", "position", "_s.part", "_s.segment", "_s.loss", "in_order")


class Reader:
    """Reads one conversation's segments back, piece by piece, and keeps only digests and counts."""

    def __init__(self, template: Template = DEFAULT):
        self.template = template
        self.turns, self.spoken = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.in_order = True
        self.opening = {p.before: role for role, p in template.roles.items()}
        self.role = ""

    def read(self, part: int, segment: str, loss: bool, in_order: bool) -> None:
        self.chars += len(segment)
        self.in_order &= in_order
        if part == 0:
            marker = segment.removeprefix(self.template.start)
            head, tail, _ = self.template.other
            self.role = self.opening[marker] if marker in self.opening else unescaped(marker[len(head) : -len(tail)])
        elif part == 1:
            text = unescaped(segment)
            self.n_turns += 1
            self.turns.update(f"{self.role}\n{text}\n".encode())
            if loss:
                self.loss_chars += len(text)
                self.spoken.update(text.encode())

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.spoken.hexdigest(), self.chars, self.in_order


def digests(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row of counts and digests per conversation, read back from its segments.

    Segments of a conversation pass by in order; what is held is the state of one
    reader, however long the conversation is.
    """
    schema = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, in_order boolean"
    )
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "position", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_order"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        reader, now = None, None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=fields)

        for batch in batches:
            done = []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "part", "segment", "loss", "in_order")]
            for conv, part, segment, loss, in_order in zip(*columns, strict=True):
                if reader is None or conv != now:
                    if reader is not None:
                        done.append((now, *reader.row()))
                    reader, now = Reader(template), conv
                reader.read(part, segment, loss, in_order)
            if done:
                yield batch_of(done)
        if reader is not None:
            yield batch_of([(now, *reader.row())])

    return ordered.mapInArrow(run, schema)
