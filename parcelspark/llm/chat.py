"""Chat formatting by a finite-state machine over roles and a declarative template, with a loss flag per segment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = "start"


@dataclass(frozen=True)
class Template:
    """What a conversation looks like in text.

    ``turns`` gives each role the control strings before and after its text and whether its text is trained on.
    ``moves`` is the state machine: from a state (the role of the turn before, or ``start``) to the roles that may
    follow. ``ends`` are the states a conversation may end in. A role without an entry in ``turns`` is written by
    ``other``, whose control strings may hold ``{role}``, and is never a valid move.

    No control string may occur inside a text: ``escape`` is put behind the first character of each that does, and
    doubled where the text has it itself, so that reading back restores the text exactly.
    """

    turns: dict[str, tuple[str, str, bool]]
    moves: dict[str, tuple[str, ...]]
    ends: tuple[str, ...]
    other: tuple[str, str, bool]
    escape: str = "\\"
    _inside: re.Pattern = field(init=False, repr=False, compare=False)
    _escapes: re.Pattern = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        marks = {m for before, after, _ in (*self.turns.values(), self.other) for m in self._marks(before + after)}
        if len(self.escape) != 1 or any(len(m) < 2 or self.escape in m for m in marks):
            raise ValueError("control strings need two characters and must not hold the escape character")
        either = "|".join(map(re.escape, sorted(marks, key=lambda m: (-len(m), m))))
        escape = re.escape(self.escape)
        object.__setattr__(self, "_inside", re.compile(f"({escape})|(?=(?:{either}))(.)", re.S))
        object.__setattr__(self, "_escapes", re.compile(f"{escape}({escape}?)"))

    @staticmethod
    def _marks(text: str) -> list[str]:
        return re.findall(r"</?[^<>\s]+>|\[/?[^\[\]\s]+\]", text)

    def escaped(self, text: str) -> str:
        return self._inside.sub(lambda m: (m[1] or m[2]) + self.escape, text)

    def unescaped(self, text: str) -> str:
        return self._escapes.sub(lambda m: m[1], text)

    def around(self, role: str | None) -> tuple[str, str, bool]:
        found = self.turns.get(role)
        if found:
            return found
        before, after, loss = self.other
        name = "null" if role is None else "role:" + self.escaped(role).replace("\n", self.escape + "n")
        return before.replace("{role}", name), after, loss

    def parsed(self, text: str) -> list[tuple[str | None, str]]:
        """(role, text) of the turns of a formatted conversation."""
        turns, at = [], 0
        named = re.compile(re.escape(self.other[0]).replace(re.escape("{role}"), "(null|role:[^\n]*?)"), re.S)
        while at < len(text):
            for role, (before, after, _) in self.turns.items():
                if text.startswith(before, at):
                    start = at + len(before)
                    break
            else:
                match = named.match(text, at)
                if not match:
                    raise ValueError(f"no turn starts at character {at}")
                start, after = match.end(), self.other[1]
                role = match[1]
                role = None if role == "null" else self.unescaped(role[5:].replace(self.escape + "n", "\n"))
            stop = text.index(after, start)
            turns.append((role, self.unescaped(text[start:stop])))
            at = stop + len(after)
        return turns


# A conversation may open with a system turn; user and assistant then alternate, and it ends with the assistant.
INST = Template(
    turns={
        "system": ("<s>[SYS] ", " [/SYS]</s>", False),
        "user": ("<s>[INST] ", " [/INST]", False),
        "assistant": ("<s>[ANS] ", " [/ANS]</s>", True),
    },
    moves={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant",),
    other=("<s>[ROLE] {role} [TEXT] ", " [/TEXT]</s>", False),
)


def segments(
    df: DataFrame,
    template: Template = INST,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The formatted conversations as segments, in order: ``conv``, ``segment`` (from 0), ``turn`` (rank, from 0),
    ``role``, ``kind`` (open, text or close), ``content``, ``loss``, ``start`` (place in the conversation, in code
    points), ``valid`` (whether the state machine accepts the conversation up to and with this turn) and ``last``
    (true on the conversation's last segment; ``valid`` there also tells whether it may end so).

    Rows are dealt by conversation and sorted by turn, then role and text where turns tie; equal rows stay. Each
    task streams through its sorted rows and keeps one turn at a time, so a conversation of any length takes no more
    memory than its longest turn. A null text is an empty one; a null or unknown role is kept but not valid; rows
    with a null conversation form one conversation of their own. Nothing else of ``df`` is kept. An empty table
    stays empty.
    """
    dealt = (
        df.select(
            F.col(conv).alias("conv"),
            F.col(turn).alias("turn"),
            F.col(role).cast("string").alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        )
        .repartition("conv")
        .sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")))
        .select("conv", "role", "text")
    )
    out = df.select(
        F.col(conv).alias(conv),
        F.lit(0).cast("long").alias("segment"),
        F.lit(0).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.lit("").alias("kind"),
        F.lit("").alias("content"),
        F.lit(True).alias("loss"),
        F.lit(0).cast("long").alias("start"),
        F.lit(True).alias("valid"),
        F.lit(True).alias("last"),
    ).schema
    out["role"].nullable = True

    def turns(batches: Iterator[pa.RecordBatch]):
        """Each row with whether its conversation goes on; a row is held back until the next one is known."""
        held = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None:
                    yield held, row[0] == held[0]
                held = row
        if held is not None:
            yield held, False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        held_chars, rank, segment, at, state, valid = 0, 0, 0, 0, START, True

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(c, types[i]) for i, c in enumerate(zip(*made))]
            return pa.RecordBatch.from_arrays(arrays, names=out.names)

        types: list = []
        for (key, who, said), more in turns(_typed(batches, types, out)):
            before, after, loss = template.around(who)
            valid = valid and who in template.moves.get(state, ())
            state = who
            ends_well = valid and (more or state in template.ends)
            parts = (("open", before, False), ("text", template.escaped(said), loss), ("close", after, False))
            for kind, content, trained in parts:
                last = not more and kind == "close"
                made.append((key, segment, rank, who, kind, content, trained, at, ends_well if last else valid, last))
                segment, at = segment + 1, at + len(content)
            held_chars += len(said)
            rank += 1
            if not more:
                rank, segment, at, state, valid = 0, 0, 0, START, True
            if len(made) >= 6_000 or held_chars > 4_000_000:
                yield flush()
                made, held_chars = [], 0
        if made:
            yield flush()

    return dealt.mapInArrow(run, out)


def _typed(batches: Iterator[pa.RecordBatch], types: list, out) -> Iterator[pa.RecordBatch]:
    """Passes batches on; notes the Arrow types of the segment rows once the key's type is known."""
    rest = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.bool_(), pa.bool_()]
    for batch in batches:
        if not types:
            types.extend([batch.schema.field(0).type, *rest])
        yield batch


def read_back(formatted: DataFrame, template: Template = INST) -> DataFrame:
    """Digests of what ``segments`` wrote, one row per conversation: ``n_turns``, ``turns_sha256`` (of role, newline,
    text, newline per turn), ``loss_chars`` and ``loss_sha256`` (of all text under the loss mask, unescaped),
    ``formatted_chars``, ``valid``.

    Turns are parsed from the written text, between a turn's control strings; roles come from these strings too.
    Works on the partitions that ``segments`` made, in their order, and holds one turn at a time. Where segments are
    missing, repeated, out of order or apart from the rest of their conversation (as after a shuffle or a reread of
    split files), it fails. Null texts were written as empty ones; no rows give no rows.
    """
    import hashlib

    key = formatted.columns[0]
    out = formatted.select(
        F.col(key),
        F.lit(0).cast("long").alias("n_turns"),
        F.lit("").alias("turns_sha256"),
        F.lit(0).cast("long").alias("loss_chars"),
        F.lit("").alias("loss_sha256"),
        F.lit(0).cast("long").alias("formatted_chars"),
        F.lit(True).alias("valid"),
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, chars, loss_chars, turns, trained, written = 0, 0, 0, hashlib.sha256(), hashlib.sha256(), []
        expected, current = 0, None
        for batch in batches:
            rows = []
            columns = (batch.column(i).to_pylist() for i in range(batch.num_columns))
            for conv, segment, _, _, kind, content, loss, _, valid, last in zip(*columns):
                if segment != expected or (segment and conv != current and conv == conv):
                    raise ValueError(f"segment {segment} of conversation {conv} where {expected} of {current} must follow")
                expected, current = (0, None) if last else (segment + 1, conv)
                written.append(content)
                chars += len(content)
                if loss:
                    plain = template.unescaped(content)
                    loss_chars += len(plain)
                    trained.update(plain.encode())
                if kind == "close":
                    for role, text in template.parsed("".join(written)):
                        turns.update(f"{'' if role is None else role}\n{text}\n".encode())
                        n += 1
                    written = []
                if last:
                    rows.append((conv, n, turns.hexdigest(), loss_chars, trained.hexdigest(), chars, valid))
                    n, chars, loss_chars, turns, trained = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            if rows:
                found = list(zip(*rows))
                types = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types)], names=out.names)
        if expected:
            raise ValueError(f"conversation {current} ends before its segment {expected}")

    return formatted.mapInArrow(run, out)
