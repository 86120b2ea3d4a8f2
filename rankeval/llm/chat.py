"""Chat formatting by a finite-state machine over roles.

A declarative template gives each role its opening and closing mark and its loss flag, and a transition table of
(state, role) -> state.  Every turn becomes three text segments (opening, escaped text, closing) with a loss flag
each; only the text of a role with ``loss`` carries it.  The machine checks the order of the turns: a turn that
the table does not allow is still formatted, and the conversation is reported invalid with the place of its
first fault.

Control strings inside a text are escaped reversibly: a backslash after the first character of each, and every
backslash doubled, so no mark can occur inside an escaped text.

Conversations are dealt by id and sorted by turn inside the tasks; a task streams its turns through the machine
(and the reader through its digests), holding one turn at a time, so a conversation of any length needs
bounded memory.

Defined cases: null texts are empty; a null or unknown role is written inside the generic mark (null as the
empty role) and is a fault; rows that tie on ``turn`` are ordered by role and text; null turns come first; rows
with a null conv_id form one conversation; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import struct_of, table


@dataclass(frozen=True)
class Template:
    """``roles``: role -> (opening, closing, loss); ``other``: marks of every other role, whose name follows the
    opening and ends with a line feed; ``moves``: (state, role) -> state, starting in ``start``; ``final``: states
    in which a conversation may end."""

    roles: dict = field(default_factory=lambda: {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n\n", False),
        "user": ("<s>[INST] ", " [/INST]", False),
        "assistant": (" ", " </s>", True),
    })
    other: tuple = ("[ROLE] ", " [/ROLE]")
    control: tuple = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
    moves: dict = field(default_factory=lambda: {
        ("begin", "system"): "system", ("begin", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user",
    })
    start: str = "begin"
    final: tuple = ("assistant",)

    def escape(self, text: str) -> str:
        return re.sub("|".join(map(re.escape, ("\\", *self.control))), lambda m: m[0][0] + "\\" + m[0][1:], text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        if role in self.roles:
            opening, closing, loss = self.roles[role]
            return [(opening, False), (self.escape(text), loss), (closing, False)]
        name = self.escape(role).replace("\n", "\\n")
        return [(f"{self.other[0]}{name}\n", False), (self.escape(text), False), (self.other[1], False)]

    def read(self, text: str, at: int = 0) -> Iterator[tuple[str, str, bool, int]]:
        """(role, text, loss, end) of each turn of a formatted text; the exact inverse of ``segments``."""
        while at < len(text):
            opened = text.startswith(self.other[0], at)
            role = None if opened else max(
                (r for r, (o, _, _) in self.roles.items() if text.startswith(o, at)), key=lambda r: len(self.roles[r][0]))
            opening, closing, loss = (*self.other, False) if opened else self.roles[role]
            begin = at + len(opening)
            if opened:
                line = text.index("\n", begin)
                role = re.sub(r"\\(\\|n)?", lambda m: {"\\": "\\", "n": "\n"}.get(m[1], ""), text[begin:line])
                begin = line + 1
            end = text.index(closing, begin)
            at = end + len(closing)
            yield role, self.unescape(text[begin:end]), loss, at


class Machine:
    """State, turns so far and the first faulty turn (None while all were allowed)."""

    def __init__(self, template: Template):
        self.template, self.state, self.turns, self.fault = template, template.start, 0, None

    def step(self, role: str | None) -> bool:
        """Take one turn; a turn that is not allowed leaves the state unless the role names one."""
        state = self.template.moves.get((self.state, role))
        ok = state is not None
        if not ok:
            self.fault = self.turns if self.fault is None else self.fault
            state = role if role in self.template.roles else self.state
        self.state, self.turns = state, self.turns + 1
        return ok

    @property
    def valid(self) -> bool:
        return self.fault is None and self.state in self.template.final


def _ordered(conversations: DataFrame) -> DataFrame:
    """Dealt by conversation and sorted; every task streams whole conversations."""
    rows = conversations.select("conv_id", "turn", F.col("role").cast("string").alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_turns(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per turn, conversations together and in order inside each partition: conv_id, position, role,
    ``segments`` (text, loss), ``allowed`` (the machine took the turn)."""
    template = template or Template()
    types = {f.name: f.dataType.simpleString() for f in conversations.schema.fields}
    segment = pa.struct([("text", pa.string()), ("loss", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, machine = object(), Machine(template)
        for batch in batches:
            position, segments, allowed = [], [], []
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if c != conv:
                    conv, machine = c, Machine(template)
                position.append(machine.turns)
                allowed.append(machine.step(role))
                segments.append([{"text": t, "loss": loss} for t, loss in template.segments(role or "", text)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(position, pa.int64()), batch.column(2),
                 pa.array(segments, pa.list_(segment)), pa.array(allowed, pa.bool_())],
                ["conv_id", "position", "role", "segments", "allowed"])

    return _ordered(conversations).mapInArrow(run, struct_of(
        ("conv_id", types["conv_id"]), ("position", "bigint"), ("role", "string"),
        ("segments", "array<struct<text: string, loss: boolean>>"), ("allowed", "boolean")))


def read_back(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """Digest per conversation, read from the formatted text and its loss mask alone."""
    template = template or Template()
    id_type = turns.schema["conv_id"].dataType.simpleString()
    schema = struct_of(
        ("conv_id", id_type), ("n_turns", "bigint"), ("turns_sha256", "string"), ("loss_chars", "bigint"),
        ("loss_sha256", "string"), ("formatted_chars", "bigint"), ("valid", "boolean"), ("first_fault", "bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = object(), None

        def done() -> dict:
            machine, all_, lost, chars, formatted = state
            return {"conv_id": conv, "n_turns": machine.turns, "turns_sha256": all_.hexdigest(), "loss_chars": chars,
                    "loss_sha256": lost.hexdigest(), "formatted_chars": formatted, "valid": machine.valid,
                    "first_fault": machine.fault}

        arrow = None
        for batch in batches:
            rows = []
            arrow = arrow or pa.schema([
                ("conv_id", batch.schema.field(0).type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                ("valid", pa.bool_()), ("first_fault", pa.int64())])
            for c, segments in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if c != conv:
                    if state is not None:
                        rows.append(done())
                    conv, state = c, [Machine(template), hashlib.sha256(), hashlib.sha256(), 0, 0]
                piece = "".join(s["text"] for s in segments)
                state[4] += len(piece)
                for role, text, _, _ in template.read(piece):
                    state[0].step(role)
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for s in segments:
                    if s["loss"]:
                        text = template.unescape(s["text"])
                        state[2].update(text.encode("utf-8", "surrogatepass"))
                        state[3] += len(text)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, arrow)
        if state is not None:
            yield pa.RecordBatch.from_pylist([done()], arrow)

    return turns.mapInArrow(run, schema)


def op4_chat_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast(given.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(given.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return read_back(format_turns(given.unionByName(probe)))
