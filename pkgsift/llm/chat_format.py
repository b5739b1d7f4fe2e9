"""Chat formatting (operator 5).

A template declares the segments of a turn and which of them carry loss.  A
finite-state machine over roles checks the order of turns.  Both run over a
conversation's turns in order, one turn at a time: a task holds a state, never a
conversation.  Reading back parses the formatted text alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pkgsift.llm.common import bounded_batches


@dataclass(frozen=True)
class Template:
    """Segments of a turn: literal text, or one of the fields ``role`` and ``text``.

    ``loss`` names the roles whose ``text`` segment carries loss.  Every literal
    that opens or closes a turn contains ``<|``; texts and roles are escaped so
    that they never do.
    """

    before: str = "<|im_start|>"
    between: str = "\n"
    after: str = "<|im_end|>\n"
    loss: tuple[str, ...] = ("assistant",)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        return [(self.before + escape_role(role) + self.between, False), (escape(text), role in self.loss), (self.after, False)]

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of every turn in a formatted text."""
        turns, at = [], 0
        while at < len(formatted):
            if not formatted.startswith(self.before, at):
                raise ValueError("a turn does not start where it should")
            a = at + len(self.before)
            b = formatted.index(self.between, a)
            c = formatted.index(self.after, b + len(self.between))
            turns.append((unescape_role(formatted[a:b]), unescape(formatted[b + len(self.between):c])))
            at = c + len(self.after)
        return turns


#: Where a conversation stands -> role -> where it stands then.
MACHINE = {
    "start": {"system": "system", "user": "user"},
    "system": {"user": "user"},
    "user": {"assistant": "assistant"},
    "assistant": {"user": "user"},
}
#: States in which a conversation may end.
ENDS = ("user", "assistant")


def escape(text: str) -> str:
    """Put one more backslash between ``<`` and ``|``, however many stand there."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


_FORMATTED = "conv_id long, turn_no long, segments array<struct<text: string, loss: boolean>>, error string"


def format_turns(turns: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn_no, segments, error: one row per turn, in order within its
    partition; a conversation lies in one partition.

    Turns are ordered by number, then role and text; a null number comes first,
    null roles and texts are empty, repeated rows are turns of their own.  Null
    conv_ids form one conversation.  ``error`` says what is wrong with a turn's
    place ("role 'x' after 'y'"), and on the last turn also a wrong end; wrongly
    ordered conversations are formatted all the same.  Other columns are ignored.
    """
    spark = turns.sparkSession
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, number = object(), "start", 0
        for batch in batches:
            segments, numbers, errors = [], [], []
            for c, role, text, last in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if c != conv:
                    conv, state, number = c, "start", 0
                then = MACHINE.get(state, {}).get(role)
                error = None if then else f"role {role!r} after {state!r}"
                state = then or (role if role in MACHINE else state)
                if last and not error and state not in ENDS:
                    error = f"ends after {state!r}"
                segments.append([{"text": t, "loss": flag} for t, flag in template.segments(role, text)])
                numbers.append(number)
                errors.append(error)
                number += 1
            kind = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
            yield pa.RecordBatch.from_pydict({"conv_id": batch.column(0), "turn_no": pa.array(numbers, pa.int64()),
                                              "segments": pa.array(segments, kind), "error": pa.array(errors, pa.string())})

    from pyspark.sql import Window

    order = ["conv_id", "turn", "role", "text"]
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ahead = F.lead(F.lit(1)).over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return (rows.withColumn("last", ahead.isNull()).sortWithinPartitions(*order)
            .select("conv_id", "role", "text", "last").mapInArrow(run, _FORMATTED))


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    valid: read from the segments' text and loss flags alone.

    ``formatted`` must stand as ``format_turns`` leaves it.  One row per
    conversation; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, open_ = None, False
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid")
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
        out: list[tuple] = []

        def close():
            out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, valid))

        for batch in batches:
            for c, first, segments, error in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if not open_ or first == 0:
                    if open_:
                        close()
                    conv, open_ = c, True
                    n = loss_chars = chars = 0
                    turns, loss, valid = hashlib.sha256(), hashlib.sha256(), True
                whole = "".join(s["text"] for s in segments)
                chars += len(whole)
                for role, text in template.parse(whole):
                    n += 1
                    turns.update(f"{role}\n{text}\n".encode())
                for s in segments:
                    if s["loss"]:
                        text = unescape(s["text"])
                        loss_chars += len(text)
                        loss.update(text.encode())
                valid = valid and error is None
            if len(out) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=list(names))
                out = []
        if open_:
            close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=list(names))

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                     "formatted_chars long, valid boolean")
