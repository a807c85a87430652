"""Chat formatting by a finite-state machine over roles and a declarative template.

A :class:`Template` names the marks around a turn, the roles' transitions and the roles
whose texts carry loss. The machine walks the turns of a conversation in order, checks that
each role may follow the last, and emits segments: (conversation, number, text, loss), whose
concatenation is the formatted conversation. Control strings inside a role or text get an
escape in front (and an escape character is doubled), so :func:`read_back` recovers every
turn from the formatted text alone.

Turns are shuffled by conversation and sorted by (conversation, turn, role, text); a task
streams over them and holds the machine's state and one turn, so a conversation of any
length needs bounded memory. A conversation is one sequence (its digest and its turn order
are), so it is read by one task.

Defined results: a null text or role is empty; an unknown role, or one out of turn, marks
the conversation invalid from there (``valid`` false, ``error_at`` its number) and is still
formatted, as is a conversation that ends in no accepting state; repeated and tied turns are
ordered by role, then text, and all kept; turns with a null number come first; rows with a
null conversation form one conversation; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks of a turn, in order: open, role, middle, text, close. ``follows`` maps a state
    (the last role; "" at the start) to the roles that may come next; ``final``: states a
    conversation may end in; ``loss``: roles whose texts are trained on."""

    open: str = "### "
    middle: str = ": "
    close: str = "</turn>\n"
    escape: str = "\\"
    follows: dict = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple = ("assistant",)
    loss: tuple = ("assistant",)

    @property
    def controls(self) -> tuple:
        """Strings that texts may not show unescaped."""
        return tuple(c for c in (self.open, self.close.rstrip("\n"), self.middle) if c)

    def protect(self, text: str) -> str:
        text = text.replace(self.escape, self.escape * 2)
        for c in self.controls:
            text = text.replace(c, self.escape + c)
        return text

    def restore(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + r"(.)", r"\1", text, flags=re.S)

    def parser(self) -> re.Pattern:
        """One formatted turn: groups role and text, still escaped."""
        e = re.escape(self.escape)
        plain = rf"((?:{e}.|[^{e}])*?)"
        return re.compile(rf"{re.escape(self.open)}{plain}{re.escape(self.middle)}{plain}{re.escape(self.close)}", re.S)


class Machine:
    """State of one conversation."""

    def __init__(self, template: Template):
        self.template, self.state, self.turns, self.error_at = template, "", 0, None

    def step(self, role: str) -> None:
        if self.error_at is None and role not in self.template.follows.get(self.state, ()):
            self.error_at = self.turns
        self.state = role
        self.turns += 1

    def accepted(self) -> bool:
        return self.error_at is None and self.state in self.template.final


SEGMENTS = "conv_id long, segment long, text string, loss boolean, valid boolean, error_at long"
OUT_ROWS = 2048


def segments(turns: DataFrame, template: Template = Template(), conv: str = "conv_id", turn: str = "turn",
             role: str = "role", text: str = "text") -> DataFrame:
    """Segments in order of (conv_id, segment). The conversation's last segment carries the
    verdict (``valid``, ``error_at``); in the others it is null."""
    def emit(batches):
        out, current, machine, number, last = [], object(), None, 0, None

        def flush():
            rows = list(zip(*out)) or [()] * 6
            out.clear()
            return pa.record_batch([pa.array(x, t) for x, t in zip(rows, (
                pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.int64()))],
                ["conv_id", "segment", "text", "loss", "valid", "error_at"])

        def close():
            if last is not None:
                out.append((*last, machine.accepted(), machine.error_at))

        for batch in batches:
            for c, r, x in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if machine is None or c != current:
                    close()
                    current, machine, number, last = c, Machine(template), 0, None
                if last is not None:
                    out.append((*last, None, None))
                machine.step(r)
                loss = r in template.loss
                out.append((c, number, template.open + template.protect(r) + template.middle, False, None, None))
                out.append((c, number + 1, template.protect(x), loss, None, None))
                last = (c, number + 2, template.close, False)
                number += 3
                if len(out) >= OUT_ROWS:
                    yield flush()
        if machine is not None:
            close()
        yield flush()

    rows = turns.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    return rows.mapInArrow(emit, SEGMENTS)


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, read from its segments (sorted by conversation and number,
    each conversation in one partition, as :func:`segments` gives them): n_turns,
    turns_sha256 (role, newline, text, newline of each turn), loss_chars and loss_sha256 of
    the text under the loss mask, formatted_chars, valid, error_at."""
    pattern = template.parser()

    def read(batches):
        current, any_row = None, False
        turn, masked = [], []
        state: dict = {}

        def fresh():
            return {"n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "size": 0, "valid": None, "error": None}

        def result():
            return {"conv_id": current, "n_turns": state["n"], "turns_sha256": state["turns"].hexdigest(),
                    "loss_chars": state["chars"], "loss_sha256": state["loss"].hexdigest(),
                    "formatted_chars": state["size"], "valid": state["valid"], "error_at": state["error"]}

        done = []
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "text", "loss", "valid", "error_at"))
            for c, x, loss, valid, error in zip(*columns):
                if not any_row or c != current:
                    if any_row:
                        done.append(result())
                    current, any_row, state = c, True, fresh()
                turn.append(x)
                state["size"] += len(x)
                if loss:
                    masked.append(x)
                # the text alone tells where a turn ends: at a close mark that is not escaped
                whole = pattern.fullmatch("".join(turn)) if x.endswith(template.close) else None
                if whole:
                    role, text = template.restore(whole[1]), template.restore(whole[2])
                    state["turns"].update(f"{role}\n{text}\n".encode())
                    state["n"] += 1
                    trained = template.restore("".join(masked))
                    state["chars"] += len(trained)
                    state["loss"].update(trained.encode())
                    turn.clear()
                    masked.clear()
                if valid is not None:
                    state["valid"], state["error"] = valid, error
            if len(done) >= OUT_ROWS:
                yield pa.RecordBatch.from_pylist(done, schema=OUT)
                done = []
        if any_row:
            done.append(result())
        yield pa.RecordBatch.from_pylist(done, schema=OUT)

    return formatted.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                "loss_sha256 string, formatted_chars long, valid boolean, error_at long")


OUT = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                 ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                 ("valid", pa.bool_()), ("error_at", pa.int64())])
