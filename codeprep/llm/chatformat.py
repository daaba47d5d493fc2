"""Conversations as training text: turn order by a finite-state machine, loss flags by segment.

A template names the marks of a turn, the steps from role to role, the state in which a
conversation may end, and the roles that are learnt. Every turn gives segments, each with its
text and whether the loss counts there: opening mark with the role, the text, closing mark.
Control strings inside a text are escaped: a backslash is doubled and ``<|`` becomes ``<\\|``, so
no text can open or close a turn, and taking each backslash away restores it.

Turns are range-partitioned by conversation and place, so a conversation with a third of all
turns is spread over tasks. A task knows the state in which its first turn begins only for
whole conversations; it runs the machine from every state at once, and the maps from state to
state of a conversation's pieces, one row per piece, are then applied one after the other.

Reading back parses the written segments. Its digests run over a conversation in order, so one
task reads a conversation, as a sorted stream and without holding more than a turn.

Null texts and roles are empty. Roles that the template does not know are formatted, without
loss, and make the conversation invalid. Equal turns of a conversation stand in order of role and
text; null turns come last, repeated rows are turns of their own. A null conversation is one.
An empty table gives an empty result. Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeprep.staging import stage

# Characters of roles and texts by which turns are dealt to ranges.
PREFIX = 64


@dataclass(frozen=True)
class Template:
    """``steps`` maps state and role to the next state; other steps lead to the dead state."""

    opens: str = "<|im_start|>"
    after_role: str = "\n"
    closes: str = "<|im_end|>"
    after_turn: str = "\n"
    learnt: tuple[str, ...] = ("assistant",)
    states: tuple[str, ...] = ("start", "system", "user", "assistant", "dead")
    ends: tuple[str, ...] = ("assistant",)
    steps: dict = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )

    def moves(self, role: str) -> list[int]:
        """For every state the one after a turn of ``role``."""
        dead = self.states.index("dead")
        return [
            self.states.index(self.steps[state, role]) if (state, role) in self.steps else dead
            for state in self.states
        ]

    def segments(self, role: str, text: str) -> list[dict]:
        head = f"{self.opens}{escape(role, True)}{self.after_role}"
        return [
            {"text": head, "loss": False},
            {"text": escape(text), "loss": role in self.learnt},
            {"text": f"{self.closes}{self.after_turn}", "loss": False},
        ]

    def parse(self, turn: str) -> tuple[str, str]:
        """Role and text of one formatted turn."""
        pattern = (
            f"{re.escape(self.opens)}([^\n]*){re.escape(self.after_role)}(.*)"
            f"{re.escape(self.closes)}{re.escape(self.after_turn)}"
        )
        found = re.fullmatch(pattern, turn, re.DOTALL)
        if not found or self.opens in found[2] or self.closes in found[2]:
            raise ValueError("not one formatted turn")
        return unescape(found[1], True), unescape(found[2])


def escape(text: str, line: bool = False) -> str:
    text = text.replace("\\", "\\\\").replace("<|", "<\\|")
    return text.replace("\n", "\\n") if line else text


def unescape(text: str, line: bool = False) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if line and m[1] == "n" else m[1], text, flags=re.DOTALL)


_SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
_FORMATTED = (
    "conv_id bigint, part int, place bigint, segments array<struct<text:string,loss:boolean>>, "
    "moves array<int>"
)


def _format(template: Template):
    names = ["conv_id", "part", "place", "segments", "moves"]
    types = [pa.int64(), pa.int32(), pa.int64(), _SEGMENTS, pa.list_(pa.int32())]

    def out(rows):
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per turn, and after the turns of a piece one with its map."""
        part, known = TaskContext.get().partitionId(), {}
        current, moves, place = None, None, 0
        for batch in batches:
            rows = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if moves is None or conv_id != current:
                    if moves is not None:
                        rows.append((current, part, place, None, moves))
                    current, moves, place = conv_id, list(range(len(template.states))), 0
                role = role or ""
                if role not in known and len(known) < 1000:
                    known[role] = template.moves(role)
                step = known.get(role) or template.moves(role)
                moves = [step[state] for state in moves]
                rows.append((conv_id, part, place, template.segments(role, text or ""), None))
                place += 1
            yield out(rows)
        if moves is not None:
            yield out([(current, part, place, None, moves)])

    return run


def format_conversations(conversations: DataFrame, template: Template = Template()) -> tuple[DataFrame, DataFrame]:
    """``(turns, checked)``: formatted turns (conv_id, part, place, segments), in order of part
    and place, and per conversation whether its turns are valid (conv_id, valid).
    """
    order = [
        F.col("conv_id"),
        F.col("turn").asc_nulls_last(),
        F.col("role"),
        F.col("text"),
    ]
    # Borders are sampled to the driver, so they hold the beginnings of roles and texts only. A
    # role that is longer is larger than its beginning, hence the nulls last.
    whole_role = F.length(F.coalesce("role", F.lit(""))) <= PREFIX
    ranges = [
        *order[:2],
        F.substring("role", 1, PREFIX),
        F.when(whole_role, F.substring(F.coalesce("text", F.lit("")), 1, PREFIX)).asc_nulls_last(),
    ]
    written = stage(
        conversations.select(
            F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text"
        )
        .repartitionByRange(*ranges)
        .sortWithinPartitions(*order)
        .select("conv_id", "role", "text")
        .mapInArrow(_format(template), _FORMATTED),
        "formatted",
    )
    dead = len(template.states) - 1
    final = F.aggregate(
        F.sort_array(F.collect_list(F.struct("part", "moves"))),
        F.lit(template.states.index("start")),
        lambda state, piece: F.coalesce(F.get(piece["moves"], state), F.lit(dead)),
    )
    checked = (
        written.filter("moves IS NOT NULL")
        .groupBy("conv_id")
        .agg(final.isin([template.states.index(s) for s in template.ends]).alias("valid"))
    )
    return written.filter("segments IS NOT NULL").drop("moves"), checked


def read_back(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, from its formatted turns: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def result():
            return [current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]]

        for batch in batches:
            rows = []
            for conv_id, segments in zip(batch.column("conv_id").to_pylist(), batch.column("segments").to_pylist()):
                if state is None or conv_id != current:
                    if state is not None:
                        rows.append(result())
                    current, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                whole = "".join(s["text"] for s in segments)
                role, text = template.parse(whole)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                for segment in segments:
                    if segment["loss"]:
                        plain = unescape(segment["text"])
                        state[2] += len(plain)
                        state[3].update(plain.encode())
                state[4] += len(whole)
            yield table(rows)
        if state is not None:
            yield table([result()])

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def table(rows):
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types)], names=names
        )

    return (
        turns.repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "place")
        .select("conv_id", "segments")
        .mapInArrow(
            run,
            "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
            "loss_sha256 string, formatted_chars bigint",
        )
    )


def formatted_digests(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """What ``read_back`` gives, and whether the turns are valid."""
    turns, checked = format_conversations(conversations, template)
    digests = read_back(turns, template)
    named = checked.withColumnRenamed("conv_id", "_conv")
    return digests.join(named, digests["conv_id"].eqNullSafe(named["_conv"])).drop("_conv")
