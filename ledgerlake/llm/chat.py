"""Chat formatting with a grammar round trip.

Each turn is rendered by its role's template, reparsed with the deterministic
parser, and compared with its source; while they differ, the control strings
inside the text are escaped by one more backslash. Escaping is reversible: it
lengthens the backslashes inside anything that looks like a control string,
escaped or not, by one, and parsing takes one away.

Rendering is row by row, before the shuffle. A conversation is then read in
turn order by a task that streams it: it holds a running digest, never the
conversation, however long that is.

Edge cases: a null text is empty, a null role is the empty role, rows of a
null conv_id form one conversation; equal turns go by role, then by rendered
text; repeated rows are turns of their own; an empty table gives no
conversation. Columns are selected by name, extra ones never clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare

# Head and tail of a turn by role; any other role is named in its head.
TEMPLATE = {"user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>"),
            "system": ("<<SYS>>\n", "\n<</SYS>>\n\n")}
OTHER_HEAD, OTHER_ROLE_END, OTHER_TAIL = "[ROLE]", "[/ROLE] ", " [/TURN]"
_CONTROL = r"/?s>|/?INST\]|<SYS>>|</SYS>>|/?ROLE\]|/TURN\]"
_ESCAPE = re.compile(rf"([<\[])(\\*)({_CONTROL})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_CONTROL})")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def parse_turn(s: str, at: int = 0) -> tuple[str, str, int, int, int]:
    """(role, text, where the raw text begins and ends, end of the turn) of the turn at ``at``."""
    for role, (head, tail) in TEMPLATE.items():
        if s.startswith(head, at):
            begin = at + len(head)
            break
    else:
        if not s.startswith(OTHER_HEAD, at):
            raise ValueError("no turn begins here")
        name_end = s.find(OTHER_ROLE_END, at)
        if name_end < 0:
            raise ValueError("a role's name does not end")
        role, tail = unescape(s[at + len(OTHER_HEAD):name_end]), OTHER_TAIL
        begin = name_end + len(OTHER_ROLE_END)
    end = s.find(tail, begin)
    if end < 0:
        raise ValueError("a turn does not end")
    return role, unescape(s[begin:end]), begin, end, end + len(tail)


def parse(s: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    out, at = [], 0
    while at < len(s):
        role, text, _, _, at = parse_turn(s, at)
        out.append((role, text))
    return out


def render_turn(role: str, text: str) -> str:
    """The turn's string, escaped as far as its reparse needs to give the source back."""
    def wrap(name: str, body: str) -> str:
        if role in TEMPLATE:
            head, tail = TEMPLATE[role]
            return head + body + tail
        return OTHER_HEAD + name + OTHER_ROLE_END + body + OTHER_TAIL

    for name, body in ((role, text), (role, escape(text)), (escape(role), escape(text))):
        s = wrap(name, body)
        try:
            got = parse_turn(s)
        except ValueError:
            continue
        if got[:2] == (role, text) and got[4] == len(s):
            return s
    raise ValueError("a turn cannot be escaped")


def render(rows: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, formatted: a row per turn, in conversation order per partition."""
    prepare(rows.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [render_turn(r, t) for r, t in zip(b.column("role").to_pylist(),
                                                     b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("turn"), b.column("role"),
                 pa.array(out, pa.string())], names=["conv_id", "turn", "role", "formatted"])

    turns = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, formatted string")
    return turns.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "turn", "role", "formatted")


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted turns alone: digests of what the parser recovers.

    Rows conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars; the loss mask
    covers the texts of assistant turns.
    """
    kind = dict(formatted.dtypes)["conv_id"]

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
             "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            done = []
            for conv, s in zip(b.column("conv_id").to_pylist(), b.column("formatted").to_pylist()):
                if state is None or conv != key:
                    if state is not None:
                        done.append(digests(key, state))
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                at = 0
                while at < len(s):
                    role, text, _, _, at = parse_turn(s, at)
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role == "assistant":
                        state[2] += len(text)
                        state[3].update(text.encode())
                state[4] += len(s)
            if done:
                yield pa.RecordBatch.from_arrays(columns(done, b.schema.field("conv_id").type),
                                                 names=names)
            kind_of = b.schema.field("conv_id").type
        if state is not None:
            yield pa.RecordBatch.from_arrays(columns([digests(key, state)], kind_of), names=names)

    def digests(key, state) -> tuple:
        return (key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

    def columns(rows: list[tuple], kind_of: pa.DataType) -> list[pa.Array]:
        kinds = [kind_of, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]

    return formatted.select("conv_id", "formatted").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long")
