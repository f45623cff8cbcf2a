"""Chat formatting of turns made of typed parts.

A turn is a row; its content is a text or a list of parts: text, image, audio, document. A visitor flattens the parts
into one string, in order, with a placeholder for each part that is no text, and records what is attached there and how
many tokens it expands to. The template marks turns with control strings made of TRIGGERS only at their start; in
texts and roles every trigger is escaped, so no text can open or close a turn, and reading the output back gives the
texts again.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, HEAD_END, CLOSE = "### ", ":\n", "</turn>\n"
#: What starts a control string or an escape, or ends a head.
TRIGGERS = re.compile(r"[\\#<:]")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
#: Placeholders of parts that are no text; parts of a kind that is none of these are unknown.
KINDS = ("image", "audio", "document", "unknown")
PLACEHOLDER = re.compile(f"<({'|'.join(KINDS)})>")
SEGMENT = re.compile(rf"### ((?:\\.|[^\\:])*):\n((?:\\.|<(?:{'|'.join(KINDS)})>|[^\\<])*)</turn>\n", re.DOTALL)
#: The role whose texts the loss is taken over.
LEARNED = "assistant"
#: Pixels on a side of the patch that one image token stands for, audio tokens a second, tokens a document page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 512
#: No part expands to more tokens.
MOST_TOKENS = 2**53

PART = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
ATTACHED = pa.list_(
    pa.struct([("kind", pa.string()), ("uri", pa.string()), ("offset", pa.int64()), ("tokens", pa.int64())])
)
SEGMENTS = pa.schema(
    [("segment", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("attachments", ATTACHED)]
)


def escape(text: str) -> str:
    return TRIGGERS.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def amount(value: float | None) -> float:
    """A size as it is, nothing for what is none: null, negative, not a number, without end."""
    return value if value is not None and math.isfinite(value) and value > 0 else 0


@dataclass
class Flattener:
    """Visits the parts of a turn in order."""

    out: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    length: int = 0

    def visit(self, part: dict | None) -> None:
        """Flatten one part; a null part is none, one of a null or another kind is unknown and has no tokens."""
        if part is not None:
            method = getattr(self, f"visit_{part['kind']}", None) if part["kind"] in ("text", *KINDS) else None
            (method or self.visit_unknown)(part)

    def _add(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def _attach(self, part: dict, kind: str, tokens: int) -> None:
        self.attachments.append({"kind": kind, "uri": part.get("uri"), "offset": self.length, "tokens": tokens})
        self._add(f"<{kind}>")

    def visit_text(self, part: dict) -> None:
        self._add(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil(amount(part.get(side)) / PATCH) for side in ("width", "height"))
        self._attach(part, "image", across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach(part, "audio", min(math.ceil(amount(part.get("seconds")) * AUDIO_RATE), MOST_TOKENS))

    def visit_document(self, part: dict) -> None:
        self._attach(part, "document", int(amount(part.get("pages"))) * PAGE_TOKENS)

    def visit_unknown(self, part: dict) -> None:
        self._attach(part, "unknown", 0)


def segment(role: str | None, text: str | None, parts: list[dict] | None = None) -> tuple:
    """(segment, loss_start, loss_end, attachments) of a turn; the loss is taken over its code points from start to end."""
    flat = Flattener(length=len(OPEN) + len(escape(role or "")) + len(HEAD_END))
    start = flat.length
    for part in [{"kind": "text", "text": text}] if parts is None else parts:
        flat.visit(part)
    end = flat.length if role == LEARNED else start
    return f"{OPEN}{escape(role or '')}{HEAD_END}{''.join(flat.out)}{CLOSE}", start, end, flat.attachments


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        parts = columns.get("parts") or [None] * batch.num_rows
        rows = [segment(*row) for row in zip(columns["role"], columns["text"], parts, strict=True)]
        if rows:
            made = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SEGMENTS, strict=True)]
            names = ["conv_id", "turn", *SEGMENTS.names]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=names)


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, segment, loss_start, loss_end, attachments) of each row of `turns` (conv_id, turn, role, text).

    A column `parts`, a list of PART, replaces the text where it is not null. A conversation's text is its segments in
    the order of turn (nulls first), then segment. Null texts and roles are empty, null parts left out; a part of a null or
    other kind is an `<unknown>` placeholder, and sizes that are null, negative or not finite are zero. Repeated rows are turns of their
    own. Rows need no other row, so no conversation is too long. No rows give no rows.
    """
    kinds = {n: turns.schema[n].dataType.simpleString() for n in ("conv_id", "turn")}
    names = ["conv_id", "turn", "role", "text"]
    if "parts" in turns.columns and turns.schema["parts"].dataType.simpleString().startswith("array<struct"):
        names.append("parts")
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, segment string, loss_start bigint, loss_end bigint, "
    schema += "attachments array<struct<kind:string,uri:string,offset:bigint,tokens:bigint>>"
    return turns.select(*names).mapInArrow(_format, schema)


def read_segment(text: str, loss_start: int, loss_end: int) -> tuple[str, str, str]:
    """(role, text, text under the loss) of one segment; placeholders are no part of a text."""
    found = SEGMENT.fullmatch(text)
    if not found:
        raise ValueError(f"not a turn: {text[:80]!r}")
    return tuple(unescape(PLACEHOLDER.sub(_unless_escaped, t)) for t in (found[1], found[2], text[loss_start:loss_end]))


def _unless_escaped(match: re.Match) -> str:
    # an escaped "<" stands behind an odd number of backslashes
    before = match.string[: match.start()]
    return match[0] if (len(before) - len(before.rstrip("\\"))) % 2 else ""


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its segments, which come one after the other; only its hashes are held."""
    state: list | None = None

    def done() -> pa.RecordBatch:
        conv, n, turns, loss_chars, loss, chars = state
        arrays = [
            pa.array([conv], pa.int64()),
            pa.array([n], pa.int64()),
            pa.array([turns.hexdigest()]),
            pa.array([loss_chars], pa.int64()),
            pa.array([loss.hexdigest()]),
            pa.array([chars], pa.int64()),
        ]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for batch in batches:
        for conv, text, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if state is None or state[0] != conv:
                if state is not None:
                    yield done()
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, content, learned = read_segment(text, start, end)
            state[1] += 1
            state[2].update(f"{role}\n{content}\n".encode())
            state[3] += len(learned)
            state[4].update(learned.encode())
            state[5] += len(text)
    if state is not None:
        yield done()


def digests(segments: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read back from formatted() rows.

    A conversation's hashes need its turns in order, so they stream, sorted, through one task, which holds one row at a
    time; null is a conversation of its own.
    """
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return (
        segments.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "segment")
        .select(F.col("conv_id").cast("bigint").alias("conv_id"), "segment", "loss_start", "loss_end")
        .mapInArrow(_read, schema)
    )
