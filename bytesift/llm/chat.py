"""Chat formatting with typed content parts.

A message is a list of parts.  A visitor flattens them in order: text is escaped,
an image, an audio clip or a document becomes a numbered placeholder, and what it
stands for is recorded with its place and with the tokens it will expand to.

A conversation is formatted as one segment per turn, in the order of turns:

    ### User: escaped content</turn>\\n

A backslash is put before every backslash, ``#`` and ``<`` of a text, so no text
can hold a mark or a placeholder, and taking one backslash off each escaped sign
gives the text back.  The loss mask covers the content of assistant turns.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = "</turn>\n"
# The marks of the template by role; any other role is written out.
MARKS = {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}

# Tokens that an attachment expands to.
IMAGE_PATCH = 28  # pixels of one token, each way
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 512
MOST_TOKENS = (1 << 63) - 1  # what a BIGINT holds

_SPECIAL = re.compile(r"([\\#<])")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _SPECIAL.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class Flattened:
    """Escaped content, its attachments in order, and the tokens they expand to."""

    content: str = ""
    attachments: list[dict] = field(default_factory=list)
    expanded_tokens: int = 0


def amount(value: object) -> float:
    """A size as a number: digits in a text count, anything else is 0, as is what is below 0."""
    try:
        number = float(value) if isinstance(value, (int, float, str)) else 0.0
    except (ValueError, OverflowError):
        return 0.0
    return number if 0 < number < 1e15 else 0.0


def written(value: object) -> str:
    """A text as it is, NULL as an empty one, anything else as JSON; half a surrogate pair becomes a question mark."""
    if value is None:
        return ""
    try:
        text = value if isinstance(value, str) else json.dumps(value)
    except RecursionError:  # nested deeper than JSON is written
        return ""
    return text if text.isascii() else text.encode("utf-8", "replace").decode()


class Visitor:
    """Flattens parts; a part is a dict with a ``type`` and what that type needs.

    A bare string is a text, NULL is nothing, and any other bare value is an
    attachment of unknown kind, so that one odd cell does not end the job.
    """

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.to_visit: list[object] = []  # the next part is the last
        self.length = 0
        self.out = Flattened()

    def visit(self, part: object) -> None:
        if part is None:
            return
        if isinstance(part, str):
            part = {"text": part}
        kind = "unknown"
        if isinstance(part, dict):
            kind = part.get("type") or "text"
        visitors = {
            "text": self.visit_text, "image": self.visit_image, "audio": self.visit_audio, "document": self.visit_document,
        }
        visit = visitors.get(kind, self.visit_unknown) if isinstance(kind, str) else self.visit_unknown
        visit(part)

    def visit_text(self, part: dict) -> None:
        self._add(escape(written(part.get("text"))))

    def visit_image(self, part: dict) -> None:
        wide, high = (math.ceil(amount(part.get(k)) / IMAGE_PATCH) for k in ("width", "height"))
        self._attach("image", part, wide * high)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil(amount(part.get("seconds")) * AUDIO_TOKENS_PER_SECOND))

    def visit_document(self, part: dict) -> None:
        """A document is a placeholder of its own, then its parts, if it has any."""
        self._attach("document", part, math.ceil(amount(part.get("pages"))) * DOCUMENT_TOKENS_PER_PAGE)
        self.then(part.get("parts"))

    def visit_unknown(self, part: object) -> None:
        self._attach("unknown", part if isinstance(part, dict) else {}, 0)

    def then(self, parts: object) -> None:
        """What comes next, before all that still waits: a list of parts, or one without its list."""
        self.to_visit.extend(reversed(parts) if isinstance(parts, list) else [parts])

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        ref = part.get("ref")
        ref = None if ref is None else written(ref)
        self.out.attachments.append(
            {"kind": kind, "ref": ref, "at": self.length, "tokens": min(tokens, MOST_TOKENS)}
        )
        self.out.expanded_tokens = min(self.out.expanded_tokens + tokens, MOST_TOKENS)
        self._add(f"<{kind}:{len(self.out.attachments) - 1}>")

    def done(self) -> Flattened:
        while self.to_visit:
            self.visit(self.to_visit.pop())
        self.out.content = "".join(self.pieces)
        return self.out


def flatten(parts: object) -> Flattened:
    """The parts of a message in order; a single part may stand without its list."""
    visitor = Visitor()
    visitor.then(parts)
    return visitor.done()


def read_parts(listed: str | None, text: str | None) -> object:
    """The typed parts of a row; without them its text, and what is no JSON is a text too."""
    if not listed:
        return text
    try:
        return json.loads(listed)
    except (ValueError, RecursionError):
        return listed


def mark(role: str | None) -> str:
    """The mark of a role; an unknown one is named in it, its colons escaped too."""
    named = escape(role or "").replace(":", "\\:")
    return MARKS.get(role or "", f"### ={named}: ")


def read_segment(segment: str) -> tuple[str, str, int, int]:
    """(role, content as escaped, where the content begins and ends) of a segment."""
    for role, text in MARKS.items():
        if segment.startswith(text):
            return role, segment[len(text) : -len(END)], len(text), len(segment) - len(END)
    role = re.match(r"### =((?:\\.|[^\\])*?): ", segment, re.DOTALL)
    return unescape(role[1]), segment[role.end() : -len(END)], role.end(), len(segment) - len(END)


SEGMENTS = (
    "conv_id {id}, turn {turn}, segment STRING, loss_start BIGINT, loss_end BIGINT,"
    " attachments ARRAY<STRUCT<kind: STRING, ref: STRING, at: BIGINT, tokens: BIGINT>>, expanded_tokens BIGINT"
)


def format_turns(turns: DataFrame, parts: str | None = None) -> DataFrame:
    """One formatted segment per row of ``turns(conv_id, turn, role, text)``.

    ``parts`` names a column with the typed parts as a JSON list; without it, or
    where it is NULL or empty, the text is the only part.  NULL texts and roles are empty;
    parts that are NULL give nothing, and what is no part (``Visitor``) never fails.
    ``loss_start`` and ``loss_end`` are code points of the segment, equal where
    nothing is learned.  Turns are formatted where they are: no shuffle.  A
    conversation is its segments ordered by (turn, role, text), see ``in_order``.
    """
    types = {f.name: f.dataType.simpleString() for f in turns.schema}
    content = F.col(parts) if parts else F.lit(None).cast("string")
    rows = turns.select("conv_id", "turn", "role", "text", content.alias("parts"))
    layout = SEGMENTS.format(id=types["conv_id"], turn=types["turn"])

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for role, text, listed in zip(*[batch[c].to_pylist() for c in ("role", "text", "parts")]):
                flat = flatten(read_parts(listed, text))
                head = mark(role)
                learned = len(flat.content) if role == "assistant" else 0
                values = (head + flat.content + END, len(head), len(head) + learned, flat.attachments, flat.expanded_tokens)
                for column, value in zip(out, values):
                    column.append(value)
            place = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())])
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(place), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], batch["turn"], *[pa.array(c, t) for c, t in zip(out, kinds)]],
                ["conv_id", "turn", "segment", "loss_start", "loss_end", "attachments", "expanded_tokens"],
            )

    return rows.mapInArrow(form, layout)


def in_order(segments: DataFrame) -> DataFrame:
    """Segments by conversation and turn; equal turns by their segments.

    One conversation has to be read in order and is so by one task, but it streams
    through it: no conversation is ever held whole.
    """
    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")


def digests(segments: DataFrame) -> DataFrame:
    """What can be read back from the formatted conversations: conv_id, n_turns,
    turns_sha256 (role, newline, text, newline per turn), loss_chars and
    loss_sha256 (the unescaped text under the loss mask) and formatted_chars."""
    id_type = segments.schema["conv_id"].dataType.simpleString()

    class Conversation:
        def __init__(self, conv_id):
            self.conv_id, self.turns, self.loss, self.formatted = conv_id, 0, 0, 0
            self.all, self.learned = hashlib.sha256(), hashlib.sha256()

        def add(self, segment: str, loss_start: int, loss_end: int) -> None:
            role, content, _, _ = read_segment(segment)
            self.all.update(f"{role}\n{unescape(content)}\n".encode())
            learned = unescape(segment[loss_start:loss_end])
            self.learned.update(learned.encode())
            self.turns += 1
            self.loss += len(learned)
            self.formatted += len(segment)

        def row(self) -> tuple:
            return self.conv_id, self.turns, self.all.hexdigest(), self.loss, self.learned.hexdigest(), self.formatted

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        held, schema = None, None
        for batch in batches:
            schema = pa.schema(
                [("conv_id", batch.schema.field("conv_id").type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                 ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
            )
            done = []
            for conv_id, *rest in zip(*[batch[c].to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end")]):
                if held is None or held.conv_id != conv_id:
                    if held is not None:
                        done.append(held.row())
                    held = Conversation(conv_id)
                held.add(*rest)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in done], schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, held.row()))], schema=schema)

    rows = in_order(segments.select("conv_id", "turn", "segment", "loss_start", "loss_end"))
    return rows.mapInArrow(
        read,
        f"conv_id {id_type}, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING,"
        " formatted_chars BIGINT",
    )
