"""Chat formatting with typed content parts.

A message holds parts: text, image, audio or document. A visitor flattens them in order: text is escaped,
an attachment leaves a numbered placeholder, its reference and the number of tokens it
expands to. A turn becomes `### role: content </turn>` and a line feed.

Control strings inside texts get a backslash before them, as backslashes do, so that a text
cannot end its turn, open another or name an attachment, and reading back restores it, and with `restored` the parts, exactly. The loss mask covers the
content of the turns of one role.

Formatting works on single rows and moves none. Reading back sorts the rows of a conversation and takes
them one by one: a task's memory doesn't grow with a conversation's length, though a digest over
a conversation has to see it in order, in one task.

Content is a text, or with `typed` a JSON array of parts such as {"type": "image", "ref": "a.png", "width": 640, "height": 480}.

Defined results: a null field of a part counts as "" or 0; content that is no such array, or has an unknown type, an unknown field or a value of
the wrong kind, is one text, as it stands. Null text is an empty text, null role an empty role; rows of a null conv_id are one conversation; turns of equal
number go by role and text; a null turn goes first; repeated rows are turns each. An empty table gives an empty result. Other columns are dropped.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, fields
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded

#: What the template and the placeholders are made of.
CONTROLS = ("###", "</turn>", "<|")
LOSS_ROLE = "assistant"
PATCH = 14
AUDIO_TOKENS_A_SECOND = 25
DOCUMENT_TOKENS_A_PAGE = 512

_escape = re.compile("|".join(map(re.escape, ("\\", *CONTROLS))))
_unescape = re.compile(r"\\(\\|" + "|".join(map(re.escape, CONTROLS)) + ")")
#: The next escaped string, placeholder or end of a turn.
_next = re.compile(r"\\(?:\\|" + "|".join(map(re.escape, CONTROLS)) + r")| </turn>\n")
#: The next escaped string or placeholder.
_mark = re.compile(r"\\(?:\\|" + "|".join(map(re.escape, CONTROLS)) + r")|<\|(?:image|audio|document):(\d+)\|>")
_head = re.compile(r"### ([^:]*): ")


def escaped(text: str) -> str:
    return _escape.sub(lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return _unescape.sub(lambda m: m[1], text)


@dataclass(frozen=True)
class Text:
    text: str

    def accept(self, visitor: Visitor) -> None:
        visitor.text(self)


@dataclass(frozen=True)
class Image:
    ref: str
    width: int = 0
    height: int = 0

    def accept(self, visitor: Visitor) -> None:
        visitor.image(self)


@dataclass(frozen=True)
class Audio:
    ref: str
    seconds: float = 0.0

    def accept(self, visitor: Visitor) -> None:
        visitor.audio(self)


@dataclass(frozen=True)
class Document:
    ref: str
    pages: int = 0

    def accept(self, visitor: Visitor) -> None:
        visitor.document(self)


Part = Text | Image | Audio | Document
KINDS: dict[str, type] = {"text": Text, "image": Image, "audio": Audio, "document": Document}


def parts_of(content: str | None, typed: bool = False) -> list[Part]:
    """The parts of a content column's value; what is no array of parts with fields of the right kinds is one text part, whole."""
    if typed and (content or "").lstrip().startswith("["):
        try:
            return [_part(dict(x)) for x in json.loads(content)]
        except (ValueError, KeyError, TypeError, RecursionError):
            pass
    return [Text(content or "")]


def _part(given: dict) -> Part:
    """A part from its JSON object; null fields have their defaults. Raises where it is none."""
    kind = KINDS[given.pop("type")]
    values = {}
    for f in fields(kind):
        value = given.pop(f.name, None)
        if value is None:
            value = "" if f.type == "str" else 0
        right = isinstance(value, str) if f.type == "str" else not isinstance(value, bool) and isinstance(value, int if f.type == "int" else int | float) and 0 <= value < 1 << 40
        if not right:
            raise TypeError(f"{f.name}: {value!r}")
        values[f.name] = float(value) if f.type == "float" else value
    if given:
        raise KeyError(*given)
    return kind(**values)


@dataclass
class Visitor:
    """Flattens parts: out is the content, attachments are (kind, number, reference, tokens, the part as JSON)."""

    out: list[str] = field(default_factory=list)
    attachments: list[tuple[str, int, str, int, str]] = field(default_factory=list)

    def text(self, part: Text) -> None:
        self.out.append(escaped(part.text))

    def _attach(self, kind: str, part: Part, tokens: int) -> None:
        self.attachments.append((kind, len(self.attachments), part.ref, tokens, json.dumps({"type": kind, **asdict(part)})))
        self.out.append(f"<|{kind}:{len(self.attachments) - 1}|>")

    def image(self, part: Image) -> None:
        self._attach("image", part, math.ceil(part.width / PATCH) * math.ceil(part.height / PATCH))

    def audio(self, part: Audio) -> None:
        self._attach("audio", part, math.ceil(part.seconds * AUDIO_TOKENS_A_SECOND))

    def document(self, part: Document) -> None:
        self._attach("document", part, part.pages * DOCUMENT_TOKENS_A_PAGE)


def turn(role: str | None, parts: Sequence[Part], loss_role: str = LOSS_ROLE) -> tuple[str, int, int, list[tuple[str, int, str, int, str]]]:
    """The formatted turn, start and end of its loss mask (equal: none), and its attachments."""
    visitor = Visitor()
    for part in parts:
        part.accept(visitor)
    head, body = f"### {quote(role or '', safe='')}: ", "".join(visitor.out)
    end = len(head) + len(body) if role == loss_role else len(head)
    return f"{head}{body} </turn>\n", len(head), end, visitor.attachments


FORMATTED = "conv_id long, turn long, formatted string, loss_start long, loss_end long, attachments array<struct<kind:string,number:int,ref:string,tokens:long,part:string>>"


def formatted_turns(rows: DataFrame, *, typed: bool = False, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Rows (conv_id, turn, role, text) as formatted turns with their loss mask, in code points, and attachments."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("number", pa.int32()), ("ref", pa.string()), ("tokens", pa.int64()), ("part", pa.string())]))
        for batch in batches:
            made = [turn(r, parts_of(t, typed), loss_role) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            attached = [[dict(zip(("kind", "number", "ref", "tokens", "part"), a, strict=True)) for a in x[3]] for x in made]
            columns = [batch.column("conv_id"), batch.column("turn"), pa.array([x[0] for x in made], pa.string()), pa.array([x[1] for x in made], pa.int64()), pa.array([x[2] for x in made], pa.int64()), pa.array(attached, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "turn", "formatted", "loss_start", "loss_end", "attachments"])

    return bounded(rows).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").mapInArrow(go, FORMATTED)


def parsed(formatted: str) -> list[tuple[str, str]]:
    """Roles and unescaped contents of formatted turns; placeholders stay as they are (restored tells them from texts)."""
    return [(role, unescaped(body)) for role, body in _turns(formatted)]


def restored(body: str, attachments: Sequence[str]) -> list[Part]:
    """The parts of a turn's content as formatted: texts unescaped, and for each placeholder the part that the attachments have as JSON.

    A placeholder has no backslash before it, whereas what looks like one inside a text does. Neighbouring texts come back as one, empty texts not at all.
    """
    out: list[Part] = []
    at = start = 0
    while found := _mark.search(body, at):
        at = found.end()
        if found[1] is not None:
            out += [Text(unescaped(body[start : found.start()])), _part(json.loads(attachments[int(found[1])]))]
            start = at
    out.append(Text(unescaped(body[start:])))
    return [x for x in out if x != Text("")]


def _turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and contents of formatted turns, escaped."""
    out, at = [], 0
    while at < len(formatted):
        head = _head.match(formatted, at)
        if not head:
            raise ValueError(f"no turn starts at {at}")
        place = head.end()
        while (found := _next.search(formatted, place)) and found[0][0] == "\\":
            place = found.end()
        if not found:
            raise ValueError(f"the turn at {at} has no end")
        out.append((unquote(head[1]), formatted[head.end() : found.start()]))
        at = found.end()
    return out


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(turns: DataFrame) -> DataFrame:
    """For each conversation, what its formatted turns hold, in order."""
    ordered = turns.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "formatted")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        conv, state = nothing, None

        def said(done: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in READ.split(", ")])

        def end() -> tuple:
            n, turns, chars, loss, size = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), size

        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))
            for own, text, first, last in zip(*columns, strict=True):
                if own != conv or conv is nothing:
                    if conv is not nothing:
                        done.append(end())
                    conv, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, content in parsed(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{content}\n".encode())
                loss = unescaped(text[first:last])
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(text)
            yield said(done)
        if conv is not nothing:
            yield said([end()])

    return bounded(ordered).mapInArrow(go, READ)


def conversations(turns: DataFrame) -> DataFrame:
    """Whole conversations: conv_id, formatted, and loss mask as (start, end) in code points. For conversations that fit one row."""
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "formatted", "loss_start", "loss_end"))).alias("turns"))

    def add(acc, x):
        span = F.struct((acc["at"] + x["loss_start"]).alias("start"), (acc["at"] + x["loss_end"]).alias("end"))
        return F.struct((acc["at"] + F.length(x["formatted"])).alias("at"), F.when(x["loss_end"] > x["loss_start"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"))
    return rows.select("conv_id", F.array_join(F.transform("turns", lambda x: x["formatted"]), "").alias("formatted"), F.aggregate("turns", start, add, lambda acc: acc["spans"]).alias("loss"))
