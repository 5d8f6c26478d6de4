"""Chat formatting: turns of typed content parts become marked-up text with a loss mask, and can be read back.

A visitor flattens the parts of a turn in their order: text as it is but for control strings, every other part as one
placeholder, with an attachment reference and the number of tokens the placeholder stands for. Turns are formatted where
they lie. Then they are ordered by conversation, and one pass gives every turn its place there; neither pass holds more
than a batch of turns, however long a conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

#: The template: a turn is START role newline content END newline.
START, END = "<|im_start|>", "<|im_end|>"
#: What stands for a part that isn't text, by its type.
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>", "other": "<|attachment|>"}
#: Roles whose content is learnt.
LEARNT = ("assistant",)

#: Tokens of an image: one for each square of PATCH pixels (a side counts from one square up); of audio: a second; of a document: a page.
PATCH, SECOND_TOKENS, PAGE_TOKENS = 28, 25, 256

PARTS = "array<struct<type:string,text:string,ref:string,width:long,height:long,seconds:double,pages:long>>"
ATTACHMENTS = "array<struct<nth:int,type:string,ref:string,at:long,tokens:long>>"
PIECES = f"conv_id long, position long, turn long, formatted string, start long, loss_start long, loss_length long, attachments {ATTACHMENTS}"


def escape(text: str) -> str:
    """No control string is left: every ``<|``, and every such sign that is escaped already, gets one more backslash."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """As text, and on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


class Flattener:
    """Visits the parts of one turn: ``content`` is the text with placeholders, ``attachments`` say what these stand for."""

    def __init__(self):
        self.pieces: list[str] = []
        self.length = 0
        self.attachments: list[dict] = []

    @property
    def content(self) -> str:
        return "".join(self.pieces)

    def visit(self, part: dict) -> None:
        """Parts of an unknown type are text if they have one, else attachments without tokens."""
        kind = (part.get("type") or "").lower()
        if kind in ("text", "image", "audio", "document"):
            getattr(self, kind)(part)
        elif part.get("text") is not None:
            self.text(part)
        else:
            self.attach("other", part, 0)

    def add(self, content: str) -> None:
        self.pieces.append(content)
        self.length += len(content)

    def text(self, part: dict) -> None:
        # A sign that begins in one part and ends in the next would be a control string of the whole.
        if self.pieces and self.pieces[-1] not in PLACEHOLDERS.values():
            before = self.pieces.pop()
            self.length -= len(before)
            self.add(escape(unescape(before) + (part.get("text") or "")))
        else:
            self.add(escape(part.get("text") or ""))

    def image(self, part: dict) -> None:
        squares = [max(1, -(-max(0, part.get(side) or 0) // PATCH)) for side in ("width", "height")]
        self.attach("image", part, squares[0] * squares[1])

    def audio(self, part: dict) -> None:
        seconds = part.get("seconds")
        self.attach("audio", part, max(1, int(-(-seconds * SECOND_TOKENS // 1))) if seconds and 0 < seconds < float("inf") else 1)

    def document(self, part: dict) -> None:
        self.attach("document", part, max(1, part.get("pages") or 0) * PAGE_TOKENS)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"nth": len(self.attachments), "type": kind, "ref": part.get("ref"), "at": self.length, "tokens": tokens})
        self.add(PLACEHOLDERS[kind])


def flattened(text: str | None, parts: list | None) -> Flattener:
    visitor = Flattener()
    for part in [{"type": "text", "text": text}] if parts is None else parts:
        if part is not None:
            visitor.visit(part)
    return visitor


def format_turns(chats: DataFrame, learnt: tuple[str, ...] = LEARNT) -> DataFrame:
    """conv_id, position, turn, formatted, start, loss_start, loss_length, attachments: a row for each turn.

    A conversation's output is its rows' ``formatted``, put together by ``position``; ``start`` is a row's place in it and
    ``loss_start`` and ``loss_length`` its part of the loss mask, in characters (length null: the turn isn't learnt).
    ``at`` of an attachment is its placeholder's place in the output too. Content is the column ``parts`` (an array of
    structs with type, text, ref, width, height, seconds, pages, as far as there are any) or, where that is missing or
    null, ``text``. Null texts and roles are empty; null parts count for nothing. Turns go by turn (null first), role,
    text and parts, so ties and repeated rows have one order; rows without conv_id are one conversation. An empty table
    gives no rows; other columns play no part.
    """
    field = chats.schema["parts"].dataType if "parts" in chats.columns else None
    if isinstance(field, ArrayType) and isinstance(field.elementType, StructType):
        given = {f.name for f in field.elementType.fields}
        shape = [part.split(":") for part in PARTS[len("array<struct<") : -2].split(",")]
        made = ", ".join(f"'{name}', " + (f"CAST(p.`{name}` AS {kind})" if name in given else f"CAST(NULL AS {kind})") for name, kind in shape)
        parts = F.expr(f"transform(parts, p -> CASE WHEN p IS NOT NULL THEN named_struct({made}) END)")
    else:
        parts = F.lit(None).cast(PARTS)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    turns = chats.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role"), text("text"), parts.alias("parts"))

    turned = f"conv_id long, turn long, role string, tie string, formatted string, length long, loss_start long, loss_length long, attachments {ATTACHMENTS}"
    schema = to_arrow_schema(StructType.fromDDL(turned))

    def each(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in schema.names}
            out["conv_id"], out["turn"], out["role"] = batch.column("conv_id"), batch.column("turn"), batch.column("role")
            for role, text, parts in zip(*[batch.column(c).to_pylist() for c in ("role", "text", "parts")]):
                visitor = flattened(text, parts)
                head = f"{START}{escape_role(role)}\n"
                formatted = f"{head}{visitor.content}{END}\n"
                for a in visitor.attachments:
                    a["at"] += len(head)
                out["formatted"].append(formatted)
                out["length"].append(len(formatted))
                out["loss_start"].append(len(head))
                out["loss_length"].append(visitor.length if role in learnt else None)
                out["attachments"].append(visitor.attachments)
                # Turns of one number go by what was formatted; equal texts then differ in their attachments only.
                out["tie"].append(hashlib.sha256(repr([(a["ref"], a["tokens"]) for a in visitor.attachments]).encode()).hexdigest() if visitor.attachments else None)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    formatted = turns.mapInArrow(each, turned)
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted", "tie")
    pieces = to_arrow_schema(StructType.fromDDL(PIECES))

    def place(batches) -> Iterator[pa.RecordBatch]:
        conversation, position, start = object(), 0, 0
        for batch in batches:
            ids, lengths, losses, attached = (batch.column(c).to_pylist() for c in ("conv_id", "length", "loss_start", "attachments"))
            out = {"position": [], "start": [], "loss_start": [], "attachments": []}
            for id_, length, loss, attachments in zip(ids, lengths, losses, attached):
                if id_ != conversation:
                    conversation, position, start = id_, 0, 0
                out["position"].append(position)
                out["start"].append(start)
                out["loss_start"].append(start + loss)
                out["attachments"].append([a | {"at": start + a["at"]} for a in attachments])
                position, start = position + 1, start + length
            same = {c: batch.column(c) for c in ("conv_id", "turn", "formatted", "loss_length")}
            yield pa.RecordBatch.from_pydict({name: (same | out)[name] for name in pieces.names}, schema=pieces)

    return ordered.mapInArrow(place, PIECES)


class Reader:
    """Reads one conversation's output, piece by piece: the state is that of the hashes and the piece at hand."""

    #: A whole turn. Content and role hold neither mark, as these are escaped there.
    TURN = re.compile(f"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", re.DOTALL)
    MARKS = re.compile("|".join(map(re.escape, PLACEHOLDERS.values())))

    def __init__(self):
        self.open, self.at = "", 0
        self.turns, self.characters, self.loss_characters = 0, 0, 0
        self.hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def piece(self, formatted: str, loss_start: int, loss_length: int | None, start: int) -> None:
        """``start`` is the place of the piece; the mask may only cover what was read by then."""
        assert start == self.characters, "pieces out of order"
        self.characters += len(formatted)
        if loss_length is not None:
            learnt = unescape(self.MARKS.sub("", formatted[loss_start - start : loss_start - start + loss_length]))
            self.loss_characters += len(learnt)
            self.loss_hash.update(learnt.encode())
        self.open += formatted
        end = 0
        for turn in self.TURN.finditer(self.open):
            assert turn.start() == end, "text between turns"
            end = turn.end()
            self.turns += 1
            self.hash.update(f"{unescape_role(turn[1])}\n{unescape(self.MARKS.sub('', turn[2]))}\n".encode())
        self.open = self.open[end:]

    def digest(self) -> tuple:
        assert not self.open, "an open turn"
        return self.turns, self.hash.hexdigest(), self.loss_characters, self.loss_hash.hexdigest(), self.characters


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(pieces: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the pieces that ``format_turns`` makes.

    Turns are role, newline, text (its text parts), newline; the loss is all text under the mask, unescaped. A digest goes
    through its conversation in order, so one conversation is one task's stream.
    """
    names = [c.split()[0] for c in DIGEST.split(", ")]
    schema = to_arrow_schema(StructType.fromDDL(DIGEST))
    ordered = pieces.select("conv_id", "position", "formatted", "start", "loss_start", "loss_length").repartition("conv_id").sortWithinPartitions("conv_id", "position")

    def read(batches) -> Iterator[pa.RecordBatch]:
        conversation, reader, rows = None, None, []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_length", "start")]):
                if reader is None or row[0] != conversation:
                    if reader is not None:
                        rows.append((conversation, *reader.digest()))
                    conversation, reader = row[0], Reader()
                reader.piece(*row[1:])
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))), schema=schema)
                rows = []
        if reader is not None:
            yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, (conversation, *reader.digest()))}, schema=schema)

    return ordered.mapInArrow(read, DIGEST)
