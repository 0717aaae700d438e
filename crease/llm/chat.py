"""Chat formatting with typed content parts and a reversible template.

A message's content is an ordered list of parts (text, image, audio, document).  A
visitor flattens it: text is escaped, every other part becomes a placeholder, and
its attachment reference and the number of tokens it expands into are recorded in
order.  The template marks turns as ``<|turn|>role<|body|>content<|end|>``.

Escaping: a backslash is doubled, and a backslash is put behind the first character
of every control string in a text or role.  So no control string can appear in
the output but those of the template, and reading back undoes it exactly.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Strings that mean something to this template or to common others.
CONTROL = (TURN, BODY, END, *PLACEHOLDERS.values(), "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
           "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_BREAK = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + r")(.)")
_UNDO = re.compile(r"\\(\\?)")
_OPEN = re.compile(re.escape(TURN) + "(.*?)" + re.escape(BODY) + "(.*?)" + re.escape(END), re.S)

PATCH, MERGE = 14, 2          # pixels of an image patch, patches merged along each side
AUDIO_RATE = 25               # tokens of a second of sound
PAGE_TOKENS = 1024            # tokens of a document's page

#: A content part: ``text`` for text; ``uri`` and its size for the others.
PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: str) -> str:
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    return _BREAK.sub(r"\1\\", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return _UNDO.sub(r"\1", text) if "\\" in text else text


class Flattener:
    """Visitor of content parts: what each becomes in the text, what it refers to
    and how many tokens its placeholder stands for."""

    def __init__(self):
        self.text: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown content part {kind!r}")
        method(part)

    def visit_text(self, part: dict) -> None:
        self.text.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        side = PATCH * MERGE
        self._attach(part, math.ceil((part.get("width") or 0) / side) * math.ceil((part.get("height") or 0) / side))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part.get("seconds") or 0.0) * AUDIO_RATE))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part.get("pages") or 0) * PAGE_TOKENS)

    def _attach(self, part: dict, tokens: int) -> None:
        self.text.append(PLACEHOLDERS[part["type"]])
        self.attachments.append({"type": part["type"], "uri": part.get("uri"), "tokens": max(1, tokens)})


_FORMATTED = StructType([
    StructField("segment", StringType()), StructField("loss_start", LongType()), StructField("loss_end", LongType()),
    StructField("attachments", ArrayType(StructType([StructField("type", StringType()), StructField("uri", StringType()),
                                                     StructField("tokens", LongType())]))),
    StructField("expanded_tokens", LongType())])
_ATTACHED = pa.list_(pa.struct([("type", pa.string()), ("uri", pa.string()), ("tokens", pa.int64())]))


def format_turns(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 parts_col: str = "parts", train_on: str = "assistant") -> DataFrame:
    """One row per message: ``conv_id, turn, role, segment, loss_start, loss_end,
    attachments, expanded_tokens``.

    ``segment`` is the message's piece of the conversation's text; the pieces joined
    in order are the formatted conversation, which as one string could outgrow a
    row.  ``loss_start`` and ``loss_end`` bound the part of the segment (code points)
    that is trained on: the content of ``train_on`` messages, else null.  Null
    content or null text: empty; null role: empty; an unknown part type raises.
    ``expanded_tokens`` adds up what the attachments' placeholders stand for.
    """
    schema = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()),
                         *_FORMATTED.fields])

    def run(batches):
        for b in batches:
            rows = []
            for role, parts in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                visitor = Flattener()
                for part in parts or ():
                    visitor.visit(part or {})
                head, body = f"{TURN}{escape(role or '')}{BODY}", "".join(visitor.text)
                span = (len(head), len(head) + len(body)) if role == train_on else (None, None)
                rows.append((head + body + END, *span, visitor.attachments, sum(a["tokens"] for a in visitor.attachments)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.string(), pa.int64(), pa.int64(), _ATTACHED, pa.int64()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                                             names=schema.names)

    return messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                           F.col(role_col).alias("role"), F.col(parts_col).cast(f"array<{PART}>").alias("parts")).mapInArrow(run, schema)


def text_parts(text_col: str = "text"):
    """A plain text column as a list of one text part."""
    none = {"uri": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("type"), F.col(text_col).alias("text"),
                            *[F.lit(None).cast(t).alias(c) for c, t in none.items()]))


def read_back(segment: str) -> list[tuple[str, str]]:
    """(role, content) of the turns of formatted text, unescaped; placeholders stay."""
    return [(unescape(r), unescape(c)) for r, c in _OPEN.findall(segment)]


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, lo: int | None, hi: int | None) -> None:
        self.chars += len(segment)
        for role, content in read_back(segment):
            self.turns += 1
            self.all.update(f"{role}\n{content}\n".encode("utf-8", "surrogatepass"))
        if lo is not None:
            text = unescape(segment[lo:hi])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation, read back from formatted turns: ``conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    Turns follow each other by ``turn`` (null first), ties by role, then segment.
    A conversation's digest is one chain over its text, so its rows pass one task;
    Spark sorts them (spilling to disk), and the task reads them as a stream with
    a hash state of a few bytes: nothing is gathered in memory, however long it is.
    """
    ordered = turns.select("conv_id", "turn", "role", "segment", "loss_start", "loss_end").repartition(
        "conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment")

    def run(batches):
        state, rows = None, []

        def batch():
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for b in batches:
            for conv, segment, lo, hi in zip(*[b.column(i).to_pylist() for i in (0, 3, 4, 5)], strict=True):
                if state is None or conv != state.conv_id:
                    if state is not None:
                        rows.append(state.row())
                    state = _Digest(conv)
                state.add(segment, lo, hi)
            if rows:
                yield batch()
                rows = []
        if state is not None:
            rows.append(state.row())
            yield batch()

    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                   "formatted_chars long")
