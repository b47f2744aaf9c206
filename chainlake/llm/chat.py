"""Conversations with typed content parts, formatted for training and read back.

A message holds parts: text, images, audio, documents. A visitor flattens them into the text
of a turn, in which every attachment is a placeholder; what it stands for, where it stands
and how many tokens it will take are recorded beside the text, in the same order.

A turn is ``### <role>: <text></turn>`` and a line end. What would look like a part of the
template inside a role or a text is escaped, and so is the escape itself, so that parsing
gives back exactly what went in. Spans of the text of learnt roles form the loss mask.

Rows are put in order over all tasks by conversation and turn, so a conversation of any
length is spread over tasks, too. It comes out as blocks of whole turns, of about ``BLOCK``
characters; blocks of a conversation in order are its formatted text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, text_batches, together

PART = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<turn:int,at:int,kind:string,uri:string,tokens:int>"
BLOCKS = (
    "conv_id long, block long, text string, n_turns int, loss array<struct<start:int,stop:int>>, "
    f"attachments array<{ATTACHMENT}>, expanded_tokens long, whole boolean"
)
#: Characters of a block; a longer turn is one alone.
BLOCK = 1 << 20
#: Roles whose texts a model learns.
LEARNT = ("assistant",)
ATTACHED = ("image", "audio", "document")


@dataclass(frozen=True)
class Template:
    """Marks of a turn, and what escapes them inside roles and texts."""

    opens: str = "### "
    says: str = ": "
    closes: str = "</turn>\n"
    escape: str = "\\"
    controls: tuple[str, ...] = ("###", "</turn>", "<|")
    own: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        known = [re.escape(c) for c in sorted((self.escape, *self.controls), key=len, reverse=True)]
        colon, escape = re.escape(self.says[0]), re.escape(self.escape)
        heads = "".join(sorted({re.escape(c[0]) for c in (self.escape, *self.controls)}))
        text, role = "|".join(known), "|".join([*known, colon])
        holder = rf"<\|(?:{'|'.join(ATTACHED)})\|>"
        inner = lambda c, first: rf"(?:[^{first}]++|{escape}(?:{c})|(?!{c})[\s\S])"
        turn = (
            rf"{re.escape(self.opens)}({inner(role, heads + colon)}*+){re.escape(self.says)}"
            rf"((?:{inner(text, heads)}|{holder})*+){re.escape(self.closes)}"
        )
        self.own.update(
            text=re.compile(text), role=re.compile(role), turn=re.compile(turn), escaped=re.compile(rf"{escape}({role})"),
            holder=re.compile(rf"{escape}(?:{text})|<\|({'|'.join(ATTACHED)})\|>"),
        )

    def escaped(self, text: str, kind: str = "text") -> str:
        return self.own[kind].sub(lambda m: self.escape + m[0], text)

    def plain(self, text: str) -> str:
        return self.own["escaped"].sub(r"\1", text)

    def turns(self, text: str) -> Iterator[tuple[str, str, int]]:
        """Role, escaped text and where it starts, of every turn; anything else is an error."""
        at = 0
        while at < len(text):
            found = self.own["turn"].match(text, at)
            if found is None:
                raise ValueError(f"no turn of this template at {at}")
            yield self.plain(found[1]), found[2], found.start(2)
            at = found.end()

    def pieces(self, text: str) -> Iterator[tuple[str, str]]:
        """Kind and plain text of the parts of an escaped text."""
        at = 0
        for found in self.own["holder"].finditer(text):
            if found[1]:
                if found.start() > at:
                    yield "text", self.plain(text[at : found.start()])
                yield found[1], ""
                at = found.end()
        if at < len(text):
            yield "text", self.plain(text[at:])


@dataclass(frozen=True)
class Expansion:
    """Tokens that attachments take: by patches, by seconds, by pages; one at least."""

    patch: int = 28
    per_second: float = 25.0
    per_page: int = 1024


class Flattener:
    """Visits the parts of a message and lays them out as the text of a turn."""

    def __init__(self, template: Template, expansion: Expansion):
        self.template, self.expansion = template, expansion

    def flatten(self, parts: list[dict]) -> tuple[str, list[tuple[int, int]], list[dict]]:
        """The text, the spans of it that came from texts, and the attachments in order."""
        self.out, self.size, self.spans, self.attached = [], 0, [], []
        for part in parts:
            if part is not None:
                getattr(self, f"visit_{part['kind'] or 'text'}", self.visit_unknown)(part)
        return "".join(self.out), self.spans, self.attached

    def put(self, text: str) -> int:
        self.out.append(text)
        self.size += len(text)
        return self.size - len(text)

    def visit_text(self, part: dict) -> None:
        text = self.template.escaped(part["text"] or "")
        if text:
            self.spans.append((self.put(text), self.size))

    def attach(self, part: dict, tokens: float) -> None:
        at = self.put(f"<|{part['kind']}|>")
        self.attached.append({"at": at, "kind": part["kind"], "uri": part["uri"], "tokens": max(1, math.ceil(tokens))})

    def visit_image(self, part: dict) -> None:
        sides = (math.ceil((part[n] or 0) / self.expansion.patch) for n in ("width", "height"))
        self.attach(part, math.prod(sides))

    def visit_audio(self, part: dict) -> None:
        self.attach(part, (part["seconds"] or 0) * self.expansion.per_second)

    def visit_document(self, part: dict) -> None:
        self.attach(part, (part["pages"] or 0) * self.expansion.per_page)

    def visit_unknown(self, part: dict) -> None:
        raise ValueError(f"no part of kind {part['kind']!r} is known")


def text_part(text) -> F.Column:
    """Content of one text part; null is empty."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))).cast(
        "array<struct<kind:string,text:string>>"
    )


def whole_parts(messages: DataFrame) -> F.Column:
    """``content`` with all fields of a part; those it lacks are null."""
    has = messages.schema["content"].dataType.elementType.names
    fields = [f.split(":") for f in PART[len("struct<") : -1].split(",")]
    return F.transform("content", lambda p: F.struct(*((p[n] if n in has else F.lit(None)).cast(t).alias(n) for n, t in fields)))


def format_chat(
    messages: DataFrame,
    template: Template = Template(),
    learnt: tuple[str, ...] = LEARNT,
    expansion: Expansion = Expansion(),
    block: int = BLOCK,
) -> DataFrame:
    """Blocks of formatted conversations from ``conv_id, turn, role, content``.

    ``content`` is an array of structs with any of the fields of ``PART``. Turns are in
    the order of ``turn``, null first, then of role and content; repeated rows are turns of
    their own. A null role is an empty one, a null ``content`` or part holds nothing, a part
    without a kind is a text. Rows without a ``conv_id`` are one conversation. Other
    columns are not read. ``block`` is in order inside a conversation, ``whole`` says that it
    surely holds all of one. ``loss`` are spans of ``text`` in characters; neighbouring texts
    of a turn have one each. ``attachments`` tell the turn inside the block, the place of the
    placeholder in ``text`` and the tokens; ``expanded_tokens`` is their sum.
    """
    text_batches(messages.sparkSession)
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        whole_parts(messages).alias("content"),
    )
    ordered = rows.repartitionByRange("conv_id", "turn", "role").sortWithinPartitions("conv_id", "turn", "role", "content")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        flattener, number, current = Flattener(template, expansion), TaskContext.get().partitionId() << 33, None
        for batch in batches:
            for conv, role, parts in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "content"))):
                if current is None or conv != current.conv_id:
                    if current is not None:
                        yield current.row(number, ended=True)
                        number += 1
                    current = Block(conv, began=current is not None)
                elif current.size >= block:
                    yield current.row(number, ended=False)
                    number += 1
                    current = Block(conv, began=False)
                current.add(template, role, role in learnt, *flattener.flatten(parts or []))
        if current is not None:
            yield current.row(number, ended=False)

    return arrow_rows(ordered, lambda batches: together(run(batches), lambda row: len(row["text"])), BLOCKS)


class Block:
    """Turns of one conversation, put together."""

    def __init__(self, conv_id: int | None, began: bool):
        self.conv_id, self.began = conv_id, began
        self.out, self.size, self.turns, self.loss, self.attached = [], 0, 0, [], []

    def add(self, template: Template, role: str, learnt: bool, text: str, spans: list, attached: list) -> None:
        head = f"{template.opens}{template.escaped(role, 'role')}{template.says}"
        start = self.size + len(head)
        if learnt:
            self.loss.extend({"start": start + a, "stop": start + b} for a, b in spans)
        self.attached.extend({**x, "turn": self.turns, "at": start + x["at"]} for x in attached)
        self.out.append(f"{head}{text}{template.closes}")
        self.size += len(self.out[-1])
        self.turns += 1

    def row(self, number: int, ended: bool) -> dict:
        return {
            "conv_id": self.conv_id, "block": number, "text": "".join(self.out), "n_turns": self.turns, "loss": self.loss,
            "attachments": self.attached, "expanded_tokens": sum(x["tokens"] for x in self.attached), "whole": self.began and ended,
        }


def read_turns(blocks: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, block, turn, role, content`` of every turn of formatted blocks.

    ``turn`` counts inside the block; parts have ``kind, text, uri, tokens``.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for conv, block, text, attached in zip(*(batch[c].to_pylist() for c in ("conv_id", "block", "text", "attachments"))):
                left, rows = iter(attached), []
                for role, body, _ in template.turns(text):
                    parts = []
                    for kind, plain in template.pieces(body):
                        found = next(left) if kind != "text" else {"kind": kind, "uri": None, "tokens": None}
                        if found["kind"] != kind:
                            raise ValueError("placeholders and attachments don't belong together")
                        parts.append({"kind": kind, "text": plain if kind == "text" else None, "uri": found["uri"], "tokens": found["tokens"]})
                    rows.append((role, parts))
                roles, contents = zip(*rows)
                yield {"conv_id": [conv] * len(rows), "block": [block] * len(rows), "turn": range(len(rows)), "role": roles, "content": contents}

    part = "struct<kind:string,text:string,uri:string,tokens:int>"
    return arrow_rows(blocks, run, f"conv_id long, block long, turn int, role string, content array<{part}>")


def digests(blocks: DataFrame, template: Template = Template()) -> DataFrame:
    """What formatted conversations say, one row for each.

    ``turns_sha256`` is of role, line end, text and line end of every turn, ``loss_sha256`` of
    the plain text under the mask. A hash over a conversation has to read it in order, so
    blocks of one that several hold meet in a task; they stream through it one by one.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        current = None
        for batch in batches:
            for conv, text, loss in zip(*(batch[c].to_pylist() for c in ("conv_id", "text", "loss"))):
                if current is None or conv != current.conv_id:
                    if current is not None:
                        yield current.row()
                    current = Digest(conv)
                current.add(template, text, loss)
        if current is not None:
            yield current.row()

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    split = blocks.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    fn = lambda batches: together(run(batches))
    return arrow_rows(blocks.where("whole"), fn, schema).unionByName(arrow_rows(split, fn, schema))


class Digest:
    """Hashes and sizes of a conversation, block by block."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.chars, self.formatted = conv_id, 0, 0, 0
        self.said, self.masked = hashlib.sha256(), hashlib.sha256()

    def add(self, template: Template, text: str, loss: list[dict]) -> None:
        for role, body, _ in template.turns(text):
            said = "".join(plain for kind, plain in template.pieces(body) if kind == "text")
            self.said.update(f"{role}\n{said}\n".encode())
            self.turns += 1
        for span in loss:
            plain = template.plain(text[span["start"] : span["stop"]])
            self.masked.update(plain.encode())
            self.chars += len(plain)
        self.formatted += len(text)

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.said.hexdigest(), "loss_chars": self.chars,
            "loss_sha256": self.masked.hexdigest(), "formatted_chars": self.formatted,
        }
