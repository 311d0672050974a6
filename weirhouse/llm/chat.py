"""Chat formatting by columnar byte assembly.

A turn becomes ``<|role|>``, a line feed, the text, ``<|end|>`` and a line feed.  Control
strings of this and of other common templates cannot occur inside a role or text: a backslash
goes before every backslash and into every control string, and both are undone by dropping
one backslash before each character that has one.

For a batch of turns, segment lengths, their running sums and scatter indices are computed with
numpy, and headers, texts and footers are copied into one buffer made beforehand.  Turns
come sorted by conversation; a conversation that is longer than ``part_bytes`` (or spans batches)
is written as numbered parts cut between turns, so none has to fit in memory.

Null roles and texts are empty.  Turns are ordered by turn (nulls first), then role and text, so ties
and repeated rows have one order.  Null conversation ids form one conversation.  An empty
table gives no conversations.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirhouse.llm.common import ship, sliced

CONTROLS = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
HEAD, HEAD_END, FOOTER = b"<|", b"|>\n", b"<|end|>\n"
PART_BYTES = 4 << 20
PART_SCHEMA = "conv_id long, part long, n_turns long, formatted string, loss array<struct<start:long,stop:long>>"
DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)
ESCAPED = re.compile(rb"\\(.)", re.DOTALL)


def escape(texts: pa.Array) -> pa.Array:
    out = pc.replace_substring(texts, "\\", "\\\\")
    for c in CONTROLS:
        out = pc.replace_substring(out, c, c[0] + "\\" + c[1:])
    return out


def unescape(text: bytes) -> bytes:
    return ESCAPED.sub(rb"\1", text) if b"\\" in text else text


def _role(roles: pa.Array) -> pa.Array:
    """Escaped, and without a closing mark inside."""
    return pc.replace_substring(escape(roles), "|>", "|\\>")


def _same(value: bytes, n: int) -> pa.Array:
    return pa.array([value] * n, pa.binary())


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns one after the other as bytes; the bounds of turns, and of texts within."""
    pieces = [_same(HEAD, len(roles)), _role(roles).cast(pa.binary()), _same(HEAD_END, len(roles)), escape(texts).cast(pa.binary()), _same(FOOTER, len(roles))]
    lengths = np.stack([pc.binary_length(p).to_numpy(zero_copy_only=False).astype(np.int64) for p in pieces], axis=1)
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    starts = ends - lengths
    out = np.empty(int(ends[-1, -1]) if len(ends) else 0, np.uint8)
    for k, piece in enumerate(pieces):
        source = np.frombuffer(piece.buffers()[2] or b"", np.uint8)
        first = np.frombuffer(piece.buffers()[1], np.int32)[piece.offset]
        n = lengths[:, k]
        total = int(n.sum())
        within = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(starts[:, k], n) + within] = source[first : first + total]
    return out, np.concatenate(([0], ends[:, -1])), starts[:, 3], ends[:, 3]


def _format(part_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, part = (), 0
        for batch in batches:
            for rows in sliced(batch, "text", part_bytes):
                roles, texts = (rows.column(c).cast(pa.string()).fill_null("") for c in ("role", "text"))
                data, bounds, text_from, text_to = assemble(roles, texts)
                ids = rows.column("conv_id").to_pylist()
                assistant = pc.equal(roles, "assistant").to_numpy(zero_copy_only=False)
                cuts = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
                # Code points before each byte, so that the loss spans count characters.
                points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                out: dict[str, list] = {"conv_id": [], "part": [], "n_turns": [], "loss": []}
                for a, b in zip(cuts, cuts[1:], strict=False):
                    conv, part = ((ids[a],), part + 1) if conv == (ids[a],) else ((ids[a],), 0)
                    base = points[bounds[a]]
                    out["conv_id"].append(ids[a])
                    out["part"].append(part)
                    out["n_turns"].append(b - a)
                    out["loss"].append([{"start": int(points[text_from[i]] - base), "stop": int(points[text_to[i]] - base)} for i in range(a, b) if assistant[i]])
                offsets = pa.array(bounds[cuts].astype(np.int32)).buffers()[1]
                text = pa.StringArray.from_buffers(len(cuts) - 1, offsets, pa.py_buffer(data))
                yield pa.record_batch(
                    [pa.array(out["conv_id"], pa.int64()), pa.array(out["part"], pa.int64()), pa.array(out["n_turns"], pa.int64()), text, pa.array(out["loss"], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
                    names=["conv_id", "part", "n_turns", "formatted", "loss"],
                )

    return run


def format_chats(turns: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(conv_id, part, n_turns, formatted, loss): the parts of a conversation stand together, in
    order; ``loss`` holds the character spans of the assistant's texts."""
    ship(turns.sparkSession)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return dealt.mapInArrow(_format(part_bytes), PART_SCHEMA)


class _Reader:
    """Digests of one conversation, part by part."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def read(self, formatted: str, loss: list[dict]) -> None:
        self.chars += len(formatted)
        data, at = formatted.encode(), 0
        while at < len(data):
            # Neither mark can occur in an escaped role or text.
            role = data.index(HEAD_END, at)
            text = data.index(FOOTER, role + len(HEAD_END))
            self.turn_hash.update(unescape(data[at + len(HEAD) : role]) + b"\n" + unescape(data[role + len(HEAD_END) : text]) + b"\n")
            self.turns, at = self.turns + 1, text + len(FOOTER)
        for span in loss:
            text = unescape(formatted[span["start"] : span["stop"]].encode())
            self.loss_chars += len(text.decode())
            self.loss_hash.update(text)

    def row(self) -> dict:
        return {"conv_id": self.conv, "n_turns": self.turns, "turns_sha256": self.turn_hash.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss_hash.hexdigest(), "formatted_chars": self.chars}


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    now = None
    for batch in batches:
        done = []
        for row in range(batch.num_rows):
            conv, part, formatted, loss = (batch.column(c)[row].as_py() for c in ("conv_id", "part", "formatted", "loss"))
            if part == 0:
                if now:
                    done.append(now.row())
                now = _Reader(conv)
            now.read(formatted, loss)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=kinds)
    if now:
        yield pa.RecordBatch.from_pylist([now.row()], schema=kinds)


def read_back(parts: DataFrame) -> DataFrame:
    """Turns and loss texts, read from the formatted parts, as digests per conversation.

    ``parts`` comes straight from ``format_chats``, whose order of rows it needs."""
    return parts.mapInArrow(_digest, DIGEST_SCHEMA)
