"""Best-fit packing of token sequences by sums of squares.

A document's ids, with an end id, are cut into pieces of at most ``capacity`` ids only where
they are longer.  Pieces are placed longest first.  A piece goes where the squared
counts of open sequences per residual gap add up to least afterwards: into an open sequence,
or into a new one.  Full pieces are sequences of their own.

Placing needs lengths only, which are dealt by a hash of id, text and, where a row repeats in an
input partition, its number there, into blocks of about ``block_pieces`` pieces; each block is packed by one task, so the number of tasks grows with the input, and a
block ends with few open sequences.

Null and empty texts are the end id alone.  Rows are packed one by one, repeated or not, null
ids too.  An empty table gives no pieces.  Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirhouse.llm import tokens
from weirhouse.llm.common import ship, sliced, write_once

CAPACITY = 2048
END_ID = 0
BLOCK_PIECES = 60_000
BATCH_BYTES = 4 << 20
#: Between the keys of equal rows.
REPEAT = 0x9E3779B97F4A7C15
PIECE_SCHEMA = "doc_id long, row_key long, piece int, start long, length long, ids binary"


def _cut(path: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.encoder(path)
        seen: Counter[int] = Counter()
        for batch in batches:
            for part in sliced(batch, "text", BATCH_BYTES):
                ids = [x + end for x in coder.encode(part.column("text").fill_null("").to_pylist())]
                step = 4 * capacity
                pieces = [[x[a : a + step] for a in range(0, len(x), step)] for x in ids]
                counts = np.array([len(p) for p in pieces])
                row = np.repeat(np.arange(len(pieces)), counts)
                number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                flat = [x for p in pieces for x in p]
                keys = []
                for k in part.column("row_key").to_pylist():
                    keys.append(k + seen[k] * REPEAT)
                    seen[k] += 1
                keys = np.array([(k + (1 << 63)) % (1 << 64) - (1 << 63) for k in keys], np.int64)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id").take(pa.array(row)),
                        "row_key": pa.array(keys[row]),
                        "piece": pa.array(number.astype(np.int32)),
                        "start": pa.array(number * capacity),
                        "length": pa.array(np.array([len(x) // 4 for x in flat], np.int64)),
                        "ids": pa.array(flat, pa.binary()),
                    }
                )

    return cut


def token_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, row_key, piece, start, length, ids): ids as little-endian unsigned 32-bit."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("row_key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_cut(vocabulary or tokens.default_vocabulary(), capacity, end_id), PIECE_SCHEMA)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, in the given order."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    count = np.zeros(capacity + 1, np.int64)  # open bins per gap; gap 0 is closed and weighs nothing
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i, size in enumerate(lengths.tolist()):
        # From gap g to g - size: 2 (count[g - size] - count[g]) + 2 in squares; closing: 1 - 2 count[g].
        change = 2 * (count[: capacity + 1 - size] - count[size:]) + 2
        change[0] = 1 - 2 * count[size]
        change[count[size:] == 0] = np.iinfo(np.int64).max
        best = int(change.argmin())
        fresh = 2 * count[capacity - size] + 1 if size < capacity else 0
        if change[best] <= fresh:
            gap = best + size
            chosen = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, chosen, made = capacity, made, made + 1
        bins[i], offsets[i] = chosen, capacity - gap
        if gap > size:
            count[gap - size] += 1
            open_bins[gap - size].append(chosen)
    return bins, offsets


def _place(capacity: int, block_pieces: int):
    def place(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "row_key", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = sum_of_squares(block["length"].to_numpy(), capacity)
        # A block makes at most one sequence per piece; 2^32 leaves room for any block.
        return block.assign(sequence_id=block["block"] * (1 << 32) + bins, offset=offsets).drop(columns="block")

    return place


def place(pieces: DataFrame, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """``pieces`` (with ``row_key``, ``piece`` and ``length``) plus ``sequence_id`` and ``offset``.

    ``pieces`` should be a table: it is read twice."""
    ship(pieces.sparkSession)
    blocks = max(1, -(-pieces.count() // block_pieces))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("row_key", "piece", F.lit(7)), F.lit(blocks)))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields], "sequence_id long", "offset long"])
    return dealt.groupBy("block").applyInPandas(_place(capacity, block_pieces), schema)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Where each piece goes: (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    pieces = token_pieces(docs, vocabulary, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(write_once(pieces, "pieces"), capacity).drop("row_key")
