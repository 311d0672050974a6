"""Exact substring dedup by fixed-block anchors.

A window is ``window`` consecutive words of one document.  Each word covered by a window that also
starts in a document with a smaller id is removed; windows are those of the input.

Documents are packed into slices, one row per slice with its documents as a compressed Arrow batch.
Blocks are the runs of ``window // 2`` words at multiples of that length, so every window holds a whole
block.  1. Blocks are indexed in shards by hash, and every rolling run of that length probes them: a slice
sends each shard its distinct run hashes and which of them are blocks, and gets back which
hit a block of another slice; hits between documents of one slice it finds itself.  2. Hits are extended
a word at a time on both sides: every whole window around a hit goes, by a 96-bit hash and the
least id that has it here, to the shards of windows, which answer with the least id of all.  3. Windows that
an earlier document has are joined to maximal repeats, whose words go.

``window`` is two words at least.  Ids are compared as longs, a null id as the largest of all; documents of one id do not remove each
other's words, nor does a document its own.  Words are ``[^\\x20\\x09-\\x0D]+`` and unchanged; a null or empty
text has none, and a text shorter than a window loses none.  Repeated rows are documents of one id.  A very long text is a
slice of its own, whose arrays grow with it.  An empty table gives no rows.  Only ``doc_id`` and ``text`` are
looked at, so other columns may have any name.

Skew: a run found in any number of documents is one entry per slice, so no group grows with the number
of its copies; slices are cut by bytes as rows come, so they do not depend on ids or texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirhouse.llm.common import ship, sliced, texts_of, write_once

WINDOW = 50
SLICE_BYTES = 8 << 20
SHARD_RUNS = 4_000_000
ROW_BYTES = 64  # what a row counts besides its text
PIECE_BYTES = 1 << 20
LARGEST = np.iinfo(np.int64).max

# Odd multipliers and a mixing step; hashes are sums over bytes or words modulo 2**64.
BYTE, RUN, CHECK = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """A hash of each ``values[start:end]``, the same wherever the range stands."""
    up, down = _powers(base, len(values)), _powers(_inverse(base), len(values))
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[:-1])))
    return _mix((run[ends] - run[starts]) * down[starts])


class Words:
    """The words of some texts: hashes, places in the joined text, and the text each belongs to."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join(texts)
        letters = np.frombuffer(self.data, np.uint8)
        edge = np.diff(np.concatenate(([0], _SOLID[letters].view(np.int8), [0])))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.hashes = np.empty(len(self.starts), np.uint64)
        cuts = np.searchsorted(self.starts, np.arange(0, len(letters) + PIECE_BYTES, PIECE_BYTES))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                low, high = self.starts[a], self.ends[b - 1]
                some = letters[low:high].astype(np.uint64) + np.uint64(1)
                self.hashes[a:b] = _ranges(some, self.starts[a:b] - low, self.ends[a:b] - low, BYTE)
        self.hashes += (self.ends - self.starts).astype(np.uint64)
        lengths = np.array([len(t) for t in texts], np.int64)
        self.doc = np.searchsorted(np.cumsum(lengths + 1), self.starts, side="right")
        self.n = np.bincount(self.doc, minlength=len(texts))
        self.first = np.cumsum(self.n) - self.n

    def runs(self, size: int) -> np.ndarray:
        """Where ``size`` words of one text start."""
        last = len(self.starts) - size + 1
        return np.flatnonzero(self.doc[: max(0, last)] == self.doc[size - 1 :]) if last > 0 else np.zeros(0, np.int64)

    def runs_of_marks(self, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, end) of the longest runs of marked words, counted within each text."""
        new, last = np.diff(self.doc, prepend=-1) != 0, np.diff(self.doc, append=-1) != 0
        starts = np.flatnonzero(marked & (new | ~np.concatenate(([False], marked[:-1]))))
        ends = np.flatnonzero(marked & (last | ~np.concatenate((marked[1:], [False]))))
        doc = self.doc[starts]
        return doc, starts - self.first[doc], ends + 1 - self.first[doc]

    def joined(self, kept: np.ndarray) -> pa.Array:
        """Each text's kept words with one space between."""
        at = np.flatnonzero(kept)
        letters = np.frombuffer(self.data, np.uint8).copy()
        inner = at[np.diff(self.doc[at], prepend=-1) == 0]  # the byte before such a word is no part of a word
        letters[self.starts[inner] - 1] = 32
        marks = np.zeros(len(letters) + 1, np.int8)
        np.add.at(marks, self.starts[at], 1)
        np.add.at(marks, self.starts[inner] - 1, 1)
        np.add.at(marks, self.starts[inner], -1)
        np.add.at(marks, self.ends[at], -1)
        out = letters[np.cumsum(marks[:-1], dtype=np.int8) > 0]
        size = np.bincount(self.doc[at], self.ends[at] - self.starts[at], len(self.n)) + np.bincount(self.doc[inner], minlength=len(self.n))
        offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(self.n), pa.py_buffer(offsets), pa.py_buffer(out)).cast(pa.string())

    def hash_runs(self, at: np.ndarray, size: int, base: np.uint64 = RUN) -> np.ndarray:
        return _ranges(self.hashes, at, at + size, base)


# -- slices of documents, and sorted hashes as bytes ------------------------------


def _pack(table: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_batch(table)
    return zstandard.ZstdCompressor(3).compress(sink.getvalue().to_pybytes())


def _unpack(data: bytes) -> tuple[list, np.ndarray, Words]:
    """Ids as they are, ids as longs to compare, and the words."""
    batch = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_next_batch()
    ids = batch.column("doc_id")
    return ids.to_pylist(), ids.fill_null(LARGEST).to_numpy(), Words(texts_of(batch, "text"))


def _slices(slice_bytes: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def row() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            columns = [pa.array([(part << 33) + n]), pa.array([size]), pa.array([_pack(whole)], pa.binary())]
            return pa.record_batch(columns, names=["slice", "bytes", "docs"])

        for batch in batches:
            for rows in sliced(batch, "text", slice_bytes):
                more = ROW_BYTES * rows.num_rows + (pc.sum(pc.binary_length(rows.column("text"))).as_py() or 0)
                if held and size + more > slice_bytes:
                    yield row()
                    n, held, size = n + 1, [], 0
                held.append(rows)
                size += more
        if held:
            yield row()

    return cut


def _squeeze(*arrays: np.ndarray) -> list[bytes]:
    return [zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(a).tobytes()) for a in arrays]


def _open(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _steps(rising: np.ndarray) -> np.ndarray:
    return np.diff(rising, prepend=rising.dtype.type(0))


def _by_shard(hashes: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of its hashes); ``hashes`` rise, so do those of a shard."""
    shard = (hashes % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cuts)):
        yield int(s), order[cuts[s] : cuts[s + 1]]


# -- anchors --------------------------------------------------------------------------


def _runs_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where runs start, which are blocks, the distinct hashes, and each run's number among those."""
    at = words.runs(size)
    block = (at - words.first[words.doc[at]]) % size == 0
    distinct, number = np.unique(words.hash_runs(at, size), return_inverse=True)
    return at, block, distinct, number


def _send_runs(size: int, shards: int):
    """A slice's distinct runs for each shard, with a bit for those that are blocks."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, _, words = _unpack(batch.column("docs")[i].as_py())
                _, block, distinct, number = _runs_of(words, size)
                is_block = np.zeros(len(distinct), bool)
                is_block[number[block]] = True
                out = [(s, *_squeeze(_steps(_short(distinct[at])), np.packbits(is_block[at])), len(at)) for s, at in _by_shard(distinct, shards)]
                if out:
                    s, runs, blocks, n = zip(*out, strict=True)
                    slices = pa.array([batch.column("slice")[i].as_py()] * len(s))
                    yield pa.record_batch([slices, pa.array(s), pa.array(n), pa.array(runs, pa.binary()), pa.array(blocks, pa.binary())], names=["slice", "shard", "n", "runs", "blocks"])

    return send


def _short(hashes: np.ndarray) -> np.ndarray:
    """The upper half of rising hashes: few runs that are alike in it and in the shard become hits too."""
    return (hashes >> np.uint64(32)).astype(np.uint32)


def _probe(rows: pd.DataFrame) -> pd.DataFrame:
    """Which runs of each slice hit a block of another one."""
    n = rows["n"].to_numpy()
    runs = [np.cumsum(_open(x, np.uint32), dtype=np.uint32) for x in rows["runs"]]
    blocks = [np.unpackbits(_open(x, np.uint8), count=k).astype(bool) for x, k in zip(rows["blocks"], n, strict=True)]
    # A slice's runs are distinct but for shared short hashes, so a block counts once per slice.
    index, times = np.unique(np.concatenate([np.unique(r[b]) for r, b in zip(runs, blocks, strict=True)]), return_counts=True)
    hits = []
    for r, b in zip(runs, blocks, strict=True):
        own = np.isin(r, r[b])
        at = np.minimum(np.searchsorted(index, r), max(0, len(index) - 1))
        found = (index[at] == r) & (times[at] > own) if len(index) else np.zeros(len(r), bool)
        hits.append(_squeeze(np.packbits(found))[0])
    return pd.DataFrame({"slice": rows["slice"], "shard": rows["shard"], "hits": hits})


# -- extension ------------------------------------------------------------------------


def _hits(words: Words, size: int, shards: int, replies: list) -> tuple[np.ndarray, np.ndarray]:
    """Where runs start that hit a block of another document."""
    at, block, distinct, number = _runs_of(words, size)
    elsewhere, answers = np.zeros(len(distinct), bool), {r["shard"]: r["hits"] for r in replies}
    for s, places in _by_shard(distinct, shards):
        elsewhere[places] = np.unpackbits(_open(answers[s], np.uint8), count=len(places)).astype(bool)
    doc = words.doc[at]
    least, most = np.full(len(distinct), LARGEST), np.full(len(distinct), -1)
    np.minimum.at(least, number[block], doc[block])
    np.maximum.at(most, number[block], doc[block])
    here = (most[number] >= 0) & ((least[number] != doc) | (most[number] != doc))
    return at, elsewhere[number] | here


def _windows(words: Words, window: int, run_at: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Where windows start that hold a hit."""
    at = words.runs(window)
    marks = np.zeros(len(words.starts) + 1, np.int64)
    marks[run_at[hit] + 1] = 1
    before = np.cumsum(marks)
    return at[before[at + window - window // 2 + 1] > before[at]]


def _send_windows(window: int, run_shards: int, shards: int):
    """A slice's distinct windows around hits for each shard, with the least and largest id that has each."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, ids, words = _unpack(batch.column("docs")[i].as_py())
                at = _windows(words, window, *_hits(words, window // 2, run_shards, batch.column("replies")[i].as_py() or []))
                distinct, one, number = np.unique(words.hash_runs(at, window), return_index=True, return_inverse=True)
                check = words.hash_runs(at[one], window, CHECK).astype(np.uint32)
                least, most = np.full(len(distinct), LARGEST), np.full(len(distinct), np.iinfo(np.int64).min)
                np.minimum.at(least, number, ids[words.doc[at]])
                np.maximum.at(most, number, ids[words.doc[at]])
                out = [(s, *_squeeze(_steps(distinct[p]), check[p], least[p], most[p] - least[p])) for s, p in _by_shard(distinct, shards)]
                if out:
                    slices = pa.array([batch.column("slice")[i].as_py()] * len(out))
                    s, *packed = zip(*out, strict=True)
                    yield pa.record_batch([slices, pa.array(s), *[pa.array(x, pa.binary()) for x in packed]], names=["slice", "shard", "windows", "checks", "least", "spread"])

    return send


def _earliest(rows: pd.DataFrame) -> pd.DataFrame:
    """For each slice its windows that some document of a smaller id has, with the least of those."""
    hashes = [np.cumsum(_open(x, np.uint64), dtype=np.uint64) for x in rows["windows"]]
    checks = [_open(x, np.uint32) for x in rows["checks"]]
    least = [_open(x, np.int64) for x in rows["least"]]
    spread = [_open(x, np.int64) for x in rows["spread"]]
    h, c = np.concatenate(hashes), np.concatenate(checks)
    order = np.lexsort((c, h))
    new = np.diff(h[order], prepend=~h[order[:1]]).astype(bool) | (np.diff(c[order], prepend=c[order[:1]]) != 0)
    number = np.empty(len(h), np.int64)
    number[order] = np.cumsum(new) - 1
    first = np.full(int(new.sum()), LARGEST)
    np.minimum.at(first, number, np.concatenate(least))
    out, cut = [], np.cumsum([0, *map(len, hashes)])
    for k, (h, low, wide) in enumerate(zip(hashes, least, spread, strict=True)):
        of = first[number[cut[k] : cut[k + 1]]]
        some = of < low + wide
        out.append(_squeeze(_steps(h[some]), of[some]))
    windows, firsts = zip(*out, strict=True)
    return pd.DataFrame({"slice": rows["slice"], "windows": windows, "first": firsts})


def _spans(words: Words, ids: np.ndarray, window: int, replies: list) -> np.ndarray:
    """A mark for each word that goes."""
    known = [(np.cumsum(_open(r["windows"], np.uint64), dtype=np.uint64), _open(r["first"], np.int64)) for r in replies]
    hashes, first = (np.concatenate(x) for x in zip(*known, strict=True)) if known else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = np.argsort(hashes)
    hashes, first = hashes[order], first[order]
    gone = np.zeros(len(words.starts) + 1, np.int64)
    if len(hashes):
        at = words.runs(window)
        mine = words.hash_runs(at, window)
        place = np.minimum(np.searchsorted(hashes, mine), len(hashes) - 1)
        later = at[(hashes[place] == mine) & (first[place] < ids[words.doc[at]])]
        np.add.at(gone, later, 1)
        np.add.at(gone, later + window, -1)
    return np.cumsum(gone)[:-1] > 0


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, compared, words = _unpack(batch.column("docs")[i].as_py())
                gone = _spans(words, compared, window, batch.column("replies")[i].as_py() or [])
                edges, starts, ends = words.runs_of_marks(gone)
                spans = pa.StructArray.from_arrays([pa.array(starts), pa.array(ends)], names=["start", "end"])
                offsets = np.concatenate(([0], np.cumsum(np.bincount(edges, minlength=len(ids)))))
                yield pa.record_batch(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(words.n.astype(np.int64)),
                        pa.array(np.bincount(words.doc[gone], minlength=len(ids)).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), spans),
                        words.joined(~gone),
                    ],
                    names=["doc_id", "n_words", "n_removed", "spans", "kept_text"],
                )

    return cut


def _answered(slices: DataFrame, replies: DataFrame, *columns: str) -> DataFrame:
    """Each slice with all that the shards answered it: one row of both sides."""
    per_slice = replies.groupBy("slice").agg(F.collect_list(F.struct(*columns)).alias("replies"))
    return slices.join(per_slice, "slice", "left").select("slice", "docs", "replies")


def remove_repeats(docs: DataFrame, window: int = WINDOW, slice_bytes: int = SLICE_BYTES, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_text): ``spans`` are the maximal repeats, in words from 0, that
    went; the words kept are joined by one space.  The sizes only set how much one row or task holds."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slices = write_once(texts.mapInArrow(_slices(slice_bytes), "slice long, bytes long, docs binary"), "slices")
    # No text has more words than half its bytes, rounded up.
    size, shards = window // 2, max(1, -(-int(slices.agg(F.sum("bytes")).first()[0] or 0) // (2 * shard_runs)))
    runs = slices.select("slice", "docs").mapInArrow(_send_runs(size, shards), "slice long, shard long, n long, runs binary, blocks binary")
    hits = write_once(runs.groupBy("shard").applyInPandas(_probe, "slice long, shard long, hits binary"), "hits")
    around = _answered(slices, hits, "shard", "hits").mapInArrow(
        _send_windows(window, shards, shards), "slice long, shard long, windows binary, checks binary, least binary, spread binary"
    )
    earliest = write_once(around.groupBy("shard").applyInPandas(_earliest, "slice long, windows binary, first binary"), "earliest")
    return _answered(slices, earliest, "windows", "first").mapInArrow(
        _cut(window), "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string"
    )
