"""Language-model scoring by context-tree weighting over bytes.

Tokens are a text's words (A-Z lower-cased), each spelled by its bytes and a space, then one end,
spelled as a line feed.  A byte is predicted bit by bit from the six bytes before it in the running
text, whatever words they belong to; before a text's first byte there are spaces.  For each context and each beginning of a byte there is a
node with counts of 0 and 1.  Its Krichevsky-Trofimov block probability Pe and the product of its
children's Pw, one byte deeper, give Pw = (Pe + product) / 2; a bit's probability mixes the estimates
of all depths with the posterior weights that follow.  Where a context was never seen, the
deepest seen one answers.

A byte's probability rests on its gram (six context bytes and the byte) alone, so counts come from distinct
grams, and a document's score is a sum over the grams of its bytes.  Nothing is broadcast that grows
with the data:

* documents become slices: their running text, and their ids;
* a slice hands its distinct grams and words, with their counts in it, to buckets: grams by a hash of the last
  two context bytes, words by a hash of the word; what it hands to one bucket is one row of packed lists;
* a bucket sums up its slices' counts and keeps what each of them asked for; its grams make whole subtrees,
  and the nodes above (at most 256 x 255 + 255) meet on the driver;
* a bucket's answers go back to each slice as one row of packed lists, and the slice sums up its documents.

Null, empty and word-less texts are the end alone.  Null ids are held out.  Each row is scored by itself
and counted, repeated or not.  Without documents to learn from, all counts are 0 and each
bit costs one bit.  An empty table gives no rows.  Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from copy import copy

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirhouse.llm.common import ship, sliced, texts_of, write_once

DEPTH = 6
SPLIT = 2  # the tree is cut in groups at this depth
END = b"\n"
PAD = b" " * DEPTH
MARK = bytes((DEPTH,))
FOLDS = 10
SMOOTH = 0.1
SLICE_BYTES = 24 << 20
BLOCK_BYTES = 2 << 20
BLOCK_TEXTS = 256  # as many as a byte beside a gram tells apart
BUCKETS = 256
MERGE_ROWS = 4 << 20
TOGETHER = 1 << 18
SLICE_SCHEMA = "slice long, doc_ids array<long>, held array<boolean>, run_size long, run binary"
ASKED_SCHEMA = "bucket int, slice long, grams binary, counts binary, words binary, word_counts binary"
BUCKET_SCHEMA = (
    "grams binary, counts binary, word_total long, word_distinct long,"
    " slices array<long>, asked array<binary>, words array<binary>, word_counts array<binary>"
)
ANSWER_SCHEMA = "slice long, grams binary, lps binary, words binary, word_counts binary"


def _next_id(n: int) -> int:
    return (TaskContext.get().partitionId() << 32) + n


def pack(x: np.ndarray) -> bytes:
    """Numbers of up to 8 bytes as their count, then by byte, all lowest bytes first, so that small numbers compress."""
    planes = x.astype("<i8", copy=False).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], 8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).view("<i8").ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    return pack(np.diff(x, prepend=0))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


def pack_words(words: list[bytes]) -> bytes:
    """No word has a space in it."""
    data = b" ".join(words)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack_words(data: bytes) -> list[bytes]:
    whole = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return whole.split(b" ") if whole else []


def run_of(text: bytes) -> bytes:
    """The running text: words, each with a space after it, and the end."""
    return b"".join([w + b" " for w in text.lower().split()]) + END  # on bytes, only A-Z are lowered


def windows(run: bytes) -> np.ndarray:
    """The gram of each byte of running texts: the six bytes before it, spaces before a text's first, and the byte."""
    padded = PAD + run.replace(END, END + PAD)
    n = len(padded) - 2 * DEPTH
    grams = np.ndarray((n,), ">u8", padded, strides=(1,)).astype(np.uint64) >> np.uint64(8)
    real = np.ones(n + DEPTH, bool)
    ends = np.flatnonzero(np.frombuffer(padded, np.uint8, n, DEPTH) == END[0])
    for j in range(1, DEPTH + 1):
        real[ends + j] = False
    return grams[real[:n]].view(np.int64)


def blocks_of(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Texts from, to: few enough for a byte to number them, and bytes enough for arrays to pay (a longer text is alone)."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + BLOCK_BYTES, side="right"))
        stop = max(start + 1, min(stop, start + BLOCK_TEXTS))
        yield start, stop
        start = stop


def bucket_of(grams: np.ndarray) -> np.ndarray:
    """All grams with the same last two context bytes share a bucket."""
    branch = (grams >> 8) & 65535
    return ((branch * 40503 & 65535) * BUCKETS >> 16).astype(np.int16)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = 0
    for batch in batches:
        whole = pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        even = whole // max(1, -(-whole // SLICE_BYTES))
        for part in sliced(batch, "text", min(SLICE_BYTES, even + even // 16 + 1)):
            ids = part.column("doc_id").to_pylist()
            held = [i is None or zlib.crc32(str(i).encode()) % FOLDS == 0 for i in ids]
            run = b"".join(map(run_of, texts_of(part, "text")))
            yield pa.record_batch(
                [
                    pa.array([_next_id(made)], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([held], pa.list_(pa.bool_())),
                    pa.array([len(run)], pa.int64()),
                    pa.array([pa.compress(run, codec="zstd", asbytes=True)], pa.binary()),
                ],
                names=["slice", "doc_ids", "held", "run_size", "run"],
            )
            made += 1


def _texts(batch: pa.RecordBatch, i: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """A slice's running texts, their sizes, and which of them are held out."""
    size = batch.column("run_size")[i].as_py()
    run = pa.decompress(batch.column("run")[i].as_buffer(), size, codec="zstd", asbytes=True)
    texts = [t + END for t in run.split(END)[:-1]]
    return texts, np.array([len(t) for t in texts], np.int64), np.array(batch.column("held")[i].as_py(), bool)


def tokens_of(text: bytes) -> list[bytes]:
    return [*text.split(), END]


def gram_counts(texts: list[bytes], sizes: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams, sorted, and how often each comes in texts that are not held out."""
    both, at = np.empty(sizes.sum(), np.int64), 0
    for start, stop in blocks_of(sizes):
        learned = np.repeat(~held[start:stop], sizes[start:stop])
        both[at : at + len(learned)] = windows(b"".join(texts[start:stop])) << 1 | learned
        at += len(learned)
    both.sort()
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.zeros(0, np.int64)
    times = np.diff(first, append=len(both)) * (both[first] & 1)
    return summed(both[first] >> 1, times)


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ones of sorted ``keys``, and the sums of ``n``."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n[:0]


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a slice hands to each bucket."""
    for batch in batches:
        for i in range(batch.num_rows):
            texts, sizes, held = _texts(batch, i)
            grams, counts = gram_counts(texts, sizes, held)
            by = bucket_of(grams)
            order = np.argsort(by, kind="stable")
            grams, counts = grams[order], counts[order]
            cuts = np.searchsorted(by[order], np.arange(BUCKETS + 1))
            learned: Counter[bytes] = Counter()
            others: set[bytes] = set()
            for text, out in zip(texts, held.tolist(), strict=True):
                (others if out else learned).update(tokens_of(text))
            words: list[list[bytes]] = [[] for _ in range(BUCKETS)]
            for w in [*learned, *(others - learned.keys())]:
                words[zlib.crc32(w) % BUCKETS].append(w)
            for k in range(BUCKETS):
                if cuts[k] < cuts[k + 1] or words[k]:
                    part = slice(cuts[k], cuts[k + 1])
                    row = [pack_sorted(grams[part]), pack(counts[part]), pack_words(words[k]), pack(np.array([learned[w] for w in words[k]], np.int64))]
                    yield pa.record_batch(
                        [pa.array([k], pa.int32()), batch.column("slice")[i : i + 1], *(pa.array([x], pa.binary()) for x in row)],
                        names=["bucket", "slice", "grams", "counts", "words", "word_counts"],
                    )


def _bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """The counts of one bucket over all slices, and what each slice asked for; word counts are answered at once."""
    total: list[tuple[np.ndarray, np.ndarray]] = []
    words: Counter[bytes] = Counter()
    for at, row in enumerate(rows.itertuples(index=False), 1):
        total.append((unpack_sorted(row.grams), unpack(row.counts)))
        if at == len(rows) or sum(len(g) for g, _ in total[1:]) > MERGE_ROWS:
            keys, n = (np.concatenate(x) for x in zip(*total, strict=True))
            order = np.argsort(keys, kind="stable")  # runs that are sorted already
            total = [summed(keys[order], n[order])]
        for w, c in zip(unpack_words(row.words), unpack(row.word_counts).tolist(), strict=True):
            words[w] += c
    answers = [pack(np.array([words[w] for w in unpack_words(x)], np.int64)) for x in rows["words"]]
    ((grams, counts),) = total
    return pd.DataFrame(
        {
            "grams": [pack_sorted(grams)], "counts": [pack(counts)],
            "word_total": [sum(words.values())], "word_distinct": [sum(c > 0 for c in words.values())],
            "slices": [rows["slice"].tolist()], "asked": [rows["grams"].tolist()], "words": [rows["words"].tolist()], "word_counts": [answers],
        }
    )


def log_gamma_half(n: np.ndarray) -> np.ndarray:
    """ln of gamma(n + 1/2) / gamma(1/2), by Stirling's series from 16 on."""
    small = np.concatenate(([0.0], np.cumsum(np.log(np.arange(16) + 0.5))))
    x = np.maximum(n, 16) + 0.5
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return np.where(n < 16, small[np.minimum(n, 16)], series - 0.5 * math.log(math.pi))


def log_factorial(n: np.ndarray) -> np.ndarray:
    small = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, 17)))))
    x = np.maximum(n, 16) + 1.0
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return np.where(n <= 16, small[np.minimum(n, 16)], series)


FEW = np.arange(1 << 12)
LOG_GAMMA_HALF, LOG_FACTORIAL = log_gamma_half(FEW), log_factorial(FEW)


def _by_table(table: np.ndarray, fn: Callable[[np.ndarray], np.ndarray], n: np.ndarray) -> np.ndarray:
    out = table[np.minimum(n, len(table) - 1)]
    many = np.flatnonzero(n >= len(table))
    out[many] = fn(n[many])
    return out


def kt_block(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return _by_table(LOG_GAMMA_HALF, log_gamma_half, n0) + _by_table(LOG_GAMMA_HALF, log_gamma_half, n1) - _by_table(LOG_FACTORIAL, log_factorial, n0 + n1)


class Nodes:
    """The nodes of one depth: sorted keys (context bytes, then the byte's beginning), counts of
    both bits, ln Pw and the weight of the node's own estimate against its children's."""

    def __init__(self, keys: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None):
        self.keys, self.n0, self.n1 = keys, n0, n1
        own = kt_block(n0, n1)
        if below is None:
            self.log_pw, self.weight = own, np.ones(len(keys))
        else:
            self.log_pw = np.logaddexp(own, below) - math.log(2)
            self.weight = 1 / (1 + np.exp(np.clip(below - own, -700, 700)))

    def above(self, depth: int) -> Nodes:
        """The nodes one byte of context less deep: ``depth`` is this one's."""
        parent = self.keys & ((1 << (8 * depth)) - 1)
        return merge(parent, self.n0, self.n1, self.log_pw)

    def at(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of both bits and weights at ``keys``; counts are 0 where nothing was seen."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.ones(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        seen = self.keys[at] == keys
        return np.where(seen, self.n0[at], 0), np.where(seen, self.n1[at], 0), self.weight[at]


def merge(keys: np.ndarray, n0: np.ndarray, n1: np.ndarray, log_pw: np.ndarray | None) -> Nodes:
    distinct, at = np.unique(keys, return_inverse=True)
    sums = [np.zeros(len(distinct), np.int64) for _ in range(2)]
    for s, n in zip(sums, (n0, n1), strict=True):
        np.add.at(s, at, n)
    below = None if log_pw is None else np.bincount(at, log_pw, len(distinct)) if len(distinct) else np.zeros(0)
    return Nodes(distinct, *sums, below)


def joined(parts: list[Nodes]) -> Nodes:
    """Nodes of one depth whose keys differ, as one."""
    out = copy(parts[0])
    order = np.argsort(np.concatenate([p.keys for p in parts]))
    for column in ("keys", "n0", "n1", "log_pw", "weight"):
        setattr(out, column, np.concatenate([getattr(p, column) for p in parts])[order])
    return out


def shortened(grams: np.ndarray, n: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """For each depth down to ``SPLIT``: distinct grams with so many context bytes, their counts, and for
    each the place of the gram that is one byte shorter."""
    levels, counts, ups = [grams], [n], []
    for depth in range(DEPTH - 1, SPLIT - 1, -1):
        keys = levels[-1] & ((1 << (8 * depth + 8)) - 1)
        order = np.argsort(keys, kind="stable")  # one sorted run for each byte cut off
        up = np.empty(len(keys), np.int64)
        ordered = keys[order]
        first = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        up[order] = np.cumsum(first) - 1
        ups.append(up)
        levels.append(ordered[first])
        counts.append(np.add.reduceat(counts[-1][order], np.flatnonzero(first)))
    return levels, counts, ups


def bit_nodes(levels: list[np.ndarray], counts: list[np.ndarray], ups: list[np.ndarray], k: int) -> list[tuple[np.ndarray, np.ndarray, Nodes]]:
    """For each depth, the nodes of the byte's bit ``k``: each gram's node, each node's first gram, and the nodes."""
    out: list[tuple[np.ndarray, np.ndarray, Nodes]] = []
    for j, (grams, n) in enumerate(zip(levels, counts, strict=True)):
        beginning = grams >> (8 - k)
        new = np.concatenate(([True], beginning[1:] != beginning[:-1]))
        first, node = np.flatnonzero(new), np.cumsum(new) - 1
        both = np.add.reduceat(n, first)
        ones = np.add.reduceat(n * (grams >> (7 - k) & 1), first)
        below = None
        if j:
            _, deeper, children = out[-1]
            below = np.bincount(node[ups[j - 1][deeper]], children.log_pw, len(first))
        keys = (grams[first] >> 8 << 8) | (1 << k) | ((grams[first] & 255) >> (8 - k))
        out.append((node, first, Nodes(keys, both - ones, ones, below)))
    return out


def subtree(grams: np.ndarray, n: np.ndarray) -> list[Nodes]:
    """The nodes at depth ``SPLIT`` over sorted distinct grams; grams without counts make none."""
    if not (n > 0).any():
        return [merge(grams[:0], n[:0], n[:0], np.zeros(0))]
    parts = shortened(grams[n > 0], n[n > 0])
    return [joined([bit_nodes(*parts, k)[-1][2] for k in range(8)])]


def _together(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray]]:
    """Some buckets' rows, their grams, and all these grams, sorted, with their counts: buckets share no node of
    ``SPLIT`` or deeper, so small ones are worked on as one."""
    rows: list[int] = []
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for i in range(batch.num_rows):
        rows.append(i)
        parts.append((unpack_sorted(batch.column("grams")[i].as_py()), unpack(batch.column("counts")[i].as_py())))
        if i == batch.num_rows - 1 or sum(len(g) for g, _ in parts) >= TOGETHER:
            grams, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(grams, kind="stable")
            yield rows, [g for g, _ in parts], grams[order], counts[order]
            rows, parts = [], []


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, grams, counts in _together(batch):
            top = subtree(grams, counts)[-1]
            up = top.above(SPLIT)  # only its sums are used: the node itself spans buckets
            below = np.zeros(len(up.keys))
            np.add.at(below, np.searchsorted(up.keys, top.keys & ((1 << (8 * SPLIT)) - 1)), top.log_pw)
            yield pa.record_batch([pa.array(x) for x in (up.keys, up.n0, up.n1, below)], names=["key", "n0", "n1", "below"])


def upper(tops: pd.DataFrame) -> list[Nodes]:
    """Depths 1 and 0 from the groups' sums."""
    one = Nodes(*(tops[c].to_numpy() for c in ("key", "n0", "n1", "below")))
    return [one, one.above(1)]


def gram_log10(grams: np.ndarray, n: np.ndarray, roots: list[Nodes]) -> np.ndarray:
    """log10 of the probability of each gram's last byte after its context; grams are sorted and distinct."""
    out = np.zeros(len(grams))
    if not len(grams):
        return out
    levels, counts, ups = shortened(grams, n)
    for k in range(8):
        found = bit_nodes(levels, counts, ups, k)
        # From depth 0 on: what the nodes so far add up to, the weight that is left for those deeper, and
        # the probability if no deeper one was seen.
        added, left, p = np.zeros(len(levels[-1])), np.ones(len(levels[-1])), np.full(len(levels[-1]), 0.5)
        for depth in range(DEPTH + 1):
            j = DEPTH - depth
            at = levels[min(j, len(levels) - 1)]
            if depth < SPLIT:
                keys = (at >> 8 << 8 & ((1 << (8 * depth + 8)) - 1)) | (1 << k) | ((at & 255) >> (8 - k))
                n0, n1, w = roots[SPLIT - 1 - depth].at(keys)
            else:
                node, _, nodes = found[j]
                n0, n1, w = nodes.n0[node], nodes.n1[node], nodes.weight[node]
                if depth > SPLIT:
                    added, left, p = added[ups[j]], left[ups[j]], p[ups[j]]
            own = (np.where(at >> (7 - k) & 1, n1, n0) + 0.5) / (n0 + n1 + 1)
            p = np.where(n0 + n1 > 0, added + left * own, p)
            added, left = added + left * w * own, left * (1 - w)
        out += np.log10(p)
    return out


def _answers(roots: list[Nodes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, parts, grams, counts in _together(batch):
                all_lp = gram_log10(grams, counts, roots).astype(np.float32).view(np.int32)
                for i, part in zip(rows, parts, strict=True):
                    lp = all_lp[np.searchsorted(grams, part)]
                    lists = (batch.column(c)[i].values for c in ("slices", "asked", "words", "word_counts"))
                    for number, asked, words, known in zip(*lists, strict=True):
                        row = [asked.as_py(), pack(lp[np.searchsorted(part, unpack_sorted(asked.as_py()))].view(np.uint32)), words.as_py(), known.as_py()]
                        yield pa.record_batch(
                            [pa.array([number.as_py()], pa.int64()), *(pa.array([x], pa.binary()) for x in row)],
                            names=["slice", "grams", "lps", "words", "word_counts"],
                        )

    return run


def text_sums(texts: list[bytes], sizes: np.ndarray, grams: np.ndarray, lp: np.ndarray) -> np.ndarray:
    """For each text the sum of ``lp`` over the grams of its bytes; ``grams`` are sorted and hold all of them."""
    out = np.zeros(len(texts))
    for start, stop in blocks_of(sizes):
        number = np.repeat(np.arange(stop - start, dtype=np.uint64), sizes[start:stop])
        both = windows(b"".join(texts[start:stop])).view(np.uint64) << np.uint64(8) | number
        both.sort()  # by gram, so that each is looked up once and in order
        each = both >> np.uint64(8)
        first = np.flatnonzero(np.concatenate(([True], each[1:] != each[:-1])))
        found = lp[np.searchsorted(grams, each[first].view(np.int64))]
        out[start:stop] = np.bincount((both & np.uint64(255)).astype(np.int64), np.repeat(found, np.diff(first, append=len(both))), stop - start)
    return out


def _doc_scores(total: int, distinct: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                texts, sizes, held = _texts(batch, i)
                found = batch.column("found")[i].values
                grams = np.concatenate([unpack_sorted(x) for x in found.field("grams").to_pylist()])
                lp = np.concatenate([unpack(x) for x in found.field("lps").to_pylist()]).astype(np.uint32).view(np.float32).astype(np.float64)
                order = np.argsort(grams, kind="stable")
                known: dict[bytes, int] = {}
                for words, counts in zip(found.field("words").to_pylist(), found.field("word_counts").to_pylist(), strict=True):
                    known.update(zip(unpack_words(words), unpack(counts).tolist(), strict=True))
                c, n_tokens = array("q"), []
                for text in texts:
                    c.extend(map(known.__getitem__, tokens_of(text)))
                    n_tokens.append(len(c))
                c = np.frombuffer(c, np.int64)
                n_tokens = np.diff(n_tokens, prepend=0)
                base = np.log10((c + SMOOTH) / (total + SMOOTH * (distinct + 1)))
                add = lambda x: np.add.reduceat(x, np.cumsum(n_tokens) - n_tokens)  # noqa: B023, E731  # no document is without its end
                yield pa.record_batch(
                    [batch.column("doc_ids")[i].values, pa.array(held), pa.array(n_tokens), pa.array(add((c > 0).astype(np.int64))), pa.array(np.full(len(texts), total)), pa.array(add(base)), pa.array(text_sums(texts, sizes, grams[order], lp[order]))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): log10 probabilities."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slices = write_once(rows.mapInArrow(_slices, SLICE_SCHEMA), "lm-slices")
    asked = slices.select("slice", "held", "run_size", "run").mapInArrow(_asked, ASKED_SCHEMA)
    buckets = write_once(asked.groupBy("bucket").applyInPandas(_bucket, BUCKET_SCHEMA), "lm-buckets")
    known = buckets.agg(F.sum("word_total").alias("total"), F.sum("word_distinct").alias("distinct")).first()
    total, distinct = known["total"] or 0, known["distinct"] or 0

    tops = buckets.select("grams", "counts").mapInArrow(_tops, "key long, n0 long, n1 long, below double")
    roots = upper(tops.groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("below").alias("below")).orderBy("key").toPandas())
    asking = buckets.select("grams", "counts", "slices", "asked", "words", "word_counts")
    answers = asking.mapInArrow(_answers(roots), ANSWER_SCHEMA)
    found = answers.groupBy("slice").agg(F.collect_list(F.struct("grams", "lps", "words", "word_counts")).alias("found"))
    return slices.join(found, "slice").mapInArrow(
        _doc_scores(total, distinct),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


# The same grams word by word, for trees over a few given words and to hold ``windows`` against.


def forms_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct forms (words with the six bytes before them); then sorted, for each text and form in it: text, number of the form, times."""
    flat, counts = [], []
    for t in texts:
        flat += t.lower().split()  # on bytes, only A-Z are lowered
        flat.append(END)
        counts.append(len(flat))
    sizes = np.diff(counts, prepend=0)
    number = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    words = list(number)
    word = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    # The running text of the slice; spaces after each end keep the next text apart.
    spelled = [w + (PAD if w == END else b" ") for w in words]
    starts = np.cumsum(np.array([len(w) for w in spelled], np.int64)[word])
    starts = np.concatenate(([0], starts[:-1])) if len(starts) else starts
    data = np.frombuffer(PAD + b"".join(map(spelled.__getitem__, word.tolist())), np.uint8)
    del flat, number, spelled  # most of a slice's memory
    before = np.zeros(len(word), np.int64)
    for j in range(DEPTH):
        before = (before << 8) | data[starts + j]
    tails, tail = np.unique(before, return_inverse=True)
    keys, form = np.unique(word * len(tails) + tail, return_inverse=True)
    tail_bytes = tails.astype(">i8").tobytes()
    tail_bytes = [MARK + tail_bytes[8 * i + 8 - DEPTH : 8 * i + 8] for i in range(len(tails))]
    forms = [tail_bytes[t] + words[w] for w, t in zip((keys // len(tails)).tolist(), (keys % len(tails)).tolist())]
    text = np.repeat(np.arange(len(texts)), sizes)
    pairs, times = np.unique(text * len(forms) + form, return_counts=True)
    return forms, pairs // len(forms), pairs % len(forms), times


def spell(forms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all forms, and how many each has.  A form is a number, that many bytes of the text
    before (padded with spaces), and the word.  A gram is six context bytes and the byte that follows."""
    cut = [(f[1 : 1 + f[0]].rjust(DEPTH), f[1 + f[0] :]) for f in forms]
    whole = [before + w + (b"" if w == END else b" ") for before, w in cut]
    data = np.frombuffer(b"".join(whole), np.uint8).astype(np.int64)
    lengths = np.array([len(w) for w in whole], np.int64)
    grams = np.zeros(max(0, len(data) - DEPTH), np.int64)
    for j in range(DEPTH + 1):
        grams = (grams << 8) | data[j : j + len(grams)]
    n = lengths - DEPTH
    at = np.repeat(np.cumsum(lengths) - lengths, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return grams[at], n
