"""Benchmark decontamination with an FM-index per shard of training documents.

A shard is a slice of a partition.  Its words are mapped to the benchmark's vocabulary; words
outside it, and runs too short for any window, become one separator, as no window can
cross them.  Over what is left an FM-index is built: suffix array, its last column in a
wavelet matrix, and every eighth suffix position.  All windows are searched backward at once;
occurrences are located by steps to a sampled position, and their spans merged.

The benchmark goes to the workers in blocks of at most ``block_bytes``; documents are scanned
once per block and the spans of all blocks are merged per document.  Nothing is shuffled for a
benchmark of one block, and no document leaves its task.

Null, empty and word-less texts have no words and no hits; items without words have no windows.
Each row is looked at by itself, repeated or not.  Repeated item ids count once; a null
item id is the empty text.  Very long texts are shards of their own, whose arrays grow with them.  Empty tables
give no rows or no hits.  Of ``docs`` only ``doc_id`` and ``text`` are looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirhouse.llm.common import WORD_BYTES, ship, sliced, texts_of, whole, write_once
from weirhouse.llm.ranked import positions

WINDOW = 10
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20
RUN = 1000  # items whose bytes are summed up together
SAMPLE_EVERY = 8
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
FOUND = "struct<n_words:long,n_hit:long,item_ids:array<string>,spans:array<struct<first:long,last:long>>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class WaveletMatrix:
    """Ranks of symbols in a sequence, for many queries at once."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.bits = range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1)
        self.ones, self.zeros, s = [], [], symbols
        for b in self.bits:
            bit = (s >> b) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate((s[bit == 0], s[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        low, high = np.zeros(len(at), np.int64), at.astype(np.int64)
        for b, ones, zeros in zip(self.bits, self.ones, self.zeros, strict=True):
            one = ((symbol >> b) & 1).astype(bool)
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return high - low

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out, at = np.zeros(len(at), np.int64), at.astype(np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            bit = ones[at + 1] - ones[at]
            out = out * 2 + bit
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return out


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By doubling the compared length; only suffixes that still tie are sorted again."""
    n, k = len(symbols), 1
    order = np.argsort(symbols, kind="stable")
    s = symbols[order]
    starts = np.concatenate(([True], s[1:] != s[:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    while True:
        ends = np.concatenate((starts[1:], [True]))
        tied = np.flatnonzero(~(starts & ends))
        if not len(tied):
            return order
        at = order[tied]
        after = np.where(at + k < n, rank[np.minimum(at + k, n - 1)] + 1, 0)
        group = rank[at]
        by = np.lexsort((after, group))
        at, after, group = at[by], after[by], group[by]
        order[tied] = at
        fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])))
        starts[tied] = fresh
        rank[at] = np.maximum.accumulate(np.where(fresh, tied, 0))
        k *= 2


class FMIndex:
    def __init__(self, symbols: np.ndarray, sigma: int):
        text = np.concatenate((symbols + 1, [0]))  # an end below all symbols
        self.n, self.sigma = len(text), sigma + 1
        order = suffix_array(text)
        self.last = WaveletMatrix(text[order - 1], self.sigma)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.sigma))))
        sampled = order % SAMPLE_EVERY == 0
        self.sampled, self.sample_number = sampled, np.cumsum(sampled) - sampled
        self.samples = order[sampled]

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array ranges of the windows (rows, padded at the right)."""
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), self.n, np.int64)
        for j in range(windows.shape[1] - 1, -1, -1):
            go = np.flatnonzero((j < lengths) & (low < high))
            c = windows[go, j] + 1
            low[go], high[go] = self.first[c] + self.last.rank(c, low[go]), self.first[c] + self.last.rank(c, high[go])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        left = np.arange(len(rows))
        while len(left):
            done = self.sampled[rows[left]]
            hit = left[done]
            out[hit] = self.samples[self.sample_number[rows[hit]]] + steps[hit]
            left = left[~done]
            c = self.last.symbol(rows[left])
            rows[left] = self.first[c] + self.last.rank(c, rows[left])
            steps[left] += 1
        return out


class Phrases:
    """Vocabulary and distinct windows of a block of the benchmark."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1)) if ids else ():
                found.setdefault(tuple(ids[i : i + window]), set()).add(item)
        self.lengths = np.array([len(w) for w in found], np.int64)
        self.windows = np.zeros((len(found), max([1, *self.lengths.tolist()])), np.int64)
        for i, w in enumerate(found):
            self.windows[i, : len(w)] = w
        self.items = [sorted(x) for x in found.values()]
        self.shortest = int(self.lengths.min()) if len(found) else 1


def find(texts: list[bytes], phrases: Phrases) -> list[tuple[int, int, list[str], list[tuple[int, int]]]]:
    """Per text: words, words hit, items found, merged word spans (first, last)."""
    get, per_text = phrases.vocabulary.get, []
    for t in texts:
        w = words_of(t)
        per_text.append(np.fromiter((get(x, 0) for x in w), np.int64, len(w)))
    counts = np.array([len(x) for x in per_text], np.int64)
    nothing = [(int(n), 0, [], []) for n in counts]
    if not len(phrases.windows) or not counts.sum():
        return nothing
    # One line of all words, each text followed by a separator.
    line = np.concatenate([y for x in per_text for y in (x, np.zeros(1, np.int64))])
    doc = np.repeat(np.arange(len(texts)), counts + 1)
    word = np.arange(len(line)) - np.repeat(np.cumsum(counts + 1) - counts - 1, counts + 1)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (line > 0).astype(np.int8), [0]))))
    begin, stop = edge[::2], edge[1::2]
    long = stop - begin >= phrases.shortest
    begin, stop = begin[long], stop[long]
    if not len(begin):
        return nothing
    sizes = stop - begin + 1  # with the separator after each run
    place = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    kept = line[place]
    index = FMIndex(kept, len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.windows, phrases.lengths)
    some = np.flatnonzero(high > low)
    if not len(some):
        return nothing
    times = (high - low)[some]
    which = np.repeat(some, times)
    at = index.locate(np.repeat(low[some], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
    cover = np.zeros(len(kept) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + phrases.lengths[which], -1)
    hit = np.cumsum(cover[:-1]) > 0
    n_hit = np.bincount(doc[place[hit]], minlength=len(texts))
    items: dict[int, set[str]] = {}
    for d, w in np.unique(np.stack((doc[place[at]], which), axis=1), axis=0).tolist():
        items.setdefault(d, set()).update(phrases.items[w])
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    spans: dict[int, list[tuple[int, int]]] = {}
    for a, b in zip(place[edge[::2]].tolist(), place[edge[1::2] - 1].tolist(), strict=True):
        spans.setdefault(int(doc[a]), []).append((int(word[a]), int(word[b])))
    return [(int(n), int(n_hit[i]), sorted(items.get(i, ())), spans.get(i, [])) for i, n in enumerate(counts)]


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the words of the spans and what stands between them."""
    at = [m.span() for m in WORD.finditer(text)]
    out, start = [], 0
    for first, last in spans:
        out.append(text[start : at[first][0]])
        start = at[last][1]
    return b"".join([*out, text[start:]])


@lru_cache(maxsize=1)
def _phrases(items: tuple[tuple[str, bytes], ...], window: int) -> Phrases:
    return Phrases(list(items), window)


class Blocks:
    """The benchmark's items in blocks of bounded size, in order of their ids; one at a time passes the driver.

    Items are numbered and their bytes summed up by Spark; the table with each item's block is written."""

    def __init__(self, benchmark: DataFrame, block_bytes: int):
        items = benchmark.select(F.lit(0).alias("grp"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), whole().alias("text"))
        placed = positions(items, ["grp"], [F.col("item"), F.col("text")], "items")
        size = F.octet_length("text").cast("long") + 1
        # Bytes are summed over runs of items first, so no window holds more than a run, or one row per run.
        run = F.floor(F.col("pos") / RUN)
        within = F.sum(size).over(Window.partitionBy("run").orderBy("pos"))
        runs = placed.withColumn("run", run).withColumn("within", within)
        sums = runs.groupBy("run").agg(F.max("within").alias("bytes"))
        before = sums.select("run", (F.sum("bytes").over(Window.orderBy("run")) - F.col("bytes")).alias("before"))
        end = F.col("before") + F.col("within")
        block = F.floor((end - 1) / block_bytes)
        self.items = write_once(runs.join(before, "run").select("pos", "item", "text", block.alias("block")), "benchmark")
        self.numbers = [r["block"] for r in self.items.select("block").distinct().orderBy("block").collect()] or [None]

    def __len__(self) -> int:
        return len(self.numbers)

    def __iter__(self) -> Iterator[tuple[tuple[str, bytes], ...]]:
        for number in self.numbers:
            rows = self.items.where(F.col("block") == F.lit(number)).orderBy("pos").collect()  # one block, of bounded size
            yield tuple((r["item"], r["text"].encode()) for r in rows)


FOUND_TYPE = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("item_ids", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
    ]
)


def _mark(items: tuple[tuple[str, bytes], ...], window: int, names: list[str]):
    """Columns ``names``; the last one is new."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = _phrases(items, window)
        for batch in batches:
            for part in sliced(batch, "text", SHARD_BYTES):
                found = [
                    {"n_words": n, "n_hit": h, "item_ids": i, "spans": [{"first": a, "last": b} for a, b in s]}
                    for n, h, i, s in find(texts_of(part, "text"), phrases)
                ]
                yield pa.record_batch([*(part.column(c) for c in names[:-1]), pa.array(found, FOUND_TYPE)], names=names)

    return mark


def _cut(items: tuple[tuple[str, bytes], ...], window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = _phrases(items, window)
        for batch in batches:
            for part in sliced(batch, "text", SHARD_BYTES):
                texts, old = texts_of(part, "text"), part.column("text").is_null().to_pylist()
                todo = list(range(len(texts)))
                while todo:  # a cut may bring words of another window together
                    found = find([texts[i] for i in todo], phrases)
                    todo = [i for i, f in zip(todo, found, strict=True) if f[1] and not texts.__setitem__(i, without(texts[i], f[3]))]
                new = pa.array([None if null else t for t, null in zip(texts, old, strict=True)], pa.binary()).cast(pa.string())
                yield part.set_column(part.schema.get_field_index("text"), "text", new)

    return cut


def _merged(spans):
    """Spans of several blocks as non-overlapping ones, in order."""
    step = lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["last"] >= s["first"] - 1),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["last"], s["last"]).alias("last")))),
    ).otherwise(F.concat(acc, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.expr("CAST(array() AS array<struct<first:bigint,last:bigint>>)"), step)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids, spans) of every row of ``docs``."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = Blocks(benchmark, block_bytes)
    for i, block in enumerate(blocks):  # the texts are carried on to the last block only
        names = [*(c for c in rows.columns if c != "text" or i + 1 < len(blocks)), f"found{i}"]
        kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields} | {f"found{i}": FOUND}
        rows = rows.mapInArrow(_mark(block, window, names), ", ".join(f"{c} {kinds[c]}" for c in names))
        if i + 1 < len(blocks):
            rows = write_once(rows, "marked")  # a plan holds one block only
    if len(blocks) == 1:
        return rows.select("doc_id", "found0.*")
    every = [F.col(f"found{i}") for i in range(len(blocks))]
    spans = _merged(F.concat(*[f["spans"] for f in every]))
    merged = rows.select("doc_id", every[0]["n_words"].alias("n_words"), F.array_sort(F.array_distinct(F.concat(*[f["item_ids"] for f in every]))).alias("item_ids"), spans.alias("spans"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
    return merged.select("doc_id", "n_words", hit.alias("n_hit"), "item_ids", "spans")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the merged spans cut out of their texts, until no window of any block is left.

    A cut may bring words of another block's window together, so with several blocks all are gone through
    again until a round has cut nothing; each round shortens a text, so it ends."""
    ship(docs.sparkSession)
    blocks = Blocks(benchmark, block_bytes)
    if len(blocks) == 1:
        return docs.mapInArrow(_cut(next(iter(blocks)), window), docs.schema)
    while True:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
        for block in blocks:
            docs = write_once(docs.mapInArrow(_cut(block, window), docs.schema), "cut")
        if docs.agg(F.sum(F.octet_length("text"))).first()[0] == size:
            return docs
