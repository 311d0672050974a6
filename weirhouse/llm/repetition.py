"""Quality rules with a suffix array of each text's words.

The suffixes of all texts of a slice are sorted together by prefix doubling, each with its text as
the first key, so only suffixes of one text can share a prefix.  Longest common prefixes of
neighbours come from the ranks kept for each doubling.  A suffix's longer common prefix
with its two neighbours is the longest substring that starts there and stands elsewhere in the
text, so the spans of all maximal repeats are the union of those prefixes; the rules
bound the share of words in repeats of ``min_repeat`` words or more, and the longest repeat.

Null, empty and word-less texts have no words and fail the base rule.  Each row is looked at by
itself, repeated or not, whatever its id.  An empty table gives no rows.  Columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirhouse.llm.common import SPACES, ship, sliced, texts_of

MIN_WORDS = 50
BASE_WINDOW = 3
BASE_PERCENT = 50
MIN_REPEAT = 8
MAX_COVERED = 0.45
MAX_LONGEST = 100
SYMBOLS = b"#*$%&|<>"
SLICE_BYTES = 4 << 20
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " covered_fraction double, longest_repeat long"
)


def repeat_lengths(words: np.ndarray, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest substring that starts there and stands
    elsewhere in its text.  ``text``: each position's text; ``ends``: that text's end."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    key = text * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    s = key[order]
    starts = np.concatenate(([True], s[1:] != s[:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    ranks, k = [rank.astype(np.int32)], 1
    while True:
        tied = np.flatnonzero(~(starts & np.concatenate((starts[1:], [True]))))
        if not len(tied):
            break
        at = order[tied]
        after = np.where(at + k < ends[at], rank[np.minimum(at + k, n - 1)] + 1, 0)
        group = rank[at]
        by = np.argsort(group * (n + 1) + after, kind="stable")
        at, after, group = at[by], after[by], group[by]
        order[tied] = at
        fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])))
        starts[tied] = fresh
        rank[at] = np.maximum.accumulate(np.where(fresh, tied, 0))
        ranks.append(rank.astype(np.int32))
        k *= 2
    # Common prefix of neighbours: the longest power of two first.  A rank of level j
    # compares 2^j words, fewer only at a text's end, where no other suffix equals it.
    a, b = order[:-1], order[1:]
    pair = np.flatnonzero(ranks[0][a] == ranks[0][b])
    a, b, common = a[pair], b[pair], np.zeros(len(pair), np.int64)
    for j in range(len(ranks) - 1, -1, -1):
        inside = np.maximum(a, b) < n
        same = inside.copy()
        i = np.flatnonzero(inside)
        same[i] = (ranks[j][a[i]] == ranks[j][b[i]]) & (text[a[i]] == text[b[i]])
        common[same] += 1 << j
        a, b = np.where(same, a + (1 << j), a), np.where(same, b + (1 << j), b)
    out = np.zeros(n, np.int64)
    np.maximum.at(out, order[pair], common)
    np.maximum.at(out, order[pair + 1], common)
    return out


def covered(lengths: np.ndarray, least: int) -> np.ndarray:
    """Positions inside a repeat of ``least`` words or more."""
    step = np.zeros(len(lengths) + 1, np.int64)
    at = np.flatnonzero(lengths >= least)
    step[at] += 1
    np.add.at(step, at + lengths[at], -1)
    return np.cumsum(step[:-1]) > 0


def measure(texts: list[bytes], min_repeat: int) -> dict[str, np.ndarray]:
    split = [t.split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    flat = [x for w in split for x in w]
    number = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    words = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    text = np.repeat(np.arange(len(texts)), counts)
    ends = np.repeat(np.cumsum(counts), counts)
    lengths = repeat_lengths(words, text, ends)
    per = lambda mask: np.bincount(text[mask], minlength=len(texts))
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, text, lengths)
    spaces = SPACES.encode()
    n_chars, n_symbols, n_dup = [], [], []
    for t in texts:
        ink = t.translate(None, spaces)
        n_chars.append(len(ink.decode()) if not ink.isascii() else len(ink))
        n_symbols.append(len(t) - len(t.translate(None, SYMBOLS)))
        lines = [x for x in t.split(b"\n") if x and not x.isspace()]
        n_dup.append(len(lines) - len(set(lines)))
    return {
        "n_words": counts,
        "word_chars": np.array(n_chars, np.int64),
        "n_symbols": np.array(n_symbols, np.int64),
        "n_dup_lines": np.array(n_dup, np.int64),
        "n_repeat_words": per(covered(lengths, BASE_WINDOW)),
        "covered_fraction": per(covered(lengths, min_repeat)) / np.maximum(counts, 1),
        "longest_repeat": longest,
    }


def _measure(min_repeat: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text", SLICE_BYTES):
                found = measure(texts_of(part, "text"), min_repeat)
                yield pa.record_batch([part.column("doc_id"), *map(pa.array, found.values())], names=["doc_id", *found])

    return run


def repetition(docs: DataFrame, min_repeat: int = MIN_REPEAT) -> DataFrame:
    """The measures of each row's whole text."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_measure(min_repeat), SCHEMA)


def quality(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """The measures, ``base_failed`` and ``kept``."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > BASE_PERCENT * F.col("n_words"))
    bad = (F.col("covered_fraction") > max_covered) | (F.col("longest_repeat") > max_longest)
    return repetition(docs, min_repeat).withColumn("base_failed", base).withColumn("kept", ~base & ~bad)
