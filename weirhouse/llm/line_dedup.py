"""Line dedup by a sharded minimal perfect hash over all distinct lines.

A line's key is the line without spaces at both ends, A-Z lower-cased.  Each distinct key
(128 hash bits) has one slot in the arrays of its shard: a fingerprint and the number of
documents that hold it.  Documents send their key hashes, never lines, to the shards and
get back those found in ``min_docs`` documents or more, whose lines they lose.

Skew: keys are counted with partial sums.  A shard gets one probe per document and key; a
shard with more of them than ``probes_per_task`` is copied, and the copies share its
probes, so a line in a third of all documents is looked up by many tasks.  What was found is gathered
by a hash of id and text, so by one text's lines at most, however many rows share an id.

Null and empty texts are one empty line; empty keys are never dropped.  Each row counts as a
document, also where rows or ids repeat or the id is null.  An empty table gives an empty one.
Only ``doc_id`` and ``text`` are looked at, so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirhouse.llm.common import SPACES, ascii_lower, ship, whole, write_once

MIN_DOCS = 10
KEYS_PER_SHARD = 100_000
PROBES_PER_TASK = 500_000
SLOTS_PER_KEY = 1.3
INDEX_SCHEMA = "shard long, copies long, levels array<long>, bits binary, fingerprints binary, counts binary"


def _place(h1: np.ndarray, h2: np.ndarray, level: int, slots: int) -> np.ndarray:
    """A key's slot on a level: both hash halves, mixed anew for each level."""
    with np.errstate(over="ignore"):
        x = h1.astype(np.uint64) + h2.astype(np.uint64) * np.uint64(2 * level + 1)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return (x % np.uint64(slots)).astype(np.int64)


def _fingerprint(h2: np.ndarray) -> np.ndarray:
    return (h2.astype(np.uint64) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Levels of bit arrays: a key lives on the first level where it met no other key.
    Its number is the count of set bits before its own."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.before = np.cumsum(bits) - bits

    @classmethod
    def of(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        sizes, arrays, left = [], [], np.arange(len(h1))
        while len(left):
            slots = max(4, int(len(left) * SLOTS_PER_KEY))
            at = _place(h1[left], h2[left], len(sizes), slots)
            alone = np.bincount(at, minlength=slots) == 1
            sizes.append(slots)
            arrays.append(alone)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(arrays).astype(np.int64) if arrays else np.zeros(0, np.int64))

    def number(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """-1 where no level takes the key."""
        out, left, base = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
        for level, slots in enumerate(self.sizes):
            at = base + _place(h1[left], h2[left], level, slots)
            here = self.bits[at] == 1
            out[left[here]] = self.before[at[here]]
            left, base = left[~here], base + slots
        return out


def _build(probes_per_task: int):
    def build(keys: pd.DataFrame) -> pd.DataFrame:
        h1, h2, n = (keys[c].to_numpy() for c in ("h1", "h2", "n"))
        index = PerfectHash.of(h1, h2)
        at = index.number(h1, h2)
        prints, counts = np.empty(len(h1), np.uint32), np.empty(len(h1), np.int64)
        prints[at], counts[at] = _fingerprint(h2), n
        return pd.DataFrame(
            {
                "shard": keys["shard"].iloc[:1].to_numpy(),
                "copies": [max(1, -(-int(n.sum()) // probes_per_task))],
                "levels": [index.sizes],
                "bits": [np.packbits(index.bits.astype(np.uint8)).tobytes()],
                "fingerprints": [prints.tobytes()],
                "counts": [counts.tobytes()],
            }
        )

    return build


def _probe(min_docs: int):
    def probe(probes: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        out = probes[["row_key", "h1", "h2"]]
        if not len(probes) or not len(index):
            return out.iloc[:0]
        row = index.iloc[0]
        sizes = [int(s) for s in row["levels"]]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: sum(sizes)].astype(np.int64)
        prints, counts = np.frombuffer(row["fingerprints"], np.uint32), np.frombuffer(row["counts"], np.int64)
        h1, h2 = out["h1"].to_numpy(), out["h2"].to_numpy()
        at = PerfectHash(sizes, bits).number(h1, h2)
        return out[(at >= 0) & (prints[at] == _fingerprint(h2)) & (counts[at] >= min_docs)]

    return probe


def _key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def _lines() -> Column:
    return F.split(whole(), "\n", -1)


def row_key(doc_id: Column, text: Column) -> Column:
    """Rows that share one by chance also share what is found; all of that is frequent, so nothing changes."""
    return F.xxhash64(doc_id.cast("long"), text.cast("string"))


def line_keys(docs: DataFrame) -> DataFrame:
    """(row_key, h1, h2): each document's distinct keys but the empty one."""
    keys = F.filter(F.array_distinct(F.transform(_lines(), _key)), lambda k: k != "")
    return docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row_key"), F.explode(keys).alias("key")).select("row_key", *_hashes(F.col("key")))


def build_index(keys: DataFrame, keys_per_shard: int = KEYS_PER_SHARD, probes_per_task: int = PROBES_PER_TASK) -> DataFrame:
    """One row per shard with its arrays, written to the shared folder."""
    counts = write_once(keys.groupBy("h1", "h2").agg(F.count("*").alias("n")), "line-counts")
    shards = max(1, -(-counts.count() // keys_per_shard))
    sharded = counts.withColumn("shard", F.pmod("h1", F.lit(shards)))
    return write_once(sharded.groupBy("shard").applyInPandas(_build(probes_per_task), INDEX_SCHEMA), "line-index")


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, **sizes: int) -> DataFrame:
    """(row_key, h1, h2) of each document's keys that ``min_docs`` documents or more hold."""
    ship(docs.sparkSession)
    keys = line_keys(docs)
    index = build_index(keys, **sizes)
    shards = max(1, index.count())
    # Shards without keys have no row, so the number of shards is taken from the largest.
    shards = max(shards, 1 + (index.agg(F.max("shard")).first()[0] or 0))
    copies = index.select("shard", "copies")
    probes = (
        keys.withColumn("shard", F.pmod("h1", F.lit(shards)))
        .join(copies, "shard")
        .withColumn("copy", F.pmod(F.xxhash64("row_key", "h2"), F.col("copies")))
        .select("shard", "copy", "row_key", "h1", "h2")
    )
    copied = index.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return probes.groupBy("shard", "copy").cogroup(copied.groupBy("shard", "copy")).applyInPandas(_probe(min_docs), "row_key long, h1 long, h2 long")


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, **sizes: int) -> DataFrame:
    """(row, kept_text, n_lines, n_dropped): each input row as a struct, its text without
    frequent lines, and the numbers of lines before and dropped."""
    hits = (
        frequent_lines(docs, min_docs, **sizes)
        .groupBy("row_key")
        .agg(F.collect_set(F.struct("h1", "h2")).alias("hits"))
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = rows.join(hits, row_key(F.col("row.doc_id"), F.col("row.text")) == F.col("row_key"), "left")
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    lines = F.split(text, "\n", -1)
    keep = lambda line: ~F.array_contains("hits", F.struct(*_hashes(_key(line))))
    kept = F.when(F.col("hits").isNull(), lines).otherwise(F.filter(lines, lambda x: (_key(x) == "") | keep(x)))
    return joined.select("row", kept.alias("kept"), F.size(lines).cast("long").alias("n_lines")).select(
        "row", F.array_join("kept", "\n").alias("kept_text"), "n_lines", (F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped")
    )


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the kept lines as text (null texts stay null)."""
    text = F.when(F.col("row.text").isNotNull(), F.col("kept_text"))
    return dedup_lines(docs, min_docs).select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
