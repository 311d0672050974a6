"""Importance resampling of documents towards a target text distribution.

Features are all runs of one or two consecutive words, counted in hashed buckets; a bucket's gain
is the log ratio of its smoothed shares in the target and in the corpus, a document's weight the
mean gain over its features, and a fixed random draw (Gumbel noise by id) turns weights into a sample
without replacement.

Newlines cut texts into lines.  Features within a line are counted once per distinct line
(A-Z lower-cased): its buckets are kept as one array, its counts multiplied by the line's
occurrences.  Pairs of words that a line break parts are few; they are counted document by
document and added.  Documents keep hashes of their lines and get the lines' gains by a join.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, so a line break always parts words.  Null and empty texts
have no features, weight 0, and no place in the draw unless ``least_words`` is 0.  A null id draws
like the empty text.  Rows that repeat count each; equal scores are ranked by id (null last), rows equal in
both by their place in the input.  Empty tables, also an empty target, are fine.  Lines of any length are
worked on in pieces of bounded size, words of any length one by one.  Only ``doc_id`` and ``text`` are looked at.

Skew: lines are counted with partial sums.  Lines that make up over one ``HEAVY``-th of all
occurrences are fewer than ``HEAVY``; their gains are broadcast, all other lines are joined by
hash.  Two 64-bit hashes stand for a line.  Only the gains (one number per bucket) pass the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirhouse.llm.common import WORD_BYTES, ascii_lower, ship, sliced, texts_of, whole, write_once
from weirhouse.llm.ranked import positions

BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = 25  # percent of the eligible documents that are drawn
SEED = 7
HEAVY = 1000
SLICE_BYTES = 2 << 20
LONG_WORD = 64

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, np.uint32(0xEDB88320) ^ (_CRC >> 1), _CRC >> 1).astype(np.uint32)


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with spaces for what is no word, and where words start and end."""
    letters = np.frombuffer(data.translate(WORD_BYTES), np.uint8)
    edge = np.diff(np.concatenate(([0], (letters != 32).view(np.int8), [0])))
    return letters, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def extend_crc(crc: np.ndarray, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of texts continued by one word each, byte by byte over all words still that long."""
    out, size = crc.astype(np.uint32), ends - starts
    order = np.argsort(-size, kind="stable")
    n_long = int(np.searchsorted(-size[order], -LONG_WORD))
    for i in order[:n_long]:
        out[i] = zlib.crc32(letters[starts[i] : ends[i]].tobytes(), int(out[i]))
    order = order[n_long:]
    state, at, left = ~out[order], starts[order], size[order]
    for j in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -j))  # words longer than j come first
        state[:n] = _CRC[(state[:n] ^ letters[at[:n] + j]) & 0xFF] ^ (state[:n] >> np.uint32(8))
    out[order] = ~state
    return out


def _space(crc: np.ndarray) -> np.ndarray:
    state = ~crc
    return ~(_CRC[(state ^ np.uint32(32)) & 0xFF] ^ (state >> np.uint32(8)))


def _crcs(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """crc32 of every word, and of word i, a space, word i + 1 for each i of ``pairs``."""
    one = extend_crc(np.zeros(len(starts), np.uint32), letters, starts, ends)
    return one, extend_crc(_space(one[pairs]), letters, starts[pairs + 1], ends[pairs + 1])


def _owners(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Number of the text each position belongs to, where texts stand joined by one byte."""
    return np.searchsorted(np.cumsum(lengths + 1), starts, side="right")


def _ragged(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _kept(buckets: int) -> type:
    return np.int16 if buckets <= 1 << 15 else np.int32


def _line_features(buckets: int):
    """(line, ...) to its buckets, one per feature, words first, then pairs."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in sliced(batch, "line", SLICE_BYTES):
                texts = texts_of(rows, "line")
                letters, starts, ends = words_of(b"\n".join(texts))
                owner = _owners(np.array([len(t) for t in texts]), starts)
                pairs = np.flatnonzero(owner[1:] == owner[:-1])
                one, two = _crcs(letters, starts, ends, pairs)
                both, of = np.concatenate((one, two)), np.concatenate((owner, owner[pairs]))
                by_line = np.argsort(of, kind="stable")
                found = (both[by_line] % np.uint32(buckets)).astype(_kept(buckets))
                columns = [rows.column(c) for c in ("h1", "h2", "n")]
                yield pa.record_batch([*columns, _ragged(found, of, len(texts))], names=["h1", "h2", "n", "buckets"])

    return features


def _crossings(buckets: int):
    """(doc_id, text, hashes) to the number of words and the buckets of pairs parted by a line break."""

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in sliced(batch, "text", SLICE_BYTES):
                texts = texts_of(rows, "text")
                data = b"\n".join(texts)
                letters, starts, ends = words_of(data)
                owner = _owners(np.array([len(t) for t in texts]), starts)
                breaks = np.cumsum(np.frombuffer(data, np.uint8) == 10)
                line = breaks[starts] if len(starts) else starts
                pairs = np.flatnonzero((owner[1:] == owner[:-1]) & (line[1:] != line[:-1]))
                first = extend_crc(np.zeros(len(pairs), np.uint32), letters, starts[pairs], ends[pairs])
                two = extend_crc(_space(first), letters, starts[pairs + 1], ends[pairs + 1])
                found = (two % np.uint32(buckets)).astype(_kept(buckets))
                n_words = np.bincount(owner, minlength=len(texts))
                yield pa.record_batch(
                    [rows.column("doc_id"), rows.column("lines"), pa.array(n_words.astype(np.int64)), _ragged(found, owner[pairs], len(texts))],
                    names=["doc_id", "lines", "n_words", "crossings"],
                )

    return cross


def _counts(buckets: int):
    """Occurrences per bucket of a partition's (buckets, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            lists = batch.column("buckets")
            at = lists.flatten().to_numpy().astype(np.int64)
            times = np.repeat(batch.column("n").to_numpy(), lists.value_lengths().to_numpy())
            seen, place = np.unique(at, return_inverse=True)
            add = np.zeros(len(seen), np.int64)
            np.add.at(add, place, times)
            total[seen] += add
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return count


def _sums(gains: np.ndarray, *kept: str):
    """The sum of gains over each row's buckets, and their number."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            run = np.concatenate(([0], np.cumsum(gains[lists.flatten().to_numpy()])))
            ends = np.cumsum(sizes)
            columns = [batch.column(c) for c in kept]
            yield pa.record_batch([*columns, pa.array(run[ends] - run[ends - sizes]), pa.array(sizes)], names=[*kept, "gain", "n_features"])

    return add


def _hashes(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


def _lines() -> Column:
    """Lines that hold anything; others have no features."""
    return F.filter(F.split(ascii_lower(whole()), "\n", -1), lambda x: x != "")


class Counted:
    """A table's texts as line features and document rows, written to the shared folder."""

    def __init__(self, docs: DataFrame, buckets: int):
        ship(docs.sparkSession)
        kind = "array<short>" if _kept(buckets) is np.int16 else "array<int>"
        texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
        counted = texts.select(F.explode(_lines()).alias("line")).groupBy("line").agg(F.count("*").alias("n"))
        hashed = counted.select("line", _hashes(F.col("line")).alias("h"), "n").select("line", "h.*", "n")
        self.lines = write_once(hashed.mapInArrow(_line_features(buckets), f"h1 long, h2 long, n long, buckets {kind}"), "line-features")
        of_doc = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.transform(_lines(), _hashes).alias("lines"))
        schema = f"doc_id long, lines array<struct<h1:long,h2:long>>, n_words long, crossings {kind}"
        rows = of_doc.mapInArrow(_crossings(buckets), schema)
        self.rows = write_once(rows.withColumn("row", F.monotonically_increasing_id()), "document-lines")
        self.buckets = buckets

    def counts(self) -> np.ndarray:
        """Features per bucket."""
        crossings = self.rows.select(F.col("crossings").alias("buckets"), F.lit(1).cast("long").alias("n"))
        parts = self.lines.select("buckets", "n").unionByName(crossings).mapInArrow(_counts(self.buckets), "bucket long, n long")
        out = np.zeros(self.buckets, np.int64)
        for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():  # at most one row per bucket
            out[bucket] = n
        return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    s, t, n = source.astype(np.float64), target.astype(np.float64), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def _floor_div(a: Column, b: Column) -> Column:
    return ((a - F.pmod(a, b)) / b).cast("long")


def _gain_per_row(counted: Counted, gains: np.ndarray, heavy: int) -> DataFrame:
    """(row, gain, n_features) of the lines within each document."""
    lines = write_once(counted.lines.mapInArrow(_sums(gains, "h1", "h2", "n"), "h1 long, h2 long, n long, gain long, n_features long"), "line-gains")
    occurrences = lines.agg(F.sum("n")).first()[0] or 0
    # Fewer than ``heavy`` lines can each make up more than one heavy-th of all.
    frequent = F.broadcast(lines.where(F.col("n") * heavy > occurrences).drop("n"))
    places = counted.rows.select("row", F.inline("lines"))
    often = places.join(frequent, ["h1", "h2"])
    seldom = places.join(frequent.select("h1", "h2"), ["h1", "h2"], "left_anti").join(lines.where(F.col("n") * heavy <= occurrences).drop("n"), ["h1", "h2"])
    return often.unionByName(seldom).groupBy("row").agg(F.sum("gain").alias("gain"), F.sum("n_features").alias("n_features"))


def weigh(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, heavy: int = HEAVY) -> DataFrame:
    """(row, doc_id, n_words, n_features, weight) of every document."""
    counted = Counted(docs, buckets)
    aimed = Counted(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets)
    gains = gains_of(counted.counts(), aimed.counts())
    crossing = counted.rows.select("row", "doc_id", "n_words", F.col("crossings").alias("buckets"))
    across = crossing.mapInArrow(_sums(gains, "row", "doc_id", "n_words"), "row long, doc_id long, n_words long, gain long, n_features long")
    within = _gain_per_row(counted, gains, heavy).toDF("row", "line_gain", "n_line")
    add = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    both = across.join(within, "row", "left").select("row", "doc_id", "n_words", add("n_features", "n_line"), add("gain", "line_gain"))
    weight = F.when(F.col("n_features") > 0, _floor_div(F.col("gain"), F.col("n_features"))).otherwise(0)
    return both.select("row", "doc_id", "n_words", "n_features", weight.alias("weight"))


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of an id in thousandths, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    share: int = SHARE,
    seed: int = SEED,
    heavy: int = HEAVY,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; ``rank`` counts the drawn ones from 1."""
    weighed = weigh(docs, target, buckets, heavy)
    scored = write_once(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    large = F.col("n_words") >= least_words
    placed = positions(scored.where(large).withColumn("grp", F.lit(0)), ["grp"], [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")], "draw")
    drawn = F.floor(F.col("total") * share / 100)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    ranked = placed.select(*columns, F.when(F.col("pos") < drawn, F.col("pos") + 1).alias("rank"))
    return ranked.unionByName(scored.where(~large).select(*columns, F.lit(None).cast("long").alias("rank")))
