"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct words and their first 4, 5 and 6 bytes, hashed into ``SLOTS``
numbers; a text of n terms gives each the value 1 / sqrt(n).  The machine has a weight and
``FACTORS`` factors for every slot, so it learns pairs of terms besides single ones, also pairs
whose terms are as frequent in both labels.  It is fitted on a bounded sample: per label, the
``sample_per_label`` documents with the least hash of their id, of each at most ``SLOTS`` numbers.
The fit is one task over that sample.  All terms of it take part; numbers that do not earn their ``SHRINK`` go back to 0, and
slots that the sample never met stay at 0.  The fitted model has a fixed size (9 MB) whatever the
input; scoring covers every whole text.

Labels are read from ``labels`` (rows with a null id or label, and ids with both labels, are left
out) and only for documents that ``learn`` lets through; of rows with one id the sample takes that with the
least hash of its text, so it has 2 x ``sample_per_label`` rows at most.  Without both labels in the sample every
score is 0.  Null and empty texts have no terms: their score is the bias.  Each row is scored by
itself, repeated or not; null ids count as held out.  An empty table gives no rows.  Columns other
than ``doc_id`` and ``text`` are ignored.  Of a very long text a worker holds the text and its distinct terms, in slices of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirhouse.llm.common import WORD_BYTES, drop_caches, quoted, ship, sliced, texts_of, write_once

SLOTS = 1 << 18
FACTORS = 8
SAMPLE_PER_LABEL = 6000
PASSES = 8
BATCH = 128
RATE = 0.2
FACTOR_RATE = 0.04
SHRINK = 2e-4
DECAY = 1e-4
KNOWN_WORDS = 50_000
SLICE_BYTES = 4 << 20
PREFIXES = (4, 5, 6)


def word_terms(word: bytes) -> tuple[int, ...]:
    """Hashed numbers of a word and its beginnings."""
    found = [xxhash.xxh32_intdigest(word, 1) % SLOTS]
    found += [xxhash.xxh32_intdigest(word[:n], 2 + n) % SLOTS for n in PREFIXES if len(word) >= n]
    return tuple(dict.fromkeys(found))


class Terms:
    """Distinct terms of texts; words seen before are not hashed again."""

    def __init__(self):
        self.known: dict[bytes, tuple[int, ...]] = {}

    def of(self, text: bytes) -> np.ndarray:
        known, found = self.known, set()
        for w in set(text.translate(WORD_BYTES).split()):
            terms = known.get(w)
            if terms is None:
                terms = word_terms(w)
                if len(known) < KNOWN_WORDS:
                    known[w] = terms
            found.update(terms)
        return np.sort(np.fromiter(found, np.int32, len(found)))


def _sums(table: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's sums of its terms' weights and factors, and what its pairs of terms add up to."""
    n = len(lengths)
    text = np.repeat(np.arange(n), lengths)
    value = 1 / np.sqrt(np.maximum(lengths, 1))
    sums, pairs = np.empty((len(table), n)), np.zeros(n)
    for f, row in enumerate(table):
        own = row[at]
        sums[f] = np.bincount(text, own, n) * value
        if f:
            pairs += (sums[f] ** 2 - np.bincount(text, own.astype(float) ** 2, n) * value**2) / 2
    return sums, pairs


@dataclass
class Machine:
    """``table`` holds the weights, then the factors, of all slots."""

    bias: float
    table: np.ndarray

    def margin(self, rows: list[np.ndarray]) -> np.ndarray:
        out = [np.zeros(0)]
        for k in range(0, len(rows), BATCH):
            own = rows[k : k + BATCH]
            sums, pairs = _sums(self.table, np.concatenate(own), np.array([len(r) for r in own]))
            out.append(self.bias + sums[0] + pairs)
        return np.concatenate(out)

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def fit_machine(rows: list[np.ndarray], labels: np.ndarray, passes: int = PASSES) -> Machine:
    """Logistic loss with both labels weighing the same, over small batches that come in a fixed
    random order.  Steps are scaled by past gradients, and each number is moved ``SHRINK`` of its
    step towards 0 (and no further)."""
    rng = np.random.default_rng(0)
    table = np.zeros((1 + FACTORS, SLOTS))
    table[1:] = rng.normal(0, 0.1, (FACTORS, SLOTS))
    past, bias, past_b = np.full(table.shape, 1e-6), 0.0, 1e-6
    weigh = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    rate = np.full((1 + FACTORS, 1), FACTOR_RATE)
    rate[0] = RATE
    decay = np.full((1 + FACTORS, 1), 10 * DECAY)
    decay[0] = DECAY
    batches, met = [], np.zeros(SLOTS, bool)
    for ids in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // BATCH)):
        slots, at = np.unique(np.concatenate([rows[i] for i in ids]), return_inverse=True)
        batches.append((ids, np.array([len(rows[i]) for i in ids]), slots, at.astype(np.int32)))
        met[slots] = True
    for _ in range(passes):
        for k in rng.permutation(len(batches)):
            ids, lengths, slots, at = batches[k]
            own = table[:, slots]
            sums, pairs = _sums(own, at, lengths)
            scores = 1 / (1 + np.exp(-np.clip(bias + sums[0] + pairs, -30, 30)))
            error = (scores - labels[ids]) * weigh[ids] / len(ids)
            value = 1 / np.sqrt(np.maximum(lengths, 1))
            each = lambda per_text: np.bincount(at, np.repeat(per_text, lengths), len(slots))  # noqa: E731, B023
            slope = np.empty_like(own)
            slope[0] = each(error * value)
            itself = each(error * value**2)
            for f in range(1, 1 + FACTORS):
                slope[f] = each(error * value * sums[f]) - own[f] * itself
            slope += decay * own
            past[:, slots] += slope**2
            step = rate / np.sqrt(past[:, slots])
            moved = own - step * slope
            table[:, slots] = np.sign(moved) * np.maximum(np.abs(moved) - step * SHRINK, 0)
            past_b += error.sum() ** 2
            bias -= RATE * error.sum() / np.sqrt(past_b)
    table[:, ~met] = 0
    return Machine(float(bias), table.astype(np.float32))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drop_caches()
    terms = Terms()
    for batch in batches:
        found = pa.array([terms.of(t) for t in texts_of(batch, "text")], pa.list_(pa.int32()))
        yield pa.record_batch([batch.column("doc_id"), batch.column("toxic"), found], names=["doc_id", "toxic", "terms"])


def sample(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int) -> DataFrame:
    """(doc_id, text, toxic): the bounded labelled sample."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .where(F.col("toxic") == F.col("most"))
        .where(learn)
        .select("doc_id", "toxic")
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    known = known.join(ids, "doc_id", "left_semi")
    least = lambda y: known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
    chosen = F.broadcast(least(0).unionAll(least(1)))  # at most 2 x per_label pairs of numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    return texts.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def learned_rows(column: str = "doc_id", folds: int = 5) -> Column:
    """Rows whose id's CRC is not 0 modulo ``folds``; the rest are held out."""
    return F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")) % folds != 0


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the machine, or none without both labels."""
    drop_caches()
    toxic, rows = [], []
    for batch in batches:
        toxic.append(batch.column("toxic").to_numpy().astype(float))
        terms = batch.column("terms")
        ends = terms.offsets.to_numpy()
        # a copy, as Arrow would keep a whole batch for each view of it
        values = terms.values.to_numpy()[ends[0] : ends[-1]].copy()
        rows += np.split(values, ends[1:-1] - ends[0]) if len(ends) > 1 else []
    labels = np.concatenate([np.zeros(0), *toxic])
    if len(set(labels)) == 2:
        fitted = fit_machine(rows, labels)
        yield pa.record_batch([pa.array([fitted.bias]), pa.array([fitted.table.tobytes()], pa.binary())], names=["bias", "numbers"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, per_label: int = SAMPLE_PER_LABEL) -> Machine | None:
    """The sample is fitted in one task, as it is bounded; the machine alone, of fixed size, comes to the driver."""
    ship(docs.sparkSession)
    rows = write_once(sample(docs, labels, learned_rows() if learn is None else learn, per_label), "toxic-sample")
    hashed = rows.mapInArrow(_terms, "doc_id long, toxic int, terms array<int>").repartition(1).sortWithinPartitions("doc_id")
    fitted = write_once(hashed.mapInArrow(_fit, "bias double, numbers binary"), "toxic-machine").first()
    if fitted is None:
        return None
    return Machine(fitted["bias"], np.frombuffer(fitted["numbers"], np.float32).reshape(1 + FACTORS, SLOTS))


def _score(machine: Broadcast, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        terms, fitted = Terms(), machine.value
        for batch in batches:
            for part in sliced(batch, "text", SLICE_BYTES):
                score = fitted.score([terms.of(t) for t in texts_of(part, "text")]) if fitted else np.zeros(part.num_rows)
                yield pa.record_batch([*(part.column(c) for c in names), pa.array(score)], names=[*names, "score"])

    return run


def score(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """(doc_id, score) of every row."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # of fixed size
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score(sent, ["doc_id"]), "doc_id long, score double")


def keep_clean(docs: DataFrame, machine: Machine | None, reject_from: float = 0.5) -> DataFrame:
    """``docs`` without those that score ``reject_from`` or more."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # of fixed size
    packed = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    kinds = T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType())])
    scored = packed.mapInArrow(_score(sent, ["row"]), kinds).where(F.col("score") < reject_from)
    return scored.select(*[F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns])
