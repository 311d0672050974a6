"""Token ids in shards of separately compressed documents with a shared dictionary.

Documents are dealt by ranges of their id and sorted, so the shards of one partition after the
other hold all ids in order.  Ids are serialized as little-endian 16-bit numbers where the
vocabulary allows (else 32-bit); each document is compressed alone with zstandard and a
dictionary trained on serialized documents.  A shard is one binary value:

    magic ``WTS1`` | id width, 1 byte | dictionary hash, 32 bytes | documents, uint32
    | offsets, uint64 x (documents + 1) | lengths in ids, uint32 x documents | frames

so any document is read by its offset without the others.  Shards are bounded in size and rows
of a Parquet table that Spark commits to the shared folder: lost executors leave no broken
files.  ``dictionary`` is a row of its own in a second table.

The dictionary is trained on a bounded sample: the ``sample_docs`` documents with the least hash
of their id, ``sample_bytes`` of each.  It only makes frames smaller.

Null and empty texts hold the end id alone.  Equal ids are ordered by text, null ids come first;
each row is a document.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirhouse.llm import tokens
from weirhouse.llm.common import ship, sliced
from weirhouse.session import scratch_dir

END_ID = 2
MAGIC = b"WTS1"
SHARD_DOCS = 4096
SHARD_BYTES = 4 << 20
SAMPLE_DOCS = 512
SAMPLE_BYTES = 32 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
HEADER = struct.Struct("<4sB32sI")
SHARD_SCHEMA = "part long, shard long, first_start long, n_tokens long, doc_ids array<long>, data binary"


def serialize(ids: np.ndarray, width: int) -> bytes:
    return ids.astype(f"<u{width}").tobytes()


def pack_shard(docs: list[np.ndarray], dictionary: bytes, width: int) -> bytes:
    coder = _compressor(dictionary)
    frames = [coder.compress(serialize(d, width)) for d in docs]
    offsets = np.concatenate(([0], np.cumsum([len(f) for f in frames]))).astype("<u8")
    lengths = np.array([len(d) for d in docs], "<u4")
    head = HEADER.pack(MAGIC, width, hashlib.sha256(dictionary).digest(), len(docs))
    return b"".join([head, offsets.tobytes(), lengths.tobytes(), *frames])


def read_shard(data: bytes, dictionary: bytes, only: int | None = None) -> list[np.ndarray]:
    """All documents' ids, or those of one document alone."""
    magic, width, digest, n = HEADER.unpack_from(data)
    if magic != MAGIC or digest != hashlib.sha256(dictionary).digest():
        raise ValueError("not a shard of this dictionary")
    offsets = np.frombuffer(data, "<u8", n + 1, HEADER.size)
    base = HEADER.size + 8 * (n + 1) + 4 * n
    lengths = np.frombuffer(data, "<u4", n, HEADER.size + 8 * (n + 1))
    coder, out = _decompressor(dictionary), []
    for i in range(n) if only is None else [only]:
        frame = data[base + int(offsets[i]) : base + int(offsets[i + 1])]
        raw = coder.decompress(frame, max_output_size=max(1, width * int(lengths[i])))
        out.append(np.frombuffer(raw, f"<u{width}").astype("<u4"))
    return out


@cache
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_dict_id=False)


@cache
def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def train_dictionary(docs: DataFrame, vocabulary: str, width: int, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """From a bounded sample; empty where the sample is too small to train on."""
    least = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    sample = docs.join(F.broadcast(least.distinct()), "doc_id", "left_semi").select(F.substring(F.coalesce("text", F.lit("")), 1, sample_bytes).alias("text"))
    texts = [r["text"] for r in sample.limit(sample_docs).collect()]
    raw = [x for x in (serialize(np.frombuffer(b, "<u4"), width) for b in tokens.encoder(vocabulary).encode(texts)) if len(x) >= 8]
    if sum(map(len, raw)) < 16 * 1024 or len(raw) < 16:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, raw)) // 8), raw).as_bytes()
    except zstandard.ZstdError:  # too uniform to train on
        return b""


def _write(vocabulary: str, dictionary: bytes, width: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, shard, start = tokens.encoder(vocabulary), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for rows in sliced(batch, "text", SHARD_BYTES):
                for at in range(0, rows.num_rows, SHARD_DOCS):
                    cut = rows.slice(at, SHARD_DOCS)
                    ids = [np.frombuffer(x + end, "<u4") for x in coder.encode(cut.column("text").fill_null("").to_pylist())]
                    n = sum(map(len, ids))
                    yield pa.record_batch(
                        [pa.array([part], pa.int64()), pa.array([shard], pa.int64()), pa.array([start], pa.int64()), pa.array([n], pa.int64()), pa.array([cut.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([pack_shard(ids, dictionary, width)], pa.binary())],
                        names=["part", "shard", "first_start", "n_tokens", "doc_ids", "data"],
                    )
                    shard, start = shard + 1, start + n

    return write


def write_store(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Writes ``path``/shards and ``path``/dictionary."""
    spark, vocabulary = docs.sparkSession, vocabulary or tokens.default_vocabulary()
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    width = 2 if max(tokens.encoder(vocabulary).tokenizer.get_vocab().values()) < 1 << 16 else 4
    dictionary = train_dictionary(rows, vocabulary, width)
    spark.createDataFrame([(bytearray(dictionary),)], "dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    dealt.mapInArrow(_write(vocabulary, dictionary, width, end_id), SHARD_SCHEMA).write.option("compression", "none").parquet(f"{path}/shards")


def _read(dictionary: bytes):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, data = batch.column("doc_ids")[i], batch.column("data")[i].as_py()
                docs = read_shard(data, dictionary)
                lengths = np.array([len(d) for d in docs], np.int64)
                starts = batch.column("start")[i].as_py() + np.cumsum(lengths) - lengths
                yield pa.record_batch(
                    [doc_ids.values, pa.array(starts), pa.array(lengths), pa.array([d.tobytes() for d in docs], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return read


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): from the files alone; start counts the ids of all documents before.

    Ids before a partition are summed over the few per-partition totals, then added to each
    shard's start within its partition."""
    ship(spark)
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()[0])
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards")
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    placed = shards.join(F.broadcast(before), "part").select((F.col("before") + F.col("first_start")).alias("start"), "doc_ids", "data")
    return placed.mapInArrow(_read(dictionary), "doc_id long, start long, n_tokens long, ids binary")


def store_dir(spark: SparkSession) -> str:
    return scratch_dir(spark, "token-store")

