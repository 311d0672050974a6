"""Importance resampling against plain counts."""

import random
import zlib

import brute
import numpy as np
import pytest

from weirhouse.llm import importance

SCHEMA = "doc_id long, text string, lines string, row int, h1 string, n int, line string, gain string, score int, grp int"


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "l", 1, "h", 2, "x", "g", 3, 4) for i, t in docs], SCHEMA)


def texts():
    rnd = random.Random(5)
    words = ["alpha", "Beta", "gamma-ray", "ÜBER", "x", "42", "字", "it's"]
    lines = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(9))) for _ in range(30)]
    docs = [(k, "\n".join(rnd.choice(lines) for _ in range(rnd.randrange(8)))) for k in range(150)]
    long_word = "w" * 100_000
    odd = [(None, None), (None, "a b " * 20), (None, "a b " * 20), (7, ""), (7, "\n\n \n"), (200, "one\n\n--\ntwo\r\nthree"), (201, f"{long_word} b\n{long_word}"), (202, "\n".join([lines[0]] * 5000)), (203, "x " * 60_000)]
    return docs + odd


ITEMS = [(1, "alpha Beta\ngamma"), (2, None), (3, ""), (4, "字 字 字")]


@pytest.mark.parametrize(("buckets", "heavy"), [(10_000, 1000), (97, 3), (40_000, 1)])
def test_resample(spark, buckets, heavy):
    docs = texts()
    out = importance.resample(frame(spark, docs).repartition(3), frame(spark, ITEMS), buckets=buckets, heavy=heavy)
    want = brute.resample(docs, ITEMS, buckets)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str) and any(r[5] for r in want)


def test_empty_tables(spark):
    none = frame(spark, [])
    assert importance.resample(none, frame(spark, ITEMS)).count() == 0
    docs = texts()
    assert sorted(map(tuple, importance.resample(frame(spark, docs), none).collect()), key=str) == sorted(brute.resample(docs, []), key=str)


def test_all_are_drawn_in_order(spark):
    docs = texts()
    out = importance.resample(frame(spark, docs), frame(spark, ITEMS), least_words=0, share=100).collect()
    assert sorted(r.rank for r in out) == list(range(1, len(docs) + 1))
    by_rank = sorted(out, key=lambda r: r.rank)
    assert all(a.score >= b.score for a, b in zip(by_rank, by_rank[1:]))


def test_crc_of_words_and_pairs():
    text = ("Ab c " + "d" * 63 + " " + "e" * 64 + " " + "f" * 65 + " é g").encode()
    letters, starts, ends = importance.words_of(text)
    one, two = importance._crcs(letters, starts, ends, np.arange(len(starts) - 1))
    words = [letters[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert one.tolist() == [zlib.crc32(w) for w in words]
    assert two.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:])]
