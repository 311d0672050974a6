"""Substring dedup against windows kept in a dictionary."""

import random

import brute
import pytest

from weirhouse.llm import substring_dedup

SCHEMA = "doc_id long, text string, slice string, shard int, docs string, replies int, n int, hits string"


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "s", 1, "d", 2, 3, "h") for i, t in docs], SCHEMA)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, [list(s) for s in r.spans], r.kept_text) for r in df.collect()), key=str)


def texts():
    """Passages around the window's length at any place, in chains of documents, with repeats inside one document."""
    rnd = random.Random(11)
    word = lambda: rnd.choice(["a", "B", "é", "字", "x,"]) + str(rnd.randrange(400))
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 60, 120, 200)]
    docs = []
    for k in range(120):
        parts = [[word() for _ in range(rnd.randrange(40))]]
        for _ in range(rnd.randrange(3)):
            p = rnd.choice(passages)
            a = rnd.randrange(3)
            parts += [p[a:], [word() for _ in range(rnd.randrange(3))]]
        docs.append((rnd.randrange(-50, 1000), rnd.choice([" ", "\n", " \t", "\x0b"]).join(w for p in parts for w in p)))
    whole = " ".join(passages[4])
    odd = [(None, None), (None, whole), (None, whole), (5, ""), (5, "\n \n"), (6, whole), (6, whole), (6, whole + " " + whole), (2000, "same " * 300), (2001, "\x1c same " + "same " * 120), (2002, whole.upper())]
    long = " ".join(word() for _ in range(30_000))
    return docs + odd + [(3000, long), (3001, "q " + long[: len(long) // 2])]


@pytest.mark.parametrize(("window", "sizes"), [(50, {}), (50, {"slice_bytes": 3000, "shard_runs": 700}), (7, {"slice_bytes": 1, "shard_runs": 5000}), (2, {})])
def test_removed_words(spark, window, sizes):
    docs = texts()
    want = sorted(brute.repeats(docs, window), key=str)
    assert got(substring_dedup.remove_repeats(frame(spark, docs).repartition(3), window, **sizes)) == want
    assert any(r[2] for r in want)


def test_many_copies(spark):
    """One passage in every document, so each run has one entry per slice."""
    passage = " ".join(f"p{k}" for k in range(80))
    docs = [(k, f"own{k} {passage} end{k}") for k in range(400)]
    out = substring_dedup.remove_repeats(frame(spark, docs), slice_bytes=4000)
    assert got(out) == sorted(brute.repeats(docs), key=str) and out.where("n_removed = 80").count() == 399


def test_no_rows(spark):
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0
    assert got(substring_dedup.remove_repeats(frame(spark, [(1, None), (1, "a")]))) == [(1, 0, 0, [], ""), (1, 1, 0, [], "a")]
