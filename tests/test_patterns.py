"""Declared patterns against a plain walk over each key's records."""

import random

import pytest
from helpers import page, pages, seqs
from pyspark.sql import functions as F

from weirhouse.operators import patterns, visits
from weirhouse.operators.patterns import Pattern

ON = lambda name: F.col("page.page_id") == name


def rows_of(seed, n=500):
    rnd = random.Random(seed)
    return [page(f"m{rnd.randrange(3)}", rnd.randrange(0, 40_000), k, rnd.choice([None, "home"]), page_id=rnd.choice(["a", "a", "b", "c", None])) for k in range(n)]


def walk(rows, steps, within):
    by_mid = {}
    for r in rows:
        by_mid.setdefault(r[0]["mid"], []).append(r)
    out = []
    for seen in by_mid.values():
        seen.sort(key=lambda r: (r[3], r[4]))
        for i, first in enumerate(seen):
            if not steps[0](first):
                continue
            for k in range(1, len(steps) + 1):
                if k == len(steps):
                    out.append((first[4], "match", k))
                elif i + k == len(seen) or (within is not None and seen[i + k][3] - first[3] >= within):
                    out.append((first[4], "timeout", k))
                    break
                elif not steps[k](seen[i + k]):
                    break
    return sorted(out)


@pytest.mark.parametrize("slice_ms", [1, 40, 1000, 100_000])
@pytest.mark.parametrize("within", [1, 120, None])
def test_three_steps(spark, slice_ms, within):
    rows = rows_of(slice_ms + (within or 0))
    pattern = Pattern.begin("one", ON("a")).next("two", ON("a") | ON("b")).next("three", ON("c"))
    pattern = pattern if within is None else pattern.within(within)
    found = patterns.find_pattern(pages(spark, rows), pattern, F.col("common.mid"), slice_ms=slice_ms)
    on = lambda *names: lambda r: r[1]["page_id"] in names
    want = walk(rows, [on("a"), on("a", "b"), on("c")], within)
    assert sorted((r.seq, r.outcome, r.steps) for r in found.collect()) == want


def test_one_step_and_names(spark):
    rows = rows_of(3, 50)
    found = patterns.find_pattern(pages(spark, rows), Pattern.begin("only", ON("a")), F.col("common.mid"))
    assert seqs(found) == sorted(r[4] for r in rows if r[1]["page_id"] == "a") and found.where("outcome <> 'match'").isEmpty()
    with pytest.raises(ValueError, match="named"):
        Pattern.begin("x", ON("a")).next("x", ON("b"))


@pytest.mark.parametrize("within", [1, 80, 10_000])
def test_bounces_as_a_pattern(spark, within):
    df = pages(spark, rows_of(within))
    found = patterns.find_pattern(df, visits.bounce_pattern(within), F.col("common.mid"), slice_ms=500)
    assert seqs(found) == seqs(visits.bounces(df, within))
