import random

import pytest

from helpers import page, pages, seqs
from weirhouse.functions import times
from weirhouse.operators import stats, visits

T0 = 1_625_227_746_000


def test_entry_flags(spark):
    df = pages(spark, [page("a", 1, 1, None), page("a", 2, 2, ""), page("a", 3, 3, "x")])
    assert seqs(df.filter(visits.is_entry())) == [1, 2]
    assert seqs(df.filter(visits.is_entry(empty_too=False))) == [1]


@pytest.mark.parametrize("slice_ms", [None, 10_000, 1_000, 77])
def test_bounce_edges(spark, slice_ms):
    def emitted(gap, last):
        df = pages(spark, [page("a", T0, 1, None), page("a", T0 + gap, 2, last)])
        return 1 in seqs(visits.bounces(df, 10_000, slice_ms=slice_ms))

    assert not emitted(9_999, "x") and emitted(10_000, "x") and emitted(10_001, "x")
    assert emitted(1, "") and emitted(1, None) and not emitted(0, "x")
    # the last entry page of a mid bounces by timeout
    assert seqs(visits.bounces(pages(spark, [page("a", T0, 1, "")]), slice_ms=slice_ms)) == [1]


def brute_bounces(rows, within):
    out, by_mid = [], {}
    for r in rows:
        by_mid.setdefault(r[0]["mid"], []).append(r)
    entry = lambda r: not r[1]["last_page_id"]
    for group in by_mid.values():
        group.sort(key=lambda r: (r[3], r[4]))
        for a, b in zip(group, group[1:] + [None]):
            if entry(a) and (b is None or entry(b) or b[3] - a[3] >= within):
                out.append(a[4])
    return sorted(out)


def random_pages(seed, n=400, mids=4, span=200_000):
    rnd = random.Random(seed)
    return [
        page(f"m{min(rnd.randrange(mids * 2), mids)}", T0 + rnd.randrange(span), i,
             rnd.choice([None, "", "x", "y"]), is_new=rnd.choice("01"), during=rnd.choice([None, 3]))
        for i in range(n)
    ]


@pytest.mark.parametrize("seed,slice_ms", [(1, None), (2, 10_000), (3, 500), (4, 13)])
def test_bounces_against_brute_force(spark, seed, slice_ms):
    rows = random_pages(seed)
    got = seqs(visits.bounces(pages(spark, rows), 10_000, slice_ms=slice_ms))
    assert got == brute_bounces(rows, 10_000)


def test_bounce_rows_come_whole(spark):
    rows = random_pages(9, n=50)
    whole = {r[4]: r for r in rows}
    for r in visits.bounces(pages(spark, rows)).collect():
        assert r["common"].asDict() == whole[r["seq"]][0] and r["page"].asDict() == whole[r["seq"]][1]


def brute_literal(rows):
    last, out = {}, []
    for r in sorted(rows, key=lambda r: (r[3], r[4])):
        mid, sec = r[0]["mid"], r[3] // 1000
        if not r[1]["last_page_id"] or mid not in last:
            last[mid] = sec
            out.append(r[4])
        elif last[mid] != sec:
            out.append(r[4])
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_literal_visits_against_brute_force(spark, seed):
    rows = random_pages(seed, span=60_000)
    want = brute_literal(rows)
    assert len(want) < len(rows)
    assert seqs(visits.unique_visits(pages(spark, rows), "literal")) == want


def test_day_turns_at_midnight_of_the_shop(spark):
    midnight = times.DAY_MS * 18_000 - times.ZONE_MS
    df = pages(spark, [page("a", midnight - 1, 1), page("a", midnight, 2), page("a", midnight + 5, 3),
                       page("a", midnight + times.DAY_MS, 4), page("b", midnight + 7, 5)])
    assert seqs(visits.unique_visits(df)) == [1, 2, 4, 5]
    with pytest.raises(ValueError):
        visits.unique_visits(df, "week")


def test_stats_of_one_window(spark):
    t = 1_700_000_000_000
    rows = [page("a", t, 1, None, during=5), page("a", t + 1_000, 2, "x", during=None),
            page("b", t + 9_999, 3, "", during=7), page("b", t + 10_000, 4, "y")]
    out = stats.visitor_stats(pages(spark, rows)).orderBy("stt").collect()
    assert [tuple(r) for r in out] == [
        ("2023-11-15 06:13:20", "2023-11-15 06:13:30", "v", "c", "a", "0", 2, 3, 1, 0, 12, t + 9_999),
        ("2023-11-15 06:13:30", "2023-11-15 06:13:40", "v", "c", "a", "0", 0, 1, 0, 0, 1, t + 10_000),
    ]
