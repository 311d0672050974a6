"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import random

import brute
import pytest

import corpus_pipeline
from weirhouse.llm import chat, ctw, decontam, license_scan, line_dedup, near_dup, packing, repetition, token_store, tokens, toxicity

# Columns named like the operators' own.
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, h1 string, shard int, block int, rep long, n long, row string, score string, piece int, word string, key string, found string"
LONG = " ".join(random.Random(3).choice(["alpha", "beta", "gamma", "all rights reserved.", "\n"]) for _ in range(60_000))
TEXTS = [None, "", " \t\n\x0b ", "one", "one\none\n\none", "Ünïcödé ÇA cc BY x", "tie words here", "tie words here", LONG, "<|endoftext|> a's [INST]", "K K k \x00 x"]


def table(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or ""), "h", 1, 2, 3, 4, "r", "s", 5, "w", "k", "f") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, EXTRA)


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, TEXTS)


@pytest.fixture(scope="module")
def odd_ids(spark):
    """Null ids and repeated rows."""
    return table(spark, ["a b c d e f", "a b c d e f", None, "x", "x", "x"], [7, 7, None, None, None, 9])


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, None), (2, 0, 1), (2, 0, 1), (3, 1, 0), (3, 1, 1), (None, 0, 1), (6, 0, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "one"), (2, None), (3, ""), (4, "tie words here"), (4, "tie words here"), (None, "beta beta")], "item_id long, text string")


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def sorted_by_text(rows):
    return sorted(map(tuple, rows), key=str)


def docs(texts=TEXTS):
    return list(enumerate(texts))


def test_line_dedup(spark, odd, odd_ids, none):
    from pyspark.sql import functions as F

    texts = ["Same line \n x", "\tsame LINE\n\ny", "same line", "other"] * 3 + TEXTS
    out = line_dedup.dedup_lines(table(spark, texts), min_docs=3)
    sha = F.sha2(F.encode("kept_text", "UTF-8"), 256)
    assert got(out.select("row.doc_id", "n_lines", "n_dropped", sha), "*") == sorted_by_text(brute.line_dedup(docs(texts), 3))
    # Tiny shards and many copies of each give the same.
    split = line_dedup.dedup_lines(table(spark, texts), min_docs=3, keys_per_shard=2, probes_per_task=1)
    assert got(split.select("row.doc_id", "n_dropped"), "*") == got(out.select("row.doc_id", "n_dropped"), "*")
    assert got(line_dedup.dedup_lines(odd_ids, 3).select("row.doc_id", "n_dropped"), "*") == sorted_by_text([(7, 0), (7, 0), (None, 0), (None, 1), (None, 1), (9, 1)])
    assert line_dedup.dedup_lines(none).count() == 0
    assert line_dedup.drop_lines(odd).columns == odd.columns


def test_rows_of_one_id_are_spread(spark):
    texts = [f"line {k}\nother {k}" for k in range(100)] * 3 + ["same"] * 300
    rows = table(spark, texts, [None] * 600)
    hits = line_dedup.frequent_lines(rows, 3).toDF("row", "h1", "h2").groupBy("row").count().collect()
    assert len(hits) == 101
    assert line_dedup.dedup_lines(rows, 3).where("n_dropped = n_lines").count() == 600
    pieces = packing.write_once(packing.token_pieces(rows.repartition(2)), "pieces")
    placed = packing.place(pieces, block_pieces=60).selectExpr("shiftright(sequence_id, 32) AS block").groupBy("block").count().collect()
    assert len(placed) == 10 and max(r["count"] for r in placed) < 150


def test_license_scan(odd, odd_ids, none):
    out = license_scan.digest(license_scan.scan(odd))
    assert got(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted_by_text(brute.licenses(docs()))
    assert license_scan.scan(odd_ids).count() == 6 and license_scan.digest(license_scan.scan(none)).count() == 0


def test_license_labels(spark):
    text = "x\nLicensed under the Apache License, Version 2.0.\nReleased under the MIT License; CC BY-NC 4.0. All rights reserved"
    row = license_scan.digest(license_scan.scan(table(spark, [text]))).first()
    assert row.base_labels == "cc-by,reserved" and row.labels == "apache-2.0,cc-by,cc-by-nc,mit,reserved" and row.score == pytest.approx(1)


def test_packing(odd, odd_ids, none):
    want = dict(brute.tokens(docs(), tokens.default_vocabulary(), 0))
    rows = packing.pack(odd).collect()
    assert {r.doc_id for r in rows} == set(want) and sum(r.length for r in rows) == sum(map(len, want.values()))
    assert packing.pack(odd_ids).count() == 6 and packing.pack(none).count() == 0


def test_sum_of_squares_prefers_even_gaps():
    import numpy as np

    bins, offsets = packing.sum_of_squares(np.array([6, 6, 4, 4, 10]), 10)
    assert len(set(bins.tolist())) == 3 and offsets.tolist() == [0, 0, 6, 6, 0]


def test_decontamination(odd, odd_ids, none, items):
    want = sorted_by_text((i, n, h, of) for i, n, h, of in plain_items())
    assert got(decontam.find_contamination(odd, items), "doc_id", "n_words", "n_hit", "item_ids") == want
    # One block per item gives the same.
    assert got(decontam.find_contamination(odd, items, block_bytes=1), "doc_id", "n_words", "n_hit", "item_ids") == want
    assert decontam.find_contamination(odd_ids, items).count() == 6 and decontam.find_contamination(none, items).count() == 0
    assert decontam.find_contamination(odd, items.limit(0)).where("n_hit > 0").count() == 0
    clean = decontam.decontaminate(odd, items)
    assert clean.columns == odd.columns and decontam.find_contamination(clean, items).where("n_hit > 0").count() == 0


def plain_items():
    bench = [("1", "one"), ("2", ""), ("3", ""), ("4", "tie words here"), ("", "beta beta")]
    for i, t in docs():
        of = sorted(b[0] for b in bench if b[1] and brute.contamination([(i, t)], [b])[0][5])
        _, n, h, *_ = brute.contamination([(i, t)], bench)[0]
        yield i, n, h, of


def test_suffix_array_and_ranks():
    import numpy as np

    rnd = random.Random(1)
    for _ in range(60):
        s = np.array([rnd.randrange(4) for _ in range(rnd.randrange(1, 40))])
        assert decontam.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        w, c, at = decontam.WaveletMatrix(s, 4), rnd.randrange(4), rnd.randrange(len(s) + 1)
        assert w.rank(np.array([c]), np.array([at]))[0] == (s[:at] == c).sum()


def test_chat(spark):
    rows = [(1, 2, "assistant", "b<|end|>\n\\"), (1, 1, "us|>\ner", None), (1, 1, None, "x"), (1, 1, None, "x"), (None, None, "assistant", ""), (2, 0, "assistant", "é</s>" * 3000)]
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, part int, loss string")
    columns = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    want = sorted_by_text(brute.chats(rows))
    assert got(chat.read_back(chat.format_chats(turns)), *columns) == want
    assert got(chat.read_back(chat.format_chats(turns, part_bytes=1)), *columns) == want
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_token_store(spark, odd, odd_ids, none):
    path = token_store.store_dir(spark)
    token_store.write_store(odd, path)
    want, at = [], 0
    for i, ids in brute.tokens(docs(), tokens.default_vocabulary(), 2):
        want.append((i, at, len(ids), bytearray(ids.tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in token_store.read_store(spark, path).collect()) == want
    for t, n in ((odd_ids, 6), (none, 0)):
        path = token_store.store_dir(spark)
        token_store.write_store(t, path)
        assert token_store.read_store(spark, path).count() == n


def test_ids_are_those_of_the_whole_text():
    from tokenizers import Tokenizer

    path = tokens.default_vocabulary()
    whole = Tokenizer.from_file(path)
    before = ["_", "a_", "\x1c", "a\x1f", "x\x85", "İ", "e\u0301", "ﬁ", "½", "字", "9", "Ünï", "it's", "*", "\u200b", "\t", "\xa0", "a.", "b,", ""]
    texts = [f"{start}{x}{mark} {end}" for x in before for mark in ".," for start in ("", "foo ", "snake_") for end in ("bar", ". z", "_, y")]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [list(memoryview(x).cast("I")) for x in tokens.PieceEncoder(path).encode(texts)] == want


def test_one_document_of_a_shard():
    import numpy as np

    shard = token_store.pack_shard([np.array([1, 2]), np.array([], int), np.array([70, 9])], b"", 2)
    assert token_store.read_shard(shard, b"", only=2)[0].tolist() == [70, 9]
    with pytest.raises(ValueError):
        token_store.read_shard(shard, b"x" * 300)


def test_lm(odd, odd_ids, none):
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    assert got(ctw.score(odd), *columns) == sorted_by_text(r[:5] for r in brute.unigrams(docs()))
    assert ctw.score(odd_ids).count() == 6 and ctw.score(none).count() == 0


def test_lm_is_a_distribution():
    """Over all forms of one hint, probabilities add up to at most 1."""
    import numpy as np

    forms = [b"\0" + w for w in (b"a", b"b", b"ab", b"ba", b"aa", ctw.END)]
    grams, n = ctw.spell(forms)
    u, at = np.unique(grams, return_inverse=True)
    count = np.bincount(at, np.repeat([5, 3, 2, 0, 1, 4], n)).astype(int)
    levels = ctw.subtree(u, count)
    one = levels[-1].above(ctw.SPLIT)
    lp = ctw.gram_log10(u, count, [one, one.above(1)])
    p = 10 ** np.add.reduceat(lp[at], np.cumsum(n) - n)
    assert 0.3 < p.sum() <= 1 and p[0] > p[2] > p[3]


def test_toxicity(odd, odd_ids, none, labels):
    for t, n in ((odd, len(TEXTS)), (odd_ids, 6), (none, 0)):
        rows = toxicity.score(t, toxicity.fit(t, labels)).collect()
        assert len(rows) == n and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.keep_clean(odd, None).columns == odd.columns


def test_factorization_learns_a_pair(spark):
    """Each term is as frequent in both labels; only the two together tell."""
    rnd = random.Random(5)
    rows = []
    for i in range(3000):
        insult, group = rnd.random() < 0.5, rnd.random() < 0.5
        words = [f"filler{rnd.randrange(300)}" for _ in range(15)] + ["insult"] * insult + ["group"] * group
        rows.append((i, " ".join(words), int(insult and group or not insult and not group)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    held = ~toxicity.learned_rows()
    machine = toxicity.fit(docs.drop("toxic"), docs.drop("text"))
    scored = toxicity.score(docs.drop("toxic"), machine).where(held).join(docs.select("doc_id", "toxic"), "doc_id").collect()
    assert len(scored) > 400 and sum((r.score >= 0.5) == r.toxic for r in scored) > 0.97 * len(scored)


def test_rare_terms_are_learned(spark):
    """A slur in fourteen toxic documents and no clean one."""
    rnd = random.Random(6)
    text = lambda: " ".join(f"filler{rnd.randrange(300)}" for _ in range(15))
    rows = [(i, text() + (" slur" if i < 14 else ""), int(i % 2 == 0 or i < 14)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    machine = toxicity.fit(docs.drop("toxic"), docs.drop("text"), toxicity.F.lit(True))
    new = [(f"{i}{end}", base + end) for i, base in enumerate(text() for _ in range(40)) for end in ("", " slur")]
    scores = dict(zip([i for i, _ in new], machine.score([toxicity.Terms().of(t.encode()) for _, t in new]), strict=True))
    assert all(scores[f"{i} slur"] > scores[str(i)] + 0.1 for i in range(40))


def test_margin_is_that_of_all_pairs():
    import numpy as np

    rnd = np.random.default_rng(3)
    m = toxicity.Machine(0.25, rnd.normal(0, 1, (1 + toxicity.FACTORS, 12)).astype(np.float32))
    rows = [np.flatnonzero(rnd.random(12) < 0.5).astype(np.int32) for _ in range(300)] + [np.zeros(0, np.int32)]
    weights, factors = m.table[0].astype(float), m.table[1:].astype(float)

    def margin(row):
        x = 1 / max(len(row), 1) ** 0.5
        pairs = sum(factors[:, i] @ factors[:, j] for n, i in enumerate(row) for j in row[n + 1 :])
        return 0.25 + x * sum(weights[i] for i in row) + x * x * pairs

    assert np.allclose(m.margin(rows), [margin(r) for r in rows], atol=1e-4)


def test_near_duplicates(spark, odd, odd_ids, none):
    rnd = random.Random(2)
    base = [str(rnd.randrange(10**6)) for _ in range(300)]
    texts = [" ".join(base[:k] + [str(rnd.random())] + base[k + 1 :]) for k in range(0, 300, 3)] + [" ".join(base), " ".join(base).upper(), "a b", "A B", "a b c"] + TEXTS
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    want = sorted_by_text(brute.near_duplicates(docs(texts)))
    assert got(near_dup.near_duplicates(table(spark, texts)), *columns) == want
    assert got(near_dup.near_duplicates(table(spark, texts), block=7), *columns) == want
    assert got(near_dup.near_duplicates(odd_ids), "doc_id", "component_id", "kept") == sorted_by_text([(7, 7, True)] * 2 + [(None, None, True)] * 3 + [(9, 9, True)])
    assert near_dup.near_duplicates(none).count() == 0 and near_dup.keep_one(odd).columns == odd.columns


def test_near_duplicates_of_a_large_loose_group(spark):
    """Twins at 0.76 among many others at 0.66, which rank before some of them."""
    rnd = random.Random(31)
    base, word = [f"w{k}" for k in range(300)], lambda: f"x{rnd.randrange(10**9)}"
    texts = []
    for _ in range(120):
        at = [10 * k + rnd.randrange(5) for k in rnd.sample(range(29), 10)]
        family = list(base)
        for k in at[:2]:
            family[k] = word()
        for own in (at[2:6], at[6:]):
            text = list(family)
            for k in own:
                text[k] = word()
            texts.append(" ".join(text))
    out = near_dup.near_duplicates(table(spark, texts))
    assert got(out, "doc_id", "n_shingles", "component_id", "kept") == sorted_by_text(brute.near_duplicates(docs(texts)))


def test_repetition(odd, odd_ids, none):
    short = [(i, t if t is None or len(t) < 1000 else t[:1000]) for i, t in docs()]
    out = repetition.quality(odd.withColumn("text", odd["text"].substr(1, 1000)))
    assert got(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted_by_text(brute.quality(short))
    longest = {r.doc_id: r.longest_repeat for r in out.collect()}
    assert all(longest[i] == brute.longest_repeat((t or "").split()) for i, t in short)
    assert repetition.quality(odd_ids).count() == 6 and repetition.quality(none).count() == 0
    assert not repetition.quality(odd).where(f"doc_id = {TEXTS.index(LONG)}").first().kept


def test_pipeline_stages(spark):
    """Each stage against brute force on its own input."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, sf)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))).collect()}
    pairs = [tuple(r) for r in clean.select("doc_id", "text").collect()]
    assert sorted(i for i, _ in pairs) == sorted(i for i, s in scores.items() if s < 0.5) and clean.columns == docs.columns
    lines = stages["line dedup"](spark, clean, sf)
    kept = {i: sha for i, _, _, sha in brute.line_dedup(pairs)}
    pairs = [tuple(r) for r in lines.select("doc_id", "text").collect()]
    assert {i: brute.sha(t) for i, t in pairs} == kept
    single = stages["near dedup"](spark, lines, sf)
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, _, _, k in brute.near_duplicates(pairs) if k)
    cut = stages["decontamination"](spark, single, sf)
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    before = {r.doc_id: r.text for r in single.collect()}
    after = {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}
    assert set(after) == set(before) and all(n == len(t) for t, n in after.values())
    assert not any(r[5] for r in brute.contamination([(i, t) for i, (t, _) in after.items()], bench))
    dirty = {r[0] for r in brute.contamination(list(before.items()), bench) if r[5]}
    assert all(after[i][0] == t for i, t in before.items() if i not in dirty)
    want = brute.tokens([(i, t) for i, (t, _) in after.items()], tokens.default_vocabulary(), 0)
    assert sum(r.length for r in stages["packing"](spark, cut, sf).collect()) == sum(len(x) for _, x in want)


def test_keep_one_decides_on_rows(spark):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    kept = lambda rows: sorted((r.doc_id, r.text) for r in near_dup.keep_one(table(spark, [t for _, t in rows], [i for i, _ in rows])).collect())
    assert kept([(3, a), (5, a), (5, b)]) == [(3, a), (5, b)]
    assert kept([(3, a), (3, a), (4, ""), (4, "")]) == [(3, a), (4, ""), (4, "")]
    # A leader's id may have another text in the same component: one row stays.
    assert kept([(3, a), (3, a + " x"), (9, a)]) in ([(3, a)], [(3, a + " x")])


def test_near_duplicates_by_exact_links(spark, monkeypatch):
    """Without rounds of proposals all links are found where classes meet."""
    monkeypatch.setattr(near_dup, "PARTNERS", (1,))
    rnd = random.Random(8)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for _ in range(150):
        text = list(base)
        for k in rnd.sample(range(200), rnd.randrange(1, 7)):
            text[k] = f"x{rnd.randrange(10**6)}"
        texts.append(" ".join(text))
    want = sorted_by_text(brute.near_duplicates(docs(texts)))
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    assert got(near_dup.near_duplicates(table(spark, texts)), *columns) == want
    assert got(near_dup.near_duplicates(table(spark, texts), block=16), *columns) == want
    assert len({r[2] for r in want}) > 1


def test_exact_links_are_a_forest():
    import numpy as np

    sets = [np.arange(k, k + 60, dtype=np.uint64) for k in range(0, 40, 2)]
    rows = {
        "rep": np.arange(20), "n": np.full(20, 60), "component": np.arange(20), "block": np.zeros(20, np.int64), "band": np.zeros(20, np.int32),
        "registers": np.zeros((20, near_dup.REGISTERS), np.uint16), "long": np.zeros((20, near_dup.LONG), np.uint8), "set": [x.tobytes() for x in sets],
    }
    a, b = near_dup.exact_links(rows, (0, 0))
    assert len(a) == 19 and near_dup.stars(a, b)[1].tolist() == [0] * 19
    rows["component"] = np.zeros(20, np.int64)
    assert len(near_dup.exact_links(rows, (0, 0))[0]) == 0


def test_decontamination_over_blocks_leaves_no_window(spark):
    p, q = [f"p{k}" for k in range(10)], [f"q{k}" for k in range(10)]
    text = " ".join(p[:5] + q + p[5:])
    items = spark.createDataFrame([(1, " ".join(p)), (2, " ".join(q))], "item_id long, text string")
    for size in (decontam.BLOCK_BYTES, 1):
        assert decontam.decontaminate(table(spark, [text, None]), items, block_bytes=size).first().text.strip() == ""
    blocks = decontam.Blocks(items.union(items).union(items), 70)
    assert len(blocks) > 1 and sum(len(b) for b in blocks) == 6 and all(sum(len(t) for _, t in b) < 140 for b in blocks)


def test_toxicity_keeps_any_column_name_and_samples_rows(spark, labels):
    rows = table(spark, ["a", None]).withColumnRenamed("key", "my col").withColumnRenamed("word", "a`b.c")
    assert toxicity.keep_clean(rows, None).columns == rows.columns and toxicity.keep_clean(rows, None).count() == 2
    many = table(spark, [f"t{k}" for k in range(300)], [2] * 150 + [6] * 150)
    assert toxicity.sample(many, labels, toxicity.F.lit(True), 10).count() == 2


def test_lm_sees_the_word_before(spark):
    """The same words in another order score otherwise, though none of them is unknown."""
    docs = spark.createDataFrame([(n, "red fox blue cat " * 20) for n in range(1, 40)] + [(100, "red cat blue fox " * 20)], "doc_id long, text string")
    by_id = {r.doc_id: r for r in ctw.score(docs).collect()}
    one, other = by_id[1], by_id[100]
    assert one.n_known == other.n_known == one.n_tokens and one.base_score == pytest.approx(other.base_score, rel=0.05)
    assert other.score < 2 * one.score


def test_lm_grams_are_those_of_the_running_text():
    """Grams of the forms, each as often as it comes, are the seven-byte windows of the text."""
    from collections import Counter

    texts = [b"Ab  cd\ne ab cd", b"", "é x é".encode()]
    forms, _, form, times = ctw.forms_of(texts)
    found = Counter()
    for f, n in zip(form.tolist(), times.tolist()):
        for g in ctw.spell([forms[f]])[0].tolist():
            found[g.to_bytes(7, "big")] += n
    want = Counter()
    for t in texts:
        run = b" " * 6 + b"".join(w + b" " for w in t.lower().split()) + b"\n"
        want.update(run[i : i + 7] for i in range(len(run) - 6))
    assert found == want


def lm_texts(n, seed):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choices("abcdefgéK", k=rnd.randint(1, 6))) for _ in range(4000)]
    return [" ".join(vocabulary[min(int(rnd.paretovariate(0.4)), 4000) - 1] for _ in range(400)) for _ in range(n)]


def test_lm_keeps_little_on_disk(spark, monkeypatch):
    """Tables between steps hold packed lists of a slice, no row for each word in its place."""
    import os
    from urllib.parse import unquote, urlparse

    sizes, write = [], ctw.write_once

    def measured(df, name):
        out = write(df, name)
        sizes.append(sum(os.path.getsize(unquote(urlparse(f).path)) for f in out.inputFiles()))
        return out

    monkeypatch.setattr(ctw, "write_once", measured)
    texts = lm_texts(400, 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert ctw.score(docs).count() == 400
    assert sum(sizes) < sum(len(t.encode()) for t in texts)


def test_lm_against_a_plain_tree(spark):
    """Slices of several texts, held out or repeated ones and null ids: each bit mixed over all depths one by one."""
    import math
    from collections import defaultdict

    texts = ["", None, "ab Ab abc", "ab abc ab", "é  aé\nab", *lm_texts(3, 2)[0].split(" ")[:40]]
    rows = [(None if i == 3 else i // 2 if i == 9 else i, t) for i, t in enumerate(texts)]

    def bits(text):
        run = b" " * 6 + b"".join(w + b" " for w in (text or "").encode().lower().split()) + b"\n"
        for at in range(6, len(run)):
            for k in range(8):
                yield run[at - 6 : at], (1 << k) | (run[at] >> (8 - k)), run[at] >> (7 - k) & 1

    seen = defaultdict(lambda: [0, 0])
    for i, t in rows:
        if i is not None and brute.fold(i, 10) != 0:
            for before, start, bit in bits(t):
                for d in range(7):
                    seen[before[6 - d :], start][bit] += 1
    children = defaultdict(set)
    for before, start in seen:
        if before:
            children[before[1:], start].add((before, start))

    def estimate(n0, n1):
        return math.lgamma(n0 + 0.5) + math.lgamma(n1 + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(n0 + n1 + 1)

    def weighted(node):  # ln of the node's own estimate and of what its children make together
        return estimate(*seen[node]), sum(map(block, children[node]))

    def block(node):
        own, below = weighted(node)
        if len(node[0]) == 6:
            return own
        return max(own, below) + math.log1p(math.exp(-abs(own - below))) - math.log(2)

    def score(text):
        total = 0.0
        for before, start, bit in bits(text):
            p = None
            for d in range(6, -1, -1):
                node = (before[6 - d :], start)
                if node in seen:
                    n, (own, below) = seen[node], weighted(node)
                    mine = (n[bit] + 0.5) / (sum(n) + 1)
                    w = 1 / (1 + math.exp(below - own))
                    p = mine if p is None else w * mine + (1 - w) * p
            total += math.log10(0.5 if p is None else p)
        return total

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(((-1 if r.doc_id is None else r.doc_id), r.score) for r in ctw.score(docs).collect())
    want = sorted(((-1 if i is None else i), score(t)) for i, t in rows)
    assert [i for i, _ in found] == [i for i, _ in want]
    assert [x for _, x in found] == pytest.approx([x for _, x in want], rel=1e-6)


def test_lm_sums_over_many_short_texts():
    """More texts than a block numbers: counts of texts that are not held out, sums of each text's own bytes."""
    from collections import Counter

    import numpy as np

    runs = [ctw.run_of(t.encode()) for t in [*lm_texts(1, 3)[0].split(" "), "", " x\ny "] * 2]
    sizes, held = np.array([len(r) for r in runs]), np.arange(len(runs)) % 3 == 0
    padded = [b" " * 6 + r for r in runs]
    each = [[int.from_bytes(p[i : i + 7], "big") for i in range(len(p) - 6)] for p in padded]
    grams, n = ctw.gram_counts(runs, sizes, held)
    learned = Counter(g for gs, out in zip(each, held, strict=True) if not out for g in gs)
    assert len(runs) > 2 * ctw.BLOCK_TEXTS and grams.tolist() == sorted({g for gs in each for g in gs})
    assert n.tolist() == [learned[g] for g in grams.tolist()]
    value = dict(zip(grams.tolist(), range(len(grams))))
    assert ctw.text_sums(runs, sizes, grams, np.arange(len(grams), dtype=float)).tolist() == [sum(value[g] for g in gs) for gs in each]


def test_lm_packs_lists():
    import numpy as np

    for x in ([], [0], [1 << 55, 3, 3], list(range(300))):
        assert ctw.unpack(ctw.pack(np.array(x, np.int64))).tolist() == x
        assert ctw.unpack_sorted(ctw.pack_sorted(np.array(sorted(x), np.int64))).tolist() == sorted(x)
    for words in ([], [b"\n"], [b"a", b"\n", "é".encode()]):
        assert ctw.unpack_words(ctw.pack_words(words)) == words
