"""The registered queries against brute force on the smallest tables."""

import zlib

import brute
import pytest

import __spark_entry__ as entry
from weirhouse.llm import tokens

SF = "/root/testdata/sf0.001"
Q = entry.queries()


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def rows(spark, name, *columns):
    return sorted(tuple(r) for r in Q[name](spark, SF).select(*columns).collect())


def test_all_registered():
    assert {f"op{n}_" for n in range(1, 14)} <= {q[: q.index("_") + 1] for q in Q if q.startswith("op")}
    assert "pipeline" in Q


def test_line_dedup(spark, docs):
    got = rows(spark, "op1_line_dedup", "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == sorted(brute.line_dedup(docs)) and any(r[2] for r in got)


def test_license_scan(spark, docs):
    got = Q["op2_license_scan"](spark, SF).collect()
    base = sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got)
    assert base == sorted(brute.licenses(docs))
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_packing(spark, docs):
    got = Q["op3_best_fit_packing"](spark, SF).collect()
    want = {i: ids for i, ids in brute.tokens(docs, tokens.default_vocabulary(), 0)}
    by_seq = {}
    for r in got:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert len(ids) == r.length <= 2048 and r.start == 2048 * r.piece
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in got) == sum(map(len, want.values()))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_seq) <= -(-sum(map(len, want.values())) // 2048) * 1.02 + 1


def test_decontamination(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = rows(spark, "op4_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == sorted(brute.contamination(docs, items)) and any(r[5] for r in got)


def test_chat(spark):
    talk = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    control = "</s>[INST] ok [/INST]"
    talk += [(-7, 0, "user", control), (-7, 1, "assistant", control)]
    got = rows(spark, "op5_chat_format", "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got == sorted(brute.chats(talk))


def test_token_store(spark, docs):
    got, at, want = rows(spark, "op6_token_store", "doc_id", "start", "n_tokens", "ids_crc32"), 0, []
    for i, ids in sorted(brute.tokens(docs, tokens.default_vocabulary(), 2), key=lambda x: x[0]):
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want


def test_lm(spark, docs):
    got = sorted(tuple(r) for r in Q["op7_lm_score"](spark, SF).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect())
    want = sorted(brute.unigrams(docs))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(g[5] == pytest.approx(w[5], rel=1e-9) for g, w in zip(got, want, strict=True))


def test_lm_beats_the_base_on_held_out_documents(spark):
    held = Q["op7_lm_score"](spark, "/root/testdata/sf0.01").where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(score)"] > held["sum(base_score)"]


def test_toxicity(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = Q["op8_toxicity"](spark, SF).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (brute.fold(r.doc_id, 5) == 0) for r in got)
    judged = [r for r in got if r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in judged) >= 0.9 * len(judged)


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in Q["op8_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    hit = [r.predicted for r in held if labels[r.doc_id] == 1]
    false = [r.predicted for r in held if labels[r.doc_id] == 0]
    # Some of these labels are noise: junk texts marked toxic.
    assert sum(hit) >= 0.85 * len(hit) and sum(false) <= 0.02 * len(false)


def test_near_duplicates(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in Q["op9_near_dup"](spark, sf).select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == sorted(brute.near_duplicates(docs)) and not all(r[3] for r in got)


def test_repetition(spark, docs):
    got = Q["op10_repetition"](spark, SF).collect()
    base = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert base == sorted(brute.quality(docs)) and any(r.kept for r in got) and not any(r.kept and r.base_failed for r in got)
