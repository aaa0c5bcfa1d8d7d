"""Every query and stage over nulls, empty and long texts, repeats, clashing columns and empty tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from llm_tables import nasty_docs
from runledger.llm import registry

DOCS = nasty_docs()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_empty_tables(spark, nothing, name):
    assert registry.QUERIES[name](spark, nothing).count() == 0


def ids(rows, column="doc_id"):
    return Counter(r[column] for r in rows)


WANT = Counter(r[0] for r in DOCS)


def test_shards(spark, nasty):
    rows = registry.QUERIES["op1_hilbert_shards"](spark, nasty).collect()
    assert ids(rows) == WANT
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in DOCS)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    placed = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve_index for r in placed] == sorted(r.curve_index for r in rows)


def test_token_files(spark, nasty):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = registry.QUERIES["op4_token_files"](spark, nasty).collect()
    got = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    encode = lambda x: t.encode(x or "", add_special_tokens=False).ids + [1]
    want = Counter((d, len(e := encode(x)), zlib.crc32(np.array(e, "<u4").tobytes())) for d, x, *_ in DOCS)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want


def test_pieces(spark, nasty):
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    hexed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = registry.QUERIES["op6_sentencepiece"](spark, nasty).collect()
    want = Counter((d, len(e := m.encode(t or "", add_eos=True)), hexed(" ".join(map(str, e))), hexed(m.decode(e)), len((t or "").encode())) for d, t, *_ in DOCS)
    assert Counter(tuple(r) for r in rows) == want


def test_quality(spark, nasty):
    rows = registry.QUERIES["op7_quality"](spark, nasty).collect()
    assert ids(rows) == WANT and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_pii_and_secrets(spark, nasty):
    rows = registry.QUERIES["op8_pii"](spark, nasty).collect()
    assert ids(rows) == WANT
    (one,) = [r for r in rows if r.doc_id == 10]
    assert one.spans == "email:5:22,ip:46:54,card:57:76,phone:27:44"
    rows = registry.QUERIES["op9_secrets"](spark, nasty).collect()
    assert ids(rows) == WANT
    (one,) = [r for r in rows if r.doc_id == 11]
    assert (one.n_assign, one.n_access, one.n_hex) == (1, 1, 1) and one.spans == "assign:0:22,access:24:44,hex:45:93"


def test_simhash(spark, nasty):
    rows = registry.QUERIES["op10_simhash"](spark, nasty).collect()
    assert ids(rows) == WANT
    of = {r.doc_id: r for r in rows}
    assert of[0].fingerprint == of[1].fingerprint == of[2].fingerprint == "0" * 16 and of[2].component_id == 0
    assert {of[i].component_id for i in (100, 101, 104)} == {100}


def test_decontamination(spark, nasty):
    assert registry.QUERIES["op5_decontamination"](spark, nasty).count() == 0


def test_pages(spark, nasty):
    rows = registry.QUERIES["op3_template_text"](spark, nasty).collect()
    got = Counter((r.page_id, r.text, r.n_chars) for r in rows)
    assert got[0, "Head 0 One & two three 0", 24] == 2 and got[7, "", 0] == 1 and got[8, "", 0] == 1 and got[None, "plain text", 10] == 1
    (one,) = [r for r in rows if r.page_id == 10]
    assert one.text == " ".join(["alone", *["deep"] * 3000])


def test_vectors(spark, nasty):
    rows = registry.QUERIES["op2_hnsw"](spark, nasty).collect()
    of = Counter(r.query_id for r in rows)
    assert set(of) == {0, 50, 100, 150, 200, 250, 1000, 2200} and all(of[q] == 5 for q in (0, 50, 100, 1000)) and of[2200] == 1
    assert [r.vec_id for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == 50] == [1000, 1001, 1002, 1003, 1004]
    near = [r.vec_id for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == 1000]
    assert near == [50, 50, 1001, 1002, 1003]  # equal vectors, the smaller ids first; a repeated row counts twice


def test_pipeline_stages(spark, nasty, nothing):
    docs = spark.read.parquet(f"{nasty}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, nasty)
        if k < 4:
            assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r.doc_id in WANT for r in rows)
    none = spark.read.parquet(f"{nothing}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, nothing).count() == 0


def test_pipeline_takes_effect(spark, nasty):
    docs = spark.read.parquet(f"{nasty}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    one = stages["near_duplicates"](spark, docs, nasty).collect()
    assert sum(r.doc_id in (100, 101, 102, 103, 104, 200) or (r.doc_id is None and r.text) for r in one) <= 2
    assert ids(one)[100] == 1 and ids(one)[0] == 1 and ids(one)[1] == 0
    clean = {r.doc_id: r for r in stages["secret_scan"](spark, docs, nasty).collect()}
    assert clean[11].text == "[SECRET]\" [SECRET] [SECRET]" and clean[11].n_chars == len(clean[11].text)
    assert re.search("hunter", " ".join(r.text or "" for r in clean.values())) is None
    assert clean[10].text == DOCS[10][1]
