import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sieveline.llm import bpe

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(bpe.DEFAULT_VOCAB)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def mine(texts):
    flat, counts = bpe.bpe(bpe.DEFAULT_VOCAB).encode(texts)
    ends = np.cumsum(counts)
    return [flat[e - n : e].tolist() for e, n in zip(ends, counts)]


EDGES = ["", None, " ", "\n\n\t ", "<|endoftext|>", "a" * 3000, "ab" * 2000 + "c", "漢字かな" * 1500, "don't I'll 've", "é‍﻿", "👩‍👩‍👧 x", "x" * 513 + "é" * 600, "\x00\x01", "a b  c   d    "]


def test_edges(reference):
    assert mine(EDGES) == reference(EDGES)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text("abcde '\n1", max_size=700)), max_size=12))
def test_random_texts(texts):
    t = tokenizers.Tokenizer.from_file(bpe.DEFAULT_VOCAB)
    t.encode_special_tokens = True
    texts = [x for x in texts if not any(0xD800 <= ord(c) < 0xE000 for c in x)]
    assert mine(texts) == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_TOKENS", 10)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 30)
    model = bpe.ByteBPE(bpe.DEFAULT_VOCAB)
    texts = [f"word{i} other{i * 7} thing" for i in range(50)]
    flat, counts = model.encode(texts)
    again, _ = bpe.bpe(bpe.DEFAULT_VOCAB).encode(texts)
    assert flat.tolist() == again.tolist() and counts.sum() == len(flat)


def test_documents(spark, rows, reference):
    df = spark.createDataFrame([(1, "a b", "x"), (2, "", "y"), (3, None, "z"), (1, "a b", "x")], "doc_id bigint, text string, ids string")
    got = rows(bpe.encode_documents(df, "doc_id", "text"))
    assert got == [(1, reference(["a b"])[0])] * 2 + [(2, []), (3, [])]
    assert bpe.encode_documents(df.limit(0), "doc_id", "text").count() == 0
    counted = bpe.count_tokens(df.withColumnRenamed("ids", "n_tokens"), "text")
    assert sorted(counted.columns) == ["doc_id", "n_tokens"] and sorted(r["n_tokens"] for r in counted.collect()) == [0, 0, 2, 2]


def test_decoded_again(spark, rows, tmp_path):
    import json

    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGES)], "doc_id bigint, text string")
    back = dict(rows(bpe.decode_documents(bpe.encode_documents(df, "doc_id", "text"), "doc_id", "ids")))
    assert back == {i: t or "" for i, t in enumerate(EDGES)}
    path = tmp_path / "twice.json"
    letters = {c: i for i, c in enumerate(bpe.byte_alphabet())}
    path.write_text(json.dumps({"model": {"vocab": letters | {"ab": 256, "bc": 257, "abc": 258}, "merges": ["a b", "b c", "a bc", "ab c"]}}))
    with pytest.raises(ValueError):
        bpe.ByteBPE(str(path))
