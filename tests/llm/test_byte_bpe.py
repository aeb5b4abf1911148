"""Byte-level BPE against the tiktoken library and exact round trips."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken

from quayside.llm import byte_bpe

SCHEMA = "doc_id bigint, text string, ids string, n_tokens string, decoded int, `key` string"
TEXTS = [None, "", " ", "  two  spaces ", "tab\tnew\nline\r\n", "<|endoftext|> </s>", "日本語 🎉 é", "a" * 3000, "-=" * 40,
         "don't I'll", " the\x1c\x85x", "thethethethe", " ".join(["wort"] * 9000), "🎉🎉", "日本語 🎉 é"]


@pytest.fixture(scope="module")
def codec():
    with open(byte_bpe.ranks_path(), "rb") as f:
        return byte_bpe.Codec(f.read(), byte_bpe.split_pattern())


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding("own", pat_str=codec.pattern, mergeable_ranks=codec.ranks, special_tokens={})


def make(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y", 1, "k") for i, t in enumerate(texts)], SCHEMA)


def test_ids_equal_tiktoken(codec, reference):
    rng = random.Random(6)
    parts = ["a", "ab", "-", "=", "the", "in", "nin", "é", "日", "🎉", " ", "  ", "\n", "\t", "1", "0", "\xa0", "\x1c", "'s"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(rng.choices(rng.sample(parts, 2), k=rng.randint(4, 50))) for _ in range(3000)]
    texts += [f"a{chr(c)}1 {chr(c)}b  {chr(c)} x!{chr(c)}" for c in (*range(0xD800), *range(0xE000, 0x30000, 7))]
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert codec.decode_bytes(ids) == text.encode()


def test_offsets_and_pieces(codec):
    for text in TEXTS[3:]:
        e = codec.tokenizer.encode(text, add_special_tokens=False)
        ids = np.array(e.ids, dtype=np.uint32)
        starts, ends = codec.offsets(ids, codec.decode_bytes(ids))
        assert list(zip(starts.tolist(), ends.tolist())) == e.offsets
        assert "".join(codec.pieces(ids)) == text
    party = codec.tokenizer.encode("🎉", add_special_tokens=False).ids
    assert len(party) > 1 and codec.pieces(np.array(party))[:-1] == [""] * (len(party) - 1)
    assert codec.decode_bytes(np.array(party[:1])).decode("utf-8", "replace") == "�"


def test_forgetful_workers_give_the_same(codec, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_CHUNKS", 3)
    monkeypatch.setattr(byte_bpe, "BATCH_CHARS", 10)
    assert [None if x is None else x.tolist() for x in codec.encode(TEXTS)] == [
        None if t is None else reference.encode_ordinary(t) for t in TEXTS]


def test_columns(spark, reference):
    docs = make(spark, TEXTS)
    expected = [reference.encode_ordinary(t or "") for t in TEXTS]
    got = byte_bpe.verify(docs)
    assert got.columns == ["doc_id", "text", "ids", "decoded", "key", "n_tokens", "ids_sha256", "decoded_sha256",
                           "n_split", "round_trip"]
    for r in got.collect():
        ids, text = expected[r.doc_id], (TEXTS[r.doc_id] or "").encode()
        assert r.n_tokens == len(ids) and r.round_trip
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text).hexdigest()
        assert (r.n_split > 0) == any(len(reference.decode_single_token_bytes(i).decode("utf-8", "ignore").encode())
                                      != len(reference.decode_single_token_bytes(i)) for i in ids)
    both = {r.doc_id: r for r in byte_bpe.decode(byte_bpe.encode(docs)).collect()}
    for i, t in enumerate(TEXTS):
        r = both[i]
        assert r.decoded_text == t and (None if t is None else "".join(r.pieces)) == t
        assert (None if r.decoded is None else bytes(r.decoded)) == (None if t is None else t.encode())
        assert r.ids == (None if t is None else expected[i]) and (t is None or len(r.starts) == len(r.ids))
    none = byte_bpe.decode(byte_bpe.encode(make(spark, [])))
    assert none.count() == 0 and byte_bpe.verify(make(spark, [])).count() == 0
