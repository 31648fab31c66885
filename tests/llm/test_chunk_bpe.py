"""Chunked encoding against the tokenizers library, and decoding against its decode."""

import random
from hashlib import sha256

import numpy as np
import pytest
from helpers import DOCS, corpus, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sediment.llm import chunk_bpe
from sediment.llm.tokens import vocabulary

ALPHABET = "aabBsStTllvedm09 \n\t\r,.'''!-s\x1c\x85\xa0 éÉ́日本“”Σσ　²½ſİ_"
PLAIN = Tokenizer.from_file(vocabulary(chunk_bpe.VOCAB))


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@pytest.fixture()
def tiny(monkeypatch):
    """Chunks of a few bytes, so that joins fall everywhere."""
    monkeypatch.setattr(chunk_bpe, "BITS", 2)
    monkeypatch.setattr(chunk_bpe, "LEAST", 17)
    monkeypatch.setattr(chunk_bpe, "MOST", 40)
    return chunk_bpe.ChunkCoder(vocabulary(chunk_bpe.VOCAB))


def check(coder, texts):
    for text, got in zip(texts, coder.encode([t.encode() for t in texts]), strict=True):
        assert got.tolist() == ids_of(text), text
        assert coder.vocabulary.decode(got) == PLAIN.decode(got.tolist(), skip_special_tokens=False)


def test_joins_are_repaired(tiny):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(400))) for _ in range(800)]
    texts += ["a" * 500, " " * 300, "'" * 200, "\n " * 200, "x'll" * 90, "it's we'll they've " * 20, "日本" * 150,
              "12345678" * 40 + "abc", "", "a", " ", "word " * 5 + "\t" * 100 + "end", "<|endoftext|>",
              "the <|endoftext|> in the middle of a text that is cut into chunks " * 4]
    check(tiny, texts)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.one_of(st.sampled_from(ALPHABET), st.characters(codec="utf-8")),
                              max_size=200), max_size=4))
def test_any_text(texts):
    old = chunk_bpe.BITS, chunk_bpe.LEAST, chunk_bpe.MOST
    chunk_bpe.BITS, chunk_bpe.LEAST, chunk_bpe.MOST = 2, 17, 40
    try:
        check(chunk_bpe.ChunkCoder(vocabulary(chunk_bpe.VOCAB)), texts)
    finally:
        chunk_bpe.BITS, chunk_bpe.LEAST, chunk_bpe.MOST = old


def test_shared_passages_are_encoded_once(tiny):
    rng = random.Random(2)
    passage = " ".join(words(rng, 300))
    texts = [(" ".join(words(rng, 40)) + " " + passage + " " + " ".join(words(rng, 40))).encode() for _ in range(40)]
    check(tiny, [t.decode() for t in texts])
    assert tiny.encoded < len(passage) * 1.2 + sum(len(t) - len(passage) + 80 for t in texts)


def test_chunks_follow_content():
    """The same passage gives the same chunks wherever it stands."""
    rng = random.Random(3)
    passage = " ".join(words(rng, 3000))
    one, two = (chunk_bpe.Pieces([t.encode()]).digests[0] for t in (passage, "another beginning " * 9 + passage))
    assert len(set(one) - set(two)) <= 2 and len(one) > 5


@pytest.mark.parametrize("ids", [[], [50256], [0, 1, 2], [220, 50257, 70000, -1], list(range(0, 50257, 97)), [126, 127, 200]])
def test_decoding(ids):
    own = chunk_bpe.Vocabulary(vocabulary(chunk_bpe.VOCAB))
    known = [i for i in ids if 0 <= i < 50257]
    assert own.decode(np.array(ids, np.int64)) == PLAIN.decode(known, skip_special_tokens=False)


def brute(rows):
    out = []
    for i, t, *_ in rows:
        ids = ids_of(t)
        back = PLAIN.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(back.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows", [corpus(7, 150), odd_rows(), []])
def test_query(spark, rows):
    got = chunk_bpe.contract(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_common_chunks_and_round_trip(spark):
    rng = random.Random(8)
    passage = " ".join(words(rng, 4000))
    rows = [(i, f"{i} {passage} {i}", "en", "a", 0) for i in range(30)]
    docs = spark.createDataFrame(rows, DOCS).repartition(6)
    common = chunk_bpe.common_chunks(docs.select("text"))
    assert len(common) > 5
    assert len(chunk_bpe.common_chunks(docs.select("text"), most_bytes=2000)) < len(common)
    tokens = chunk_bpe.encode(docs)
    assert {r["doc_id"]: r["ids"] for r in tokens.collect()} == {i: ids_of(t) for i, t, *_ in rows}
    assert {tuple(r) for r in chunk_bpe.decode(tokens).collect()} == {r[:2] for r in rows}


def test_other_columns_play_no_part(spark):
    rows = corpus(9, 10)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], DOCS + ", ids int, key int")
    assert sorted(map(tuple, chunk_bpe.contract(docs).collect()), key=repr) == brute(rows)
