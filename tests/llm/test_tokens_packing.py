"""Token files, packing and sharding: exact round trips and brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import DOCS, corpus, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sediment.llm import packing, sharding, token_files, tokens

ALPHABET = "abAB09 \n\t\r,.'!-s\x1c\x85\xa0 éÉ́日本“”Σσ　²½ſİ_"


def plain(name: str):
    own = Tokenizer.from_file(tokens.vocabulary(name))
    return lambda t: own.encode(t or "", add_special_tokens=False).ids


@pytest.fixture(scope="module", params=sorted(tokens.KINDS))
def both(request):
    return plain(request.param), tokens.ChunkEncoder(tokens.vocabulary(request.param), *tokens.KINDS[request.param])


def test_chunked_encoding_is_the_library_s(both):
    want, coder = both
    rng = random.Random(2)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["it's we'll 's''t", "<|endoftext|> x", "y" * 500, None, "", "  \n\n ", "a\n b\n  c"]
    for t, got in zip(texts, coder.encode(pa.array(texts), 7), strict=True):
        assert got.tolist() == [*want(t), 7]


@settings(max_examples=200, deadline=None)
@given(t=st.text(max_size=60))
def test_chunked_encoding_of_any_text(both, t):
    want, coder = both
    assert next(coder.encode(pa.array([t]), 0)).tolist() == [*want(t), 0]


def test_memo_starts_anew_when_full(both, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 50)
    monkeypatch.setattr(tokens, "GROUP_BYTES", 400)
    want, coder = both
    rng = random.Random(3)
    texts = [" ".join(words(rng, 30)) for _ in range(60)]
    assert [g.tolist() for g in coder.encode(pa.array(texts), 1)] == [[*want(t), 1] for t in texts]


@pytest.mark.parametrize("rows", [corpus(3, 80), odd_rows(), []])
def test_token_files_round_trip(spark, rows):
    encode = plain("byte_bpe_50k.json")
    got = token_files.contract(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at, want = 0, Counter()
    for r in order:
        ids = [*encode(r[1]), 0]
        want[r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        at += len(ids)
    assert Counter(tuple(r) for r in got) == want


def test_token_files_prune_by_id(spark, tmp_path):
    path = str(tmp_path / "ids.orc")
    token_files.write_tokens(spark.createDataFrame(corpus(5, 60), DOCS), path)
    one = token_files.read_tokens(spark, path).where("doc_id = 17")
    plan = one._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,17)]" in plan
    assert one.count() == 1


def check_packing(rows, got, capacity):
    encode = plain("word_bpe_49k.json")
    want = Counter()
    for r in rows:
        ids = [*encode(r[1]), 1]
        for n, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at:at + capacity]
            want[r[0], n, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r["length"] for r in got) // capacity)


@pytest.mark.parametrize("rows", [corpus(6, 150), odd_rows(), []])
def test_packing_places_every_piece(spark, rows):
    got = packing.contract(spark.createDataFrame(rows, DOCS)).collect()
    used, least = check_packing(rows, got, packing.CAPACITY)
    assert used <= least + 1


def test_sequences_hold_the_ids(spark):
    rows = corpus(8, 60)
    from sediment.llm.common import written
    cut = written(packing.pieces(spark.createDataFrame(rows, DOCS), 128, with_ids=True), "t-pieces")
    packed = packing.pack(cut, 128)
    got = packed.drop("ids").collect()
    check_packing(rows, got, 128)
    place = {(r["sequence_id"], r["offset"]): r for r in got}
    for s in packing.sequences(packed).collect():
        at = 0
        while at < len(s["ids"]):
            r = place[s["sequence_id"], at]
            own = np.array(s["ids"][at:at + r["length"]], "<u4").tobytes()
            assert zlib.crc32(own) == r["ids_crc32"]
            at += r["length"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=40))
def test_fullest_is_the_fullest(lengths):
    counts, capacity = Counter(lengths), 60
    chosen = packing.fullest(dict(counts), capacity)
    assert max(counts) in chosen and all(n <= counts[k] for k, n in chosen.items())
    rest = list(lengths)
    rest.remove(max(lengths))
    sums = {max(lengths)}
    for x in rest:
        sums |= {s + x for s in sums if s + x <= capacity}
    assert sum(k * n for k, n in chosen.items()) == max(sums)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=200))
def test_patterns_use_every_piece(lengths):
    kinds = packing.patterns(dict(Counter(lengths)), 100)
    used = Counter()
    for times, chosen in kinds:
        assert sum(k * n for k, n in chosen.items()) <= 100
        for k, n in chosen.items():
            used[k] += times * n
    assert used == Counter(lengths)


@pytest.mark.parametrize("rows", [corpus(2, 130), odd_rows(), []])
def test_shards_interleave_sources(spark, rows):
    got = sharding.contract(spark.createDataFrame(rows, DOCS)).collect()
    n = len(rows)
    assert len(got) == n
    sizes = Counter(r["shard"] for r in got)
    assert all(v in (n // 40, -(-n // 40)) for v in sizes.values()) and all(0 <= s < 40 for s in sizes)
    for shard in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sizes[shard]))
    want = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


def test_every_shard_matches_the_mixture(spark):
    rows = [(i, f"t{i}", "en", "abc"[min(2, i % 7)], 2) for i in range(2100)]
    got = sharding.interleave(spark.createDataFrame(rows, DOCS), 10).collect()
    share = Counter(r[3] for r in rows)
    for shard in range(10):
        own = Counter(r["stratum"] for r in got if r["shard"] == shard)
        assert all(abs(own[s] - share[s] / 10) <= 2 for s in share)


def test_written_shards_keep_texts(spark, tmp_path):
    rows = corpus(2, 40)
    df = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", slot int")
    sharding.write_shards(df, str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s")).collect()
    assert Counter(r["text"] for r in back) == Counter(r[1] for r in rows)
    assert {r["shard"] for r in back} == {0, 1, 2, 3}


@pytest.mark.parametrize("name", sorted(tokens.KINDS))
def test_literals_of_added_tokens_are_the_library_s(name):
    own = Tokenizer.from_file(tokens.vocabulary(name))  # as it comes: no flag set
    coder = tokens.ChunkEncoder(tokens.vocabulary(name), *tokens.KINDS[name])
    rng = random.Random(5)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endof text|>", "<|", "|>", "endoftext", " ",
             "\n ", "it's", "Abc", "é", "\xa0", "9", "!"]
    texts = ["abc <|endoftext|> x", "<|endoftext|>", "a<|startoftext|>b", "plain words"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(2000)]
    for t, got in zip(texts, coder.encode(pa.array(texts), 7), strict=True):
        assert got.tolist() == [*own.encode(t, add_special_tokens=False).ids, 7]


def test_sources_of_one_row_are_dealt_over_buckets(spark, monkeypatch):
    """All their fractional ranks are 1/2; the order and the mixture stay as they are."""
    rows = [(i, f"t{i}", "en", f"s{i}" if i % 3 else "big", 2) for i in range(900)]
    docs = spark.createDataFrame(rows, DOCS)
    want = sorted(map(tuple, sharding.interleave(docs, 7).collect()))
    buckets = []
    ranked = sharding.stratified_rank
    monkeypatch.setattr(sharding, "stratified_rank", lambda df, strata, bucket, *a: (
        buckets.append(df.select(bucket.alias("b")).groupBy("b").count()) or ranked(df, strata, bucket, *a)))
    monkeypatch.setattr(sharding, "SHARED_ROWS", 100)
    assert sorted(map(tuple, sharding.interleave(docs, 7).collect())) == want
    assert max(r["count"] for r in buckets[-1].collect()) < 100


def test_stripes_and_row_groups_are_skipped(spark, tmp_path):
    """A filter on doc_id reads one row group by the row index, and none by the Bloom filter."""
    n = 6 * token_files.ROW_STRIDE
    docs = spark.range(n).select((F.col("id") * 2).alias("doc_id"), F.lit("a few words").alias("text"))
    path = str(tmp_path / "t")
    token_files.write_tokens(docs.coalesce(1), path)

    def read(i):
        found = token_files.read_tokens(spark, path).where(F.col("doc_id") == i).select("doc_id", "n_tokens")
        rows = found.collect()
        node = found._jdf.queryExecution().executedPlan()
        assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id" in node.toString()
        while node.children().nonEmpty():
            node = node.children().head()
        return len(rows), node.metrics().get("numOutputRows").get().value()

    hit, scanned = read(2 * (n // 2))
    assert hit == 1 and 0 < scanned <= token_files.ROW_STRIDE
    # Odd ids lie inside the bounds of a row group, but in no Bloom filter (but for one in a hundred).
    assert sum(read(2 * i + 1)[1] == 0 for i in range(100, 112)) >= 10
