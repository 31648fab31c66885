"""BPE encoding and decoding with content-defined chunk reuse.

1. Texts are cut where a rolling hash of the last WINDOW bytes has BITS leading zeros (never inside
   a character, chunks of LEAST to MOST bytes), so equal passages of different documents give
   equal chunks wherever they stand.
2. Every chunk is encoded once.  The chunks that save most (uses x bytes over the whole corpus, up
   to COMMON_BYTES of text, a broadcast bound by that parameter) are counted by digest, encoded
   in one job and sent to all tasks.  A worker keeps the ids of the other chunks it has met in a
   memo of bounded size; only a chunk that is neither common nor in the memo is encoded.  Moving each rare chunk's ids through a shuffle to its few other uses
   would cost more than the text's own bytes, see README.  Inside a new chunk, words that the
   worker has met are looked up (``tokens.ChunkEncoder``), new words go to the library.
3. Joins are repaired.  A text's ids are those of its words one after the other, and whether a
   place is a cut between words can be told from the characters around it (REACH bytes are
   more than enough).  For the join of two chunks, the text from the left chunk's last cut that
   is out of reach of the join is encoded anew, up to AHEAD bytes into the right chunk, and
   further until one of its cuts (out of reach of the window's end) is a cut of the right chunk
   too: from there on both agree exactly.  A window without agreement is doubled, over several
   chunks if need be, at most to the text's end.
4. Decoding joins the bytes of the ids and reads them as UTF-8, ill-formed bytes replaced.

Texts that hold the literal of an added token (as ``<|endoftext|>``, one id) or white space
outside ASCII are encoded whole.

Defined cases: null texts are empty and have no ids; null doc_ids and repeated rows are rows like
any other; ids outside the vocabulary decode to nothing; an empty table gives no rows; other
columns play no part.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import small_batches
from sediment.llm.mph import mix
from sediment.llm.tokens import MEMO, ChunkEncoder, chunks, vocabulary

VOCAB = "byte_bpe_50k.json"
WINDOW, BITS = 16, 10
LEAST, MOST = 256, 4096
REACH = 12  # bytes: three characters at least
AHEAD = 36
GROUP_BYTES = 1 << 20
MEMO_CHUNKS = 8_000
COMMON_BYTES = 8 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_TABLE = mix(np.arange(1, 257, dtype=np.uint64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, GROUP_BYTES * 2)
        for k, base in enumerate((_BASE, _BACK)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[k] = np.cumprod(factors)
    return _POWERS[0][:n], _POWERS[1][:n]


def candidates(data: np.ndarray) -> np.ndarray:
    """Positions at which a chunk may start, by the bytes before them.  Those of the first WINDOW
    bytes of a text also depend on what stands before the text; no chunk starts there."""
    if len(data) <= WINDOW:
        return np.zeros(0, np.int64)
    up, down = _powers(len(data))
    total = np.cumsum(_TABLE[data] * down)
    rolled = (total[WINDOW:] - total[:-WINDOW]) * up[WINDOW:]
    at = np.flatnonzero(rolled < _U(1 << (64 - BITS))) + WINDOW + 1
    at = at[at < len(data)]
    return at[(data[at] & 0xC0) != 0x80]


def _character(data: bytes | np.ndarray, at: int) -> int:
    """``at``, moved back to the start of a character."""
    while int(data[at]) & 0xC0 == 0x80:
        at -= 1
    return at


def cut(data: np.ndarray, begin: int, end: int, found: list[int]) -> list[int]:
    """The starts of the chunks of a text that stands at ``begin``:``end`` in ``data``."""
    starts, last = [begin], begin
    for at in [*found, end]:
        while at - last > MOST:
            last = _character(data, last + MOST)
            starts.append(last)
        if at - last >= LEAST and at < end:
            starts.append(at)
            last = at
    return starts


class Pieces:
    """The chunks of some texts: texts joined, chunk starts of each text, chunk digests."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        joined = b"".join(texts)
        data = np.frombuffer(joined, np.uint8)
        found, ends = candidates(data), np.cumsum([len(t) for t in texts])
        upto = np.searchsorted(found, ends)
        self.starts, self.digests, begin, low = [], [], 0, 0
        for t, end, high in zip(texts, ends.tolist(), upto.tolist(), strict=True):
            starts = cut(data, begin, end, found[low:high].tolist()) if t else []
            own = [a - begin for a in starts]
            self.starts.append(own)
            self.digests.append([xxhash.xxh3_128_digest(t[a:b]) for a, b in pairwise([*own, len(t)])])
            begin, low = end, high

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        """(digest, chunk) of every chunk."""
        for text, starts, digests in zip(self.texts, self.starts, self.digests, strict=True):
            for (a, b), key in zip(pairwise([*starts, len(text)]), digests, strict=True):
                yield key, text[a:b]


class Vocabulary:
    """The bytes of a byte-level vocabulary's ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        own = Tokenizer.from_file(path)
        kind = own.pre_tokenizer
        if not isinstance(kind, ByteLevel) or kind.add_prefix_space or not kind.use_regex or own.normalizer:
            raise ValueError("chunks are repaired for byte-level vocabularies without normalisation only")
        # Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        held = own.get_vocab(with_added_tokens=True)
        size = max(held.values()) + 1
        spelled = [b""] * size
        for token, i in held.items():
            spelled[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for i, t in own.get_added_tokens_decoder().items():
            spelled[i] = t.content.encode()
        self.spelled = spelled
        if size > 1 << 16:
            raise ValueError("ids are kept in 16 bits")

    def decode(self, ids: np.ndarray) -> str:
        known = ids[(ids >= 0) & (ids < len(self.spelled))]
        return b"".join(map(self.spelled.__getitem__, known.tolist())).decode("utf-8", "replace")


class WordCoder(ChunkEncoder):
    """Encodes chunks: their words that the worker has met are looked up, others go to the library."""

    def whole(self, text: bytes) -> np.ndarray | None:
        """The ids of a text that cannot be cut, else None."""
        return self._encode([text.decode()])[0] if self._whole(text) else None

    def words(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Each text's ids, and its cuts: their byte offsets and the number of ids before them."""
        if len(self.key) > MEMO or self.used > 8 * MEMO:
            self._reset()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(texts), np.uint8)
        start = chunks(data, begin[sizes > 0], self.keep_space)
        if not len(start):
            return [(np.zeros(0, np.uint16), start, start)] * len(texts)
        first, count = self._find(data, start, np.diff(np.append(start, len(data))))
        before = np.append(0, np.cumsum(count.astype(np.int64)))
        at = np.repeat(first - before[:-1], count)
        ids = self.ids[at + np.arange(len(at))].astype(np.uint16)
        low = np.searchsorted(start, begin)
        cuts = np.append(low, len(start))
        out = []
        for a, b, text in zip(cuts[:-1].tolist(), cuts[1:].tolist(), begin.tolist(), strict=True):
            out.append((ids[before[a]:before[b]], start[a:b] - text, before[a:b] - before[a]))
        return out


class ChunkCoder:
    def __init__(self, path: str):
        self.vocabulary, self.words = Vocabulary(path), WordCoder(path, keep_space=True, fold=False)
        self.common, self.young, self.old = {}, {}, {}
        self.encoded = 0  # bytes of the chunks encoded

    def _chunk(self, encoded: tuple) -> tuple:
        ids, offsets, tokens = encoded
        return ids, offsets.astype(np.uint16), tokens.astype(np.uint16)

    def _held(self, key: bytes):
        found = self.common.get(key) or self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.young[key] = found
        return found

    def learn(self, pieces: Pieces) -> dict[bytes, tuple]:
        """The chunks of ``pieces`` by digest; those not met before are encoded, each once."""
        out, new = {}, {}
        for key, chunk in pieces:
            if key not in out and key not in new:
                found = self._held(key)
                if found is None:
                    new[key] = chunk
                else:
                    out[key] = found
        self.encoded += sum(map(len, new.values()))
        for key, encoded in zip(new, self.words.words(list(new.values())), strict=True):
            out[key] = self.young[key] = self._chunk(encoded)
        if len(self.young) > MEMO_CHUNKS:
            self.young, self.old = {}, self.young
        return out

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        whole = [self.words.whole(t) for t in texts]
        pieces = Pieces([t if w is None else b"" for t, w in zip(texts, whole, strict=True)])
        chunks = self.learn(pieces)
        documents = [Joiner(t, s, [chunks[k] for k in d])
                     for t, s, d in zip(pieces.texts, pieces.starts, pieces.digests, strict=True)]
        # The first window of every join, in one call.
        wanted = [(d, d.window(k)) for d in documents for k in range(len(d.starts) - 1)]
        windows = [d.text[slice(*span)] for d, span in wanted]
        for (d, span), encoded in zip(wanted, self.words.words(windows), strict=True):
            d.ready[span] = encoded
        return [d.ids(self.words).astype(np.uint32) if w is None else w
                for w, d in zip(whole, documents, strict=True)]


class Joiner:
    """One text, its chunks and the repair of their joins."""

    def __init__(self, text: bytes, starts: list[int], chunks: list[tuple]):
        self.text, self.starts, self.chunks = text, starts, chunks
        self.ready = {}

    def _safe(self, k: int) -> int:
        """The number of the last cut of chunk k that is out of reach of the join behind it."""
        limit = self.starts[k + 1] - self.starts[k] - REACH
        return int(np.searchsorted(self.chunks[k][1], max(limit, 0), "right")) - 1

    def window(self, k: int, ahead: int = AHEAD, begin: int | None = None) -> tuple[int, int]:
        if begin is None:
            begin = self.starts[k] + int(self.chunks[k][1][self._safe(k)])
        end = self.starts[k + 1] + ahead
        return begin, len(self.text) if end >= len(self.text) else _character(self.text, end)

    def ids(self, coder: WordCoder) -> np.ndarray:
        out, k, token, place = [], 0, 0, 0
        if not self.chunks:
            return np.zeros(0, np.uint32)
        while k < len(self.chunks) - 1:
            ids, offsets, tokens = self.chunks[k]
            at = self._safe(k)
            begin, upto = self.starts[k] + int(offsets[at]), int(tokens[at])
            if begin < place:
                begin, upto = place, token
            out.append(ids[token:upto])
            ahead = AHEAD
            while True:
                span = self.window(k, ahead, begin)
                got = self.ready.get(span) or coder.words([self.text[slice(*span)]])[0]
                agreed = self._agreement(k, *span, got)
                if agreed:
                    break
                ahead *= 2
            taken, k, token, place = agreed
            out.append(got[0][:taken])
            if place == len(self.text):
                return np.concatenate(out)
        out.append(self.chunks[k][0][token:])
        return np.concatenate(out)

    def _agreement(self, k: int, begin: int, end: int, got: tuple):
        """(ids of the window before it, chunk, ids of the chunk before it, place) of the first
        cut at or behind the join that window and chunk share."""
        offsets, tokens = got[1], got[2]
        limit = end if end == len(self.text) else end - REACH
        for i in range(int(np.searchsorted(offsets, self.starts[k + 1] - begin)), len(offsets)):
            place = begin + int(offsets[i])
            if place > limit:
                return None
            own = bisect_right(self.starts, place) - 1
            cuts, at = self.chunks[own][1], place - self.starts[own]
            same = int(np.searchsorted(cuts, at))
            if same < len(cuts) and cuts[same] == at:
                return int(tokens[i]), own, int(self.chunks[own][2][same]), place
        return (len(got[0]), k, 0, end) if end == len(self.text) else None


_HELD: dict[str, ChunkCoder] = {}


def coder(vocab: str) -> ChunkCoder:
    """This worker's coder; the vocabulary's file is asked for where the code runs."""
    if vocab not in _HELD:
        _HELD[vocab] = ChunkCoder(vocabulary(vocab))
    return _HELD[vocab]


def _grouped(column: pa.Array) -> Iterator[list[bytes]]:
    group, size = [], 0
    for text in column:
        group.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
        size += len(group[-1])
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> each distinct chunk of a group with its uses and bytes."""
    for batch in batches:
        for group in _grouped(batch.column(0)):
            uses = {}
            for key, chunk in Pieces(group):
                uses[key] = (uses.get(key, (0, 0))[0] + 1, len(chunk))
            keys = list(uses)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array([uses[k][0] for k in keys], pa.int64()),
                 pa.array([uses[k][1] for k in keys], pa.int64())], ["key", "uses", "bytes"])


def _pick(wanted: frozenset[bytes]):
    """Texts -> the wanted chunks, each once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for group in _grouped(batch.column(0)):
                keys, found = [], []
                for key, chunk in Pieces(group):
                    if key in wanted and key not in seen:
                        seen.add(key)
                        keys.append(key)
                        found.append(chunk)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.binary())],
                                                 ["key", "chunk"])
    return run


def _encode_chunks(vocab: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(vocab)
        for batch in batches:
            found = own.words.words([c.as_py() for c in batch.column(1)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([np.asarray(e[i], np.uint32).tobytes() for e in found], pa.binary())
                                    for i in range(3)]], ["key", "ids", "offsets", "tokens"])
    return run


def common_chunks(texts: DataFrame, vocab: str = VOCAB, most_bytes: int = COMMON_BYTES) -> dict[bytes, tuple]:
    """{digest: encoded chunk} of the chunks that save most, ``most_bytes`` of text at most.

    The driver so holds at most most_bytes / LEAST digests and, at one id a byte, 12 bytes a byte.
    """
    every = texts.mapInArrow(_digests, "key binary, uses long, bytes long").groupBy("key").agg(
        F.sum("uses").alias("uses"), F.first("bytes").alias("bytes"))
    saved = (F.col("uses") - 1) * F.col("bytes")
    best = every.where("uses > 2").orderBy(saved.desc(), "key").limit(max(1, most_bytes // LEAST)).collect()
    wanted, left = set(), most_bytes
    for r in best:
        left -= r["bytes"]
        if left < 0:
            break
        wanted.add(bytes(r["key"]))
    if not wanted:
        return {}
    held = texts.mapInArrow(_pick(frozenset(wanted)), "key binary, chunk binary").groupBy("key").agg(
        F.first("chunk").alias("chunk"))
    encoded = held.mapInArrow(_encode_chunks(vocab), "key binary, ids binary, offsets binary, tokens binary")
    return {bytes(r["key"]): tuple(np.frombuffer(r[c], np.uint32).astype(np.uint16)
                                   for c in ("ids", "offsets", "tokens")) for r in encoded.collect()}


def _encode(vocab: str, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(vocab)
        own.common = common.value
        for batch in batches:
            at = 0
            for group in _grouped(batch.column(1)):
                found = own.encode(group)
                ends = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found).view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(group)), ids], ["doc_id", "ids"])
                at += len(group)
    return run


def encode(docs: DataFrame, vocab: str = VOCAB, common_bytes: int = COMMON_BYTES) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text, one row per input row."""
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    common = spark.sparkContext.broadcast(common_chunks(source.select("text"), vocab, common_bytes))
    return source.mapInArrow(_encode(vocab, common), "doc_id long, ids array<int>")


def _decode(vocab: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(vocab).vocabulary
        for batch in batches:
            column = batch.column(1)
            flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
            ids = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            texts = [words.decode(i) for i in ids]
            if not digests:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
                continue
            said = [sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids]
            back = [sha256(t.encode()).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(ends).astype(np.int64)), pa.array(said, pa.string()),
                 pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def decode(tokens: DataFrame, vocab: str = VOCAB) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    small_batches(tokens.sparkSession)
    ids = F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    return tokens.select("doc_id", ids).mapInArrow(_decode(vocab, False), "doc_id long, text string")


def contract(docs: DataFrame) -> DataFrame:
    return encode(docs).mapInArrow(_decode(VOCAB, True), "doc_id long, n_tokens long, ids_sha256 string, "
                                                         "decoded_sha256 string")
