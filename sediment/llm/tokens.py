"""Encoding with a public tokenizer, each distinct chunk once.

Both vocabularies encode a text as the concatenation of the encodings of its chunks: words, with
the space before them where the vocabulary keeps spaces; runs of punctuation; runs of white
space.  A worker keeps the ids of the chunks it has met, found by two 64-bit hashes (128 bits)
in sorted arrays, and gives only new chunks to the tokenizers library.  The arrays hold up to
``MEMO`` chunks, about 50 bytes each, then start anew; chunks longer than ``MEMO_BYTES`` are
always encoded.  Texts with white space outside ASCII are encoded whole, where spaces are kept,
and so are texts that hold the literal of an added token (as ``<|endoftext|>``), which is one id.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from sediment.llm.bytehash import blanks, range_hashes

MEMO = 1_200_000
MEMO_BYTES = 48
GROUP_BYTES = 2 << 20

#: White space outside ASCII, as the vocabularies' patterns mean it.
WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

_BYTES = np.arange(256)
_ALNUM = ((_BYTES >= 48) & (_BYTES < 58)) | ((_BYTES >= 65) & (_BYTES < 91)) | (
    (_BYTES >= 97) & (_BYTES < 123))
_PUNCT = (_BYTES < 128) & ~_ALNUM & (_BYTES != 32) & ~((_BYTES >= 9) & (_BYTES <= 13))
_FREE = _PUNCT & (_BYTES != 39)  # an apostrophe may belong to the letters after it


def chunks(data: np.ndarray, texts: np.ndarray, keep_space: bool) -> np.ndarray:
    """The starts of all chunks of texts that begin at ``texts`` in ``data``; a chunk lasts until
    the next.  With keep_space, white space is cut as the vocabulary does: all but the last
    character of a run, then the last, which a word takes along if it is a space."""
    if not len(data):
        return np.zeros(0, np.int64)
    first = np.zeros(len(data) + 1, bool)
    first[texts] = True
    first[-1] = True
    blank = blanks(data)
    before, own = data[:-1], data[1:]
    start = first[:-1].copy()
    edge = (_ALNUM[before] & _PUNCT[own]) | (_FREE[before] & _ALNUM[own])
    if keep_space:
        # Entering a run; the last character of a run that a word follows; leaving one that
        # does not end in a space.
        last = blank.copy()
        last[:-1] &= ~blank[1:] | first[1:-1]
        last &= ~first[1:]
        edge |= blank[1:] & (~blank[:-1] | last[1:])
        edge |= ~blank[1:] & blank[:-1] & (before != 32)
    else:
        edge |= blank[1:] != blank[:-1]
    start[1:] |= edge
    return np.flatnonzero(start)


class ChunkEncoder:
    def __init__(self, path: str, keep_space: bool, fold: bool):
        """fold: the vocabulary lower-cases, so chunks that differ in A-Z only are one."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keep_space, self.fold = keep_space, fold
        self._reset()

    def _reset(self) -> None:
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.first, self.count = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _whole(self, text: bytes) -> bool:
        """Whether cutting the text into chunks could change its ids."""
        return any(a in text for a in self.added) or (
            self.keep_space and not text.isascii() and WIDE_SPACE.search(text.decode()) is not None)

    def _encode(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, how many of each)."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(found, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), np.int32, len(ids))
        return np.fromiter((i for x in ids for i in x), np.uint32, int(counts.sum())), counts

    def _store(self, flat: np.ndarray) -> int:
        at = self.used
        self.used += len(flat)
        if self.used > len(self.ids):
            grown = np.zeros(max(self.used, len(self.ids) * 3 // 2), np.uint32)
            grown[:at] = self.ids[:at]
            self.ids = grown
        self.ids[at:self.used] = flat
        return at

    def _find(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``ids`` each chunk's ids are, and how many; new chunks are encoded."""
        key, check = range_hashes(data, start, length, self.fold, second=True)
        distinct, sample, number = np.unique(key, return_index=True, return_inverse=True)
        want = check[sample]
        at = np.searchsorted(self.key, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.key)
        taken = np.zeros(len(distinct), bool)
        taken[inside] = self.key[at[inside]] == distinct[inside]
        known[taken] = self.check[at[taken]] == want[taken]
        first, count = np.zeros(len(distinct), np.int32), np.zeros(len(distinct), np.int32)
        first[known], count[known] = self.first[at[known]], self.count[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            begin, stop = start[sample[new]], start[sample[new]] + length[sample[new]]
            whole = data.tobytes()
            flat, n = self._encode([whole[a:b].decode() for a, b in zip(begin.tolist(), stop.tolist(), strict=True)])
            count[new] = n
            first[new] = self._store(flat) + np.cumsum(n) - n
            free = new[(length[sample[new]] <= MEMO_BYTES) & ~taken[new]]
            self.key = np.insert(self.key, at[free], distinct[free])
            self.check = np.insert(self.check, at[free], want[free])
            self.first = np.insert(self.first, at[free], first[free])
            self.count = np.insert(self.count, at[free], count[free])
        # Chunks of one key but another check are none of the sample's.
        odd = np.flatnonzero(check != want[number])
        first, count = first[number], count[number]
        for i in odd.tolist():
            flat, n = self._encode([data[start[i]:start[i] + length[i]].tobytes().decode()])
            first[i], count[i] = self._store(flat), n[0]
        return first, count

    def _group(self, texts: list[bytes], end: int) -> Iterator[np.ndarray]:
        if len(self.key) > MEMO or self.used > 8 * MEMO:
            self._reset()
        whole = {i: self._encode([t.decode()])[0] for i, t in enumerate(texts) if self._whole(t)}
        texts = [b"" if i in whole else t for i, t in enumerate(texts)]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(texts), np.uint8)
        start = chunks(data, begin[sizes > 0], self.keep_space)
        length = np.diff(np.append(start, len(data)))
        if not self.keep_space and len(start):
            word = ~blanks(data[start])
            start, length = start[word], length[word]
        first, count = self._find(data, start, length) if len(start) else (start, start)
        total = np.cumsum(count.astype(np.int64))
        at = np.repeat(first - (total - count), count)
        flat = self.ids[at + np.arange(len(at))]
        upto = np.searchsorted(start, begin + sizes)
        total = np.append(0, total)
        low = 0
        for i, high in enumerate(upto.tolist()):
            own = whole[i] if i in whole else flat[total[low]:total[high]]
            yield np.append(own, np.uint32(end))
            low = high

    def encode(self, column: pa.Array, end: int) -> Iterator[np.ndarray]:
        """Each text's ids with the end id, in order; texts are taken in groups of bounded size."""
        group, size = [], 0
        for text in column:
            group.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
            size += len(group[-1])
            if size >= GROUP_BYTES:
                yield from self._group(group, end)
                group, size = [], 0
        if group:
            yield from self._group(group, end)


#: Vocabulary file to (keeps spaces, lower-cases).
KINDS = {"byte_bpe_50k.json": (True, False), "word_bpe_49k.json": (False, True)}
_HELD: dict[str, ChunkEncoder] = {}


def encoder(name: str) -> ChunkEncoder:
    """This worker's encoder for a vocabulary; its file is asked for where the code runs."""
    if name not in _HELD:
        _HELD[name] = ChunkEncoder(vocabulary(name), *KINDS[name])
    return _HELD[name]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
