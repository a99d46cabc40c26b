"""Encoding of a corpus with a public byte-level BPE tokenizer.

Each short word holds one contiguous array of part boundaries with the rank of
every adjacent pair; the minimum rank is found by scanning, its boundary is
deleted and the two neighbouring ranks are refreshed, until no pair has a
rank.  Scanning is quadratic in the length of a word, so words of more than
``SCAN_LIMIT`` bytes use a heap over linked parts, which makes the same merges
in the same order.

The vocabulary is read from a file each executor can open (parameter
``vocabulary``); it is never copied.  Words repeat, so each worker keeps a
bounded cache of encoded words.

Defined cases: null and empty texts have an empty list; any other text,
blank or very long, is encoded whole; rows are independent, so repeated rows
and further columns change nothing.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quillforge.session import ship

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-tokenisation pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SCAN_LIMIT = 400
CACHE_WORDS = 200_000
NONE = 1 << 60


class Encoder:
    def __init__(self, vocabulary: str):
        with open(vocabulary, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.words = regex.compile(PATTERN)
        self.cache: dict[str, list[int]] = {}

    def scan(self, word: bytes) -> list[int]:
        """Boundaries and adjacent ranks in two contiguous arrays."""
        get = self.ranks.get
        bounds = list(range(len(word) + 1))
        ranks = [get(word[i : i + 2], NONE) for i in range(len(word) - 1)]
        while ranks:
            low = min(ranks)
            if low == NONE:
                break
            i = ranks.index(low)
            del bounds[i + 1]
            del ranks[i]
            # The part at i has grown: refresh the rank with each neighbour.
            if i < len(ranks):
                ranks[i] = get(word[bounds[i] : bounds[i + 2]], NONE)
            if i:
                ranks[i - 1] = get(word[bounds[i - 1] : bounds[i + 1]], NONE)
        return [self.ranks[word[a:b]] for a, b in zip(bounds, bounds[1:])]

    def heap(self, word: bytes) -> list[int]:
        """The same merges for long words, in time n log n."""
        get, n = self.ranks.get, len(word)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = bytearray(b"\1") * n
        queue = [(r, i, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, stop = heapq.heappop(queue)
            if not alive[i] or (j := after[i]) >= n or end[j] != stop:
                continue
            alive[j] = 0
            end[i], after[i] = stop, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := get(word[i : end[after[i]]])) is not None:
                    heapq.heappush(queue, (r, i, end[after[i]]))
            if (h := before[i]) >= 0 and (r := get(word[h:stop])) is not None:
                heapq.heappush(queue, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i : end[i]]])
            i = after[i]
        return out

    def word(self, text: str) -> list[int]:
        word = text.encode("utf-8", "replace")
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        return self.scan(word) if len(word) <= SCAN_LIMIT else self.heap(word)

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        cache = self.cache
        for w in self.words.findall(text or ""):
            got = cache.get(w)
            if got is None:
                got = self.word(w)
                if len(w) < 64:
                    if len(cache) >= CACHE_WORDS:
                        cache.clear()
                    cache[w] = got
            ids += got
        return ids


@lru_cache(4)
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    return Encoder(vocabulary)


def encode_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``key, ids``: the token ids of each text, without special tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            # Small output batches: a batch of long texts must not pile up ids.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [enc.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[key, "ids"])

    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(run, f"{key} {kind}, ids array<int>")


def token_counts(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``key, n_tokens`` without moving the ids out of the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            counts = [len(enc.encode(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=[key, "n_tokens"])

    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(run, f"{key} {kind}, n_tokens bigint")
