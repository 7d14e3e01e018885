"""Byte-level BPE: encoding as a reduction over a tree of halves, and decoding."""

from __future__ import annotations

import array
import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyjoin.llm.common import blocks, text_bytes

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Bytes of a piece that are merged at once, and ids that are decoded at once; more are halved.
LEAF = 24
#: Distinct chunks, and distinct pieces, in each of the two generations that a worker remembers.
REMEMBERED = 100_000


class Memory:
    """Results by key. When REMEMBERED are new, those of the generation before are forgotten but for the ones used since."""

    def __init__(self):
        self.new: dict = {}
        self.old: dict = {}

    def get(self, key):
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= REMEMBERED:
            self.old, self.new = self.new, {}
        self.new[key] = value


class Codec:
    """Encodes pieces by ranks: the pair whose bytes have the lowest rank merges first, the leftmost of equals."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF):
        self.ranks, self.leaf = ranks, leaf
        self.pieces = {i: b for b, i in ranks.items()}
        self.stays = functools.lru_cache(1 << 16)(self._stays)
        self.seen, self.words = Memory(), Memory()

    def merged(self, data: bytes) -> list[bytes]:
        """The tokens of a short piece, by merges from single bytes."""
        rank, none = self.ranks.get, 1 << 60
        cuts = list(range(len(data) + 1))
        pairs = [rank(data[i : i + 2], none) for i in range(len(data) - 1)]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            del cuts[at + 1], pairs[at]
            if at:
                pairs[at - 1] = rank(data[cuts[at - 1] : cuts[at + 1]], none)
            if at < len(pairs):
                pairs[at] = rank(data[cuts[at] : cuts[at + 2]], none)
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def _stays(self, a: bytes, b: bytes) -> bool:
        """Whether two tokens side by side encode to themselves. A row of tokens is the encoding of its bytes
        if and only if all neighbours in it do, so outside such a seam nothing can change."""
        return self.merged(a + b) == [a, b]

    def joined(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The encoding of the bytes of two encodings: encode anew a window about the seam, twice as wide each
        time, until it fits its neighbours on both sides."""
        if not left or not right or self.stays(left[-1], right[0]):
            return left + right
        width = 1
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self.direct(b"".join(left[a:] + right[:b]))
            if (a == 0 or self.stays(left[a - 1], window[0])) and (b == len(right) or self.stays(window[-1], right[b])):
                return left[:a] + window + right[b:]
            width *= 2

    def reduced(self, data: bytes) -> list[bytes]:
        """Tokens of a piece: those of its halves, joined."""
        if len(data) <= self.leaf:
            return self.merged(data)
        half = len(data) // 2
        return self.joined(self.reduced(data[:half]), self.reduced(data[half:]))

    def direct(self, data: bytes) -> list[bytes]:
        return self.merged(data) if len(data) <= 256 else self.ordered(data)

    def ordered(self, data: bytes) -> list[bytes]:
        """merged() for a long window, with a heap of pairs."""
        size = len(data)
        ends, before, heap = list(range(1, size + 1)), list(range(-1, size)), []

        def offer(i: int) -> None:
            if i >= 0 and ends[i] < size and (r := self.ranks.get(data[i : ends[ends[i]]])) is not None:
                heapq.heappush(heap, (r, i, ends[ends[i]]))

        for i in range(size):
            offer(i)
        gone = bytearray(size)
        while heap:
            _, i, end = heapq.heappop(heap)
            if gone[i] or ends[i] >= size or ends[ends[i]] != end:
                continue
            gone[ends[i]] = 1
            ends[i] = end
            if end < size:
                before[end] = i
            offer(i)
            offer(before[i])
        return [data[i : ends[i]] for i in range(size) if not gone[i]]

    def encode(self, piece: bytes) -> list[int]:
        """Ids of a piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ids = self.words.get(piece)
        if ids is None:
            ids = [self.ranks[t] for t in self.reduced(piece)]
            if len(piece) <= 64:
                self.words.put(piece, ids)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ids: those of the halves, one after the other, down to LEAF ids."""
        if len(ids) <= self.leaf:
            return b"".join(map(self.pieces.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@functools.lru_cache(2)
def codec(path: str) -> Codec:
    with open(path, "rb") as file:
        return Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)})


@functools.lru_cache(2)
def splitter(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


#: Bytes that a character other than white space starts or, if it has one or two bytes, ends with.
OPENS = np.zeros(256, bool)
OPENS[[*range(0x21, 0x7F), *range(0xC3, 0xE0), *range(0xE4, 0xF5)]] = True
PLAIN = np.zeros(256, bool)
PLAIN[0x21:0x7F] = True
TWO = np.zeros(256, bool)
TWO[0xC3:0xE0] = True


#: Letters (1), digits (2) and other visible characters (3) of ASCII.
KINDS = np.zeros(256, np.uint8)
KINDS[0x21:0x7F] = 3
KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
KINDS[0x30:0x3A] = 2
#: Bytes side by side of different kinds: a match holds one kind, but for an apostrophe and the letters after it.
APART = (KINDS[:, None] > 0) & (KINDS > 0) & (KINDS[:, None] != KINDS)
APART[0x27] = False


def chunk_starts(data: np.ndarray, offsets: np.ndarray, by_kind: bool = True) -> np.ndarray:
    """Where to cut texts so that no match of the pattern lies across a cut: before a space with no white space
    on either side, between ASCII characters of different kinds if by_kind, and at the start of each text."""
    space = np.flatnonzero(data[2:-1] == 0x20) + 2 if len(data) > 3 else np.zeros(0, np.int64)
    before = PLAIN[data[space - 1]] | ((data[space - 1] & 0xC0) == 0x80) & TWO[data[space - 2]]
    cut = np.zeros(len(data) + 1, bool)
    if by_kind:
        cut[1:-1] = APART[data[:-1], data[1:]]
    cut[space[before & OPENS[data[space + 1]]]] = True
    cut[offsets] = True
    return np.flatnonzero(cut)


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    own, pieces_of = codec(path), splitter(pattern).findall
    seen = own.seen

    def encoded(chunk: bytes) -> tuple[bytes, bytes, bytes]:
        """Ids of a chunk as 4-byte numbers, and as decimals; and the bytes that they decode to."""
        ids = [i for piece in pieces_of(chunk.decode()) for i in own.encode(piece.encode())]
        decoded = own.decode(ids)
        # equal bytes are held once
        found = array.array("i", ids).tobytes(), " ".join(map(str, ids)).encode(), chunk if decoded == chunk else decoded
        if len(chunk) <= 64:
            seen.put(chunk, found)
        return found

    for block in blocks(batches):
        data, offsets = text_bytes(block.column("text"))
        starts = chunk_starts(data, offsets, pattern == public_tokenizers.PATTERN)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]).dictionary_encode()
        codes, distinct = np.asarray(chunks.indices), chunks.dictionary.to_pylist()
        found = [seen.get(chunk) or encoded(chunk) for chunk in distinct]
        binary, decimals, decoded = zip(*found, strict=True) if found else ((), (), ())
        sizes = np.array([len(x) // 4 for x in binary], np.int64)[codes]
        bounds = np.searchsorted(starts, offsets)
        totals = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        codes, ids_digests, digests, ids_lists = codes.tolist(), [], [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            part = codes[a:b]
            ids_digests.append(hashlib.sha256(b" ".join(map(decimals.__getitem__, part))).hexdigest())
            digests.append(hashlib.sha256(b"".join(map(decoded.__getitem__, part))).hexdigest())
            ids_lists.append(np.frombuffer(b"".join(map(binary.__getitem__, part)), np.int32) if with_ids else None)
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), pa.array(np.diff(totals), pa.int64()), pa.array(ids_digests), pa.array(digests), pa.array(ids_lists, pa.list_(pa.int32()))],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])


def encode(documents: DataFrame, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids (null unless with_ids) for each row of documents (doc_id, text).

    Every match of pattern in the whole text is encoded by itself. A piece is halved down to leaves of LEAF
    bytes; encodings of neighbours are joined by encoding anew a window about their seam. The digests are
    SHA-256 of the ids as decimals joined by one space, and of the bytes that the ids decode to.

    Null or empty text: no ids, both digests those of no bytes. Null doc_id stays null; repeated rows each get
    their row; other columns are ignored. A text is one row's work and no row meets another: no shuffle.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(
        lambda batches: encode_batches(batches, path, pattern, with_ids),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>")


def decode(tokens: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, text of rows (doc_id, ids). Null ids: null text. Bytes that are no UTF-8 become U+FFFD."""
    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = [None if x is None else own.decode(x).decode(errors="replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(batches_of, "doc_id long, text string")
