"""Word-piece counts by a linear longest-match automaton."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyjoin.llm.common import Words, blocks

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
FIRST, LATER, NONE = 0, 1, -1
#: Words up to this many bytes go through the automaton side by side.
TOGETHER = 64


class Automaton:
    """A trie of the pieces that begin words (below FIRST) and of those that continue them (below LATER).

    Each node has a failure link: where matching goes on once the node has no edge for the next byte, after
    pops[node] finished pieces. Every byte takes one edge, and every link pops a piece that some byte began, so
    the work is linear in the word's length, and no piece is built.
    """

    def __init__(self, first: Iterable[bytes], later: Iterable[bytes]):
        edges: dict[int, int] = {}
        ends, parents = {FIRST: False, LATER: False}, {}
        for root, pieces in ((FIRST, first), (LATER, later)):
            for piece in pieces:
                node = root
                for byte in piece:
                    key = node << 8 | byte
                    nxt = edges.get(key)
                    if nxt is None:
                        nxt = edges[key] = len(ends)
                        ends[nxt], parents[nxt] = False, (node, byte)
                    node = nxt
                if piece:
                    ends[node] = True
        depth = [0] * len(ends)
        for node, (parent, _) in parents.items():  # parents come before their children
            depth[node] = depth[parent] + 1
        fail, pops = [NONE] * len(ends), [0] * len(ends)
        for node in sorted(parents, key=depth.__getitem__):
            if ends[node]:
                fail[node], pops[node] = LATER, 1
                continue
            parent, byte = parents[node]
            at, count = fail[parent], pops[parent]
            while at != NONE and (at << 8 | byte) not in edges:
                count += pops[at]
                at = fail[at]
            if at != NONE:
                fail[node], pops[node] = edges[at << 8 | byte], count
        self.edges, self.fail, self.pops = edges, fail, pops
        self.keys = np.array(sorted(edges), np.int64)
        self.targets = np.array([edges[k] for k in self.keys.tolist()], np.int64)
        self.fails, self.counts = np.array(fail, np.int64), np.array(pops, np.int64)

    def count(self, word: bytes) -> int:
        """Pieces of one word, or 0 if it can't be split."""
        node, total, edges, fail, pops = FIRST, 0, self.edges, self.fail, self.pops
        for byte in word:
            while (nxt := edges.get(node << 8 | byte)) is None:
                total += pops[node]
                node = fail[node]
                if node == NONE:
                    return 0
            node = nxt
        while node != LATER:
            total += pops[node]
            node = fail[node]
            if node == NONE:
                return 0
        return total

    def count_all(self, words: list[bytes]) -> np.ndarray:
        """count() of many words, one step of all of them at a time."""
        sizes = np.array([len(w) for w in words], np.int64)
        totals = np.zeros(len(words), np.int64)
        for k in np.flatnonzero(sizes > TOGETHER):
            totals[k] = self.count(words[k])
        data, starts = np.frombuffer(b"".join(words) + b"\0", np.uint8), np.cumsum(sizes) - sizes
        who = np.flatnonzero(sizes <= TOGETHER)
        node, at, end = np.full(len(who), FIRST), starts[who], (starts + sizes)[who]
        while len(who):
            key = node << 8 | data[np.minimum(at, len(data) - 1)]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            step = (at < end) & (self.keys[place] == key)
            totals[who] += np.where(step, 0, self.counts[node])
            node = np.where(step, self.targets[place], self.fails[node])
            at = at + step
            lost = node == NONE
            totals[who[lost]] = 0
            go = ~lost & ((at < end) | (node != LATER))
            who, node, at, end = who[go], node[go], at[go], end[go]
        return totals


def roles(pieces: Iterable[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Pieces that begin words, after their space, or are single bytes; and pieces that continue words."""
    pieces = list(pieces)
    return [p[1:] for p in pieces if p[:1] == b" " and len(p) > 1] + [p for p in pieces if len(p) == 1], [p for p in pieces if p[:1] != b" "]


@functools.lru_cache(2)
def automaton(path: str) -> Automaton:
    with open(path, "rb") as file:
        return Automaton(*roles(base64.b64decode(line.split()[0]) for line in file))


def count_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    own = automaton(path)
    for block in blocks(batches):
        words = Words(block.column("text"))
        codes, distinct = words.coded
        counts = own.count_all(distinct)[codes]
        sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[words.first])
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words.counts, sums(np.maximum(counts, 1)), sums(counts == 0), np.diff(words.offsets)))],
            ["doc_id", "n_words", "n_tokens", "n_unknown", "n_bytes"])


def token_counts(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown, n_bytes for each row of documents (doc_id, text).

    Each word is split greedily into the longest piece of the vocabulary that begins it, then the longest that
    continue it. Pieces with a leading space in the file at path begin words, as do single bytes; pieces
    without one continue them. A word that can't be split counts as one token and as unknown.

    Null or wordless text: all counts 0. Null doc_id stays null; repeated rows each get their row; other
    columns are ignored. Texts are counted where they are read: no shuffle.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(lambda batches: count_batches(batches, path), "doc_id long, n_words long, n_tokens long, n_unknown long, n_bytes long")
