"""Importance resampling towards a target: exact weights from bit planes of bucket counts."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyjoin.llm.common import LOWER, Stage, Words, blocks, text_bytes
from skyjoin.operators.ordering import with_position

BUCKETS, SEED = 10_000, 2024
#: Words are runs of digits, letters a to z after lower-casing, and bytes outside ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
FOLDED = np.where(LETTERS[LOWER], LOWER, 0x20).astype(np.uint8)
#: Documents whose planes are held side by side.
TOGETHER = 512


def features(texts: pa.Array, longest: int, buckets: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of a block, and text and bucket of each of its features, the runs of 1 to longest words."""
    data, offsets = text_bytes(texts)
    words = Words(pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(FOLDED[data])]))
    codes, distinct = words.coded
    sums = np.fromiter(map(zlib.crc32, distinct), np.int64, len(distinct))[codes]
    text_of, found = words.text_of, [(words.text_of, sums)]
    spaced = [b" " + w for w in distinct] if longest > 1 else []
    for more in range(1, longest):
        # the checksum of a run goes on with the next word, if that is of the same text
        sums = np.fromiter(map(zlib.crc32, map(spaced.__getitem__, codes[more:]), sums[:-1].tolist()), np.int64, max(0, len(codes) - more))
        same = text_of[more:] == text_of[: len(sums)]
        found.append((text_of[more:][same], sums[same]))
    return words, np.concatenate([t for t, _ in found]), np.concatenate([s for _, s in found]) % buckets


def count_batches(batches: Iterator[pa.RecordBatch], longest: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for block in blocks(batches):
        total += np.bincount(features(block.column("text"), longest, buckets)[2], minlength=buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features of all texts by bucket. Every task sends one row for each bucket at most."""
    own = texts.select(F.col("text").cast("string").alias("text"))
    return own.mapInArrow(lambda b: count_batches(b, longest, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of each bucket, floor(1000 ln(share in target / share in source)) with one feature more in all buckets.

    source and target are counts (bucket, n); at most buckets rows of each come to the driver.
    """
    s, t = ({r.bucket: r.n for r in side.collect()} for side in (source, target))
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return [math.floor(1000 * math.log((t.get(b, 0) + 1) * all_s / ((s.get(b, 0) + 1) * all_t))) for b in range(buckets)]


def packed(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit numbers."""
    short = -flags.shape[1] % 64
    return np.packbits(np.pad(flags, ((0, 0), (0, short))), axis=1).view(np.uint64)


class GainPlanes:
    """Bit k of the gains above zero, and bit k of those below, each as one plane over all buckets."""

    def __init__(self, values: list[int]):
        values = np.array(values, np.int64)
        self.size, self.planes = len(values), []
        for sign in (1, -1):
            side = np.maximum(sign * values, 0)
            for k in range(int(side.max(initial=0)).bit_length()):
                self.planes.append((sign << k, packed((side >> k & 1).astype(bool)[None])[0]))

    def weights(self, row: np.ndarray, bucket: np.ndarray, count: np.ndarray, rows: int) -> np.ndarray:
        """Sum of count x gain for each row: counts become planes too, and two planes share 2^(j + k) a common bit."""
        out = np.zeros(rows, np.int64)
        for j in range(int(count.max(initial=0)).bit_length()):
            there = np.flatnonzero(count >> j & 1)
            who, place = np.unique(row[there], return_inverse=True)
            flags = np.zeros((len(who), self.size), bool)
            flags[place, bucket[there]] = True
            plane, part = packed(flags), np.zeros(len(who), np.int64)
            for value, gain in self.planes:
                part += value * np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
            out[who] += part << j
        return out


def noise(seed: int, doc_id: int | None) -> int:
    """floor(-1000 ln(-ln u)), u uniform from the digest of seed and doc_id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh_batches(batches: Iterator[pa.RecordBatch], values: list[int], longest: int, seed: int) -> Iterator[pa.RecordBatch]:
    planes = GainPlanes(values)
    for block in blocks(batches):
        words, text, bucket = features(block.column("text"), longest, planes.size)
        key, count = np.unique(text * planes.size + bucket, return_counts=True)
        text, bucket = np.divmod(key, planes.size)
        weights = np.zeros(block.num_rows, np.int64)
        for low in range(0, block.num_rows, TOGETHER):
            high = min(low + TOGETHER, block.num_rows)
            a, b = np.searchsorted(text, (low, high))
            weights[low:high] = planes.weights(text[a:b] - low, bucket[a:b], count[a:b], high - low)
        drawn = np.array([noise(seed, i) for i in block.column("doc_id").to_pylist()], np.int64)
        held = sum(np.maximum(words.counts - more, 0) for more in range(longest))
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words.counts, held, weights, weights + drawn))],
            ["doc_id", "n_words", "n_features", "weight", "score"])


def resample(documents: DataFrame, target: DataFrame, stage: Stage, *, percent: int = 10, least_words: int = 20, longest: int = 1,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank for each row of documents (doc_id, text); target has texts (text).

    Features are all runs of 1 to longest words, each in the bucket of its CRC-32. weight is the exact sum of
    gains() over a row's features, by bit planes: no document's counts are multiplied out. score adds Gumbel noise drawn
    from seed and doc_id, so the percent % highest scores among rows of at least least_words words are a draw without
    replacement in proportion to exp(weight / 1000). rank is the place in that draw, by descending score and
    ascending doc_id; rows not drawn have none.

    Texts are read twice: for the counts of all buckets, and for weights. Ranks come from a sort by ranges in all tasks.

    Null, empty or wordless text: no features, weight 0, never drawn unless least_words is 0. Null doc_id: the
    noise of seed and an empty string, last among equal scores. Repeated rows each get their row and their own rank.
    Without target texts all gains come from the counts plus one; other columns are ignored; an empty table gives none.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    values = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets), buckets)
    scored = stage.write(docs.mapInArrow(
        lambda batches: weigh_batches(batches, values, longest, seed), "doc_id long, n_words long, n_features long, weight long, score long"), "scored")
    able = F.col("n_words") >= least_words
    drawn = percent * scored.where(able).count() // 100
    placed = with_position(scored, [(~able).cast("int"), F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "place")
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", F.when(able & (F.col("place") <= drawn), F.col("place")).alias("rank"))
