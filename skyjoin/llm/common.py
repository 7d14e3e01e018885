"""What the operators share: staged tables, blocks of texts, words and hashes.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D. All of these are single bytes in UTF-8,
so texts are cut as bytes, a block of texts at a time, without a loop over words.
"""

from __future__ import annotations

import contextlib
import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from skyjoin.sources.staging import shared_folder

#: Bytes of text that a Python worker holds as numpy arrays at a time. One longer text is a block of its own.
BLOCK_BYTES = 4 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


# ---- staged tables

class Stage:
    """Tables that a job writes as Parquet in the shared folder, to cut lineage and to read a result twice."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        """Delete staged tables that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for table in tables:
            for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
                if self.folder.rsplit("/", 1)[1] in folder:
                    path = jvm.org.apache.hadoop.fs.Path(folder)
                    path.getFileSystem(conf).delete(path, True)


@contextlib.contextmanager
def arrow_bytes(spark: SparkSession, limit: int) -> Iterator[None]:
    """Jobs run inside hand their Python workers batches of about ``limit`` bytes at most, or one row."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, limit)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def input_tasks(df: DataFrame) -> int:
    """Tasks in which Spark reads df: a measure of its size that needs no job."""
    return max(1, df.rdd.getNumPartitions())


# ---- blocks of texts

def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows whose texts hold at most limit bytes, or one row."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and the n + 1 offsets of the texts. A null text is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - offsets[0]


class Words:
    """The words of a block: starts and ends in bytes, first[i] to first[i + 1] those of text i."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        data, self.offsets = text_bytes(texts)
        self.data = LOWER[data] if lower else data
        self.inside = ~SPACE[self.data]
        edge = self.inside.copy()
        edge[1:] &= ~self.inside[:-1]
        last = self.inside.copy()
        last[:-1] &= ~self.inside[1:]
        full = np.flatnonzero(np.diff(self.offsets) > 0)
        edge[self.offsets[full]] = self.inside[self.offsets[full]]
        last[self.offsets[full + 1] - 1] = self.inside[self.offsets[full + 1] - 1]
        self.starts, self.ends = np.flatnonzero(edge), np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @functools.cached_property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @functools.cached_property
    def text_of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    @functools.cached_property
    def coded(self) -> tuple[np.ndarray, list[bytes]]:
        """A code for each word, and the distinct words by code."""
        ends = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
        array = pa.Array.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(self.data[self.inside])])
        coded = array.dictionary_encode()
        return np.asarray(coded.indices), coded.dictionary.to_pylist()

    @functools.cached_property
    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        codes, words = self.coded
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[codes]


# ---- 64-bit hashing; unsigned products wrap, as meant

def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(count: int, seed: int) -> np.ndarray:
    """count odd 64-bit numbers from a seed."""
    steps = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mixed(steps) | np.uint64(1)
