"""Removal of repeated passages: Rabin-Karp hashes of all word windows, counted in Spark."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyjoin.llm.common import Words, blocks, constants, input_tasks, mixed

SEED = 77_003
#: Stands for a null doc_id, which counts as larger than any other.
LAST = np.iinfo(np.int64).max


def window_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of size words within one text, and their hashes.

    A window's hash is the sum of h[i + j] * b**-j modulo 2**64, a difference of two running sums times b**i.
    """
    n = len(words)
    base = int(constants(1, SEED)[0])
    powers = np.cumprod(np.full(n, base, np.uint64))
    inverse = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hashes * inverse, dtype=np.uint64)])
    ends = np.repeat(words.first[1:], words.counts)
    starts = np.flatnonzero(np.arange(n) + size <= ends)
    return starts, mixed((sums[starts + size] - sums[starts]) * powers[starts])


def ids_of(block: pa.RecordBatch) -> np.ndarray:
    return np.asarray(pc.fill_null(block.column("doc_id"), LAST), np.int64)


#: Entries of a window: the smallest document with an id in a block, one with an id that is settled, and documents without
#: an id, known by a digest of their texts, not settled and settled.
LOWEST, SETTLED, NAMELESS, NAMELESS_SETTLED = range(4)


def packed(values: np.ndarray) -> bytes:
    """Bytes of the same weight together, which compress well where numbers are sorted or small."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def window_batches(batches: Iterator[pa.RecordBatch], size: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Distinct windows of each block by bucket of their hash, with the block's smallest document (LOWEST);
    and the block's other documents of such windows, which need no more search (SETTLED). Documents without an id
    are larger than any with one, and are told apart by their digests."""
    for block in blocks(batches):
        digests = np.asarray(pc.fill_null(block.column("digest"), 0), np.int64)
        order = np.lexsort((digests, ids_of(block)))
        block, digests = block.take(pa.array(order)), digests[order]
        ids, words = ids_of(block), Words(block.column("text"))
        named = np.asarray(block.column("doc_id").is_valid())
        starts, hashes = window_hashes(words, size)
        order = np.argsort(hashes, kind="stable")
        text = words.text_of[starts][order]
        hashes, ids, named, digests = hashes[order], ids[text], named[text], digests[text]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(ids) else np.zeros(0, np.int64)
        once = new.copy()
        once[1:] |= (ids[1:] != ids[:-1]) | (named[1:] != named[:-1]) | (digests[1:] != digests[:-1])
        rows: list[tuple] = []
        for kind, part in ((LOWEST, new & named), (SETTLED, once & named & (ids > ids[head])), (NAMELESS, once & ~named & ~named[head]), (NAMELESS_SETTLED, once & ~named & named[head])):
            h, i = hashes[part], (ids if kind in (LOWEST, SETTLED) else digests)[part]
            bucket = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(h)], strict=True):
                if a < b:
                    rows.append((int(bucket[a]), kind, packed(h[a:b]), packed(i[a:b])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(list(zip(*rows, strict=True)) or [[]] * 4, (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
            ["bucket", "kind", "hashes", "ids"])


def repeated(table: pa.Table) -> pa.Table:
    """doc_id or digest, window of one bucket, where the window also starts in a document with a smaller doc_id."""
    done = table.column("kind").to_pylist()
    hashes = [unpacked(x, np.uint64) for x in table.column("hashes").to_pylist()]
    ids = [unpacked(x, np.int64) for x in table.column("ids").to_pylist()]
    pick = lambda parts, which, kind: np.concatenate([np.zeros(0, kind), *(p for p, d in zip(parts, done, strict=True) if d == which)])
    h, i = pick(hashes, LOWEST, np.uint64), pick(ids, LOWEST, np.int64)
    order = np.argsort(h, kind="stable")
    h, i = h[order], i[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    heads = np.flatnonzero(new)
    low = np.minimum.reduceat(i, heads)[np.cumsum(new) - 1] if len(h) else i
    later = i > low
    owners = np.concatenate([i[later], pick(ids, SETTLED, np.int64)])
    windows = np.concatenate([h[later], pick(hashes, SETTLED, np.uint64)])
    # any document with an id is smaller than those without
    nameless = pick(hashes, NAMELESS, np.uint64)
    below = np.isin(nameless, h)
    digests = np.concatenate([pick(ids, NAMELESS, np.int64)[below], pick(ids, NAMELESS_SETTLED, np.int64)])
    nameless = np.concatenate([nameless[below], pick(hashes, NAMELESS_SETTLED, np.uint64)])
    # copies of one text send the same from every block
    order = np.lexsort((nameless, digests))
    digests, nameless = digests[order], nameless[order]
    new = np.ones(len(digests), bool)
    new[1:] = (digests[1:] != digests[:-1]) | (nameless[1:] != nameless[:-1])
    digests, windows = digests[new], np.concatenate([windows, nameless[new]]).view(np.int64)
    free = [None] * len(digests)
    return pa.table({
        "doc_id": pa.array([*owners.tolist(), *free], pa.int64()), "digest": pa.array([*[None] * len(owners), *digests.tolist()], pa.int64()), "window": pa.array(windows)})


def covered(words: Words, size: int, row_windows: list) -> np.ndarray:
    """Which words of a block lie in a window that its row lists: the union of maximal intervals."""
    marks = np.zeros(len(words) + 1, np.int64)
    rows = np.flatnonzero([x is not None for x in row_windows])
    if len(rows):
        starts, hashes = window_hashes(words, size)
        bounds = np.searchsorted(starts, words.first)
        for r in rows:
            own = slice(bounds[r], bounds[r + 1])
            hit = starts[own][np.isin(hashes[own], row_windows[r])]
            marks[hit] += 1
            np.subtract.at(marks, hit + size, 1)
    return np.cumsum(marks[:-1]) > 0


def cut_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        words = Words(block.column("text"))
        lists = block.column("windows")
        numbers, ends = np.asarray(lists.flatten(), np.int64).view(np.uint64), np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))])
        valid = np.asarray(lists.is_valid().to_numpy(zero_copy_only=False))
        gone = covered(words, size, [numbers[ends[k] : ends[k + 1]] if v else None for k, v in enumerate(valid)])
        removed = np.concatenate([[0], np.cumsum(gone)])
        removed = removed[words.first[1:]] - removed[words.first[:-1]]
        data, digests, texts = words.data.tobytes(), [], []
        for k, text in enumerate(block.column("text")):
            raw = data[words.offsets[k] : words.offsets[k + 1]]
            if not removed[k]:
                digests.append(hashlib.sha256(b" ".join(raw.split())).hexdigest())
                texts.append(raw if text.is_valid else None)
                continue
            own = range(words.first[k], words.first[k + 1])
            left = [w for w in own if not gone[w]]
            digests.append(hashlib.sha256(b" ".join(data[words.starts[w] : words.ends[w]] for w in left)).hexdigest())
            # a kept word keeps what stands before it, up to the word before; the end keeps the last blanks
            parts = [data[(words.ends[w - 1] if w > own.start else words.offsets[k]) : words.ends[w]] for w in left]
            texts.append(b"".join([*parts, data[words.ends[own.stop - 1] : words.offsets[k + 1]]]).strip(b" \t\n\r\x0b\x0c") if left else b"")
        yield pa.RecordBatch.from_arrays(
            [block.column("row"), block.column("doc_id"), pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()),
             pa.array(texts, pa.binary()).cast(pa.string())],
            ["row", "doc_id", "n_words", "n_removed", "kept_sha256", "text"])


def remove_repeats(documents: DataFrame, *, size: int = 13, buckets: int | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, text, and row, a struct of the columns asked for.

    A word goes if it lies in a window of size words that also starts in a document with a smaller doc_id;
    all windows are judged on the input. text holds the words left, with the blanks that stood before them.

    * Each block of texts finds its distinct windows and sends each with the block's smallest document to the
      bucket of its hash, so a passage that all documents share costs an entry a block. Documents of the block
      with the same window and a larger doc_id are settled there and then.
    * A bucket, of even size since hashes are even, finds the smallest document of each window and lists the
      entries of larger ones. buckets grows with the tasks that read the input.
    * The windows of a document, never more than it has words, meet its text; whole intervals are cut there.

    Null text: no words, stays null. Null doc_id: larger than any other; equal ids are not smaller than each
    other. Rows without an id look up their windows by a digest of their text, so however many there are, each meets
    its own windows only (of equal digests, those of either; which of them are repeated is the same for both).
    Rows that share an id each meet the windows of all of them. Texts with fewer than size words keep all. Other columns are ignored but for columns.
    """
    docs = documents.select(
        F.struct(*[F.col(c) for c in columns]).alias("row") if columns else F.lit(0).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.when(F.col("doc_id").isNull(), F.xxhash64(F.col("text").cast("string"))).alias("digest"))
    buckets = buckets or 8 * input_tasks(documents)
    cut: Callable = lambda batches: cut_batches(batches, size)
    found = docs.select("doc_id", "text", "digest").mapInArrow(
        lambda batches: window_batches(batches, size, buckets), "bucket long, kind int, hashes binary, ids binary")
    windows = found.groupBy("bucket").applyInArrow(repeated, "doc_id long, digest long, window long")
    # an id, or the digest where there is none
    own = F.coalesce("digest", "doc_id")
    lists = windows.groupBy(own.alias("owner"), F.col("digest").isNotNull().alias("nameless")).agg(F.collect_list("window").alias("windows"))
    joined = docs.join(lists, (own == F.col("owner")) & (F.col("digest").isNotNull() == F.col("nameless")), "left").select("row", "doc_id", "text", "windows")
    kind = docs.schema["row"].dataType.simpleString()
    return joined.mapInArrow(cut, f"row {kind}, doc_id long, n_words long, n_removed long, kept_sha256 string, text string")
