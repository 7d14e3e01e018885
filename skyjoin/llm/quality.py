"""Quality rules: repetition found by suffix arrays, and simple counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from skyjoin.llm.common import Words, blocks

#: Bytes of text in a block; ranks of a word's suffix take several numbers a word.
BLOCK = 1 << 20
#: Repeats count from this many words.
LEAST = 5
#: The method's limits: share of a text's word characters in repeats, and words in the longest repeat.
MOST_COVERED, MOST_WORDS = 0.20, 200
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def rank_levels(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffix array of each text of a block by prefix doubling, all texts at once.

    Returns the suffixes in order of (text, words), the end of each suffix's text, and ranks by the first 2, 4,
    8 ... words. Two suffixes of equal rank share that prefix: past its end a text has the code 0, at a place
    that differs between its suffixes. Only suffixes whose rank is shared are sorted again.
    """
    n = len(codes)
    ends = np.repeat(np.cumsum(counts), counts)
    text = np.repeat(np.arange(len(counts)), counts)
    word = codes.astype(np.int64) + 1
    following = np.zeros(n, np.int64)
    following[:-1] = word[1:]
    following[np.arange(n) + 1 >= ends] = 0
    width = int(word.max(initial=0)) + 1
    key = (text * width + word) * width + following
    order = np.argsort(key)
    levels, k = [], 2
    head = np.ones(n, bool)
    head[1:] = key[order][1:] != key[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    while True:
        levels.append(rank.copy())
        alone = head.copy()
        alone[:-1] &= head[1:]
        active = np.flatnonzero(~alone)
        if not len(active):
            return order, ends, levels
        suffix = order[active]
        later = np.minimum(suffix + k, n - 1)
        second = np.where(suffix + k < ends[suffix], rank[later] + 1, 0)
        again = np.lexsort((second, rank[suffix]))
        order[active] = suffix[again]
        split = np.ones(len(active), bool)
        first, second = rank[suffix][again], second[again]
        split[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        head[active] = split
        rank[order[active]] = np.maximum.accumulate(np.where(split, active, 0))
        k *= 2


def repeat_lengths(codes: np.ndarray, counts: np.ndarray, least: int = LEAST) -> np.ndarray:
    """For each word, the longest substring from there that occurs twice in its text, or 0 where shorter than least.

    That is the larger of the two longest common prefixes with the neighbours in suffix order. Prefixes are
    measured by ranks, from the longest power of two down.
    """
    n = len(codes)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    order, ends, levels = rank_levels(codes, counts)
    start = min(len(levels) - 1, max(0, least.bit_length() - 2))  # the largest power of two up to least
    pair = np.flatnonzero(levels[start][order[1:]] == levels[start][order[:-1]])
    a, b = order[pair], order[pair + 1]
    length = np.zeros(len(pair), np.int64)
    word = codes
    for level in range(len(levels) - 1, -2, -1):
        x, y = a + length, b + length
        fits = (x < ends[a]) & (y < ends[b])
        x, y = np.minimum(x, n - 1), np.minimum(y, n - 1)
        ranks = levels[level] if level >= 0 else word
        same = fits & (ranks[x] == ranks[y])
        length += same * (2 << level if level >= 0 else 1)
    length[length < least] = 0
    np.maximum.at(longest, a, length)
    np.maximum.at(longest, b, length)
    return longest


def with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches whose text is that of their row, where they have no other."""
    for batch in batches:
        names = batch.schema.names
        yield batch if "text" in names else pa.RecordBatch.from_arrays([*batch.columns, batch.column("row").field("text")], [*names, "text"])


def rule_batches(batches: Iterator[pa.RecordBatch], most_covered: float, most_words: int) -> Iterator[pa.RecordBatch]:
    for block in blocks(with_text(batches), BLOCK):
        words = Words(block.column("text"))
        n, counts = len(words), words.counts
        longest = repeat_lengths(words.coded[0], counts)
        marks = np.zeros(n + 1, np.int64)
        starts = np.flatnonzero(longest)
        np.add.at(marks, starts, 1)
        np.add.at(marks, starts + longest[starts], -1)
        within = np.cumsum(marks[:-1]) > 0
        by_text = lambda values, bounds: np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])
        letters = words.inside & ((words.data & 0xC0) != 0x80)
        total = np.concatenate([[0], np.cumsum(letters)])
        chars = total[words.ends] - total[words.starts]
        peak = np.zeros(len(counts), np.int64)
        full = np.flatnonzero(counts)
        if len(full):
            peak[full] = np.maximum.reduceat(longest, words.first[:-1][full])
        word_chars, repeat_chars = by_text(chars, words.first), by_text(chars * within, words.first)
        repeat_words, symbols = by_text(within, words.first), by_text(SYMBOLS[words.data], words.offsets)
        data, lines = words.data.tobytes(), []
        for k in range(len(counts)):
            own = [x for x in data[words.offsets[k] : words.offsets[k + 1]].split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
            lines.append(len(own) - len(set(own)))
        failed = (counts < 10) | (100 * repeat_words > 20 * counts)
        covered = repeat_chars / np.maximum(word_chars, 1)
        yield pa.RecordBatch.from_pydict({
            "doc_id": block.column("doc_id"), "row": block.column("row"), "n_words": pa.array(counts, pa.int64()), "word_chars": pa.array(word_chars, pa.int64()),
            "n_symbols": pa.array(symbols, pa.int64()), "n_dup_lines": pa.array(lines, pa.int64()), "n_repeat_words": pa.array(repeat_words, pa.int64()),
            "base_failed": pa.array(failed), "kept": pa.array(~failed & (covered <= most_covered) & (peak <= most_words)),
            "repeat_chars": pa.array(repeat_chars, pa.int64()), "longest_repeat": pa.array(peak, pa.int64())})


def quality_rules(documents: DataFrame, *, most_covered: float = MOST_COVERED, most_words: int = MOST_WORDS, columns: tuple[str, ...] = ()) -> DataFrame:
    """Counts and verdict for each row of documents (doc_id, text), and row, a struct of the columns asked for.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word that equal an earlier
    one), n_repeat_words (words in windows of five that occur twice), base_failed (fewer than ten words, or over
    a fifth of them in such windows), kept; and of the suffix array: repeat_chars (code points of words in
    maximal repeats of five words or more, a union of spans) and longest_repeat (words).
    kept is false if base_failed, or if repeats cover more than most_covered of word_chars, or if the longest
    has more than most_words words. A text is judged whole and alone: no shuffle.

    Null or empty text: all counts 0, base_failed, not kept. Null doc_id stays null. Repeated rows each get
    their own row. Other columns are ignored but for columns.
    """
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.struct(*[F.col(c) for c in columns]).alias("row") if columns else F.lit(0).alias("row"),
        F.col("text").cast("string").alias("text"))
    if "text" in columns and isinstance(documents.schema["text"].dataType, StringType):
        docs = docs.drop("text")  # the row has it
    kind = docs.schema["row"].dataType.simpleString()
    return docs.mapInArrow(
        lambda batches: rule_batches(batches, most_covered, most_words),
        f"doc_id long, row {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "kept boolean, repeat_chars long, longest_repeat long")
