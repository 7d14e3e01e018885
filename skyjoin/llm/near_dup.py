"""Near-duplicate documents by MinHash with tensored banding."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyjoin.llm.common import Stage, Words, blocks, constants, mixed
from skyjoin.llm.components import components

#: Half keys in each of the two collections, and MinHash values in a half key. A table key is a pair of half
#: keys, one of each collection: 144 tables of 6 values out of 72. At similarity s two documents meet with
#: probability (1 - (1 - s^3)^12)^2, which is 0.9996 at 0.8 and 0.99999 at 0.85.
HALVES, WIDTH = 12, 3
SEED = 20_240_607
#: One-bit MinHash values by which the last comparisons are chosen.
BITS = 2048


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of a block, and how many each text has; a shorter text is one shingle."""
    h, counts = words.hashes, words.counts
    n = len(h)
    factors = constants(size, SEED + size)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled[: max(0, n - k)] += h[k:] * factors[k]
    place = np.arange(n) - np.repeat(words.first[:-1], counts)
    whole = place + size <= np.repeat(counts, counts)
    short = np.flatnonzero((counts > 0) & (counts < size))
    for i in short:
        part = h[words.first[i] : words.first[i + 1]]
        rolled[words.first[i]] = (part * factors[: len(part)]).sum(dtype=np.uint64) + np.uint64(len(part))
        whole[words.first[i]] = True
    return mixed(rolled[whole]), np.where(counts < size, np.minimum(counts, 1), counts - size + 1)


def half_keys(hashes: np.ndarray, starts: np.ndarray, halves: int, width: int) -> np.ndarray:
    """2 x halves keys for each run of hashes; each hashes width MinHash values."""
    factors, mixers = constants(2 * halves * width, SEED), constants(width, SEED + 1)
    keys = np.empty((len(starts), 2 * halves), np.uint64)
    for k in range(2 * halves):
        key = np.full(len(starts), k + 1, np.uint64)
        for w in range(width):
            key += np.minimum.reduceat(hashes * factors[k * width + w], starts) * mixers[w]
        keys[:, k] = mixed(key)
    return keys


def sketch_batches(batches: Iterator[pa.RecordBatch], size: int, halves: int, width: int) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        hashes, counts = shingles(Words(block.column("text"), lower=True), size)
        ends = np.cumsum(counts)
        distinct, digests = np.zeros(len(counts), np.int64), [None] * len(counts)
        for i in np.flatnonzero(counts):
            own = np.unique(hashes[ends[i] - counts[i] : ends[i]])
            distinct[i], digests[i] = len(own), hashlib.blake2b(own.tobytes(), digest_size=16).digest()
        full = np.flatnonzero(counts)
        keys = np.zeros((len(counts), 2 * halves), np.int64)
        if len(full):
            keys[full] = half_keys(hashes, (ends - counts)[full], halves, width).view(np.int64)
        lists = lambda part: pa.ListArray.from_arrays(
            pa.array(np.arange(0, (len(counts) + 1) * halves, halves, dtype=np.int32)), pa.array(np.ascontiguousarray(part).ravel()))
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), pa.array(distinct), pa.array(digests, pa.binary()), lists(keys[:, :halves]), lists(keys[:, halves:])],
            ["doc_id", "n_shingles", "digest", "lefts", "rights"])


def set_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        hashes, counts = shingles(Words(block.column("text"), lower=True), size)
        ends = np.cumsum(counts)
        sets = [np.unique(hashes[e - c : e]).view(np.int64) for e, c in zip(ends, counts, strict=True)]
        yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "hashes"])


def bit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """BITS one-bit MinHash values of each set: two sets of similarity s differ in (1 - s) / 2 of them."""
    factors = constants(BITS, SEED + 2)[:, None]
    for batch in batches:
        lists = batch.column("hashes")
        hashes, ends = np.asarray(lists.flatten()).view(np.uint64), np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), np.int64))])
        bits = np.empty((batch.num_rows, BITS), np.uint8)
        for k in range(batch.num_rows):
            own = hashes[ends[k] : ends[k + 1]]
            for at in range(0, BITS, 64):
                bits[k, at : at + 64] = mixed((own * factors[at : at + 64]).min(1)) & np.uint64(1)
        packed = np.packbits(bits, axis=1).view(np.int64).ravel()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(np.arange(0, len(packed) + 1, BITS // 64, dtype=np.int32)), pa.array(packed))], ["doc_id", "bits"])


def most_apart(percent: int) -> int:
    """One-bit values in which two sets that link may differ: five standard deviations above the mean, which one
    link in three million exceeds."""
    share = (1 - percent / 100) / 2
    return math.ceil(BITS * share + 5 * math.sqrt(BITS * share * (1 - share)))


def common_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = []
        for name in ("a_set", "b_set"):
            lists = batch.column(name)
            sides.append((np.asarray(lists.flatten()), np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), np.int64))])))
        (x, x_ends), (y, y_ends) = sides
        common, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for k in range(batch.num_rows):
            merged = np.concatenate([x[x_ends[k] : x_ends[k + 1]], y[y_ends[k] : y_ends[k + 1]]])
            merged.sort()
            common[k] = np.count_nonzero(merged[1:] == merged[:-1])
            total[k] = len(merged) - common[k]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(common), pa.array(total)], ["a", "b", "common", "total"])


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, common, total: sizes of intersection and union of the full sets of each pair."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("a_set"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("b_set"))
    both = pairs.join(b, "b").join(a, "a").select("a", "b", "a_set", "b_set")
    return both.mapInArrow(common_batches, "a long, b long, common long, total long")


def near_duplicates(
    documents: DataFrame, stage: Stage, *, size: int = 5, percent: int = 80, halves: int = HALVES, width: int = WIDTH,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of documents (doc_id, text).

    Documents link if their sets of word shingles (A-Z in lower case) hold 100 * common >= percent * union.
    component_id is the smallest doc_id that links reach; kept marks the rows that bear it.

    * Equal sets make one class, found by a digest with minima combined before the shuffle; classes alone go on.
    * Table keys: halves**2 pairs of half keys. A table key can repeat only where its left half does, so
      keys are paired for those left halves alone.
    * Members of a table key are compared in rounds, on full sets: first each class with the smallest partner
      that any of its keys offers; then, within keys whose members are still in several components, each with
      the key's smallest member; last, members of different components. Members of one component need no
      comparison. Of the last pairs the join drops those that sizes or distances to the smallest member rule
      out (set distance is a metric), those that share an earlier key, and those whose BITS one-bit values
      differ by more than most_apart: only pairs about the threshold and above are compared on full sets.
    * Shingles that one candidate alone has bound its links from above. Texts that share a common passage, and
      little else, fall out by that before any comparison.

    Null or wordless text: no shingles, no links. Null doc_id: component_id null, kept, no links. Rows that
    share a doc_id are one document with several texts. Other columns are ignored; an empty table gives none.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = stage.write(docs.mapInArrow(
        lambda batches: sketch_batches(batches, size, halves, width),
        "doc_id long, n_shingles long, digest binary, lefts array<long>, rights array<long>"), "sketches")
    linkable = sketches.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stage.write(linkable.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("lefts").alias("lefts"), F.first("rights").alias("rights")), "classes")

    # table keys held by two classes or more
    lefts = classes.select("digest", "doc_id", "n", F.posexplode("lefts").alias("i", "left"), "rights")
    twice = lefts.groupBy("left").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("top")).where("low != top").select("left")
    keyed = lefts.join(twice, "left", "left_semi").select("digest", "doc_id", "n", "i", "left", F.posexplode("rights").alias("j", "right"))
    keyed = stage.write(keyed.select(F.xxhash64("left", "right").alias("key"), "i", "j", F.struct("doc_id", "n", "digest").alias("x")), "keys")
    several = keyed.groupBy("key").agg(F.min("x.doc_id").alias("low"), F.max("x.doc_id").alias("top")).where("low != top")
    keyed = stage.write(keyed.join(several.select("key"), "key", "left_semi"), "repeated")
    sets = stage.write(docs.join(keyed.select("x.doc_id").distinct(), "doc_id", "left_semi").mapInArrow(
        lambda batches: set_batches(batches, size), "doc_id long, hashes array<long>"), "sets")

    # shingles that no other candidate has bound all links of a document
    owners = sets.select("doc_id", F.explode("hashes").alias("hash")).groupBy("hash").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("top"))
    own = owners.where("doc_id = top").groupBy("doc_id").agg(F.count("*").alias("own"))
    single = sets.groupBy("doc_id").agg(F.count("*").alias("texts")).where("texts = 1").select("doc_id")
    own = stage.write(own.join(single, "doc_id", "left_semi"), "own")
    keyed = keyed.join(own, F.col("x.doc_id") == own.doc_id, "left").select(
        "key", "i", "j", F.struct("x.doc_id", "x.n", F.coalesce("own", F.lit(0)).alias("own"), "x.digest").alias("x"))
    keyed = stage.write(keyed.where(may_link("x", "x", percent)), "linkable")
    firsts = keyed.groupBy("key").agg(F.min("x").alias("a"), F.max("x.doc_id").alias("top")).where("a.doc_id != top").drop("top")
    members = stage.write(keyed.join(firsts, "key").select("key", "i", "j", "x", "a"), "members")

    linked = F.expr(f"100 * common >= {int(percent)} * total")
    # rows with one doc_id but several texts
    several = linkable.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("top")).where("low != top").select("doc_id")
    links = linkable.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("b"), "digest").join(
        classes.select("digest", F.col("doc_id").alias("a")), "digest").select("a", "b")

    nearest = members.where(may_link("a", "x", percent) & F.expr("a.doc_id != x.doc_id")).groupBy(F.col("x.doc_id").alias("b")).agg(F.min("a.doc_id").alias("a"))
    first = stage.write(compared(nearest.select("a", "b"), sets), "first")
    links = links.union(first.where(linked).select("a", "b"))
    group = components(stage, links)

    pairs = open_members(members, group).where(may_link("a", "x", percent) & F.expr("a.doc_id != x.doc_id AND group != a_group"))
    pairs = pairs.select(F.col("a.doc_id").alias("a"), F.col("x.doc_id").alias("b")).distinct()
    second = stage.write(compared(pairs.join(first, ["a", "b"], "left_anti"), sets), "second")
    links = links.union(second.where(linked).select("a", "b"))
    group = components(stage, links)

    # keys whose members are still apart: compare them with one another
    known = first.union(second).groupBy("a", F.col("b").alias("doc_id")).agg(F.when(F.count("*") == 1, F.max(F.col("common") / F.col("total"))).alias("near"))
    rest = open_members(members, group).select("key", "i", "j", "group", "x", F.col("x.doc_id").alias("doc_id"), F.col("a.doc_id").alias("a")).where("doc_id != a")
    rest = rest.join(known, ["a", "doc_id"], "left")
    apart = rest.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("top")).where("low != top").select("key")
    rest = stage.write(rest.join(apart, "key", "left_semi").select("key", "i", "j", "doc_id", "x", "group", "near"), "rest")
    bits = sets.join(rest.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(bit_batches, "doc_id long, bits array<long>")
    halves_of = classes.select(F.col("digest").alias("of"), "lefts", "rights")
    rest = stage.write(rest.join(stage.write(bits, "bits"), "doc_id").join(halves_of, F.col("x.digest") == F.col("of")).drop("doc_id", "of"), "described")
    one = rest.select("key", *[F.col(c).alias(f"{c}1") for c in rest.columns if c != "key"])
    gap = 1 - int(percent) / 100 + 1e-9
    first_key = " AND ".join(f"NOT ({n} > {k} AND {side}1[{k}] = {side}[{k}])" for n, side in (("i", "lefts"), ("j", "rights")) for k in range(halves - 1))
    apart_bits = " + ".join(f"bit_count(bits1[{k}] ^ bits[{k}])" for k in range(BITS // 64))
    pairs = one.join(rest, "key").where(
        F.expr("group1 < group") & may_link("x1", "x", percent) & (F.coalesce(F.abs(F.col("near1") - F.col("near")), F.lit(0.0)) <= gap)
        & F.expr(first_key) & F.expr(f"{apart_bits} <= {most_apart(percent)}"))
    pairs = pairs.select(F.least("x1.doc_id", "x.doc_id").alias("a"), F.greatest("x1.doc_id", "x.doc_id").alias("b")).distinct()
    third = stage.write(compared(pairs, sets), "third")
    group = components(stage, links.union(third.where(linked).select("a", "b")))
    stage.drop(sets, members)

    named = classes.select("digest", "doc_id").join(group, F.col("doc_id") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "doc_id").alias("component"))
    rows = sketches.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    return rows.join(named, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component", "doc_id")).alias("kept"))


def may_link(x: str, y: str, percent: int) -> Column:
    """Whether sizes leave room for a link: sets of n shingles, own of them in no other document, have at most
    n - own in common, and at least the n of one and the own of the other in all."""
    return F.expr(f"100 * least({x}.n - {x}.own, {y}.n - {y}.own) >= {int(percent)} * greatest({x}.n, {y}.n)") & F.expr(
        f"{x}.doc_id = {y}.doc_id OR 100 * least({x}.n - {x}.own, {y}.n - {y}.own) >= {int(percent)} * greatest({x}.n + {y}.own, {y}.n + {x}.own)")


def open_members(members: DataFrame, group: DataFrame) -> DataFrame:
    """Members of keys, with their components and that of their key's smallest member, where a key has several."""
    named = members.withColumn("doc_id", F.col("x.doc_id")).join(group.select(F.col("node").alias("doc_id"), F.col("component").alias("group")), "doc_id", "left")
    named = named.withColumn("group", F.coalesce("group", "doc_id")).drop("doc_id")
    several = named.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("top"), F.min_by("group", "x.doc_id").alias("a_group")).where("low != top")
    return named.join(several.select("key", "a_group"), "key")
