"""Hard negatives: exact inner-product search with length buckets and coordinate pruning, as in LEMP."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyjoin.llm.common import Stage
from skyjoin.operators.ordering import with_position

SCALE = 256
#: Rows of a length bucket, numbers of vectors that one task holds at most (24 bytes each with their order), and coordinates
#: of an anchor that ranges are looked up for.
BUCKET, HELD, FOCUS = 512, 1 << 22, 4
#: Stands for a null vec_id, which comes last.
NO_ID = (1 << 63) - 1
#: Values of vectors beyond this are cut to it, so that sums of products fit 64 bits.
LARGEST = (1 << 26) - 1

FOUND = "anchor long, rank int, at long, vec_id long, score long"


# ---- rows

def quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as 32-bit numbers, floor(SCALE x), with their lengths. Rows without label, or with a null or non-finite value, go."""
    for batch in batches:
        vectors = batch.column("vector")
        values = vectors.flatten()
        numbers = np.asarray(values.cast(pa.float64()).fill_null(np.nan))
        sizes = np.asarray(vectors.value_lengths().fill_null(0).cast(pa.int64()))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        broken = np.concatenate([[0], np.cumsum(~np.isfinite(numbers))])
        good = (np.diff(broken[ends]) == 0) & np.asarray(vectors.is_valid()) & np.asarray(batch.column("label").is_valid())
        with np.errstate(all="ignore"):
            whole = np.nan_to_num(np.clip(np.floor(SCALE * numbers), -LARGEST, LARGEST)).astype("<i4")
        rows = np.flatnonzero(good)
        parts = [whole[ends[r] : ends[r + 1]] for r in rows]
        lengths = [float(np.sqrt((p.astype(np.float64) ** 2).sum())) for p in parts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").take(pa.array(rows)), batch.column("label").take(pa.array(rows)), pa.array(lengths, pa.float64()), pa.array([p.tobytes() for p in parts], pa.binary())],
            ["vec_id", "label", "length", "vector"])


def matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows; a shorter one ends in zeros."""
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, : len(v) // 4] = np.frombuffer(v, "<i4")
    return out


# ---- search in the rows of one task

@dataclass
class Bucket:
    """Rows of about equal length: numbers, their directions, and for each coordinate the rows in its order."""

    first: int
    vectors: np.ndarray
    longest: float
    values: np.ndarray
    order: np.ndarray

    @staticmethod
    def of(first: int, vectors: np.ndarray, lengths: np.ndarray) -> Bucket:
        directions = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        order = np.argsort(directions, axis=0, kind="stable")
        return Bucket(first, vectors, float(lengths.max(initial=0)), np.take_along_axis(directions, order, axis=0).T.copy(), order.T.copy())

    def candidates(self, direction: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray | None:
        """Rows whose direction can have the cosine with the anchor's, or more. None stands for all.

        On the unit sphere q.p = cos(b - a) at most, where q[f] = cos b and p[f] = cos a. So a lies within the angle
        of the cosine about b, for every coordinate f.
        """
        angle = np.arccos(cosine)
        chosen = None
        for f in focus:
            own = np.arccos(np.clip(direction[f], -1, 1))
            a = np.searchsorted(self.values[f], np.cos(min(own + angle, np.pi)) - 1e-9, "left")
            b = np.searchsorted(self.values[f], np.cos(max(own - angle, 0.0)) + 1e-9, "right")
            if b - a == len(self.vectors):
                continue
            near = self.order[f, a:b]
            chosen = near if chosen is None else chosen[np.isin(chosen, near, assume_unique=True)]
            if not len(chosen):
                break
        return chosen


class Index:
    """All rows of a task, longest first, in buckets."""

    def __init__(self, rows: pa.Table, width: int):
        lengths = np.asarray(rows["length"])
        order = np.argsort(-lengths, kind="stable")
        rows, self.lengths = rows.take(pa.array(order)), lengths[order]
        self.at = np.asarray(rows["at"])
        self.ids = np.asarray(rows["vec_id"].fill_null(NO_ID))
        self.labels = np.asarray(rows["label"])
        self.width = width
        vectors = rows["vector"].to_pylist()
        self.buckets = [Bucket.of(k, matrix(vectors[k : k + BUCKET], width), self.lengths[k : k + BUCKET]) for k in range(0, len(vectors), BUCKET)]

    def search(self, at: int, label: int, length: float, vector: np.ndarray, low: list[int] | None, high: list[int] | None, count: int):
        """The first count rows of each rank's band, by descending score and then vec_id: arrays rank, row, score.

        Without high: one band, of rows with the anchor's label other than itself, from the best count found so far
        upwards. With high: of rows with other labels, bands of scores from low[rank] to high[rank].

        A bucket is done once its longest row can't reach the lowest score that any band still takes; until then
        rows whose coordinates rule out that score are passed over, and the others compared exactly.
        """
        negatives = high is not None
        tops = np.array(high if negatives else [NO_ID], np.int64)
        lows = np.array(low if negatives else [-NO_ID], np.int64)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in tops]
        direction = vector / length if length > 0 else vector
        focus = np.argsort(-np.abs(direction), kind="stable")[:FOCUS]
        floors = np.where(lows <= tops, lows, NO_ID)
        for bucket in self.buckets:
            reach = length * bucket.longest
            least = int(floors.min())
            # a little below, for what rounding does to lengths and directions
            if least > reach * (1 + 1e-9) + 1:
                break
            some = bucket.candidates(direction, focus, min((least - 1) / reach, 1.0)) if least > 1 and reach > 0 else None
            vectors = bucket.vectors if some is None else bucket.vectors[some]
            rows = bucket.first + (np.arange(len(vectors)) if some is None else some)
            scores = exact(vectors, vector)
            fit = ((self.labels[rows] == label) != negatives) & (self.at[rows] != at) & (scores >= least)
            rows, scores = rows[fit], scores[fit]
            if not len(rows):
                continue
            for rank, top in enumerate(tops):
                inside = (scores <= top) & (scores >= floors[rank])
                if not inside.any():
                    continue
                r, s = np.concatenate([best[rank][0], rows[inside]]), np.concatenate([best[rank][1], scores[inside]])
                keep = np.lexsort((self.ids[r], -s))[:count]
                best[rank] = r[keep], s[keep]
                if len(keep) == count:
                    floors[rank] = max(lows[rank], s[keep[-1]])
        ranks = np.concatenate([np.full(len(r), k) for k, (r, _) in enumerate(best)]) if len(tops) else np.zeros(0, np.int64)
        return ranks, np.concatenate([r for r, _ in best] or [np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([s for _, s in best] or [np.zeros(0, np.int64)])


def exact(vectors: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers: in doubles where these are exact, else in 64-bit numbers."""
    bound = np.abs(vectors).max(initial=0) * np.abs(vector).sum()
    return (vectors @ vector).astype(np.int64) if bound < 2**53 else vectors.astype(np.int64) @ vector.astype(np.int64)


def answers(batches: Iterator[pa.RecordBatch], width: int, count: int) -> Iterator[pa.RecordBatch]:
    """Parts one after the other: first the rows of a part (kind 0), which are kept, then its anchors (kind 1)."""
    part, held, index = None, [], None
    for batch in batches:
        numbers, kinds = np.asarray(batch.column("part")), np.asarray(batch.column("kind"))
        edges = [0, *(np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            piece = batch.slice(a, b - a)
            if numbers[a] != part:
                part, held, index = numbers[a], [], None
            if kinds[a] == 0:
                held.append(piece)
                continue
            if index is None:
                if not held:
                    continue
                index, held = Index(pa.Table.from_batches(held), width), []
            anchors, ranks, ats, ids, scores = [], [], [], [], []
            for row in piece.to_pylist():
                vector = matrix([row["vector"]], width)[0]
                rank, at, score = index.search(row["at"], row["label"], row["length"], vector, row["low"], row["high"], count)
                anchors.append(np.full(len(rank), row["at"]))
                ranks.append(rank), ats.append(index.at[at]), ids.append(index.ids[at]), scores.append(score)
            anchors, ranks, ats, ids, scores = (np.concatenate(x).astype(np.int64) for x in (anchors, ranks, ats, ids, scores))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors), pa.array(ranks.astype(np.int32)), pa.array(ats), pa.array(ids, mask=ids == NO_ID), pa.array(scores)], ["anchor", "rank", "at", "vec_id", "score"])


# ---- the job

def searched(rows: DataFrame, anchors: DataFrame, width: int, count: int) -> DataFrame:
    """Answers of anchors (part, low, high and the columns of rows) in the parts of rows that they are sent to.

    A part's rows go to one task, followed by its anchors, however many: only the rows are held there.
    """
    empty = F.lit(None).cast("array<bigint>")
    columns = ["part", "kind", "at", "vec_id", "label", "length", "vector", "low", "high"]
    both = rows.withColumns({"kind": F.lit(0), "low": empty, "high": empty}).select(*columns).unionByName(anchors.withColumn("kind", F.lit(1)).select(*columns))
    return both.repartitionByRange("part").sortWithinPartitions("part", "kind").mapInArrow(lambda b: answers(b, width, count), FOUND)


def first_of(found: DataFrame, keys: list[str], count: int) -> DataFrame:
    """The first count rows of each key by descending score, then vec_id."""
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "at")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)


def hundredth(x: Column) -> Column:
    """A whole number divided by 100, rounded down, without a double in between."""
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))


def mine(embeddings: DataFrame, stage: Stage, *, every: int = 50, changed: int = 7, labels: int = 10, positives: int = 5, negatives: int = 3,
         least_percent: int = 50, most_percent: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of embeddings (vec_id, embedding, label).

    Values become floor(256 x); the score of two rows is their inner product. Rows whose vec_id is divisible by changed
    get the next label of labels; those divisible by every are anchors. Of an anchor's first positives rows of its own
    label, each gets the first negatives rows of other labels with least_percent to most_percent of its score. Higher
    scores come first, then smaller vec_id.

    Rows are stored by label and falling length, and parts of HELD numbers or fewer meet the anchors in one task each; an
    anchor goes to the parts that hold its label, then to those that can reach the lowest score it takes. There
    buckets of BUCKET rows keep every coordinate in order; see Index and Bucket. No row or score is left out: pruning
    drops only what can't reach the score looked for.

    Rows with a null label, a null vector, or a null or non-finite value take no part. A shorter vector ends in zeros;
    an empty one scores 0. Values beyond LARGEST after scaling count as that. Null vec_id: no anchor, last among equal
    scores, null in the result. Rows with one vec_id are different rows, each an anchor or a partner by itself. Other
    columns are ignored; an empty table gives none.
    """
    given = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    moved = F.when(F.col("vec_id") % changed == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    rows = stage.write(given.mapInArrow(quantised, "vec_id long, label int, length double, vector binary").withColumn("label", moved), "rows")
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.octet_length("vector")), F.lit(0)).alias("bytes")).first()
    tasks, width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), size.bytes // 4
    in_part = min(max(1, HELD // max(width, 1)), max(BUCKET, -(-size.n // tasks)))

    rows = with_position(rows, ["label", F.col("length").desc(), F.col("vec_id").asc_nulls_last()], "at")
    rows = rows.withColumn("part", F.floor((F.col("at") - 1) / in_part))
    anchors = rows.where(F.col("vec_id") % every == 0).drop("part")
    none = F.lit(None).cast("array<bigint>")
    holds = rows.select("part", "label").distinct()
    found = searched(rows, anchors.join(holds, "label").withColumns({"low": none, "high": none}), width, positives)
    chosen = first_of(found, ["anchor"], positives).select("anchor", F.col("place").alias("p"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    chosen = stage.write(chosen, "positives")

    # at most positives bands an anchor
    bands = chosen.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("p", "positive_score"))).alias("bands"))
    bands = bands.select(
        F.col("anchor").alias("at"), F.transform("bands", lambda b: -hundredth(-least_percent * b["positive_score"])).alias("low"),
        F.transform("bands", lambda b: hundredth(most_percent * b["positive_score"])).alias("high"))
    parts = rows.groupBy("part").agg(F.min("label").alias("from"), F.max("label").alias("to"), F.max("length").alias("longest"))
    sent = anchors.join(bands, "at").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, -(-size.n // in_part) - 1)).cast("long")))).join(parts, "part")
    sent = sent.where(((F.col("from") != F.col("label")) | (F.col("to") != F.col("label"))) & (F.array_min("low") <= F.col("length") * F.col("longest") * (1 + 1e-9) + 1))
    found = searched(rows, sent, width, negatives).withColumn("p", F.col("rank") + 1)
    hard = first_of(found, ["anchor", "p"], negatives)
    names = anchors.select(F.col("at").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return hard.join(chosen, ["anchor", "p"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
