"""Mixing of sources to target weights by Sainte-Lague apportionment. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyjoin.llm.common import Stage

#: Blocks that the whole mix has, and shards that it is dealt to. Both and the number of sources bound every table
#: below but the documents'.
BLOCKS, SHARDS = 65_536, 16
#: Blocks that a target has at least: a source with fewer has smaller blocks of its own, down to a word.
FEWEST = 64
#: How often a source, and so a document, may be taken at most.
MOST = 3
SEED = 11
#: Layers of documents, by number of words, to a doubling; documents in a part of a layer; fractions of a document.
LAYERS, PART, ONE = 4, 4096, 1 << 30
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """One row per source (source, source_size): its weight 1, 2, 3, 1 ... by code point, null last, and its target.

    Weights share all sizes. A target stops at most times its source's size and the rest is shared anew, until
    none is above: with sources in order of size per weight, those that stop come first, and the first k stop
    for the smallest k at which the next one's fair share fits.
    """
    by_source = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", (F.row_number().over(by_source) - 1) % 3 + 1)
    by_room = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, all_rows = by_room.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    stopped = F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0))
    weights = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    total = F.sum("source_size").over(all_rows)
    level = ((total - stopped) / weights)
    ranked = ranked.withColumns({"total": total, "level": level, "room": F.row_number().over(by_room)})
    fits = F.col("level") * F.col("weight") <= most * F.col("source_size")
    first = F.struct("room", "level")
    ranked = ranked.withColumn("cut", F.min(F.when(fits, first)).over(all_rows))
    free = F.col("room") >= F.col("cut.room")
    return ranked.select(
        "source", "source_size", "weight", "total",
        F.when(free, F.col("cut.level") * F.col("weight")).otherwise(F.col("source_size") * F.lit(float(most))).alias("target"))


def block_quotas(targets: DataFrame, blocks: int = BLOCKS, shards: int = SHARDS, most: int = MOST) -> DataFrame:
    """source, source_size, target, block_size, quota, shard_quotas for each source.

    All words make at most blocks blocks of equal size. They go one by one to the source with the highest
    quotient target / (2 * blocks held + 1); ties go to the smaller source. The first shard's blocks are the
    first dealt, and so on, which apportions every shard's part too. A source bids for as many blocks as
    its target holds and two more, so all bids are few more than blocks and sources.

    A source whose target is under FEWEST such blocks takes no part in that. It has blocks of its own, of a
    FEWEST-th of its target or one word, as many as come nearest to the target and dealt evenly to the shards;
    what is left of all words makes the other blocks. A target is a third of an even share at least or three
    times its source, so such sources together have some hundred blocks for each source.
    """
    size = F.greatest(F.ceil(F.col("total") / blocks), F.lit(1)).cast("long")
    sized = targets.withColumn("common", size).withColumn("own", F.col("target") < FEWEST * F.when(F.col("common") > 1, F.col("common")).otherwise(F.lit(0)))
    own_size = F.greatest(F.floor(F.col("target") / FEWEST), F.lit(1)).cast("long")
    own_words = F.coalesce(F.sum(F.when(F.col("own"), F.col("target"))).over(W.partitionBy()), F.lit(0.0))
    sized = sized.withColumn("block_size", F.when(F.col("own"), own_size).otherwise(F.col("common"))).withColumn("all_blocks", F.ceil((F.col("total") - own_words) / F.col("common")))
    bids = sized.where("target > 0 AND NOT own").select("source", "target", "all_blocks",
                        F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("target") / F.col("block_size")) + 1)).alias("held"))
    order = W.orderBy(F.desc(F.col("target") / (2 * F.col("held") + 1)), F.col("source").asc_nulls_last(), "held")
    dealt = bids.withColumn("seat", F.row_number().over(order)).where("seat <= all_blocks").select("source", "seat", "all_blocks")
    own_quota = F.round(F.col("target") / F.col("block_size")).cast("long")
    apart = sized.where("own").withColumn("all_blocks", own_quota).where("all_blocks > 0").select(
        "source", F.explode(F.sequence(F.lit(1).cast("long"), F.col("all_blocks"))).alias("seat"), "all_blocks")
    dealt = dealt.unionByName(apart)
    shard = F.floor((F.col("seat") - 1) * shards / F.col("all_blocks")).cast("int")
    by_shard = dealt.groupBy("source", shard.alias("shard")).agg(F.count("*").alias("quota"))
    quotas = by_shard.groupBy("source").agg(F.sum("quota").alias("quota"), F.array_sort(F.collect_list(F.struct("shard", "quota"))).alias("shard_quotas"))
    other = quotas.withColumnRenamed("source", "other")
    return sized.join(other, F.col("source").eqNullSafe(F.col("other")), "left").select(
        "source", "source_size", "target", "block_size", F.coalesce("quota", F.lit(0)).alias("quota"), "shard_quotas")


def running(rows: DataFrame, part: Column, order: list[str], value: str, name: str) -> DataFrame:
    """rows with the running sum of value along each source. part grows with order: rows are summed within a part, in a task
    each, after the sums of the parts before, so a source with most of the rows is not one task's."""
    rows = rows.withColumn("part", part)
    sums = rows.groupBy(F.col("source").alias("of"), F.col("part").alias("at")).agg(F.sum(value).alias("sum"))
    before = F.sum("sum").over(W.partitionBy("of").orderBy("at")) - F.col("sum")
    within = F.sum(value).over(W.partitionBy("source", "part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    placed = rows.withColumn("within", within).join(sums.select("of", "at", before.alias("offset")), F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("at")))
    return placed.withColumn(name, F.col("offset") + F.col("within")).drop("part", "of", "at", "within", "offset")


def mix(documents: DataFrame, stage: Stage, *, blocks: int = BLOCKS, shards: int = SHARDS, most: int = MOST, seed: int = SEED, buckets: int | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for each row of documents (doc_id, text, source), and row,
    a struct of the named columns of documents, if any are named.

    size counts words. Each source's documents stand in an order drawn by MD5 of seed and doc_id, end to end,
    and are cut into blocks of block_size words. The source gives quota * block_size words: whole passes over
    all its documents, and for the rest blocks drawn by MD5 of seed, source and block number. taken counts the
    words of a document in all passes and drawn blocks; a block may end inside a document, and a source's last
    block is shorter. No document is taken more than most times.

    Places are running sums within buckets of the order, and so are those of blocks, so a source with most of the rows is
    spread over all tasks; what is joined with the documents has one row per bucket of a source, or per block.

    Null text: size 0, taken 0. Null source: a source of its own, last. Null doc_id: ordered as an empty one;
    rows with one doc_id are placed by size, and equal rows may change places. No words at all: targets and
    takes are 0. Other columns are ignored.
    """
    buckets = buckets or 16 * int(stage.spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.col("text").cast("string")
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), drawn.alias("drawn"),
        *([F.struct(*columns).alias("row")] if columns else []))
    row = ["row"] if columns else []
    # a bucket is a range of the order
    bucket = F.floor(F.conv(F.substring("drawn", 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32)).cast("long")
    sized = stage.write(sized.withColumn("bucket", bucket), "sizes")
    sums = stage.write(sized.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "sums")
    quotas = stage.write(block_quotas(source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), most), blocks, shards, most), "quotas")

    # what a source gives: whole passes, and drawn blocks
    source_size = F.col("source_size")
    gives = F.least(F.col("quota") * F.col("block_size"), most * source_size)
    passes = F.when(source_size > 0, F.floor(gives / source_size)).otherwise(F.lit(0))
    plan = quotas.withColumn("passes", passes).withColumn("rest", gives - F.col("passes") * source_size)
    numbers = plan.where("source_size > 0").select(
        "source", "source_size", "block_size", "rest", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((source_size - 1) / F.col("block_size")))).alias("block"))
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce("source", F.lit("")), F.col("block").cast("string")).cast("binary"))
    numbers = numbers.withColumns({"words": F.least(F.col("block_size"), source_size - F.col("block") * F.col("block_size")), "draw": draw})
    # blocks in drawn order until the rest is met, nearer than half a block
    met = running(numbers, F.substring("draw", 1, 2), ["draw", "block"], "words", "met")
    met = stage.write(met.select("source", "block", "words", (F.col("met") - F.col("words") / 2 <= F.col("rest")).alias("chosen")), "met")
    met = met.withColumn("chosen_words", F.when(F.col("chosen"), F.col("words")).otherwise(F.lit(0)))
    drawn_blocks = stage.write(running(met, F.shiftright("block", 8), ["block"], "chosen_words", "upto").select(
        "source", "block", "chosen", (F.col("upto") - F.col("chosen_words")).alias("before")), "blocks")

    # places of documents in their source's order
    by_bucket = W.partitionBy("source").orderBy("bucket")
    offsets = sums.select(F.col("source").alias("at_source"), F.col("bucket").alias("at_bucket"), (F.sum("words").over(by_bucket) - F.col("words")).alias("offset"))
    within = W.partitionBy("source", "bucket").orderBy("drawn", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = sized.withColumn("upto", F.sum("size").over(within)).join(
        offsets, F.col("source").eqNullSafe(F.col("at_source")) & (F.col("bucket") == F.col("at_bucket")))
    other = plan.select(F.col("source").alias("of"), "source_size", "target", "block_size", "passes")
    placed = placed.join(other, F.col("source").eqNullSafe(F.col("of")))
    end = F.col("offset") + F.col("upto")
    placed = placed.select("doc_id", "source", "size", *row, "source_size", "target", "block_size", "passes", (end - F.col("size")).alias("start"), end.alias("end"))
    # words of drawn blocks up to a place: those of the blocks before, and the part of its own
    for edge in ("start", "end"):
        edges = drawn_blocks.select(F.col("source").alias("of"), F.col("block").alias("at"), F.col("chosen").alias(f"{edge}_chosen"), F.col("before").alias(f"{edge}_before"))
        at = F.floor(F.greatest(F.col(edge) - (1 if edge == "end" else 0), F.lit(0)) / F.col("block_size"))
        placed = placed.withColumn(f"{edge}_block", at)
        placed = placed.join(edges, F.col("source").eqNullSafe(F.col("of")) & (F.col(f"{edge}_block") == F.col("at")), "left").drop("of", "at")
        part = F.when(F.col(f"{edge}_chosen"), F.col(edge) - F.col(f"{edge}_block") * F.col("block_size")).otherwise(F.lit(0))
        placed = placed.withColumn(f"{edge}_words", F.coalesce(F.col(f"{edge}_before") + part, F.lit(0)))
    extra = F.when(F.col("size") > 0, F.col("end_words") - F.col("start_words")).otherwise(F.lit(0))
    return placed.select("doc_id", "source", "size", "source_size", "target", (F.col("passes") * F.col("size") + extra).cast("long").alias("taken"), *row)


def whole_times(taken: DataFrame, stage: Stage, *, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """key, times for each row of mix's result that has words: how often to take the row as a whole.

    times is taken / size or a neighbour of it, rounded along the source and not row by row: rows stand in order
    of size, largest layer first, and the running sum of taken / size is rounded. It is off by half a row at
    most, so where sizes fall all along, the words of a source are off by half its longest row at most. A layer
    of more than PART rows is cut by hash of doc_id into parts; each part has falling sizes, which adds a ten
    thousandth of the source's words at most. Rows of the same size stand by that hash too; without a doc_id the
    key, a number, is hashed. Sums are of whole numbers, and a window holds a part; rows of one doc_id share it.
    """
    rows = stage.write(taken.where("size > 0").select(
        F.col(key).alias("key"), "source", "size", F.expr("taken div size").alias("times"), F.expr(f"((taken % size) * {ONE}L) div size").alias("share"),
        (-F.floor(F.log2("size") * LAYERS)).alias("layer"), F.xxhash64(F.lit(seed), F.coalesce("doc_id", key)).alias("drawn")), "shares")
    layers = rows.groupBy(F.col("source").alias("of"), F.col("layer").alias("in")).agg(F.ceil(F.count("*") / PART).alias("parts"))
    rows = rows.join(layers, F.col("source").eqNullSafe(F.col("of")) & (F.col("layer") == F.col("in"))).drop("of", "in")
    rows = stage.write(rows.withColumn("part", F.pmod("drawn", "parts")), "parts")
    sums = rows.groupBy(F.col("source").alias("of"), F.col("layer").alias("in"), F.col("part").alias("at")).agg(F.sum("share").alias("shares"))
    by_part = W.partitionBy("of").orderBy("in", "at")
    offsets = sums.select("of", "in", "at", (F.sum("shares").over(by_part) - F.col("shares")).alias("offset"))
    within = W.partitionBy("source", "layer", "part").orderBy(F.desc("size"), "drawn").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("share").over(within)).join(
        offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("layer") == F.col("in")) & (F.col("part") == F.col("at")))
    end = F.col("offset") + F.col("upto") + ONE // 2
    more = F.shiftright(end, 30) - F.shiftright(end - F.col("share"), 30)
    return rows.select(F.col("key").alias(key), (F.col("times") + more).cast("int").alias("times"))
