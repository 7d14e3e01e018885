"""A corpus from documents: quality rules, near-duplicates, repeated passages, source mix, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyjoin.llm import bpe, mixing, near_dup, quality, substrings
from skyjoin.llm.common import Stage

#: Words in a shingle, percent of shingles that near-duplicates share, and words in a repeated passage.
SHINGLE, SIMILAR, PASSAGE = 5, 80, 13


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, unchanged."""
    return quality.quality_rules(docs, columns=tuple(docs.columns)).where("kept").select("row.*")


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group of near-duplicates, one of them where several have it. Rows that share
    a doc_id are told apart by numbers of their own, so those with different texts all stay; rows without a doc_id all
    stay, as they take part in no group."""
    stage, named = Stage(spark, "pipeline"), docs.where("doc_id IS NOT NULL")
    shared = named.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    single = named.join(shared, "doc_id", "left_anti").select(docs.columns)
    # written, because a row's number must be the same in the search and in the join; numbers follow all doc_ids
    last = named.agg(F.coalesce(F.max("doc_id"), F.lit(0)).cast("long").alias("last")).first()["last"]
    twins = stage.write(named.join(shared, "doc_id", "left_semi").select(
        F.struct(*docs.columns).alias("doc"), (F.lit(last + 1) + F.monotonically_increasing_id()).alias("number")), "twins")
    found = near_dup.near_duplicates(single.select("doc_id", "text").unionByName(
        twins.select(F.col("number").alias("doc_id"), "doc.text")), stage, size=SHINGLE, percent=SIMILAR)
    own = twins.select("number", F.col("doc.doc_id").alias("own"))
    groups = found.join(own, found.doc_id == own.number, "left").groupBy("component_id").agg(F.min(F.struct(F.coalesce("own", "doc_id").alias("own"), "doc_id")).alias("least"))
    kept = stage.write(groups.select(F.col("least.doc_id").alias("number")), "kept")
    once = single.join(kept, single.doc_id == kept.number, "left_semi")
    return once.unionByName(twins.join(kept, "number", "left_semi").select("doc.*")).unionByName(docs.where("doc_id IS NULL"))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller doc_id holds too; n_chars follows."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = substrings.remove_repeats(docs, size=PASSAGE, columns=tuple(others))
    return cut.select("doc_id", "text", *[F.col(f"row.{c}").alias(c) for c in others], F.length("text").cast("long").alias("n_chars")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words, a whole number of times: 0 to 3. Numbers are rounded along
    each source, so the words of a source are as many as the mix takes, give or take half its longest document. Every row
    counts by itself: rows that share a doc_id, or have none, may be taken differently."""
    stage = Stage(spark, "pipeline")
    # written, because a row's number must be the same in the mix and in the join
    rows = stage.write(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("number")), "rows")
    taken = mixing.mix(rows.select("doc.doc_id", "doc.text", "doc.source", "number"), stage, columns=("number",))
    times = mixing.whole_times(taken.select("doc_id", "row.number", "source", "size", "taken"), stage, key="number").where("times > 0")
    return rows.join(times, "number").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select("doc.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of the bytes they decode to."""
    return bpe.encode(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("near-duplicates", keep_one_of_copies),
    ("substring dedup", cut_passages),
    ("source mix", mix_sources),
    ("byte-level BPE", tokens),
]

#: SQL can't express MinHash, the mix's draws over cleaned texts and BPE; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written to the shared folder and read again."""
    stage, docs = Stage(spark, "corpus"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage.write(docs, f"stage{k + 1}")
    return docs
