"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyjoin.llm.common import Stage


def components(stage: Stage, links: DataFrame) -> DataFrame:
    """node, component: the smallest node that each node of links (a, b) reaches.

    Large stars and small stars take turns: every node hands its larger neighbours, then its smaller ones,
    to its smallest neighbour, until all links point at the smallest node of their component. A node with
    many neighbours costs a minimum, combined before the shuffle, and a join that Spark can split.
    """
    edges = stage.write(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty() \
            or not edges.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("top")).where("low != top").isEmpty():
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        new = stage.write(small.select("e.*").where("a != b").distinct(), "stars")
        stage.drop(edges)
        edges = new
    top = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stage.write(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(top), "components")
