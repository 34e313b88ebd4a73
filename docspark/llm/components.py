"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import released, staged


def components(links: DataFrame) -> DataFrame:
    """(`node`, `component`) of every node of the links (`a`, `b`): the smallest node it reaches.

    Alternates two star operations: every node's larger neighbours move to its smallest neighbour, then
    its smaller ones do. The links of a node are added up in each task before they move; the join that
    follows streams them, but has those of one node in one task. Each round is written out, and the rounds end when no link changes.
    """
    spark = links.sparkSession
    links = staged(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = links.union(links.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        moved = larger.join(least, "a")
        smaller = moved.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        old, links = links, staged(smaller.union(least.toDF("a", "b")).distinct())
        released(spark, old)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
