"""Token counts as rollups that signed changes maintain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "version"]


def changes(docs: DataFrame, counters: dict[str, Column], sign: int = 1) -> DataFrame:
    """Signed changes of documents that come (1) or go (-1), one for each tokenizer version.

    `counters` has the number of tokens of a document by version. Null counts as no tokens.
    """
    pairs = F.array(*[F.struct(F.lit(v).alias("version"), F.coalesce(c.cast("long"), F.lit(0)).alias("n")) for v, c in counters.items()])
    given = docs.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.explode(pairs).alias("_p"))
    return given.select("source", "lang", "_p.version", F.lit(sign).cast("long").alias("docs"), (sign * F.col("_p.n")).alias("tokens"))


def revisions(docs: DataFrame, version: str, old: Column, new: Column) -> DataFrame:
    """Changes of documents whose count of one version is corrected."""
    return docs.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       F.lit(version).alias("version"), F.lit(0).cast("long").alias("docs"),
                       (F.coalesce(new.cast("long"), F.lit(0)) - F.coalesce(old.cast("long"), F.lit(0))).alias("tokens"))


class Rollup:
    """Totals by source, language and tokenizer version in a shared folder.

    A batch is summed by key, which partial sums do before the shuffle, and written to a folder of its own
    name. To commit it again replaces that folder by the same sums, so a batch that failed or is sent twice
    counts once. Totals are the sum over the batches, a row for each key and batch to read. Null sources
    and languages are keys like others. Totals without batches have no rows.
    """

    SCHEMA = "source string, lang string, version string, docs long, tokens long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], self.SCHEMA).write.mode("overwrite").parquet(f"{path}/batch=-1")

    def commit(self, batch: int, *deltas: DataFrame) -> None:
        rows = deltas[0]
        for more in deltas[1:]:
            rows = rows.unionByName(more)
        sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.write.mode("overwrite").parquet(f"{self.path}/batch={int(batch)}")

    def totals(self) -> DataFrame:
        """One row per key that has documents or tokens."""
        rows = self.spark.read.schema(self.SCHEMA + ", batch int").parquet(self.path)
        sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs != 0 OR tokens != 0")
