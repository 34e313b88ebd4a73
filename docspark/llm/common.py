"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark import settings

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\f\r"


def text_of(column: str) -> Column:
    """The column as text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def without_white(text: Column) -> Column:
    """The text without ASCII white space."""
    for c in WHITE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once, also where use refers to it inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def staged(df: DataFrame, partitions: str | None = None, options: dict | None = None) -> DataFrame:
    """Write the frame below the shared folder and read it again: later steps restart from there.

    No later step reads the shuffle files behind it. Spark deletes them once the driver's collector
    has found them unused, which is asked for here, as they would fill the disks over many steps.
    """
    spark = df.sparkSession
    path = settings.shared_dir(spark)
    writer = df.write.options(**(options or {}))
    writer = writer.partitionBy(partitions) if partitions else writer
    writer.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def released(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the files of staged frames that no later step reads."""
    jvm = spark.sparkContext._jvm
    for frame in frames:
        for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Texts in a batch that goes to a Python worker, which holds it twice.
BATCH = 500


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of at most BATCH rows for the jobs of functions over Arrow that run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, BATCH)
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Ids that picked() sends to every task; more are joined by a shuffle.
FEW = 1 << 18


def picked(docs: DataFrame, ids: DataFrame, id: str) -> DataFrame:
    """Join the documents with the rows of `ids`: no document moves if the ids, counted first, are few."""
    return docs.join(F.broadcast(ids) if ids.count() <= FEW else ids, id)
