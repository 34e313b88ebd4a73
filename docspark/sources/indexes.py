"""Several containers searched as one: selection by name glob, union with an `_index` column."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def glob_filter(glob: str, names) -> list[str]:
    """The names matching a glob such as `foo*` or `bar,baz`; the whole name must match."""
    patterns = [p.replace("[", "[[]").replace("?", "[?]") for p in glob.split(",")]
    return [n for n in names if any(fnmatchcase(n, p) for p in patterns)]


def first_match(configs: Mapping[str, dict], name: str) -> dict:
    """The settings listed first under a glob that matches the name."""
    for glob, config in configs.items():
        if glob_filter(glob, [name]):
            return config
    raise ValueError(f"no matching index settings found for: {name}")


def catalog_indexes(spark: SparkSession, database: str | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Name -> loader of every table of a catalog database."""
    tables = spark.catalog.listTables(database)
    return {t.name: lambda n=".".join([*(t.namespace or []), t.name]): spark.table(n) for t in tables}


def folder_indexes(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """Name -> loader of every Parquet table in a folder: `name.parquet`, or a folder `name`."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    entries = [s.getPath() for s in files.listStatus(path)]
    visible = sorted((e.getName(), e.toString()) for e in entries if e.getName()[0] not in "_.")
    return {
        name.removesuffix(".parquet"): lambda where=where: spark.read.parquet(where) for name, where in visible
    }


def read_indexes(indexes: Mapping[str, DataFrame | Callable[[], DataFrame]], glob: str) -> DataFrame:
    """Bag union of the matching containers; columns that one of them lacks are null there.

    Loaders of containers that do not match are not called.
    """
    names = glob_filter(glob, indexes)
    if not names:
        raise ValueError(f"no index matches {glob!r}")
    frames = []
    for name in names:
        source = indexes[name]
        frame = source if isinstance(source, DataFrame) else source()
        frames.append(frame.withColumn("_index", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
