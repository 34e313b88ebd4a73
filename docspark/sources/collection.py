"""A stored, keyed collection of documents: partitioned Parquet, changed by appending.

Two folders below the collection's own, which all executors must share:

    base/_bucket=<hash of the route>/_slice=<hash of the id>/*.parquet
    changes/_version=<number>/_bucket=<...>/_slice=<...>/*.parquet

`append` adds to the base. Every other change writes its own documents, or the removed ones with
`_deleted`, under the next version, and nothing else: what it writes grows with the change. A reader takes
the newest version of each changed key and the base without those keys; `compact` puts the changes
into the base of the cells that they touch. A route is one bucket and an id one slice of it, so a filter on either
is a partition filter; slices spread a route that owns a large share of the documents. Readers that
run while `compact` replaces files must start again; two changes at one time do not wait for each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T

from docspark.functions.geo import geohash
from docspark.model import GEOPOINT, DocModel
from docspark.operators import mutate
from docspark.operators.aggregate import Spec, aggregate, aggregate_multi
from docspark.operators.find import count, find
from docspark.operators.predicates import Doc, all_of
from docspark.settings import shared_dir

_META = [T.StructField(n, T.StringType()) for n in ("_id", "_parent", "_routing", "_index")]
_KEYS = ["_id", "_routing"]
_CELL = ("_bucket", "_slice")
_CELL_FIELDS = [T.StructField(n, T.IntegerType()) for n in _CELL]
_VERSION = T.StructField("_version", T.LongType())
_CHANGE_FIELDS = [T.StructField("_deleted", T.BooleanType()), T.StructField("_source", T.StringType())]


class Collection:
    """Documents of one model under `path`.

    `buckets` and `slices` are fixed when the collection is created, and kept with the files; take enough
    cells that one holds a few files, for example 512 x 8 for tens of terabytes.
    Files are sorted by the fields in `cluster_by`, points by their geohash, so that
    a range or distance filter skips most row groups of a cell, and have Bloom filters on the id. With `store_search`
    the model's derived search columns, such as tokens, are stored as well, so that a
    search reads them instead of analysing the texts again.
    """

    def __init__(self, spark: SparkSession, path: str, model: DocModel, buckets: int = 16, slices: int = 2,
                 cluster_by: tuple[str, ...] = (), store_search: bool = False):
        self.spark, self.path, self.model = spark, path.rstrip("/"), model
        self.buckets, self.slices, self.cluster_by = buckets, slices, cluster_by
        self.store_search = store_search
        self._layout = f"{buckets}x{slices}" + ("+search" if store_search else "")
        self._checked = False
        self.schema = T.StructType([*model.schema.fields, *_META])

    @cached_property
    def doc(self) -> Doc:
        """Paths of the documents, with the model's derived search columns."""
        return Doc(self.model.searchable(self.spark.createDataFrame([], self.schema)))

    # -- reading -----------------------------------------------------------

    def read(self, routing: str | None = None, ids: list[str] | None = None) -> DataFrame:
        """All documents, or those of one route or with some ids; only their cells and, of ids, their row groups are read."""
        cells, conditions = [], []
        if routing is not None:
            cells.append(F.col("_bucket") == _hash(F.lit(routing), self.buckets))
            conditions.append(F.col("_routing") == routing)
        if ids is not None:
            cells.append(F.col("_slice").isin([_hash(F.lit(i), self.slices) for i in ids]))
            conditions.append(F.col("_id").isin(ids))
        return self._merged(*cells).where(all_of(*conditions)).select(*self.schema.names)

    def search(self, routing: str | None = None) -> DataFrame:
        """`read` with the model's derived search columns."""
        if routing is None:
            return self._searched()
        return self._searched(F.col("_bucket") == _hash(F.lit(routing), self.buckets)).where(F.col("_routing") == routing)

    def find(self, where: Column | None = None, routing: str | None = None, **options) -> DataFrame:
        """A page of the stored documents; options of `operators.find.find`."""
        found = find(self.search(routing), where, **options)
        return found.drop(*[c for c in self.doc.schema.names if c not in self.schema.names])

    def count(self, where: Column | None = None, routing: str | None = None) -> int:
        return count(self.search(routing), where).first()[0]

    def aggregate(self, *args, routing: str | None = None, **options) -> DataFrame:
        """Grouped statistics of the stored documents; arguments of `operators.aggregate.aggregate`."""
        return aggregate(self.search(routing), *args, **options)

    def aggregate_multi(self, specs: dict[str, Spec], where: Column | None = None,
                        routing: str | None = None) -> dict[str, DataFrame]:
        """Several aggregates over the stored documents that match, by name."""
        return aggregate_multi(self.search(routing), specs, where)

    def stream(self, where: Column | None = None, routing: str | None = None, **options) -> Iterator[Row]:
        """`find`, delivered to the driver one partition at a time."""
        return self.find(where, routing, **options).toLocalIterator(prefetchPartitions=True)

    # -- writing -----------------------------------------------------------

    def upsert(self, batch: DataFrame, order_by: list[str] | None = None, index: str | None = None,
               routing: str | None = None) -> int:
        """Save documents by id and route; the newest of a batch by `order_by` (column `_seq`) wins.

        A document that changes its id or route names its old place in `_old_id` and
        `_old_routing`, and is removed there. Returns the number of documents written. The batch is
        computed once, with one shuffle, and what is stored is not read.
        """
        return self.save(self.prepared(batch, index, routing), order_by)

    insert = upsert

    def prepared(self, batch: DataFrame, index: str | None = None, routing: str | None = None) -> DataFrame:
        """Documents as they are stored, with the columns that order and move them."""
        prepared = self.model.prepare(batch, index, routing)
        return _with_id(prepared.select(*self.schema.names, *[c for c in prepared.columns if c not in self.schema.names]))

    def save(self, prepared: DataFrame, order_by: list[str] | None = None, source: str | None = None) -> int:
        """Store documents as `prepared` gives them. A `source` that is saved again replaces what it has written."""
        order = order_by or [c for c in ["_seq"] if c in prepared.columns]
        row = {c: F.col(f"`{c}`") for c in self.schema.names}
        row |= {f"_by{i}": F.col(f"`{c}`") for i, c in enumerate(order)} | {"_deleted": F.lit(False)}
        moved = {k: F.coalesce(F.col(f"_old{k}"), F.col(k)) for k in _KEYS if f"_old{k}" in prepared.columns}
        changes = prepared.select(*[v.alias(c) for c, v in row.items()])
        if moved:
            gone = {c: moved.get(c, v) if c in _KEYS else F.lit(True) if c == "_deleted" else
                    F.lit(None).cast(prepared.select(v).schema[0].dataType) for c, v in row.items()}
            new, old = (F.struct(*[v.alias(c) for c, v in r.items()]) for r in (row, gone))
            moves = ~F.struct(*[gone[k] for k in _KEYS]).eqNullSafe(F.struct(*_KEYS))
            changes = prepared.select(F.explode(F.array_compact(F.array(new, F.when(moves, old)))).alias("_row")).select("_row.*")
        # a document that is saved at a place stays there, whichever has left it
        kept = changes.withColumn("_saved", ~F.col("_deleted"))
        newest = mutate.latest(kept, _KEYS, ["_saved", *[f"_by{i}" for i in range(len(order))]])
        written, n = self._change(newest.select(*self.schema.names, "_deleted"), source)
        self.model.run_hooks("post-save", written.where("NOT _deleted").select(*self.schema.names))
        return n["saved"]

    def append(self, batch: DataFrame, index: str | None = None, routing: str | None = None) -> int:
        """Save documents whose ids are known to be new, straight into the base."""
        docs = _with_id(self.model.prepare(batch, index, routing).select(*self.schema.names))
        if self.model.hooks.get("post-save"):  # they see the documents with the ids that are stored
            docs = _stored_once(docs)
        n = self._write(docs.withColumn("_deleted", F.lit(False)), f"{self.path}/base")
        self.model.run_hooks("post-save", docs)
        return n["saved"]

    def update(self, where: Column | None, set: dict | None = None, unset: list[str] | None = None,
               replace: dict | None = None, skip: tuple[str, ...] = (), routing: str | None = None) -> int:
        """Rewrite the matching documents; returns their number. See `mutate.update`.

        The result must fit the model. Where the id may change or the model has hooks, the documents
        are saved as by `upsert`: the hooks run, and a document with a new id leaves its old place.
        """
        found = self._matching(where, routing)
        keys = tuple(p for p in [self.model.id_path] if p)
        changed = mutate.update(found, None, set, unset, replace, keys, skip).select(*self.schema.names)
        if any(self.model.hooks.values()) or self.model.id_path in {*(set or {}), *(unset or [])}:
            return self.upsert(self._renamed(changed))
        changed = self.model.cast(changed).select(*self.schema.names)
        return self._change(changed.withColumn("_deleted", F.lit(False)))[1]["saved"]

    def _renamed(self, changed: DataFrame) -> DataFrame:
        """Stored documents to save again: the id is that of the body, the route follows the id it was."""
        own = F.col(self.model.id_path).cast("string") if self.model.id_path else F.lit(None).cast("string")
        return changed.withColumns({
            "_old_id": F.col("_id"), "_old_routing": F.col("_routing"),
            "_id": F.coalesce(own, F.col("_id")),
            "_routing": F.when(F.col("_routing") != F.col("_id"), F.col("_routing")),
        })

    def delete(self, where: Column | None = None, routing: str | None = None) -> int:
        """Remove the matching documents; returns their number.

        The remove hooks are given the documents that go.
        """
        return self._remove(self._matching(where, routing).select(*self.schema.names))[1]

    def delete_keys(self, gone: DataFrame) -> tuple[int, DataFrame]:
        """Remove documents by `_id` (and `_routing`, else the id): (number, keys without a document)."""
        if "_routing" not in gone.columns:
            gone = gone.withColumn("_routing", F.col("_id"))
        gone = _stored_once(gone.select(*_KEYS).where("_id IS NOT NULL").distinct())
        removed, n = self._remove(self._merged().join(gone, _KEYS, "left_semi").select(*self.schema.names))
        return n, gone.join(removed.select(*_KEYS), _KEYS, "left_anti")

    def _remove(self, gone: DataFrame) -> tuple[DataFrame, int]:
        if any(self.model.hooks.get(f"{when}-remove") for when in ("pre", "post")):
            gone = _stored_once(gone)
        self.model.run_hooks("pre-remove", gone)
        written, n = self._change(gone.withColumn("_deleted", F.lit(True)))
        self.model.run_hooks("post-remove", gone)
        return written, n["removed"]

    def compact(self) -> int:
        """Put the changes into the base, in the cells that they touch; returns the number of versions put in.

        Run it when no change is being written. The merged cells are written beside the base first, then take the
        place of its old files cell by cell; the changes go last, the oldest first. A run that breaks off
        can be repeated, and readers find the same documents before, between and after.
        """
        changes = self._read("changes", _VERSION)
        if changes is None:
            return 0
        versions = [r[0] for r in changes.select("_version").distinct().orderBy("_version").collect()]
        if not versions:
            return 0
        cells = changes.select(*_CELL).distinct()
        docs = self._merged().join(F.broadcast(cells), [*_CELL], "left_semi").withColumn("_deleted", F.lit(False))
        # a row that holds no document, so that a cell which has none left is replaced too
        docs = docs.unionByName(cells.withColumn("_deleted", F.lit(True)), allowMissingColumns=True)
        merged = shared_dir(self.spark)
        self._write(docs, merged, placed=True)
        rows = self.spark.read.schema(self._file_schema()).parquet(merged)
        self._write(rows, f"{self.path}/base", placed=True, mode="overwrite")
        for version in versions:
            _delete(self.spark, f"{self.path}/changes/_version={version}")
        _delete(self.spark, f"{self.path}/changes")
        _delete(self.spark, merged)
        return len(versions)

    # -- files -------------------------------------------------------------

    def _matching(self, where: Column | None, routing: str | None) -> DataFrame:
        found = self.search(routing)
        return found if where is None else found.where(where)

    def _searched(self, *cells: Column) -> DataFrame:
        merged = self._merged(*cells).drop(*_CELL)
        return merged if self.store_search else self.model.searchable(merged)

    def _merged(self, *cells: Column) -> DataFrame:
        """The documents of some cells, with their cell: the newest changes, and the base without their keys."""
        base, changes = (self._read(name, *extra) for name, extra in (("base", ()), ("changes", (_VERSION,))))
        fields = [*self._stored.fields, *_CELL_FIELDS]
        parts = []
        if base is not None:
            parts.append(base.where(all_of(*cells)).where("NOT _deleted"))
        if changes is not None:
            changes = changes.where(all_of(*cells))
            parts = [part.join(changes.select(*_KEYS), _KEYS, "left_anti") for part in parts]
            parts.append(mutate.latest(changes, _KEYS, ["_version"]).where("NOT _deleted"))
        if not parts:
            return self.spark.createDataFrame([], T.StructType(fields))
        merged = parts[0].select(*[f"`{f.name}`" for f in fields])
        for part in parts[1:]:
            merged = merged.unionByName(part.select(*[f"`{f.name}`" for f in fields]))
        return merged.select(*[F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in fields])

    @property
    def _stored(self) -> T.StructType:
        """The columns of the files, without the cell."""
        return self.doc.schema if self.store_search else self.schema

    def _file_schema(self, *extra: T.StructField) -> T.StructType:
        return T.StructType([*self._stored.fields, *_CHANGE_FIELDS, *extra, *_CELL_FIELDS])

    def _read(self, name: str, *extra: T.StructField) -> DataFrame | None:
        """One of the two folders; None if it is not there yet."""
        try:
            files = self.spark.read.schema(self._file_schema(*extra)).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if not self._checked:
            found = self._layout_of(name)
            if found is not None and found != self._layout:
                raise ValueError(f"the collection was written as {found}, not {self._layout} cells")
            self._checked = found is not None
        return files

    def _layout_of(self, name: str) -> str | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{name}").schema["_id"].metadata.get("layout")
        except AnalysisException as error:  # a folder without files
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return None

    def _change(self, rows: DataFrame, source: str | None = None) -> tuple[DataFrame, dict[str, int]]:
        """Write rows as a version of their own, a source's again as the one it had: (what was written, counts)."""
        version = (self.last_version(source) if source else 0) or self.last_version() + 1
        folder = f"{self.path}/changes/_version={version}"
        n = self._write(rows.withColumn("_source", F.lit(source).cast("string")), folder, mode="overwrite")
        return self.spark.read.schema(self._file_schema()).parquet(folder), n

    def last_version(self, source: str | None = None) -> int:
        """The last version, or the last of a source, that is not in the base; 0 if there is none."""
        changes = self._read("changes", _VERSION)
        if changes is None:
            return 0
        return changes.where(F.lit(True) if source is None else F.col("_source") == source).agg(F.max("_version")).first()[0] or 0

    def _with_cell(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"_bucket": _hash(F.col("_routing"), self.buckets), "_slice": _hash(F.col("_id"), self.slices)})

    def _write(self, rows: DataFrame, folder: str, placed: bool = False, mode: str = "append") -> dict[str, int]:
        """Write documents by cell; `overwrite` replaces the cells that have rows. Counts come from the write itself.

        Rows are rebalanced: adaptive execution splits large cells over several tasks and joins small ones.
        """
        if not placed:
            rows = self._with_cell(rows)
        if "_source" not in rows.columns:
            rows = rows.withColumn("_source", F.lit(None).cast("string"))
        if self.store_search and any(c not in rows.columns for c in self._stored.names):
            rows = self.model.searchable(rows)
        id_field = self._stored["_id"]
        columns = [F.col("_id").alias("_id", metadata={**id_field.metadata, "layout": self._layout}) if c == "_id" else F.col(f"`{c}`")
                   for c in [*self._stored.names, "_deleted", "_source", *_CELL]]
        rows = rows.select(*columns).hint("rebalance", *_CELL)
        if self.cluster_by:
            rows = rows.sortWithinPartitions(*_CELL, *self._cluster_columns())
        seen = Observation()
        rows = rows.observe(seen, F.count_if(~F.col("_deleted")).alias("saved"), F.count_if(F.col("_deleted")).alias("removed"))
        writer = rows.write.mode(mode).partitionBy(*_CELL).option("parquet.bloom.filter.enabled#_id", "true")
        writer.option("partitionOverwriteMode", "dynamic").parquet(folder)
        return {"saved": 0, "removed": 0} | seen.get

    def _cluster_columns(self) -> list[Column]:
        paths = [Doc(self.schema)[p] for p in self.cluster_by]
        return [geohash(p.column["lon"], p.column["lat"]) if p.dtype == GEOPOINT else p.column for p in paths]


def _hash(value: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(n)).cast("int")


def _stored_once(df: DataFrame) -> DataFrame:
    """The frame from a file, for steps after which its source is no longer the same."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _with_id(df: DataFrame) -> DataFrame:
    return df.withColumn("_id", F.coalesce("_id", F.raise_error(F.lit("a document has no id"))))
