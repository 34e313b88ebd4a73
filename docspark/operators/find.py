"""Find, count and totals: filter, sort, skip, limit and field selection."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from docspark.operators.predicates import Doc
from docspark.settings import shared_dir

METADATA = ("_id", "_parent", "_routing", "_index")


def find(
    df: DataFrame,
    where: Column | None = None,
    sort: dict[str, int] | list | None = None,
    skip: int = 0,
    limit: int | None = None,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    with_total: bool = False,
    after: Row | dict | None = None,
) -> DataFrame:
    """One page of the matching documents.

    `after` holds the sorted values of a document, for example the last of a page, and the page starts
    behind it: a filter, of which Parquet gets the part on the first key. End `sort`, a dict here, with a unique
    field, else documents that are equal in all of it are passed over together.

    `sort` is `{path: 1 | -1}` or a list of sort Columns; missing values come last
    in both directions. `with_total` adds `_total`, the matches before skip and
    limit, from a second aggregate over the same filter. `skip` without `limit`
    writes the rows below the shared folder at once.
    """
    matched = df if where is None else df.where(where)
    page = matched if after is None else matched.where(_behind(df, sort, after))
    page = page.orderBy(*sort_columns(df, sort)) if sort else page
    if limit is not None:
        page = page.offset(skip).limit(limit) if skip else page.limit(limit)
    page = project(page, include, exclude)
    if skip and limit is None:
        page = _after(page, skip, bool(sort))
    return page.withColumn("_total", count(matched).scalar()) if with_total else page


def _after(rows: DataFrame, skip: int, ordered: bool) -> DataFrame:
    """All but the first `skip` rows, in as many tasks as there are partitions.

    The rows are written with ids that grow from partition to partition, so that one count for
    each partition tells the id of the first row that stays.
    """
    spark, path = rows.sparkSession, shared_dir(rows.sparkSession)
    at = F.monotonically_increasing_id()
    rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), at.alias("_at")).write.parquet(path)
    stored = spark.read.parquet(path)
    first = None
    for part, n in stored.groupBy(F.shiftright("_at", 33).alias("part")).count().orderBy("part").collect():
        if skip < n:
            first = (part << 33) + skip
            break
        skip -= n
    kept = stored.where(F.lit(False) if first is None else F.col("_at") >= first)
    kept = (kept.orderBy("_at") if ordered else kept).select("_row.*")
    return kept.select(*[F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in rows.schema.fields])


def _behind(df: DataFrame, sort: dict[str, int], after: Row | dict) -> Column:
    """Rows that come behind the given one in a sort that has missing values last."""
    if not isinstance(sort, dict) or not sort:
        raise ValueError("after needs a sort by paths")
    doc, held = Doc(df), after.asDict(recursive=True) if isinstance(after, Row) else after
    later, equal, first = F.lit(False), F.lit(True), None
    for path, direction in sort.items():
        value = held
        for name in [path] if path in held else path.split("."):
            if value is not None and name not in value:
                raise ValueError(f"after has no value of {path}")
            value = value if value is None else value[name]
        column = doc[path].column
        if doc[path].is_array:
            column = F.array_min(column) if direction == 1 else F.array_max(column)
            value = None if value is None else (min if direction == 1 else max)([v for v in value if v is not None], default=None)
        if value is None:
            behind, here = F.lit(False), column.isNull()
            bound = here
        else:
            given = F.lit(value)
            behind = (column > given if direction == 1 else column < given) | column.isNull()
            here = column == given
            bound = (column >= given if direction == 1 else column <= given) | column.isNull()
        # where an earlier key is the same; null is not equal to a value
        later, equal = later | (equal & behind), equal & F.coalesce(here, F.lit(False))
        first = bound if first is None else first
    return first & F.coalesce(later, F.lit(False))


def pages(df: DataFrame, where: Column | None = None, sort: dict[str, int] | None = None, size: int = 100,
          **options) -> Iterator[list[Row]]:
    """All matching documents in pages of `size`, each found behind the last row of the one before.

    A page is one query with a limit, so the driver and the tasks hold a page, however far it is. `sort` ends with a
    unique field; its paths have to be among the fields that `include` and `exclude` leave.
    """
    after = None
    while True:
        page = find(df, where, sort, limit=size, after=after, **options).collect()
        if page:
            yield page
        if len(page) < size:
            return
        after = page[-1]


def stream(df: DataFrame, *args, **options) -> Iterator[Row]:
    """`find`, delivered to the driver one partition at a time instead of collected."""
    return find(df, *args, **options).toLocalIterator(prefetchPartitions=True)


def count(df: DataFrame, where: Column | None = None) -> DataFrame:
    """One row, `n`: the number of matching documents."""
    matched = df if where is None else df.where(where)
    return matched.agg(F.count(F.lit(1)).alias("n"))


def sort_columns(df: DataFrame, sort: dict[str, int] | list) -> list[Column]:
    """Sort keys; an array sorts by its least element ascending, its greatest descending."""
    if not isinstance(sort, dict):
        return list(sort)
    doc, keys = Doc(df), []
    for name, direction in sort.items():
        path = doc[name]
        if direction == 1:
            value = F.array_min(path.column) if path.is_array else path.column
            keys.append(value.asc_nulls_last())
        else:
            value = F.array_max(path.column) if path.is_array else path.column
            keys.append(value.desc_nulls_last())
    return keys


def project(df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Keep the named paths, then drop the excluded ones; both reach into structs and arrays.

    Metadata columns stay whenever the input has them. Of an array's elements only the
    kept fields are read, so a null element comes back as an object of null fields.
    """
    if not include and not exclude:
        return df
    doc = Doc(df)
    for path in [*(include or []), *(exclude or [])]:
        doc[path]
    keep, drop = _tree(include or []), _tree(exclude or [])
    columns = []
    for field in df.schema.fields:
        if field.name in METADATA:
            columns.append(F.col(f"`{field.name}`"))
            continue
        kept = _cut(F.col(f"`{field.name}`"), field.dataType, keep.get(field.name, {}) if keep else {},
                    drop.get(field.name))
        if (keep and field.name not in keep) or kept is None:
            continue
        columns.append(kept.alias(field.name, metadata=field.metadata))
    return df.select(*columns)


def _tree(paths: list[str]) -> dict:
    root: dict = {}
    for path in sorted(paths, key=lambda p: p.count("."), reverse=True):
        node, names = root, path.split(".")
        for name in names[:-1]:
            node = node.setdefault(name, {})
        node[names[-1]] = {}  # a shorter path keeps or drops the whole field
    return root


def _cut(column: Column, dtype: T.DataType, keep: dict, drop: dict | None) -> Column | None:
    """The column with only the kept and without the dropped parts; None when nothing is left.

    An empty `keep` keeps everything, an empty `drop` drops everything.
    """
    if drop == {}:
        return None
    if not keep and drop is None:
        return column
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        # field by field, so that the scan reads the kept fields of the elements only
        parts = _cut_fields(column, dtype.elementType, keep, drop, in_array=True)
        return F.arrays_zip(*parts) if parts else None
    if isinstance(dtype, T.ArrayType):
        if _cut(F.lit(None), dtype.elementType, keep, drop) is None:
            return None
        return F.transform(column, lambda e: _cut(e, dtype.elementType, keep, drop))
    if isinstance(dtype, T.MapType):
        return F.transform_values(column, lambda _, v: _cut(v, dtype.valueType, keep, drop))
    parts = _cut_fields(column, dtype, keep, drop)
    return F.when(column.isNotNull(), F.struct(*parts)) if parts else None


def _cut_fields(
    column: Column, dtype: T.StructType, keep: dict, drop: dict | None, in_array: bool = False
) -> list[Column]:
    parts = []
    for field in dtype.fields:
        if keep and field.name not in keep:
            continue
        inner = T.ArrayType(field.dataType) if in_array else field.dataType
        part = _cut(column.getField(field.name), inner, keep.get(field.name, {}), (drop or {}).get(field.name))
        if part is not None:
            parts.append(part.alias(field.name))
    return parts
