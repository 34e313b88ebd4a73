"""Upsert, update and delete as functions from DataFrames to a DataFrame.

They define the result only; `docspark.sources.Collection` stores it, rewriting
no more of the stored data than a change touches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from docspark.functions import literals
from docspark.operators.predicates import Doc, none_of


def latest(batch: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by `order_by`, ties broken by content.

    An aggregate rather than a window: rows of a key that fills a large share of
    the batch collapse in every task before the shuffle.
    """
    columns = [F.col(f"`{c}`") for c in batch.columns]
    rank = F.struct(*[F.col(c) for c in order_by or []], content_hash(batch))
    newest = batch.groupBy(*keys).agg(F.max_by(F.struct(*columns), rank).alias("_row"))
    return newest.select("_row.*")


def content_hash(df: DataFrame) -> Column:
    """A number that breaks ties between rows by what they hold."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    hashable = not any(w in df.schema.simpleString() for w in ("map<", "variant"))
    return F.xxhash64(*(columns if hashable else [F.to_json(F.struct(*columns))]))


def upsert(
    old: DataFrame,
    batch: DataFrame,
    keys: list[str],
    order_by: list[str] | None = None,
    old_keys: dict[str, str] | None = None,
) -> DataFrame:
    """`old` with the rows of `batch` put in by key; the newest row of a key wins.

    `old_keys` names, per key column, the batch column holding the key under which
    the document was stored before (null or equal: it did not move). A moved
    document replaces the record under its old key.
    """
    extra = [c for c in batch.columns if c not in old.columns]
    new = latest(batch, keys, order_by).drop(*extra)
    gone = replaced_keys(batch, keys, old_keys)
    return old.join(gone, keys, "left_anti").unionByName(new, allowMissingColumns=True)


def replaced_keys(batch: DataFrame, keys: list[str], old_keys: dict[str, str] | None = None) -> DataFrame:
    """The distinct keys under which the documents of a batch are, or were, stored."""
    if not old_keys:
        return batch.select(*keys).distinct()
    now = F.struct(*[F.col(k) for k in keys])
    before = F.struct(*[
        (F.coalesce(F.col(old_keys[k]), F.col(k)) if k in old_keys else F.col(k)).alias(k) for k in keys])
    return batch.select(F.inline(F.array(now, before))).distinct()


def update(
    df: DataFrame,
    where: Column | None,
    set: dict[str, object] | None = None,
    unset: list[str] | None = None,
    replace: dict[str, object] | None = None,
    keys: tuple[str, ...] = (),
    skip: tuple[str, ...] = (),
) -> DataFrame:
    """Rewrite the matching documents; values may be Columns over the old document.

    `set` writes dotted paths, `unset` clears them, `replace` gives the whole new
    document: every column but `keys` and the metadata takes its value or null.
    Paths in `skip` are left alone.
    """
    if (replace is None) == (set is None and unset is None):
        raise ValueError("give either set/unset or replace")
    hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    doc = Doc(df)
    if replace is not None:
        for name in replace:
            doc[name]
        kept = {*keys, *skip}
        changes = {c: replace.get(c) for c in df.columns if c not in kept and not c.startswith("_")}
    else:
        changes = {**dict.fromkeys(unset or []), **(set or {})}
        changes = {p: v for p, v in changes.items() if p not in skip}
    by_root: dict[str, list[tuple[list[str], Column]]] = {}
    for path, value in changes.items():
        target = doc[path]
        new = literals.stored(value, target.dtype)
        root, *inner = path.split(".")
        by_root.setdefault(root, []).append((inner, new))
    columns = []
    for name in df.columns:
        old = F.col(f"`{name}`")
        if name in by_root:
            new = reduce(lambda c, change: _put(c, *change), by_root[name], old)
            old = F.when(hit, new).otherwise(old).alias(name, metadata=df.schema[name].metadata)
        columns.append(old)
    return df.select(*columns)


def _put(column: Column, inner: list[str], value: Column) -> Column:
    return value if not inner else column.withField(".".join(f"`{n}`" for n in inner), value)


def delete(df: DataFrame, where: Column) -> DataFrame:
    """The documents that do not match; a null predicate does not match."""
    return df.where(none_of(where))


def delete_keys(df: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """The documents whose key is not in `gone`."""
    return df.join(gone.select(*keys).distinct(), keys, "left_anti")


def unmatched_keys(df: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of `gone` that no document has."""
    # both sides are made distinct before the join, so that a hot key collapses in every task
    return gone.select(*keys).distinct().join(df.select(*keys).distinct(), keys, "left_anti")
