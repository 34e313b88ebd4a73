"""Grouped statistics: group keys, per-field statistics, several aggregates at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docspark.functions import dates, literals, text
from docspark.operators.predicates import Doc, Path

STATS = ("count", "min", "max", "avg", "sum")


@dataclass(frozen=True)
class GroupKey:
    """One key of a grouping: a field and the bucket of each of its values.

    `many` says that one value can fall in several buckets; `bucket` then gives an
    array. A document falls once in every bucket that one of its values reaches.
    With an `analyzer` the buckets are the tokens of the field.
    """

    path: str
    bucket: Callable[[Column, T.DataType], Column] = lambda c, _: c
    many: bool = False
    analyzer: str | None = None
    ranges: tuple[tuple, ...] = ()  # given where they overlap

    def resolve(self, doc: Doc) -> tuple[Column, bool]:
        """(column, is it an array to explode) for a document schema."""
        source = doc[self.path]
        if self.analyzer:
            return text.analyze(source.column, self.analyzer, source.is_array, distinct=True), True
        if not source.is_array:
            value = self.bucket(source.column, source.dtype)
            return (F.array_distinct(value) if self.many else value), self.many
        buckets = F.transform(
            F.array_compact(source.column), lambda v: self.bucket(v, source.value_type)
        )
        return F.array_distinct(F.flatten(buckets) if self.many else buckets), True


def by_field(path: str, analyzer: str | None = None) -> GroupKey:
    """One group per value; with an analyser, one per token."""
    return GroupKey(path, analyzer=analyzer)


def by_ranges(path: str, ranges: list[tuple]) -> GroupKey:
    """One group per range, keyed by its position. `(low, high)`: low inclusive, high
    exclusive, None open. Ranges of numbers or dates; they may overlap: `aggregate` then
    places each row of a scalar field once, between two neighbouring bounds, and adds the
    few groups between bounds up by range."""
    if not ranges:
        raise ValueError("by_ranges needs at least one range")

    def member(c: Column, dtype: T.DataType, low, high) -> Column:
        bounds = [c.isNotNull()]
        if low is not None:
            bounds.append(c >= literals.compared(low, dtype))
        if high is not None:
            bounds.append(c < literals.compared(high, dtype))
        return reduce(lambda a, b: a & b, bounds)

    def first_member(c: Column, dtype: T.DataType) -> Column:
        branches = [(member(c, dtype, *r), F.lit(i)) for i, r in enumerate(ranges)]
        return reduce(lambda w, b: w.when(*b), branches[1:], F.when(*branches[0]))

    def all_members(c: Column, dtype: T.DataType) -> Column:
        hits = [F.when(member(c, dtype, *r), F.lit(i)) for i, r in enumerate(ranges)]
        return F.array_compact(F.array(*hits))

    if _disjoint(ranges):
        return GroupKey(path, first_member)
    return GroupKey(path, all_members, many=True, ranges=tuple(ranges))


def by_interval(path: str, width: float, base: float = 0) -> GroupKey:
    """Numeric buckets, keyed by their lower bound (a double)."""
    if isinstance(width, bool) or not isinstance(width, (int, float)) or width <= 0:
        raise ValueError("the interval must be a positive number")
    width, base = float(width), float(base)

    def lower_bound(c: Column, _: T.DataType) -> Column:
        shifted = c - F.lit(base) if base else c.cast("double")
        start = F.floor(shifted / F.lit(width)) * F.lit(width)
        return (start + F.lit(base) if base else start).cast("double")

    return GroupKey(path, lower_bound)


def by_duration(path: str, duration: str, base: datetime | None = None) -> GroupKey:
    """Fixed-width time buckets from the epoch (or `base`, in UTC), width as ISO-8601."""
    width = round(dates.duration_seconds(duration) * 10**6)
    origin = 0
    if base is not None:
        base = base if base.tzinfo else base.replace(tzinfo=timezone.utc)
        origin = round((base - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds() * 10**6)
    return GroupKey(path, lambda c, dtype: dates.fixed_bucket(c, dtype, width, origin))


def by_component(path: str, unit: str, count: int = 1) -> GroupKey:
    """Calendar buckets of `count` years, months, weeks, days, hours, minutes or seconds."""
    if unit not in dates.UNITS:
        raise ValueError(f"unknown time unit {unit!r}; known: {dates.UNITS}")
    return GroupKey(path, lambda c, dtype: dates.unit_bucket(c, dtype, unit, count))


def _disjoint(ranges: list[tuple]) -> bool:
    ordered = sorted(ranges, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0))
    return all(
        a[1] is not None and b[0] is not None and a[1] <= b[0] for a, b in zip(ordered, ordered[1:])
    )


@dataclass(frozen=True)
class Spec:
    """An aggregate: group keys, statistics per field, and whether to count documents.

    `stats` is a field name (count of its values) or `{path: [statistic, ...]}`.
    """

    by: list[GroupKey] = field(default_factory=list)
    stats: str | dict[str, list[str]] | None = None
    total: bool = False

    def statistics(self) -> list[tuple[str, str]]:
        stats = {self.stats: ["count"]} if isinstance(self.stats, str) else (self.stats or {})
        pairs = [(path, name) for path, names in stats.items() for name in names]
        for path, name in pairs:
            if name not in STATS:
                raise ValueError(f"unknown statistic {name!r} of {path}; known: {STATS}")
        return pairs


def stat_name(path: str, name: str) -> str:
    return f"{path.replace('.', '_')}_{name}"


def _stat(path: Path, name: str) -> Column:
    """One statistic; on arrays every element counts."""
    c = path.column
    if not path.is_array:
        return getattr(F, name)(c)
    values = F.array_compact(c)
    if name in ("min", "max"):
        return getattr(F, name)(getattr(F, f"array_{name}")(values))
    number = F.sum(F.array_size(values))
    if name == "count":
        return F.coalesce(number, F.lit(0).cast("bigint"))
    total = F.sum(F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v.cast("double")))
    total = F.when(number > 0, total)
    return total if name == "sum" else total / number


def aggregate(
    df: DataFrame,
    by: list[GroupKey] | GroupKey | None = None,
    stats: str | dict[str, list[str]] | None = None,
    total: bool = False,
    where: Column | None = None,
    scope: str = "matched",
) -> DataFrame:
    """Columns `k0..kn`, `total` and `<field>_<statistic>`, one row per group that has documents.

    `scope="all"` ignores the filter. Without keys there is one row.
    """
    if scope not in ("matched", "all"):
        raise ValueError("scope must be 'matched' or 'all'")
    spec = Spec([by] if isinstance(by, GroupKey) else list(by or []), stats, total)
    frame = df.where(where) if where is not None and scope == "matched" else df
    return _grouped(frame, spec)


def measures(doc: Doc, spec: Spec) -> list[Column]:
    """The total and statistics of a spec, under their output names."""
    columns = [_stat(doc[p], name).alias(stat_name(p, name)) for p, name in spec.statistics()]
    return [F.count(F.lit(1)).alias("total"), *columns] if spec.total else columns


def keyed_rows(frame: DataFrame, by: list[GroupKey]) -> tuple[DataFrame, list[str]]:
    """(rows with key columns `_k0.._kn`, one per group a document falls in; their names)."""
    resolved = [key.resolve(Doc(frame)) for key in by]
    names = [f"_k{i}" for i in range(len(resolved))]
    keyed = frame.select("*", *[c.alias(n) for n, (c, _) in zip(names, resolved)])
    for name, (_, many) in zip(names, resolved):
        if many:
            # An inner explode infers a filter on the array's size, and pushing it down
            # computes the array twice; the null keys of an outer one are dropped below.
            keyed = keyed.withColumn(name, F.explode_outer(name))
    for name in names:
        keyed = keyed.where(F.col(name).isNotNull())
    return keyed, names


def _between(frame: DataFrame, key: GroupKey) -> tuple[Column, Callable[[Column], Column]]:
    """(number of bounds at or below a value, the ranges that hold all values of such a number)."""
    path = Doc(frame)[key.path]
    bounds = list(dict.fromkeys(b for r in key.ranges for b in r if b is not None))
    # the bounds as the field's type sees them, for their order
    values = frame.sparkSession.range(1).select(F.array(*[literals.compared(b, path.dtype) for b in bounds])).first()[0]
    order = sorted(set(values))
    place = {None: None, **{bound: order.index(value) + 1 for bound, value in zip(bounds, values)}}
    literal = F.array(*[literals.compared(bounds[values.index(value)], path.dtype) for value in order])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(order).bit_length()))])
    # binary search: one step for each doubling of the bounds
    at = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(literal, n + step - 1) <= path.column, n + step).otherwise(n))
    lows = F.array(*[F.lit(0 if low is None else place[low]) for low, _ in key.ranges])
    highs = F.array(*[F.lit(len(order) + 1 if high is None else place[high]) for _, high in key.ranges])
    every = F.sequence(F.lit(0), F.lit(len(key.ranges) - 1))
    return F.when(path.column.isNotNull(), at), lambda n: F.filter(every, lambda i: (F.get(lows, i) <= n) & (n < F.get(highs, i)))


def _added_up(frame: DataFrame, spec: Spec) -> DataFrame:
    """A grouping with overlapping ranges of scalar fields: rows are grouped between bounds, groups then by range."""
    doc, found, by = Doc(frame), {}, []
    for i, key in enumerate(spec.by):
        if key.ranges and not doc[key.path].is_array:
            at, found[i] = _between(frame, key)
            frame = frame.withColumn(f"_between{i}", at)
            by.append(by_field(f"_between{i}"))
        else:
            by.append(key)
    named = {stat_name(path, name): (path, name) for path, name in spec.statistics()}
    kinds = frame.agg(*[_stat(doc[path], name).alias(alias) for alias, (path, name) in named.items()]).schema if named else []
    parts = dict.fromkeys(p for path, name in named.values() for p in ([(path, "sum"), (path, "count")] if name == "avg" else [(path, name)]))
    keyed, names = keyed_rows(frame, by)
    columns = [_stat(doc[path], name).alias(stat_name(path, name)) for path, name in parts]
    groups = keyed.groupBy(*[F.col(n).alias(n[1:]) for n in names]).agg(F.count(F.lit(1)).alias("total"), *columns)
    for i, ranges in found.items():
        groups = groups.withColumn(f"k{i}", F.explode(ranges(F.col(f"k{i}"))))
    merged = groups.groupBy(*[n[1:] for n in names]).agg(F.sum("total").alias("total"), *[
        (getattr(F, name) if name in ("min", "max") else F.sum)(stat_name(path, name)).alias(stat_name(path, name)) for path, name in parts])
    results = ["total"] if spec.total else []
    for alias, (path, name) in named.items():
        value = F.try_divide(stat_name(path, "sum"), F.col(stat_name(path, "count"))) if name == "avg" else F.col(alias)
        results.append(value.cast(kinds[alias].dataType).alias(alias))
    return merged.select(*[n[1:] for n in names], *results)


def _grouped(frame: DataFrame, spec: Spec) -> DataFrame:
    if any(key.ranges and not Doc(frame)[key.path].is_array for key in spec.by):
        return _added_up(frame, spec)
    columns = measures(Doc(frame), spec)
    if not spec.by:
        return frame.agg(*(columns or [F.count(F.lit(1)).alias("total")]))
    keyed, names = keyed_rows(frame, spec.by)
    keys = [F.col(n).alias(n[1:]) for n in names]
    return keyed.groupBy(*keys).agg(*columns) if columns else keyed.select(*keys).distinct()


def top_groups(groups: DataFrame, k: int) -> DataFrame:
    """The `k` largest groups of an aggregate that has `total`; ties by ascending key."""
    keys = [c for c in groups.columns if c[0] == "k" and c[1:].isdigit()]
    return groups.orderBy(F.desc("total"), *[F.asc(c) for c in keys]).limit(k)


def aggregate_multi(
    df: DataFrame, specs: dict[str, Spec], where: Column | None = None
) -> dict[str, DataFrame]:
    """Several aggregates over one filter, each a lazy DataFrame with its own columns.

    Each scans only the columns it needs. `aggregate_multi_long` runs all in one scan.
    """
    matched = df if where is None else df.where(where)
    return {name: _grouped(matched, spec) for name, spec in specs.items()}


def aggregate_multi_long(
    df: DataFrame, specs: dict[str, Spec], where: Column | None = None
) -> DataFrame:
    """Several aggregates in one scan and one shuffle, stacked in long form.

    Where every key has one value for a document they are the grouping sets of one aggregation, and
    aggregates with the same keys are one set. Otherwise a document has a row for each group it falls in.

    Columns: `name`, `k0..kn` (null beyond the keys of an aggregate; text where the
    aggregates disagree on the type), `total`, and every statistic (null where not
    asked for). An aggregate without keys has its row even if nothing matches.
    """
    matched = df if where is None else df.where(where)
    doc = Doc(matched)
    resolved = {name: [key.resolve(doc) for key in s.by] for name, s in specs.items()}
    if not any(many for cols in resolved.values() for _, many in cols):
        return _by_sets(df, matched, specs, resolved)
    width = max(len(cols) for cols in resolved.values())
    types = _key_types(matched, resolved, width)
    arrays = [any(cols[i][1] for cols in resolved.values() if i < len(cols)) for i in range(width)]

    # One row per aggregate; a key that some aggregate takes from an array is an array
    # in all of them, and is exploded after.
    keys = [f"_k{i}" for i in range(width)]
    pairs = list(dict.fromkeys(p for s in specs.values() for p in s.statistics()))
    groups = []
    for name, cols in resolved.items():
        fields = [F.lit(name).alias("name")]
        for i, (dtype, is_array) in enumerate(zip(types, arrays)):
            value, many = cols[i] if i < len(cols) else (F.lit(None), is_array)
            value = F.array(value) if is_array and not many else value
            fields.append(value.cast(T.ArrayType(dtype) if is_array else dtype).alias(f"k{i}"))
        groups.append(F.struct(*fields))
    rows = matched.select("*", F.inline(F.array(*groups)).alias("_name", *keys))
    for key, is_array in zip(keys, arrays):
        rows = rows.withColumn(key, F.explode_outer(key)) if is_array else rows
    complete = [
        (F.col("_name") != name)
        | reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys[:len(s.by)]])
        for name, s in specs.items() if s.by
    ]
    if complete:
        rows = rows.where(reduce(lambda a, b: a & b, complete))
    single = [(name,) for name, s in specs.items() if not s.by]
    rows = rows.withColumn("_document", F.lit(1))
    if single:  # a row that is no document, so that the group is there
        rows = rows.unionByName(df.sparkSession.createDataFrame(single, "_name string"), allowMissingColumns=True)
    columns = [F.count("_document").alias("total")]
    columns += [_stat(doc[p], stat).alias(stat_name(p, stat)) for p, stat in pairs]
    grouped = rows.groupBy(*[F.col(c).alias(c[1:]) for c in ("_name", *keys)]).agg(*columns)

    def asked(column: str, names: list[str]) -> Column:
        return F.when(F.col("name").isin(names), F.col(column)).alias(column)

    masked = [asked("total", [n for n, s in specs.items() if s.total])]
    masked += [asked(stat_name(*p), [n for n, s in specs.items() if p in s.statistics()]) for p in pairs]
    return grouped.select("name", *[k[1:] for k in keys], *masked)


def _by_sets(df: DataFrame, matched: DataFrame, specs: dict[str, Spec], resolved: dict) -> DataFrame:
    """`aggregate_multi_long` as grouping sets: each key is computed once, whichever aggregates have it."""
    doc = Doc(matched)
    width = max(len(cols) for cols in resolved.values())
    types = _key_types(matched, resolved, width)
    keys = list(dict.fromkeys(key for s in specs.values() for key in s.by))
    place = {key: i for i, key in enumerate(keys)}
    columns = {key: column for name, s in specs.items() for key, (column, _) in zip(s.by, resolved[name])}
    rows = matched.select("*", *[columns[key].alias(f"_g{i}") for key, i in place.items()], F.lit(1).alias("_document"))
    if any(not s.by for s in specs.values()):  # a row that is no document, so that the group without keys is there
        rows = rows.unionByName(df.sparkSession.createDataFrame([(None,)], "_document int"), allowMissingColumns=True)
    wanted: dict[tuple[int, ...], list[str]] = {}
    for name, s in specs.items():
        wanted.setdefault(tuple(sorted({place[key] for key in s.by})), []).append(name)
    pairs = list(dict.fromkeys(p for s in specs.values() for p in s.statistics()))
    measured = [F.count("_document").alias("total"), *[_stat(doc[p], stat).alias(stat_name(p, stat)) for p, stat in pairs]]
    if keys:
        every = [F.col(f"_g{i}") for i in range(len(keys))]
        sets = rows.groupingSets([[every[i] for i in indexes] for indexes in wanted], *every)
        grouped = sets.agg(F.grouping_id().alias("_set"), *measured)
    else:
        grouped = rows.agg(F.lit(0).cast("bigint").alias("_set"), *measured)
    names = None
    for indexes, of_set in wanted.items():
        # the bit of a key that a set does not have is 1, the first key's bit is the highest
        number = sum(1 << (len(keys) - 1 - i) for i in range(len(keys)) if i not in indexes)
        choice = (F.col("_set") == number, F.array(*[F.lit(name) for name in of_set]))
        names = F.when(*choice) if names is None else names.when(*choice)
    grouped = grouped.withColumn("name", F.explode(names))

    def by_name(value: Callable[[str, Spec], Column | None], dtype: T.DataType | None = None) -> Column:
        chosen = F.when(F.lit(False), F.lit(None))
        for name, s in specs.items():
            column = value(name, s)
            if column is not None:
                chosen = chosen.when(F.col("name") == name, column)
        return chosen if dtype is None else chosen.cast(dtype)

    for i, dtype in enumerate(types):
        value = by_name(lambda _, s, i=i, t=dtype: F.col(f"_g{place[s.by[i]]}").cast(t) if i < len(s.by) else None, dtype)
        grouped = grouped.withColumn(f"k{i}", value)
    complete = by_name(lambda _, s: reduce(lambda a, b: a & b, [F.col(f"k{i}").isNotNull() for i in range(len(s.by))], F.lit(True)))
    results = [by_name(lambda _, s: F.col("total") if s.total else None, T.LongType()).alias("total")]
    results += [by_name(lambda _, s, p=p: F.col(stat_name(*p)) if p in s.statistics() else None,
                        grouped.schema[stat_name(*p)].dataType).alias(stat_name(*p)) for p in pairs]
    return grouped.where(complete).select("name", *[f"k{i}" for i in range(width)], *results)


def _key_types(df: DataFrame, resolved: dict, width: int) -> list[T.DataType]:
    """Type of each key position, text where the aggregates differ."""
    seen: list[list[T.DataType]] = [[] for _ in range(width)]
    for cols in resolved.values():
        schema = df.select(*[c.alias(f"k{i}") for i, (c, _) in enumerate(cols)]).schema if cols else []
        for position, (f, (_, many)) in enumerate(zip(schema, cols)):
            seen[position].append(f.dataType.elementType if many else f.dataType)
    return [types[0] if all(t == types[0] for t in types) else T.StringType() for types in seen]


def to_documents(groups: DataFrame, spec: Spec) -> DataFrame:
    """The aggregate as JSON documents `{keys, stats, total}` in a column `json`.

    Numbers stay numbers; time keys become ISO-8601 in UTC.
    """
    parts = []
    if spec.by:
        keys = []
        for i in range(len(spec.by)):
            time = isinstance(groups.schema[f"k{i}"].dataType, (T.TimestampType, T.TimestampNTZType))
            keys.append((dates.iso_utc(F.col(f"k{i}")) if time else F.col(f"k{i}")).cast("variant"))
        parts.append(F.array(*keys).alias("keys"))
    by_path: dict[str, list[Column]] = {}
    for path, name in spec.statistics():
        by_path.setdefault(path, []).append(F.col(stat_name(path, name)).alias(name))
    if by_path:
        parts.append(F.struct(*[F.struct(*cols).alias(p) for p, cols in by_path.items()]).alias("stats"))
    if spec.total:
        parts.append(F.col("total"))
    return groups.select(F.to_json(F.struct(*parts)).alias("json"))
