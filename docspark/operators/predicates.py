"""Predicates over document fields, as boolean Columns.

`doc = Doc(df)` resolves dotted paths against the schema, so a predicate knows
whether a field holds one value or an array, and `doc["a.b"].eq(5)` means "any
element" on arrays. A missing field fails every positive predicate and passes
every negative one; negate with `none_of`, `ne` and `nin`, never with a bare `~`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docspark.functions import geo, literals, text

_OPERATORS: dict[str, Callable[..., Column]] = {}


def register_operator(name: str, predicate: Callable[..., Column]) -> None:
    """Add a predicate, called as `doc[path].op(name, *args)` with the `Path` first."""
    _OPERATORS[name] = predicate


def match_all() -> Column:
    return F.lit(True)


def all_of(*predicates: Column) -> Column:
    return reduce(lambda a, b: a & b, predicates) if predicates else F.lit(True)


def any_of(*predicates: Column) -> Column:
    if not predicates:
        raise ValueError("any_of needs at least one predicate")
    return reduce(lambda a, b: a | b, predicates)


def none_of(*predicates: Column) -> Column:
    """No predicate holds; one that is null because a field is missing does not hold.

    The predicates of a single value bring their complement in a form that reaches the scan.
    """
    return all_of(*[vars(p).get("_complement", ~F.coalesce(p, F.lit(False))) for p in predicates])


class Doc:
    """Paths of a DataFrame, or of the struct elements of an array."""

    def __init__(self, source: DataFrame | T.StructType, base: Column | None = None):
        self.schema = source.schema if isinstance(source, DataFrame) else source
        self.used: set[str] = set()  # top-level fields asked for
        self._base = base

    def __getitem__(self, path: str) -> Path:
        names = path.split(".")
        self.used.add(names[0])
        column, dtype, metadata = self._base, self.schema, {}
        for i, name in enumerate(names):
            if isinstance(dtype, T.VariantType):
                return Path(path, column, dtype, {}, variant_path="$." + ".".join(names[i:]))
            column, dtype, metadata = _step(path, name, column, dtype)
        return Path(path, column, dtype, metadata, stored=self._base is None)


def _step(path: str, name: str, column: Column | None, dtype: T.DataType):
    """One part of a dotted path: (column, type, metadata) of the named field."""
    if isinstance(dtype, T.StructType):
        field = _field(path, name, dtype)
        column = F.col(f"`{name}`") if column is None else column.getField(name)
        return column, field.dataType, field.metadata
    if isinstance(dtype, T.MapType):
        return column[name], dtype.valueType, {}
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        field = _field(path, name, dtype.elementType)
        column = column.getField(name)
        if isinstance(field.dataType, T.ArrayType):
            return F.flatten(F.array_compact(column)), field.dataType, field.metadata
        return column, T.ArrayType(field.dataType), field.metadata
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.MapType):
        return F.transform(column, lambda m: m[name]), T.ArrayType(dtype.elementType.valueType), {}
    raise ValueError(f"could not find field {path} in the schema")


def _field(path: str, name: str, struct: T.StructType) -> T.StructField:
    for field in struct.fields:
        if field.name == name:
            return field
    raise ValueError(f"could not find field {path} in the schema")


#: What open fields are read as to be compared with whole numbers that are not exact as double.
_EXACT = "decimal(38,18)"


class Path:
    """One field of a document, with the predicates that apply to it."""

    def __init__(self, name, column, dtype, metadata=None, variant_path=None, stored=False, rough=None):
        self.name = name
        self.stored = stored  # a field of the table, not of an array element
        self.dtype = dtype
        self.metadata = metadata or {}
        self.is_array = isinstance(dtype, T.ArrayType)
        self.value_type = dtype.elementType if self.is_array else dtype
        self._column = column
        self._variant_path = variant_path
        self._rough = rough  # of an open field, what has no exact value

    @property
    def column(self) -> Column:
        """The searched value: missing reads as the schema's default, if it has one."""
        default = self.metadata.get("default")
        if default is None:
            return self._column
        default = literals.stored(default, self.value_type)
        if self.is_array:
            return F.coalesce(F.transform(self._column, lambda v: F.coalesce(v, default)), F.array(default))
        return F.coalesce(self._column, default)

    def literal(self, value) -> Column:
        """A value to compare with this field."""
        if value is None:
            raise ValueError(f"{self.name}: compare with a value; missing() finds absent fields")
        if isinstance(value, Column):
            return value
        if isinstance(self.dtype, T.VariantType):
            return F.lit(value)
        return literals.compared(value, self.value_type)

    def cast(self, dtype: str) -> Path:
        """The same field read as another type; for open (`mixed`) fields mainly."""
        if isinstance(self.dtype, T.VariantType):
            column = F.try_variant_get(self._column, self._variant_path or "$", dtype)
        else:
            column = self._column.cast(dtype)
        return Path(self.name, column, T.DataType.fromDDL(dtype), self.metadata)

    @staticmethod
    def _kind(value) -> str:
        """The type an open column's values are read as to be compared with `value`."""
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return "double" if abs(value) < 2**53 or abs(value) >= 10**19 else _EXACT  # not all are exact as double
        return {bool: "boolean", str: "string"}.get(type(value), "timestamp")

    def _typed(self, value) -> Path:
        """A field of an open column compared with `value` takes its kind; booleans are compared with booleans only."""
        if not isinstance(self.dtype, T.VariantType):
            return self
        kind = self._kind(value)
        is_bool = F.schema_of_variant(F.try_variant_get(self._column, self._variant_path or "$", "variant")) == "BOOLEAN"

        def read(dtype: str) -> Column:
            return F.when(is_bool if kind == "boolean" else ~is_bool, self.cast(dtype)._column)

        return Path(self.name, read(kind), T.DataType.fromDDL(kind), self.metadata, rough=read("double") if kind == _EXACT else None)

    def _by_kind(self, values: list) -> list[list]:
        """The values, those together that an open column compares as one type."""
        kinds: dict[str, list] = {}
        for v in values:
            kinds.setdefault(self._kind(v), []).append(v)
        return list(kinds.values())

    def _any(self, test: Callable[[Column], Column]) -> Column:
        """`test` holds for the value, or for some element of an array."""
        if self._rough is not None:
            return F.when(self._column.isNotNull(), test(self._column)).otherwise(test(self._rough))
        if self.is_array:
            return F.exists(self.column, test)
        default = self.metadata.get("default")
        if default is None:
            found = test(self._column)
            found._complement = self._column.isNull() | ~test(self._column)  # see none_of
            return found
        # kept apart from the column so that the comparison still reaches the scan
        return test(self._column) | (self._column.isNull() & test(literals.stored(default, self.value_type)))

    # -- values ------------------------------------------------------------

    def eq(self, value) -> Column:
        field = self._typed(value)
        if field.is_array:
            return F.array_contains(field.column, field.literal(value))
        return field._any(lambda c: c == field.literal(value))

    def ne(self, value) -> Column:
        """Not equal, or missing; on arrays no element is equal."""
        field = self._typed(value)
        if field.is_array or "default" in field.metadata or field._rough is not None:
            return none_of(field.eq(value))
        return ~field._column.eqNullSafe(field.literal(value))

    def isin(self, values) -> Column:
        values = _list("isin", values)
        if not values:
            return F.lit(False)
        if isinstance(self.dtype, T.VariantType) and len(self._by_kind(values)) > 1:
            return any_of(*[self.isin(some) for some in self._by_kind(values)])
        field = self._typed(values[0])
        literals = [field.literal(v) for v in values]
        if field.is_array:
            return F.arrays_overlap(field.column, F.array(*literals))
        return field._any(lambda c: c.isin(*literals))

    def nin(self, values) -> Column:
        """Equal to none of the values, or missing."""
        values = _list("nin", values)
        if not values:
            return F.lit(True)
        if isinstance(self.dtype, T.VariantType) and len(self._by_kind(values)) > 1:
            return none_of(self.isin(values))
        field = self._typed(values[0])
        if field.is_array or "default" in field.metadata or field._rough is not None:
            return none_of(field.isin(values))
        return field._column.isNull() | ~field._column.isin(*[field.literal(v) for v in values])

    def has_all(self, values) -> Column:
        """Every listed value is an element."""
        return all_of(*[self.eq(v) for v in _list("has_all", values)])

    def range(self, gt=None, gte=None, lt=None, lte=None) -> Column:
        """All given bounds hold; on arrays one element must satisfy all of them."""
        bounds = {"gt": gt, "gte": gte, "lt": lt, "lte": lte}
        bounds = {k: v for k, v in bounds.items() if v is not None}
        if not bounds:
            raise ValueError("range needs at least one bound")
        field = self._typed(next(iter(bounds.values())))
        tests = {"gt": Column.__gt__, "gte": Column.__ge__, "lt": Column.__lt__, "lte": Column.__le__}
        return field._any(lambda c: all_of(*[tests[k](c, field.literal(v)) for k, v in bounds.items()]))

    def exists(self) -> Column:
        """Present; an array needs an element that is not null."""
        if self.is_array:
            return F.coalesce(F.size(F.array_compact(self.column)) > 0, F.lit(False))
        if self._variant_path:
            value = F.try_variant_get(self._column, self._variant_path, "variant")
            return value.isNotNull() & ~F.is_variant_null(value)
        return self.column.isNotNull()

    def missing(self) -> Column:
        if self.is_array or self._variant_path:
            return ~self.exists()
        return self.column.isNull()

    # -- strings -----------------------------------------------------------

    def text(self, query: str, analyzer: str | None = None) -> Column:
        """All tokens of the query occur in the field, across the elements of an array."""
        stored = self.metadata.get("tokens")
        if self.is_array and stored and analyzer in (None, stored):
            return text.has_all_tokens(self._column, query, stored, tokenised=True)
        analyzer = analyzer or self.metadata.get("analyzer") or "standard"
        return text.has_all_tokens(self.column, query, analyzer, self.is_array)

    def wildcard(self, pattern: str) -> Column:
        """Glob on the whole value; `*` is any run of characters."""
        return self._any(lambda c: c.like(text.like_pattern(pattern)))

    def regex(self, pattern: str, anchored: bool = True) -> Column:
        """Regular expression on the whole value, or on any part with `anchored=False`."""
        pattern = rf"(?s)\A(?:{pattern})\z" if anchored else pattern
        return self._any(lambda c: c.rlike(pattern))

    # -- structure ---------------------------------------------------------

    def elem_match(self, predicate: Callable[[Doc], Column]) -> Column:
        """One element of an array of structs satisfies the whole inner predicate."""
        if not (self.is_array and isinstance(self.value_type, T.StructType)):
            raise ValueError(f"elem_match needs an array of objects: {self.name}")
        probe = Doc(self.value_type, F.lit(None))
        predicate(probe)
        fields = [f for f in self.value_type.fields if f.name in probe.used]
        elements, kind = self._column, self.value_type
        if self.stored and 0 < len(fields) < len(kind.fields):
            # the scan then reads only the fields of the elements that are tested
            elements = F.arrays_zip(*[elements.getField(f.name).alias(f.name) for f in fields])
            kind = T.StructType(fields)
        return F.exists(elements, lambda e: predicate(Doc(kind, e)))

    def near(self, lon: float, lat: float, max_distance: float, cells: str | None = None) -> Column:
        """A `struct<lon, lat>` point within `max_distance` metres.

        `cells` names a stored column with the point's geohash of 12 characters: where files are sorted by it, the
        ranges of cells that cover the circle pass over row groups that the box alone would read.
        """
        if cells is not None:
            if self.is_array:
                raise ValueError("cells are those of a single point")
            inside = geo.within_distance(self._column["lon"], self._column["lat"], lon, lat, max_distance)
            return geo.in_cells(F.col(f"`{cells}`"), lon, lat, max_distance) & inside
        test = lambda c: geo.within_distance(c["lon"], c["lat"], lon, lat, max_distance)
        return F.exists(self._column, test) if self.is_array else test(self._column)

    def distance_m(self, lon: float, lat: float) -> Column:
        """Metres to a point, for sorting or output."""
        return geo.geo_distance_m(self._column["lon"], self._column["lat"], lon, lat)

    def none(self, *tests: Callable[[Path], Column]) -> Column:
        """None of the given tests on this field holds."""
        return none_of(*[test(self) for test in tests])

    def op(self, name: str, *args) -> Column:
        if name not in _OPERATORS:
            raise ValueError(f"unrecognised operator: {name}")
        return _OPERATORS[name](self, *args)


def _list(operator: str, values) -> list:
    if isinstance(values, (str, bytes)) or not hasattr(values, "__iter__"):
        raise ValueError(f"{operator} needs a list of values")
    return list(values)
