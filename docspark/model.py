"""Document models: a Spark schema whose field metadata carries the model's declarations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field as dataclass_field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docspark.functions import geo, text
from docspark.operators.predicates import Doc

GEOPOINT = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])

# The declared types and their Spark types.
_TYPES = {
    "string": T.StringType(), "boolean": T.BooleanType(), "date": T.TimestampType(),
    "geopoint": GEOPOINT, "mixed": T.VariantType(),
    "number": T.DoubleType(), "byte": T.ByteType(), "short": T.ShortType(),
    "integer": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(),
}
_VALUES = (T.StringType, T.BooleanType, T.DatetimeType, T.NumericType)
STAGES = (
    "post-init", "pre-normalize", "post-normalize", "pre-save", "post-save", "pre-remove",
    "post-remove",
)


class ModelError(ValueError):
    """A model declaration that cannot be used, or data that does not fit the model."""


def field(
    name: str,
    dtype: str | T.DataType = "string",
    *,
    id: bool = False,
    key: bool = False,
    index: bool | str = False,
    analyzer: str | None = None,
    default=None,
    enum: list | None = None,
    format: str | None = None,
    nested: bool = False,
    geohash: bool = True,
    extra: dict | None = None,
) -> T.StructField:
    """A schema field. `dtype` is a type name, a Spark type, or one of the helpers below.

    `format` is the pattern of a date given as text; the default reads ISO-8601.
    `extra` is kept in the field's metadata as it is.
    """
    if index == "analyzed" and not analyzer:
        raise ModelError(f"analyzed field {name!r} is missing its analyzer")
    options = {
        "id": id, "key": key, "index": index, "analyzer": analyzer, "default": default,
        "enum": enum, "format": format, "nested": nested, "geohash": geohash, **(extra or {}),
    }
    if geohash and dtype != "geopoint":
        del options["geohash"]
    metadata = {k: v for k, v in options.items() if v is not None and v is not False}
    return T.StructField(name, spark_type(dtype, name), True, metadata)


def spark_type(dtype: str | T.DataType, name: str = "") -> T.DataType:
    if isinstance(dtype, T.DataType):
        return dtype
    if dtype == "or":
        raise ModelError(f"union types have no column type ({name!r}); declare the field as 'mixed'")
    if dtype not in _TYPES:
        raise ModelError(f"unknown type {dtype!r} of field {name!r}; known: {sorted(_TYPES)}")
    return _TYPES[dtype]


def object_of(*fields: T.StructField) -> T.StructType:
    return T.StructType(list(fields))


def array_of(element: str | T.DataType) -> T.ArrayType:
    return T.ArrayType(spark_type(element))


def map_of(value: str | T.DataType) -> T.MapType:
    return T.MapType(T.StringType(), spark_type(value))


@dataclass
class DocModel:
    """A named document type.

    `parent` names the parent model; `all_text` adds the searchable text of all
    fields; `hooks` maps a stage to functions from DataFrame to DataFrame.
    """

    name: str
    schema: T.StructType
    index: str | None = None
    parent: str | None = None
    keys: list[str] | None = None
    all_text: bool = False
    hooks: dict[str, list[Callable[[DataFrame], DataFrame]]] = dataclass_field(default_factory=dict)

    def __post_init__(self):
        if not isinstance(self.schema, T.StructType):
            raise ModelError("the schema of a model must be an object")
        self._paths = dict(_walk(self.schema))
        self._multi: dict[tuple[str, str], str] = {}
        self._in_use = False
        for stage in self.hooks:
            _check_stage(stage)

    # -- declarations ------------------------------------------------------

    @property
    def id_path(self) -> str | None:
        """Path of the field flagged `id`; the last one counts."""
        flagged = [p for p, f in self._paths.items() if f.metadata.get("id")]
        return flagged[-1] if flagged else None

    def get_keys(self) -> list[str]:
        """Declared keys, else fields flagged `key`, else the first indexed field."""
        flagged = [p for p, f in self._paths.items() if f.metadata.get("key")]
        indexed = [p for p, f in self._paths.items() if f.metadata.get("index")]
        keys = self.keys or flagged or indexed[:1]
        if not keys:
            raise ModelError(f"no keys are declared for model {self.name!r}")
        return list(keys)

    def add_index(self, path: str, analyzer: str = "keyword", name: str | None = None) -> DocModel:
        """Search `path` in one more way, as the tokens in column `path__name`."""
        if self._in_use:
            raise ModelError("indexes cannot be added once the model is in use")
        if path not in self._paths:
            raise ModelError(f"could not find field {path} in the schema")
        if not isinstance(_element(self._paths[path].dataType), _VALUES):
            raise ModelError(f"an extra index needs a value field: {path}")
        name = name or analyzer
        if (path, name) in self._multi:
            raise ModelError(f"{path} already has an index named {name}")
        self._multi[(path, name)] = analyzer
        return self

    def on(self, stage: str, hook: Callable[[DataFrame], DataFrame]) -> DocModel:
        _check_stage(stage)
        self.hooks.setdefault(stage, []).append(hook)
        return self

    def run_hooks(self, stage: str, df: DataFrame) -> DataFrame:
        for hook in self.hooks.get(stage, []):
            df = df.transform(hook)
        return df

    # -- writing -----------------------------------------------------------

    def cast(self, df: DataFrame) -> DataFrame:
        """The schema's columns, cast; a value that does not fit fails the job."""
        return df.select(*self._conformed(df, strict=True), *_metadata_columns(df))

    def split_castable(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(documents that fit, original rows that do not), without failing the job."""
        conformed = self._conformed(df, strict=False)
        lost = [
            F.col(f"`{f.name}`").isNotNull()
            & ~_same_presence(F.col(f"`{f.name}`"), df.schema[f.name].dataType, new, f.dataType)
            for f, new in zip(self.schema.fields, conformed) if f.name in df.columns
        ]
        bad = F.lit(False)
        for condition in lost:
            bad = bad | F.coalesce(condition, F.lit(False))
        return df.where(~bad).select(*conformed, *_metadata_columns(df)), df.where(bad)

    def _conformed(self, df: DataFrame, strict: bool) -> list[Column]:
        columns = []
        for f in self.schema.fields:
            if f.name in df.columns:
                value = _conform(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f, strict)
            else:
                value = F.lit(None).cast(f.dataType)
            columns.append(value.alias(f.name, metadata=f.metadata))
        return columns

    def prepare(self, df: DataFrame, index: str | None = None, routing: str | None = None) -> DataFrame:
        """Documents ready to store: hooks, cast, then `_id _parent _routing _index`.

        The id comes from the id path unless `_id` is given; the route is the given
        one, else the parent id, else the own id.
        """
        self._in_use = True
        df = self.run_hooks("pre-normalize", self.run_hooks("post-init", df))
        df = self.cast(df)

        def given(name: str) -> Column:
            return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")

        own = F.col(self.id_path).cast("string") if self.id_path else F.lit(None).cast("string")
        df = df.withColumns({"_id": F.coalesce(given("_id"), own), "_parent": given("_parent")})
        route = given("_routing") if routing is None else F.lit(routing)
        default_route = F.coalesce(F.col("_parent"), F.col("_id")) if self.parent else F.col("_id")
        df = df.withColumns({
            "_routing": F.coalesce(route, default_route),
            "_index": F.coalesce(given("_index"), F.lit(index or self.index)),
        })
        return self.run_hooks("pre-save", self.run_hooks("post-normalize", df))

    # -- searching ---------------------------------------------------------

    def doc(self, df: DataFrame) -> Doc:
        """Paths of any DataFrame of this model's documents, with the declared defaults."""
        return Doc(_declare(df.schema, self.schema))

    def searchable(self, df: DataFrame) -> DataFrame:
        """`df` with the columns that only searching needs.

        `path__name` tokens of each extra index, `path__geohash` of indexed points,
        and `_all` text. They are computed when a query reads them.
        """
        self._in_use = True
        columns = {}
        for (path, name), analyzer in self._multi.items():
            source = Doc(df)[path]
            value = source.column if source.is_array else source.column.cast("string")
            tokens = text.analyze(value, analyzer, source.is_array)
            columns[f"{path}__{name}"] = (tokens, {"tokens": analyzer})
        for path, f in self._paths.items():
            if f.metadata.get("geohash") and f.metadata.get("index"):
                point = F.col(path)
                columns[f"{path}__geohash"] = (geo.geohash(point["lon"], point["lat"]), {})
        if self.all_text:
            doc = Doc(df.schema)
            leaves = [_joined(F.col(p), doc[p].dtype) for p, f in self._paths.items()
                      if not isinstance(f.dataType, T.StructType)
                      and not isinstance(_element(f.dataType), (T.StructType, T.MapType, T.VariantType))]
            columns["_all"] = (all_text(*leaves), {})
        derived = [c.alias(n.replace(".", "_"), metadata=m) for n, (c, m) in columns.items()]
        declared = {f.name: f.metadata for f in self.schema.fields}
        stored = [F.col(f"`{c}`").alias(c, metadata=declared[c]) if c in declared else F.col(f"`{c}`")
                  for c in df.columns]
        return df.select(*stored, *derived)


def _declare(dtype: T.DataType, declared: T.DataType) -> T.DataType:
    """A type with the declarations of the model's fields, matched by name."""
    if isinstance(dtype, T.ArrayType) and isinstance(declared, T.ArrayType):
        return T.ArrayType(_declare(dtype.elementType, declared.elementType), dtype.containsNull)
    if not (isinstance(dtype, T.StructType) and isinstance(declared, T.StructType)):
        return dtype
    known = {f.name: f for f in declared.fields}
    return T.StructType([
        T.StructField(f.name, _declare(f.dataType, known[f.name].dataType), f.nullable,
                      {**known[f.name].metadata, **f.metadata}) if f.name in known else f
        for f in dtype.fields
    ])


def all_text(*columns: Column) -> Column:
    """One text of several columns."""
    return F.concat_ws(" ", *[c.cast("string") for c in columns])


def _joined(column: Column, dtype: T.DataType) -> Column:
    """An array as the text of its elements that are not null; other values as they are."""
    if not isinstance(dtype, T.ArrayType):
        return column
    return F.array_join(F.transform(column, lambda v: _joined(v, dtype.elementType).cast("string")), " ")


def _check_stage(stage: str) -> None:
    if stage not in STAGES:
        raise ModelError(f"unknown hook stage {stage!r}; known: {STAGES}")


def _element(dtype: T.DataType) -> T.DataType:
    while isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return dtype


def _walk(struct: T.StructType, prefix: str = ""):
    """(path, field) of every field, in order, parents first."""
    for f in struct.fields:
        path = f"{prefix}{f.name}"
        yield path, f
        inner = _element(f.dataType)
        if isinstance(inner, T.StructType) and inner != GEOPOINT:
            yield from _walk(inner, path + ".")


def _metadata_columns(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in ("_id", "_parent", "_routing", "_index", "_old_id", "_old_routing", "_seq")
            if c in df.columns]


def _conform(column: Column, source: T.DataType, field: T.StructField, strict: bool) -> Column:
    """Cast by field name through structs, arrays and maps, then check listed values."""
    value = _convert(column, source, field.dataType, field.metadata, strict)
    allowed = field.metadata.get("enum")
    if not allowed:
        return value
    refused = F.raise_error(F.lit(f"invalid value of {field.name}")) if strict else F.lit(None)
    return F.when(value.isNull() | value.isin(allowed), value).otherwise(refused.cast(field.dataType))


def _convert(column: Column, source: T.DataType, target: T.DataType, metadata: dict, strict: bool) -> Column:
    if target == GEOPOINT and isinstance(source, T.ArrayType):
        lon, lat = (F.get(column, F.lit(i)) for i in (0, 1))
        lon, lat = (c.cast("double") if strict else c.try_cast("double") for c in (lon, lat))
        return _point(column, F.size(column) == 2, lon, lat, strict)
    if target == GEOPOINT and isinstance(source, T.StructType) and {"lon", "lat"} <= set(source.names):
        lon, lat = (column.getField(n) for n in ("lon", "lat"))
        lon, lat = (c.cast("double") if strict else c.try_cast("double") for c in (lon, lat))
        return _point(column, F.lit(True), lon, lat, strict)
    if isinstance(target, T.StructType) and isinstance(source, T.StructType):
        have = {f.name: f.dataType for f in source.fields}
        parts = [
            (_conform(column.getField(f.name), have[f.name], f, strict)
             if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        return F.transform(
            column, lambda e: _convert(e, source.elementType, target.elementType, metadata, strict))
    if isinstance(target, T.MapType) and isinstance(source, T.MapType):
        return F.transform_values(
            column, lambda _, v: _convert(v, source.valueType, target.valueType, metadata, strict))
    if source == target:
        return column
    if isinstance(target, T.VariantType) and isinstance(source, T.StringType):
        return F.parse_json(column) if strict else F.try_parse_json(column)
    if metadata.get("format") and isinstance(source, T.StringType):
        pattern = metadata["format"]
        return F.to_timestamp(column, pattern) if strict else F.try_to_timestamp(column, F.lit(pattern))
    return column.cast(target) if strict else column.try_cast(target)


def _point(given: Column, shaped: Column, lon: Column, lat: Column, strict: bool) -> Column:
    """The point; a malformed one, or one that is not on the globe, is refused or null."""
    right = F.coalesce(shaped & lon.between(-180, 180) & lat.between(-90, 90), F.lit(False))
    point = F.when(given.isNotNull() & right, F.struct(lon.alias("lon"), lat.alias("lat")))
    if not strict:
        return point
    return point.when(given.isNotNull(), F.raise_error(F.lit("malformed point")).cast(GEOPOINT))


def _same_presence(old: Column, source: T.DataType, new: Column, target: T.DataType) -> Column:
    """No part that was present became null by the cast."""
    if isinstance(source, T.StructType) and isinstance(target, T.StructType) and target != GEOPOINT:
        result = new.isNotNull()
        have = {f.name: f.dataType for f in source.fields}
        for f in target.fields:
            if f.name in have:
                part = old.getField(f.name)
                result = result & (part.isNull() | _same_presence(
                    part, have[f.name], new.getField(f.name), f.dataType))
        return result
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        pairs = F.arrays_zip(old.alias("o"), new.alias("n"))
        return F.forall(pairs, lambda p: p["o"].isNull() | _same_presence(
            p["o"], source.elementType, p["n"], target.elementType))
    return new.isNotNull()


_MODELS: dict[str, DocModel] = {}


def register_model(model: DocModel) -> DocModel:
    _MODELS[model.name] = model
    return model


def get_model(name: str) -> DocModel:
    if name not in _MODELS:
        raise ModelError(f"model not found: {name}")
    return _MODELS[name]
