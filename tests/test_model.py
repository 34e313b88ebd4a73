import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from conftest import animal_model
from docspark import Doc, DocModel, array_of, field, find, get_model, map_of, object_of, register_model
from docspark.model import ModelError


def model(*fields, **options):
    return DocModel("M", object_of(*fields), **options)


def test_types():
    kinds = {"number": "double", "integer": "int", "byte": "tinyint", "short": "smallint", "long": "bigint",
             "float": "float", "double": "double", "string": "string", "boolean": "boolean", "date": "timestamp",
             "geopoint": "struct<lon:double,lat:double>", "mixed": "variant"}
    for name, spark_name in kinds.items():
        assert field("f", name).dataType.simpleString() == spark_name
    deep = object_of(field("a", array_of(object_of(
        field("foo"), field("bar", object_of(field("baz", "float")))))), field("m", map_of(object_of(field("x")))))
    assert deep.simpleString() == "struct<a:array<struct<foo:string,bar:struct<baz:float>>>,m:map<string,struct<x:string>>>"


def test_declaration_errors():
    with pytest.raises(ModelError, match="union types"):
        field("f", "or")
    with pytest.raises(ModelError, match="unknown type"):
        field("f", "decimal")
    with pytest.raises(ModelError, match="missing its analyzer"):
        field("f", index="analyzed")
    with pytest.raises(ModelError, match="must be an object"):
        DocModel("M", T.StringType())
    with pytest.raises(ModelError, match="unknown hook stage"):
        model(field("f"), hooks={"sometime": []})


def test_id_and_keys():
    assert animal_model().id_path == "animalId"
    assert model(field("a", id=True), field("o", object_of(field("b", id=True)))).id_path == "o.b"
    assert animal_model().get_keys() == ["animalId", "name"]
    assert animal_model(keys=["animalId"]).get_keys() == ["animalId"]
    assert model(field("x"), field("a", index=True), field("b", index=True)).get_keys() == ["a"]
    with pytest.raises(ModelError, match="no keys are declared"):
        model(field("a")).get_keys()


def test_extra_metadata_and_registry():
    assert field("f", extra={"boost": 2}).metadata["boost"] == 2
    registered = register_model(animal_model())
    assert get_model("Animal") is registered
    with pytest.raises(ModelError, match="model not found"):
        get_model("Unknown")


def test_extra_indexes(spark, animals):
    m = animal_model().add_index("name", "english", "englishKeywords")
    with pytest.raises(ModelError, match="already has an index"):
        m.add_index("name", "standard", "englishKeywords")
    with pytest.raises(ModelError, match="value field"):
        m.add_index("beds")
    with pytest.raises(ModelError, match="could not find"):
        m.add_index("nothing")
    searched = m.searchable(animals)
    with pytest.raises(ModelError, match="once the model is in use"):
        m.add_index("description")
    assert find(searched, Doc(searched)["name__englishKeywords"].text("barkleys")).first().name == "Charles Barkley"
    assert find(searched, Doc(searched)["name__englishKeywords"].eq("ein")).count() == 1
    by_name = {r.name: r.loc__geohash for r in searched.collect()}
    assert {len(h) for h in by_name.values()} == {12} and by_name["Ein"].startswith("tygt")


def test_extra_index_on_array_elements(spark):
    m = model(field("tags", array_of("string"), index=True)).add_index("tags", "english", "words")
    df = m.searchable(spark.createDataFrame([(["red cats", "dogs"],), (None,)], "tags array<string>"))
    assert df.first().tags__words == ["red", "cat", "dog"]
    assert df.where(Doc(df)["tags__words"].text("dog cat")).count() == 1


def test_all_text(spark):
    m = model(field("a"), field("n", "integer"), field("o", object_of(field("t", array_of("string")))), all_text=True)
    df = m.searchable(spark.createDataFrame([("x", 5, (["p", "q"],)), (None, 7, None)], m.schema))
    assert [r._all for r in df.collect()] == ["x 5 p q", "7"]
    assert df.where(Doc(df)["_all"].text("q x 5")).count() == 1


def test_cast(spark):
    m = animal_model()
    raw = spark.createDataFrame(
        [("a", "3", "2015-01-01", [10.0, 20.0], [("b1", 1)])],
        "animalId string, age string, found string, loc array<double>, beds array<struct<bedId: string, x: int>>")
    row = m.cast(raw).first()
    assert row.age == 3.0 and row.found == dt.datetime(2015, 1, 1) and row.loc == (10.0, 20.0)
    assert row.beds[0].asDict() == {"bedId": "b1"} and row.name is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        m.cast(raw.withColumn("age", F.lit("old"))).collect()
    with pytest.raises(Exception, match="invalid value of sex"):
        m.cast(raw.withColumn("sex", F.lit("other"))).collect()


def test_split_castable(spark):
    m = model(field("id", "long", id=True), field("n", array_of("integer")), field("o", object_of(field("d", "date"))),
              field("s", enum=["x", "y"]), field("v", "mixed"))
    raw = spark.createDataFrame([
        ("1", ["1", None], ("2020-01-01",), "x", '{"a":1}'), ("two", None, None, None, None),
        ("3", ["1", "z"], None, None, None), ("4", [], ("no day",), None, None),
        ("5", None, (None,), "z", None), ("6", None, None, None, "{"), (None, None, None, None, None),
    ], "id string, n array<string>, o struct<d: string>, s string, v string")
    good, bad = m.split_castable(raw)
    assert sorted(r.id for r in bad.collect()) == ["3", "4", "5", "6", "two"]
    assert sorted((r.id is None, r.id) for r in good.collect()) == [(False, 1), (True, None)]


def test_date_format_and_nested_enum(spark):
    m = model(field("d", "date", format="dd/MM/yyyy"), field("o", object_of(field("s", enum=["x"]))))
    raw = spark.createDataFrame([("31/12/2020", ("x",)), ("2020-12-31", ("x",)), (None, ("z",))],
                                "d string, o struct<s: string>")
    good, bad = m.split_castable(raw)
    assert [r.d for r in good.collect()] == [dt.datetime(2020, 12, 31)] and bad.count() == 2
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        m.cast(raw.drop("o")).collect()
    with pytest.raises(Exception, match="invalid value of s"):
        m.cast(raw.drop("d")).collect()


def test_prepare(spark):
    child = DocModel("Sheltered", animal_model().schema, index="shelters", parent="Shelter")
    raw = spark.createDataFrame([("baloo", "farm"), ("stray", None)], "animalId string, _parent string")
    rows = {r._id: (r._parent, r._routing, r._index) for r in child.prepare(raw).collect()}
    assert rows == {"baloo": ("farm", "farm", "shelters"), "stray": (None, "stray", "shelters")}
    plain = animal_model().prepare(raw.drop("_parent"), index="other", routing="R").first()
    assert (plain._id, plain._parent, plain._routing, plain._index) == ("baloo", None, "R", "other")


def test_hooks_run_in_order(spark):
    seen = []
    m = animal_model()
    for stage in ("pre-save", "pre-normalize", "post-normalize", "post-init"):
        m.on(stage, lambda df, s=stage: (seen.append(s), df.withColumn("name", F.lit(s)))[1])
    raw = spark.createDataFrame([("a", "n")], "animalId string, name string")
    assert m.prepare(raw).first().name == "pre-save"
    assert seen == ["post-init", "pre-normalize", "post-normalize", "pre-save"]


def test_declared_defaults_of_nested_fields(spark):
    m = model(field("id"), field("o", object_of(field("n", "integer", default=7))),
              field("a", array_of(object_of(field("k", "integer", default=1)))))
    df = spark.createDataFrame([("x", (None,), [(None,)]), ("y", (3,), []), ("z", None, None)],
                               "id string, o struct<n: int>, a array<struct<k: int>>")
    found = df.where(m.doc(df)["o.n"].eq(7))
    assert sorted(r.id for r in found.collect()) == ["x", "z"]
    assert [r.id for r in df.where(m.doc(df)["a"].elem_match(lambda e: e["k"].eq(1))).collect()] == ["x"]
    assert df.where(Doc(df)["o.n"].eq(7)).count() == 0


def test_malformed_points(spark):
    model = DocModel("Place", object_of(field("id", "integer", id=True), field("at", "geopoint")))
    rows = [(1, [10.0, 20.0]), (2, [1.0, 2.0, 3.0]), (3, [500.0, 99.0]), (4, None), (5, [1.0, None])]
    df = spark.createDataFrame(rows, "id int, at array<double>")
    good, bad = model.split_castable(df)
    assert {r.id for r in good.collect()} == {1, 4} and {r.id for r in bad.collect()} == {2, 3, 5}
    for i in (2, 3, 5):
        with pytest.raises(Exception, match="malformed point"):
            model.cast(df.where(F.col("id") == i)).collect()
    assert model.cast(df.where("id IN (1, 4)")).where("at.lat = 20").count() == 1
