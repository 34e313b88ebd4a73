import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from conftest import plan_of
from docspark import Doc, all_of, any_of, match_all, none_of, register_operator


@pytest.fixture
def people(spark):
    rows = [
        (1, "Ann Lee", 30, ["red", "blue"], [1, 5, 9], {"k": "v"}),
        (2, "bob", None, [], [4], {}),
        (3, None, 41, None, None, None),
        (4, "Cy % x", 30, ["blue", None], [None, 2], {"k": "w"}),
    ]
    return spark.createDataFrame(
        rows, "id int, name string, age int, tags array<string>, scores array<int>, props map<string,string>")


def ids(df, where):
    return sorted(r.id for r in df.where(where).select("id").collect())


def test_match_all_and_empty_conjunction(people):
    assert ids(people, match_all()) == ids(people, all_of()) == [1, 2, 3, 4]


def test_scalar_values(people):
    d = Doc(people)
    assert ids(people, d["age"].eq(30)) == [1, 4]
    assert ids(people, d["age"].eq("30")) == [1, 4]
    assert ids(people, d["age"].ne(30)) == [2, 3]
    assert ids(people, d["age"].isin([41, 30])) == [1, 3, 4]
    assert ids(people, d["age"].nin([41])) == [1, 2, 4]
    assert ids(people, d["age"].isin([])) == [] and ids(people, d["age"].nin([])) == [1, 2, 3, 4]
    assert ids(people, d["age"].range(gt=30, lte=41)) == [3]


def test_array_values_mean_any_element(people):
    d = Doc(people)
    assert ids(people, d["tags"].eq("blue")) == [1, 4]
    assert ids(people, d["tags"].ne("red")) == [2, 3, 4]
    assert ids(people, d["tags"].isin(["red", "x"])) == [1]
    assert ids(people, d["tags"].nin(["red", "x"])) == [2, 3, 4]
    assert ids(people, d["tags"].has_all(["red", "blue"])) == [1]
    assert ids(people, d["scores"].range(gt=1, lt=5)) == [2, 4]  # one element in the whole range
    assert ids(people, d["scores"].range(gt=5, lt=9)) == []
    assert ids(people, d["tags"].wildcard("b*e")) == [1, 4]
    assert ids(people, d["tags"].regex("r.d")) == [1]


def test_presence(people):
    d = Doc(people)
    assert ids(people, d["name"].exists()) == [1, 2, 4]
    assert ids(people, d["name"].missing()) == [3]
    assert ids(people, d["tags"].exists()) == [1, 4]
    assert ids(people, d["tags"].missing()) == [2, 3]


def test_negations_match_missing_fields(people):
    d = Doc(people)
    assert ids(people, none_of(d["age"].eq(30))) == [2, 3]
    assert ids(people, none_of(d["age"].eq(30), d["name"].eq("bob"))) == [3]
    assert ids(people, d["name"].none(lambda n: n.wildcard("bob"), lambda n: n.text("lee"))) == [3, 4]
    assert ids(people, any_of(d["age"].eq(41), d["name"].eq("bob"))) == [2, 3]


def test_strings(people):
    d = Doc(people)
    assert ids(people, d["name"].wildcard("*% *")) == [4]  # % and _ are plain characters
    assert ids(people, d["name"].wildcard("Ann")) == []
    assert ids(people, d["name"].regex("Ann")) == []  # anchored
    assert ids(people, d["name"].regex("Ann", anchored=False)) == [1]
    assert ids(people, d["name"].text("LEE ann")) == [1]
    assert ids(people, d["name"].text("le")) == []
    assert ids(people, d["name"].text("...")) == []
    assert ids(people, d["tags"].text("red blue")) == [1]
    assert ids(people, d["name"].text("anns", "english")) == [1]


def test_maps_and_open_fields(spark, people):
    assert ids(people, Doc(people)["props.k"].eq("v")) == [1]
    mixed = spark.createDataFrame(
        [(1, '{"a": {"b": 5}}'), (2, '{"a": {"b": "5"}}'), (3, '{"a": 1}'), (4, '{"a": {"b": null}}')],
        "id int, m string").withColumn("m", F.parse_json("m"))
    d = Doc(mixed)
    assert ids(mixed, d["m.a.b"].eq("5")) == [1, 2]
    assert ids(mixed, d["m.a.b"].range(gte=5)) == [1, 2]
    assert ids(mixed, d["m.a.b"].exists()) == [1, 2]
    assert ids(mixed, d["m.a.b"].missing()) == [3, 4]
    assert ids(mixed, d["m.a.b"].ne(5)) == [3, 4]


def test_nested_arrays(spark):
    df = spark.createDataFrame(
        [(1, [([("x", 1), ("y", 2)],), ([("z", 3)],)]), (2, [([("x", 3)],), (None,)]), (3, None)],
        "id int, a array<struct<b: array<struct<c: string, n: int>>>>")
    d = Doc(df)
    assert ids(df, d["a.b.c"].eq("x")) == [1, 2]
    assert ids(df, d["a.b.c"].eq("x") & d["a.b.n"].eq(3)) == [1, 2]
    assert ids(df, d["a.b"].elem_match(lambda e: e["c"].eq("x") & e["n"].eq(3))) == [2]
    inner = lambda e: e["b"].elem_match(lambda f: f["n"].range(gte=3))
    assert ids(df, d["a"].elem_match(inner)) == [1, 2]


def test_elem_match_reads_the_tested_fields_only(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, [("x", 1, "long"), None]), (2, [("y", 1, "long")]), (3, [None]), (4, None)],
        "id int, a array<struct<c: string, n: int, big: string>>")
    df.write.parquet(str(tmp_path / "e"))
    df = spark.read.parquet(str(tmp_path / "e"))
    d = Doc(df)
    found = df.where(d["a"].elem_match(lambda e: e["c"].eq("x") & e["n"].eq(1))).select("id")
    assert "ReadSchema: struct<id:int,a:array<struct<c:string,n:int>>>" in plan_of(found)
    assert [r.id for r in found.collect()] == [1]
    assert ids(df, d["a"].elem_match(lambda e: e["c"].missing())) == [1, 3]
    assert ids(df, d["a"].elem_match(lambda e: e["c"].ne("x"))) == [1, 2, 3]


def test_default_value_counts_as_the_value_of_a_missing_field(people):
    df = people.select("id", F.col("age").alias("age", metadata={"default": 30}))
    d = Doc(df)
    assert ids(df, d["age"].eq(30)) == [1, 2, 4]
    assert ids(df, d["age"].ne(30)) == [3]
    assert ids(df, d["age"].nin([41])) == [1, 2, 4]
    assert ids(df, d["age"].range(lt=31)) == [1, 2, 4]
    assert ids(df, d["age"].missing()) == []


def test_dates(spark):
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2020, 2, 1))], "id int, t timestamp")
    assert ids(df, Doc(df)["t"].range(gte="2020-01-15")) == [2]
    assert ids(df, Doc(df)["t"].eq(dt.datetime(2020, 1, 1))) == [1]


def test_numbers_are_not_narrowed(spark):
    df = spark.createDataFrame([(1, 5, 0.3, [5]), (2, 6, 0.5, [6])], "id int, n int, f float, ns array<int>")
    d = Doc(df)
    assert ids(df, d["n"].eq(5.5)) == [] and ids(df, d["ns"].eq(5.5)) == []
    assert ids(df, d["n"].range(gte=5.5)) == [2] and ids(df, d["n"].range(lt=5.5)) == [1]
    assert ids(df, d["n"].isin([2**40, 5])) == [1] and ids(df, d["ns"].isin([2**40, 5])) == [1]
    assert ids(df, d["f"].eq(0.3)) == [1]
    assert ids(df, d["n"].ne(5.5)) == [1, 2]


def test_times_are_utc_whatever_the_driver_zone(spark, monkeypatch):
    import time

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        df = spark.sql("SELECT TIMESTAMP '2020-01-01 00:00:00' AS t, TIMESTAMP_NTZ '2020-01-01 00:00:00' AS u")
        noon = dt.datetime(2020, 1, 1)
        for path in ("t", "u"):
            assert df.where(Doc(df)[path].eq(noon)).count() == 1
            assert df.where(Doc(df)[path].eq(noon.replace(tzinfo=dt.timezone.utc))).count() == 1
            assert df.where(Doc(df)[path].eq(noon.replace(tzinfo=dt.timezone(dt.timedelta(hours=1))))).count() == 0
    finally:
        monkeypatch.undo()
        time.tzset()


def test_errors(people):
    d = Doc(people)
    with pytest.raises(ValueError, match="could not find field bedId"):
        d["bedId"]
    with pytest.raises(ValueError, match="list of values"):
        d["age"].nin("41")
    with pytest.raises(ValueError, match="list of values"):
        d["tags"].has_all("red")
    with pytest.raises(ValueError, match="array of objects"):
        d["name"].elem_match(lambda e: e["x"].eq(1))
    with pytest.raises(ValueError, match="unrecognised operator"):
        d["name"].op("what")
    with pytest.raises(ValueError, match="missing"):
        d["name"].eq(None)
    with pytest.raises(ValueError):
        any_of()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        people.where(d["age"].eq("many")).collect()


def test_custom_operator(people):
    register_operator("longer", lambda path, n: F.length(path.column) > n)
    assert ids(people, Doc(people)["name"].op("longer", 3)) == [1, 4]


def test_predicates_reach_the_scan(spark, tmp_path, people):
    people.write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    d = Doc(df)
    pushed = {
        "EqualTo(age,30)": d["age"].eq("30"),
        "Not(EqualNullSafe(age,30))": d["age"].ne(30),
        "Or(IsNull(age),Not(In(age, [1,2,3])))": d["age"].nin([1, 2, 3]),
        "StringStartsWith(name,Ann)": d["name"].wildcard("Ann*"),
        "GreaterThan(age,3), LessThan(age,9)": d["age"].range(gt=3, lt=9),
    }
    for filters, where in pushed.items():
        assert filters in plan_of(df.where(where).select("id")), filters


def test_open_fields_compare_by_kind(spark):
    rows = spark.sql("""
        SELECT id, parse_json(v) AS k FROM VALUES
        (1, '5.7'), (2, '5'), (3, '"x"'), (4, '6.2'), (5, '"5"'), (6, '9007199254740993'), (7, NULL) AS t(id, v)""")
    k = Doc(rows)["k"]
    found = lambda p: [r.id for r in rows.where(p).orderBy("id").collect()]
    assert found(k.eq(5)) == [2, 5]  # a number in a text counts as that number
    assert found(k.eq("5")) == [2, 5]
    assert found(k.range(gt=5)) == [1, 4, 6]
    assert found(k.range(lte=5)) == [2, 5]
    assert found(k.range(gt=1, lt=5.5)) == [2, 5]
    assert found(k.isin([5, "x"])) == [2, 3, 5]
    assert found(k.nin([5, "x"])) == [1, 4, 6, 7]
    assert found(k.ne(5)) == [1, 3, 4, 6, 7]
    assert found(k.eq(2**53 + 1)) == [6]


def test_negations_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", F.when(F.col("id") % 7 > 0, F.col("id")).alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    v = Doc(df)["v"]
    ranges = df.where(v.none(lambda p: p.range(lt=10), lambda p: p.range(gt=80, lte=90)))
    expected = {i for i in range(100) if i % 7 == 0 or not (i < 10 or 80 < i <= 90)}
    assert {r.id for r in ranges.collect()} == expected
    pushed = plan_of(ranges).split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(v,10)" in pushed and "IsNull(v)" in pushed and "GreaterThan(v,90)" in pushed
    equal = df.where(none_of(v.eq(3), v.isin([4, 5])))
    assert {r.id for r in equal.collect()} == set(range(100)) - {3, 4, 5}
    pushed = plan_of(equal).split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "Not(EqualTo(v,3))" in pushed and "Not(In(v, [4,5]))" in pushed


def test_defaults_of_null_elements(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType()),
                           T.StructField("vs", T.ArrayType(T.DoubleType()), True, {"default": 9.0})])
    df = spark.createDataFrame([(1, [None, 2.0]), (2, [2.0]), (3, []), (4, None)], schema)
    vs = Doc(df)["vs"]
    ids = lambda p: {r.id for r in df.where(p).collect()}
    assert ids(vs.eq(9.0)) == ids(vs.isin([9.0])) == ids(vs.range(gt=5)) == {1, 4}
    assert ids(vs.ne(9.0)) == {2, 3}
    assert ids(vs.exists()) == {1, 2, 4}
