import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from docspark import Doc, count, find, pages, project, stream


def names(df):
    return [r.name for r in df.collect()]


def test_match(animals):
    d = Doc(animals)
    assert find(animals).count() == 3
    assert sorted(names(find(animals, d["isDog"].eq(True)))) == ["Baloo", "Charles Barkley"]
    assert find(animals, d["name"].eq("Larry Bird")).collect() == []
    assert find(animals, d["beds"].elem_match(lambda b: b["bedId"].eq("couch"))).first().name == "Charles Barkley"
    assert find(animals, d["beds.bedId"].has_all(["couch", "mat"])).count() == 1
    assert sorted(names(find(animals, d["beds"].missing()))) == ["Baloo", "Ein"]


def test_near_and_order_by_distance(animals):
    loc = Doc(animals)["loc"]
    close = find(animals, loc.near(84, 39, 6731000), sort=[loc.distance_m(84, 39)])
    assert names(close) == ["Ein", "Charles Barkley", "Baloo"]
    assert names(find(animals, loc.near(84, 39, 0))) == ["Ein"]
    for bad in ("5", None, True):
        with pytest.raises(ValueError, match="metres"):
            loc.near(84, 39, bad)


def test_page(animals):
    by_id = {"animalId": 1}
    assert find(animals, skip=1).count() == 2 and find(animals, limit=1).count() == 1
    assert find(animals, limit=0).count() == 0
    assert names(find(animals, sort=by_id, skip=1, limit=1)) == ["Charles Barkley"]
    assert names(find(animals, sort={"description": -1, "name": 1})) == ["Charles Barkley", "Ein", "Baloo"]
    page = find(animals, limit=2, with_total=True).collect()
    assert len(page) == 2 and {r._total for r in page} == {3}
    assert count(animals, Doc(animals)["isDog"].eq(True)).first().n == 2


def test_stream_options(spark):
    rows = [(f"data-dog-{c}", c != "e", "Baloo" if c == "f" else "Ein") for c in "abcdef"]
    dogs = spark.createDataFrame(rows, "animalId string, isDog boolean, _routing string")
    routed = dogs.where("_routing = 'Ein'")
    where = Doc(dogs)["isDog"].eq(True)
    docs = list(stream(routed, where, sort={"animalId": 1}, skip=1, limit=2, exclude=["isDog"], with_total=True))
    assert [d.animalId for d in docs] == ["data-dog-b", "data-dog-c"]
    assert docs[0]._total == 4 and "isDog" not in docs[0]


def test_missing_sorts_last_both_ways(spark):
    df = spark.createDataFrame([(1, None, [3, 9]), (2, 5, None), (3, 7, [4])], "id int, v int, a array<int>")

    def order(sort):
        return [r.id for r in find(df, sort=sort).collect()]

    assert order({"v": 1}) == [2, 3, 1] and order({"v": -1}) == [3, 2, 1]
    assert order({"a": 1}) == [1, 3, 2] and order({"a": -1}) == [1, 3, 2]  # least, greatest element


def test_top_k_is_not_a_full_sort(animals):
    assert "TakeOrderedAndProject" in plan_of(find(animals, sort={"animalId": 1}, skip=1, limit=1))


def test_fields(spark, animals):
    assert "isDog" not in project(animals, exclude=["isDog"]).columns
    kept = project(animals, include=["name", "loc.lat", "beds.bedId"])
    assert kept.columns == ["name", "loc", "beds", "_routing"]
    assert kept.schema["loc"].dataType.simpleString() == "struct<lat:double>"
    assert project(animals, include=["loc", "loc.lat"]).schema["loc"].dataType.simpleString() == \
        "struct<lon:double,lat:double>"
    with pytest.raises(ValueError, match="could not find field"):
        project(animals, include=["nothing"])


def test_fields_inside_arrays_and_maps(spark):
    df = spark.createDataFrame(
        [(1, [({"x": (1, 2)}, 3)]), (2, None)], "id int, a array<struct<m: map<string, struct<p: int, q: int>>, n: int>>")
    cut = project(df, exclude=["a.m.p"])
    assert cut.schema["a"].dataType.simpleString() == "array<struct<m:map<string,struct<q:int>>,n:int>>"
    assert cut.orderBy("id").collect()[0].a[0].m["x"].q == 2 and cut.orderBy("id").collect()[1].a is None
    assert project(df, include=["a.n"]).schema["a"].dataType.simpleString() == "array<struct<n:int>>"
    assert project(df, include=["id", "a"], exclude=["a.n", "a.m"]).columns == ["id"]


def test_array_fields_are_pruned_in_the_scan(spark, tmp_path):
    schema = "id int, a array<struct<x: int, y: string, o: struct<p: int, q: int>, l: array<struct<r: int, s: int>>>>"
    rows = [(1, [(1, "u", (3, 4), [(5, 6), (7, 8)]), (2, None, None, None)]), (2, []), (3, None)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "n"))
    df = spark.read.parquet(str(tmp_path / "n"))
    cut = project(df, include=["id", "a.x", "a.o.q"])
    assert "ReadSchema: struct<id:int,a:array<struct<x:int,o:struct<q:int>>>>" in plan_of(cut)
    got = {r.id: r.a for r in cut.collect()}
    assert got[1] == [(1, (4,)), (2, (None,))] and got[2] == [] and got[3] is None
    rest = project(df, exclude=["a.y", "a.o", "a.l.r"])
    assert rest.schema["a"].dataType.simpleString() == "array<struct<x:int,l:array<struct<s:int>>>>"
    got = {r.id: r.a for r in rest.collect()}
    assert got[1] == [(1, [(6,), (8,)]), (2, None)] and got[3] is None


def test_projection_prunes_the_scan(spark, tmp_path, animals):
    animals.write.parquet(str(tmp_path / "a"))
    df = spark.read.parquet(str(tmp_path / "a"))
    plan = plan_of(find(df, Doc(df)["isDog"].eq(True), include=["name", "loc.lat"]).drop("_routing"))
    assert "ReadSchema: struct<name:string,isDog:boolean,loc:struct<lat:double>>" in plan


def test_geohash_column(spark):
    from docspark.functions.geo import geohash
    points = spark.createDataFrame([(-5.603, 42.605), (10.40744, 57.64911), (180.0, 90.0)], "lon double, lat double")
    hashes = [r[0] for r in points.select(geohash(F.col("lon"), F.col("lat"), 5)).collect()]
    assert hashes == ["ezs42", "u4pru", "zzzzz"]


@pytest.fixture(scope="module")
def mixed(spark, tmp_path_factory):
    rnd = random.Random(8)
    rows = [(i, rnd.choice([None, "a", "b", "c"]), rnd.choice([None, *range(6)]), (rnd.choice([None, 1.5, 2.5]),),
             [rnd.choice([None, 1, 2, 3]) for _ in range(rnd.randint(0, 3))] if rnd.random() < 0.9 else None) for i in range(250)]
    df = spark.createDataFrame(rows, "id int, s string, n int, o struct<d: double>, many array<int>")
    path = str(tmp_path_factory.mktemp("mixed"))
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("sort", [
    {"s": 1, "n": -1, "id": 1}, {"n": -1, "s": -1, "id": -1}, {"o.d": 1, "s": -1, "id": 1}, {"many": 1, "id": -1}, {"many": -1, "id": 1}, {"id": -1},
])
def test_pages_joined_are_the_whole_sort(mixed, sort):
    whole = [r.id for r in find(mixed, sort=sort).collect()]
    for size in (1000, 83, 50):
        got = list(pages(mixed, sort=sort, size=size))
        assert [r.id for page in got for r in page] == whole and all(0 < len(page) <= size for page in got)


def test_a_page_behind_a_row_is_a_filter_of_the_scan(mixed):
    doc = Doc(mixed)
    page = find(mixed, doc["n"].range(gte=2), sort={"s": 1, "id": -1}, after={"s": "b", "id": 100}, limit=10, with_total=True)
    plan = plan_of(page)
    assert "Or(GreaterThanOrEqual(s,b),IsNull(s))" in plan
    assert "TakeOrderedAndProject" in plan and "Offset" not in plan
    assert {r._total for r in page.collect()} == {mixed.where("n >= 2").count()}
    assert find(mixed, sort={"s": 1, "id": 1}, after={"s": None, "id": 10**6}).count() == 0
    assert "IsNull(s)" in plan_of(find(mixed, sort={"s": -1, "id": 1}, after={"s": None, "id": 3}, limit=2))
    with pytest.raises(ValueError, match="no value of id"):
        find(mixed, sort={"s": 1, "id": 1}, after={"s": "b"})
    with pytest.raises(ValueError, match="sort by paths"):
        find(mixed, after={"s": "b"})
    assert list(pages(mixed.where("false"), sort={"id": 1})) == []
