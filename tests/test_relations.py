import pytest

from conftest import plan_of
from docspark import (
    Collection, Doc, DocModel, Spec, aggregate, aggregate_multi_long, by_field, count, delete, field, find,
    has_child, has_parent, none_of, object_of, update,
)
from docspark.settings import shared_dir


@pytest.fixture
def shelters(spark):
    return spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C"), ("d", None)], "_id string, name string")


@pytest.fixture
def sheltered(spark):
    rows = [("1", "a", 5), ("2", "a", 7), ("3", "a", 1), ("4", "b", 7), ("5", None, 7), ("6", "x", 7)]
    return spark.createDataFrame(rows, "animal string, _parent string, age int")


def ids(df, where, column="_id"):
    return "".join(sorted(r[0] for r in df.where(where).select(column).collect()))


def child(sheltered, **options):
    return has_child(sheltered, "_id", "_parent", **options)


def test_has_child(shelters, sheltered):
    old = Doc(sheltered)["age"].range(gte=5)
    assert ids(shelters, child(sheltered)) == "ab"
    assert ids(shelters, child(sheltered, where=Doc(sheltered)["age"].eq(5))) == "a"
    assert ids(shelters, none_of(child(sheltered))) == "cd"
    assert ids(shelters, child(sheltered, where=old) & Doc(shelters)["name"].eq("B")) == "b"
    assert ids(shelters, child(sheltered, where=old) | Doc(shelters)["name"].missing()) == "abd"


def test_child_counts(shelters, sheltered):
    assert ids(shelters, child(sheltered, min_children=2)) == "a"
    assert ids(shelters, child(sheltered, min_children="2", max_children=3)) == "a"
    assert ids(shelters, child(sheltered, max_children=2)) == "b"  # none at all is not a match
    assert ids(shelters, child(sheltered, min_children=0, max_children=2)) == "bcd"
    assert ids(shelters, child(sheltered, min_children=0, max_children=0)) == "cd"
    assert ids(shelters, child(sheltered, max_children=0)) == ""
    assert ids(shelters, child(sheltered, min_children=0)) == "abcd"
    assert ids(shelters, child(sheltered, min_children=1)) == "ab"


def test_bad_bounds(sheltered):
    with pytest.raises(ValueError, match="must not be greater"):
        child(sheltered, min_children=15, max_children=10)
    with pytest.raises(ValueError, match="must be a number"):
        child(sheltered, min_children="many")


@pytest.mark.parametrize("salt", [{}, {"salt": 5, "salt_by": "animal"}])
def test_has_parent(shelters, sheltered, salt):
    in_a = has_parent(shelters, "_parent", "_id", where=Doc(shelters)["name"].eq("A"), **salt)
    assert ids(sheltered, in_a, "animal") == "123"
    assert ids(sheltered, none_of(in_a), "animal") == "456"
    assert ids(sheltered, in_a | Doc(sheltered)["_parent"].missing(), "animal") == "1235"


def test_relative_of_a_relative(spark, shelters, sheltered):
    toys = spark.createDataFrame([("2",), ("4",)], "owner string")
    owners = has_child(toys, "animal", "owner") & Doc(sheltered)["age"].eq(7)
    assert ids(shelters, child(sheltered, where=owners)) == "ab"
    siblings = has_parent(shelters.where(child(sheltered, min_children=2)), "_parent", "_id")
    assert ids(sheltered, siblings, "animal") == "123"


def test_same_column_names_on_both_sides(spark):
    """Parents and children both have `_id` and `_parent`; the names do not mix."""
    parents = spark.createDataFrame([("a", "z"), ("b", "a"), ("c", None)], "_id string, _parent string")
    children = spark.createDataFrame([("a", "b"), ("c", "b"), ("9", "c")], "_id string, _parent string")
    assert ids(parents, has_child(children, "_id", "_parent")) == "bc"
    assert ids(parents, has_child(children, "_id", "_parent", min_children=2)) == "b"
    assert ids(parents, has_child(children, "_id", "_parent", max_children=1)) == "c"
    for salt in ({}, {"salt": 3, "salt_by": "_id"}):
        rooted = has_parent(parents, "_parent", "_id", where=Doc(parents)["_parent"].exists(), **salt)
        assert ids(children, rooted) == "ac"
        assert ids(children, rooted | Doc(children)["_id"].eq("9")) == "9ac"
        assert ids(parents, has_parent(parents, "_parent", "_id", **salt)) == "b"  # a table with itself


def test_relations_inside_other_operators(shelters, sheltered):
    page = find(shelters, child(sheltered), sort={"_id": -1}, limit=1, with_total=True).first()
    assert (page._id, page._total) == ("b", 2)
    assert count(shelters, none_of(child(sheltered))).first().n == 2
    assert aggregate(shelters, total=True, where=child(sheltered, min_children=2)).first().total == 1
    specs = {"n": Spec([by_field("name")], total=True), "all": Spec(total=True)}
    long = aggregate_multi_long(shelters, specs, where=child(sheltered) | Doc(shelters)["name"].missing())
    assert {(r["name"], r.k0): r.total for r in long.collect()} == {("n", "A"): 1, ("n", "B"): 1, ("all", None): 3}
    kept = delete(shelters, child(sheltered))
    assert sorted(r._id for r in kept.collect()) == ["c", "d"]
    changed = update(shelters, child(sheltered, min_children=2), set={"name": "many"})
    assert {r._id: r.name for r in changed.collect()} == {"a": "many", "b": "B", "c": "C", "d": None}


def test_relations_between_collections(spark, shelters, sheltered):
    model = DocModel("Shelter", object_of(field("shelterId", id=True), field("name")))
    homes = Collection(spark, shared_dir(spark), model, buckets=2, slices=1)
    homes.insert(shelters.withColumnRenamed("_id", "shelterId"))
    child_model = DocModel("Sheltered", object_of(field("animal", id=True), field("age", "integer")), parent="Shelter")
    store = Collection(spark, shared_dir(spark), child_model, buckets=2, slices=1)
    store.insert(sheltered)
    old = store.doc["age"].eq(7)
    found = homes.find(has_child(store.search(), "_id", "_parent", where=old))
    assert sorted(r._id for r in found.collect()) == ["a", "b"]
    assert homes.update(has_child(store.search(), "_id", "_parent", where=old), set={"name": "x"}) == 2
    assert homes.delete(none_of(has_child(store.search(), "_id", "_parent"))) == 2
    assert store.count(has_parent(homes.search(), "_parent", "_id", where=homes.doc["name"].eq("x"))) == 4


def test_plans(spark, shelters, sheltered):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(shelters.where(child(sheltered, min_children=2)))
        assert "LeftSemi" in plan and plan.count("Exchange") == 2  # the count's shuffle serves the join
        plan = plan_of(shelters.where(child(sheltered)))
        assert "LeftSemi" in plan and plan.count("Exchange") == 2
        assert plan.index("HashAggregate") < plan.rindex("HashAggregate")  # children are reduced first
        assert "LeftAnti" in plan_of(shelters.where(none_of(child(sheltered))))
        assert "LeftAnti" in plan_of(shelters.where(child(sheltered, min_children=0, max_children=2)))
        either = child(sheltered) | Doc(shelters)["name"].eq("B")
        assert "ExistenceJoin" in plan_of(shelters.where(either))
        salted = has_parent(shelters, "_parent", "_id", salt=4, salt_by="animal")
        plan = plan_of(sheltered.where(salted | Doc(sheltered)["age"].eq(1)))
        assert "ExistenceJoin" in plan and "pmod" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
