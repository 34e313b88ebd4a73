import pytest
from pyspark.sql import functions as F

from conftest import animal_model, plan_of, rows_scanned
from docspark import (
    Collection, Doc, by_field, catalog_indexes, delete, delete_keys, field, find, first_match, glob_filter, object_of,
    map_of, read_indexes, unmatched_keys, update,
    upsert, DocModel,
)
from docspark.model import STAGES
from docspark.operators.aggregate import Spec
from docspark.operators.mutate import latest
from docspark.settings import shared_dir


@pytest.fixture
def store(spark):
    return Collection(spark, shared_dir(spark), animal_model(), buckets=4, slices=3)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


DOGS = [("charles", True, "Charles"), ("baloo", True, "Baloo"), ("ein", False, "Ein")]


@pytest.fixture
def dogs(spark):
    return spark.createDataFrame(DOGS, "animalId string, isDog boolean, name string")


def test_empty(store):
    assert store.read().collect() == [] and store.delete() == 0 and store.update(None, set={"name": "x"}) == 0


def test_insert_and_upsert(spark, store, dogs):
    assert store.insert(dogs) == 3
    assert rows(store.read(), "_id", "_routing", "_index", "name") == [
        ("baloo", "baloo", "animals", "Baloo"), ("charles", "charles", "animals", "Charles"),
        ("ein", "ein", "animals", "Ein")]
    changed = spark.createDataFrame(
        [("ein", "old", 1), ("ein", "new", 3), ("ein", "mid", 2), ("spike", "Spike", 1)],
        "animalId string, name string, _seq int")
    for _ in range(2):  # a replay changes nothing
        assert store.upsert(changed) == 2
        assert rows(store.read(), "_id", "name", "isDog") == [
            ("baloo", "Baloo", True), ("charles", "Charles", True), ("ein", "new", None), ("spike", "Spike", None)]
    assert store.upsert(changed.limit(0)) == 0
    with pytest.raises(Exception, match="a document has no id"):
        store.upsert(spark.createDataFrame([(None, "x")], "animalId string, name string"))


def test_append_then_rewrite(store, dogs):
    store.append(dogs.where("isDog"))
    store.append(dogs.where("NOT isDog"))
    assert store.read().count() == 3
    store.upsert(dogs.withColumn("name", F.upper("name")))
    assert rows(store.read(), "name") == [("BALOO",), ("CHARLES",), ("EIN",)]


def test_routing(store, animals):
    store.insert(animals)
    assert rows(store.read(routing="Ein"), "name") == [("Ein",)]
    assert rows(store.read(ids=["data-dog-ein", "opes-farm-dog-baloo"]), "name") == [("Baloo",), ("Ein",)]
    assert len(store.read(routing="Ein").inputFiles()) <= 3 < 4 * 3
    assert store.update(None, set={"updatable": "yes"}, routing="Ein") == 1
    assert store.delete(None, routing="Baloo") == 1
    assert rows(store.read(), "name", "updatable") == [("Charles Barkley", None), ("Ein", "yes")]


def test_key_move(spark, store, dogs):
    store.insert(dogs)
    moved = spark.createDataFrame([("ein-2", "Ein", "ein"), ("baloo", "Baloo II", None)],
                                  "animalId string, name string, _old_id string")
    moved = moved.withColumn("_old_routing", F.col("_old_id"))
    store.upsert(moved)
    assert rows(store.read(), "_id", "name") == [("baloo", "Baloo II"), ("charles", "Charles"), ("ein-2", "Ein")]


def test_route_move(spark, store, dogs):
    store.insert(dogs, routing="A")
    move = dogs.where("animalId = 'ein'").withColumns({"_old_routing": F.lit("A")})
    store.upsert(move, routing="B")
    assert rows(store.read(), "_id", "_routing") == [("baloo", "A"), ("charles", "A"), ("ein", "B")]


def test_update_and_delete(store, dogs):
    store.insert(dogs)
    d = Doc(dogs)
    assert store.update(d["isDog"].eq(True), set={"updatable": "whoa", "age": F.length("name")}) == 2
    assert rows(store.read(), "_id", "updatable", "age") == [
        ("baloo", "whoa", 5.0), ("charles", "whoa", 7.0), ("ein", None, None)]
    assert store.update(d["name"].eq("nobody"), set={"name": "x"}) == 0
    assert store.delete(d["isDog"].eq(True)) == 2
    assert rows(store.read(), "_id") == [("ein",)]
    assert store.delete() == 1 and store.read().count() == 0
    store.insert(dogs)
    assert store.read().count() == 3


def test_delete_keys(spark, store, dogs):
    store.insert(dogs)
    gone = spark.createDataFrame([("ein",), ("ein",), ("nobody",)], "_id string")
    removed, missing = store.delete_keys(gone)
    assert removed == 1 and rows(missing, "_id") == [("nobody",)]
    assert rows(store.read(), "_id") == [("baloo",), ("charles",)]
    assert store.delete_keys(gone)[0] == 0


def test_a_change_writes_its_own_documents_only(spark, store):
    many = spark.range(200).select(F.col("id").cast("string").alias("animalId"), F.lit(True).alias("isDog"))
    store.append(many)
    before = set(store.read().inputFiles())
    assert store.upsert(many.limit(1).withColumn("name", F.lit("x"))) == 1
    assert store.update(store.doc["animalId"].eq("7"), set={"name": "y"}) == 1
    assert store.delete(store.doc["animalId"].eq("9")) == 1
    after = set(store.read().inputFiles())
    assert before < after and len(after - before) == 3 and store.read().count() == 199
    stored = spark.read.parquet(f"{store.path}/changes")
    assert sorted((r._version, r._id, r._deleted) for r in stored.collect()) == [(1, "0", False), (2, "7", False), (3, "9", True)]


def test_a_batch_is_computed_once_and_nothing_stored_is_read(spark, store, dogs):
    store.append(dogs)
    evaluated = spark.sparkContext.accumulator(0)

    def seen(parts):
        for part in parts:
            evaluated.add(part.num_rows)
            yield part

    batch = dogs.mapInArrow(seen, dogs.schema)
    assert store.upsert(batch.withColumn("_old_id", F.lit("nobody"))) == 3
    assert evaluated.value == 3


def test_compact(spark, store, dogs):
    assert store.compact() == 0
    store.append(dogs)
    store.append(spark.range(100).select(F.concat(F.lit("n"), "id").alias("animalId"), F.lit("n").alias("name")))
    store.upsert(spark.createDataFrame([("ein", "Ein II"), ("spike", "Spike")], "animalId string, name string"))
    store.update(store.doc["animalId"].eq("n3"), set={"name": "three"})
    store.delete(store.doc["animalId"].isin(["baloo", "n4"]))
    before, files = rows(store.read(), "_id", "name", "isDog"), set(store.read().inputFiles())
    assert store.compact() == 3 and store.last_version() == 0
    assert rows(store.read(), "_id", "name", "isDog") == before and len(before) == 102
    assert not any("changes" in f for f in store.read().inputFiles())
    assert files & set(store.read().inputFiles())  # cells without changes stay
    assert "Join" not in plan_of(store.read()) and store.compact() == 0
    store.delete()
    assert store.read().count() == 0
    store.compact()
    assert store.read().count() == 0  # cells that are emptied are replaced as well
    store.upsert(dogs)
    assert store.read().count() == 3


def test_a_broken_off_compaction_changes_nothing(spark, store, dogs, monkeypatch):
    from docspark.sources import collection

    store.append(dogs)
    store.update(None, set={"name": "x"})
    store.delete(store.doc["animalId"].eq("ein"))
    before, deleted = rows(store.read(), "_id", "name"), []
    monkeypatch.setattr(collection, "_delete", lambda spark, folder: deleted.append(folder))
    store.compact()
    assert rows(store.read(), "_id", "name") == before
    assert [f.rsplit("=")[-1] for f in deleted[:2]] == ["1", "2"]  # the oldest first


def test_routes_and_ids_are_partition_filters(spark):
    store = Collection(spark, shared_dir(spark), animal_model(), buckets=8, slices=8)
    docs = spark.range(2000).select(F.format_string("%05d", F.col("id") * 2).alias("animalId"),
                                    (F.col("id") % 50).cast("string").alias("_routing"))
    store.append(docs)
    store.update(store.doc["animalId"].eq("00006"), set={"name": "x"})
    routed = store.read(routing="3")
    assert routed.count() == 40 and {r._routing for r in routed.collect()} == {"3"}
    plan = plan_of(routed)
    filters = [line for line in plan.split("\n") if "PartitionFilters" in line]
    assert len(filters) >= 2 and all("(_bucket" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in filters)
    assert "xxhash64" not in plan.split("PartitionFilters")[1].split("PushedFilters")[0]  # the bucket is a literal

    store.compact()
    assert rows_scanned(store.read(ids=["00006"])) > 0
    missing = store.read(ids=["00007"])  # between the least and the greatest id of its files
    assert "_slice" in plan_of(missing).split("PartitionFilters")[1] and rows_scanned(missing) == 0


def test_two_changes_at_one_time_keep_all_documents(spark, store, dogs, monkeypatch):
    store.append(dogs)
    other = Collection(spark, store.path, store.model, buckets=4, slices=3)
    for writer, name in ((store, "ein"), (other, "baloo")):  # both have found no version yet
        monkeypatch.setattr(writer, "last_version", lambda source=None: 0)
        writer.upsert(dogs.where(f"animalId = '{name}'").withColumn("name", F.lit("new")))
    assert rows(store.read(), "_id", "name") == [("baloo", "new"), ("charles", "Charles"), ("ein", "new")]


def test_failed_write_changes_nothing(store, dogs):
    store.insert(dogs)
    boom = F.raise_error(F.lit("boom")).cast("string")
    with pytest.raises(Exception, match="boom"):
        store.update(Doc(dogs)["isDog"].eq(True), set={"name": boom})
    assert rows(store.read(), "name") == [("Baloo",), ("Charles",), ("Ein",)]
    assert store.update(Doc(dogs)["isDog"].eq(True), set={"name": "ok"}) == 2


def test_another_layout_is_refused(spark, store, dogs):
    store.insert(dogs)
    with pytest.raises(ValueError, match="written as 4x3"):
        Collection(spark, store.path, store.model, buckets=8, slices=3).read()


def test_hot_route_is_spread_over_slices(spark):
    store = Collection(spark, shared_dir(spark), animal_model(), buckets=4, slices=8)
    store.insert(spark.range(400).select(F.col("id").cast("string").alias("animalId")), routing="hot")
    assert len(store.read(routing="hot").inputFiles()) == 8 and store.read(routing="hot").count() == 400


def test_search_columns(spark, dogs):
    store = Collection(spark, shared_dir(spark), animal_model().add_index("name", "english", "kw"))
    store.insert(dogs)
    view = store.search()
    assert rows(find(view, Doc(view)["name__kw"].text("CHARLES")), "_id") == [("charles",)]


def test_changes_by_search_columns(spark, dogs):
    store = Collection(spark, shared_dir(spark), animal_model().add_index("name", "english", "kw"))
    store.insert(dogs)
    doc = store.doc
    assert store.update(doc["name__kw"].text("charles"), set={"updatable": "u"}) == 1
    assert store.delete(doc["name__kw"].text("ein")) == 1
    assert rows(store.read(), "_id", "updatable") == [("baloo", None), ("charles", "u")]


def test_stored_search_columns(spark, dogs):
    def store_at(path):
        model = animal_model(all_text=True).add_index("name", "english", "kw")
        return Collection(spark, path, model, buckets=2, slices=1, store_search=True)

    store = store_at(shared_dir(spark))
    store.append(dogs.where("isDog"))
    store.upsert(dogs.withColumn("name", F.concat("name", F.lit(" barking"))).where("NOT isDog"))
    doc = store.doc
    found = store.find(doc["name__kw"].text("barks"))
    assert rows(found, "_id") == [("ein",)] and "name__kw" not in found.columns
    plan = plan_of(found.select("_id"))
    assert "name__kw" in plan.split("ReadSchema")[1] and "split(" not in plan  # read, not analysed again
    store.update(doc["name"].eq("Baloo"), set={"name": "Barks"})
    store.delete(doc["_all"].text("charles"))
    store = store_at(store.path)
    assert rows(store.find(doc["name__kw"].text("bark")), "_id", "name") == [
        ("baloo", "Barks"), ("ein", "Ein barking")]
    assert store.read().columns == store.schema.names
    assert store.delete_keys(spark.createDataFrame([("ein",)], "_id string"))[0] == 1
    assert rows(store.search(), "_id", "name__kw") == [("baloo", ["bark"])]
    with pytest.raises(ValueError, match="written as"):
        Collection(spark, store.path, store.model, buckets=2, slices=1).read()


def test_remove_hooks_see_the_documents(spark, dogs):
    seen = []
    model = animal_model()
    for stage in ("pre-remove", "post-remove"):
        model.on(stage, lambda df, s=stage: (seen.append((s, rows(df, "_id"))), df)[1])
    store = Collection(spark, shared_dir(spark), model)
    store.insert(dogs)
    store.delete(store.doc["isDog"].eq(False))
    assert seen == [("pre-remove", [("ein",)]), ("post-remove", [("ein",)])]


def test_open_and_map_fields(spark):
    model = DocModel("Open", object_of(
        field("id", id=True), field("m", "mixed"), field("p", map_of("integer")), field("at", "geopoint", index=True)))
    store = Collection(spark, shared_dir(spark), model, buckets=2)
    batch = spark.createDataFrame(
        [("a", '{"x": 1}', {"k": "1"}, [1.0, 2.0], 1), ("a", '{"x": [2, 3]}', {"k": "2"}, None, 2),
         ("b", None, None, [3.0, 4.0], 1)],
        "id string, m string, p map<string,string>, at array<double>, _seq int")
    for _ in range(2):
        assert store.upsert(batch) == 2
    doc = store.doc
    assert rows(store.find(doc["p.k"].eq(2)), "_id") == [("a",)]
    assert rows(store.find(doc["m.x[1]"].eq(3)), "_id") == [("a",)]
    assert rows(store.find(doc["at"].near(3, 4, 10)), "_id") == [("b",)]


def test_find_count_aggregate(spark, animals):
    store = Collection(spark, shared_dir(spark), animal_model().add_index("name", "standard", "words"),
                       cluster_by=("loc", "name"))
    store.insert(animals)
    doc = store.doc
    page = store.find(doc["name__words"].text("charles"), sort={"name": 1}, include=["name", "loc.lat"])
    assert page.columns == ["name", "loc", "_id", "_parent", "_routing", "_index"]
    assert rows(page, "name") == [("Charles Barkley",)]
    assert store.count(doc["isDog"].eq(True)) == 2 and store.count(routing="Ein") == 1
    assert {r.k0: r.total for r in store.aggregate(by_field("isDog"), total=True).collect()} == {True: 2, False: 1}


def test_points_are_clustered_and_filters_reach_the_scan(spark):
    store = Collection(spark, shared_dir(spark), animal_model(), buckets=1, slices=1, cluster_by=("loc",))
    store.append(spark.range(2000).select(
        F.col("id").cast("string").alias("animalId"),
        F.array((F.rand(1) * 360 - 180), (F.rand(2) * 180 - 90)).alias("loc")))
    near = store.find(store.doc["loc"].near(10, 10, 100_000))
    assert "GreaterThanOrEqual(loc.lat" in plan_of(near) and "LessThanOrEqual(loc.lon" in plan_of(near)
    hashes = [r[0] for r in store.search().select("loc__geohash").collect()]
    assert hashes == sorted(hashes)


def test_dogs_with_default_values(spark):
    model = DocModel("D", object_of(field("id", id=True), field("n", "integer", default=7)))
    store = Collection(spark, shared_dir(spark), model)
    store.insert(spark.createDataFrame([("a", None), ("b", 3)], "id string, n int"))
    found = store.read()
    assert rows(find(found, Doc(found)["n"].eq(7)), "_id", "n") == [("a", None)]


# -- the operators without storage ------------------------------------------


def test_latest_is_deterministic(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, s int, v string")
    first = rows(latest(df, ["k"], ["s"]), "k", "v")
    assert all(rows(latest(df.repartition(n), ["k"], ["s"]), "k", "v") == first for n in (1, 2, 3))
    mapped = df.withColumn("m", F.create_map(F.lit("a"), "v"))
    assert latest(mapped, ["k"], ["s"]).count() == 2


def test_pure_upsert(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id int, v string, w int")
    batch = spark.createDataFrame([(2, "B", None), (3, "C", 1)], "id int, v string, was int")
    assert rows(upsert(old, batch, ["id"], old_keys={"id": "was"}), "id", "v", "w") == [
        (2, "B", None), (3, "C", None)]


def test_pure_update(spark):
    df = spark.createDataFrame([(1, ("p", 1), None), (2, ("q", 2), 5)], "id int, o struct<s: string, n: int>, v int")
    d = Doc(df)
    got = update(df, d["v"].range(gt=1), set={"o.n": "9", "v": F.col("v") + F.col("id")}, unset=["o.s"])
    assert rows(got, "id", "o", "v") == [(1, ("p", 1), None), (2, (None, 9), 7)]
    assert rows(update(df, None, set={"v": 1, "id": 0}, skip=("id",)), "id", "v") == [(1, 1), (2, 1)]
    assert rows(update(df, d["id"].eq(2), replace={"v": 8}, keys=("id",)), "id", "o", "v") == [
        (1, ("p", 1), None), (2, None, 8)]
    with pytest.raises(ValueError, match="could not find field"):
        update(df, None, set={"nothing": 1})
    with pytest.raises(ValueError, match="either"):
        update(df, None)


def test_pure_delete(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    assert rows(delete(df, Doc(df)["v"].range(gt=1)), "id") == [(1,)]
    gone = spark.createDataFrame([(2,), (9,), (9,)], "id int")
    assert rows(delete_keys(df, gone, ["id"]), "id") == [(1,)]
    assert rows(unmatched_keys(df, gone, ["id"]), "id") == [(9,)]


# -- indexes ------------------------------------------------------------------


def test_globs():
    names = ["foo1", "xfoo", "bar", "foo", "b[r"]
    assert glob_filter("foo*", names) == ["foo1", "foo"]
    assert glob_filter("bar,foo", names) == ["bar", "foo"]
    assert glob_filter("b[r", names) == ["b[r"]
    configs = {"test_*": {"buckets": 16}, "test_x": {"buckets": 5}}
    assert first_match(configs, "test_x") == {"buckets": 16}
    with pytest.raises(ValueError, match="no matching index settings"):
        first_match(configs, "other")


def test_union_of_indexes(spark, dogs):
    calls = []
    indexes = {"a1": dogs, "a2": dogs.drop("name"), "b": lambda: calls.append(1)}
    union = read_indexes(indexes, "a*")
    assert rows(union.where("animalId = 'ein'"), "_index", "name") == [("a1", "Ein"), ("a2", None)]
    assert not calls
    with pytest.raises(ValueError, match="no index matches"):
        read_indexes(indexes, "zzz")


def test_catalog_indexes(spark, dogs):
    dogs.createOrReplaceTempView("animals_view")
    dogs.createOrReplaceTempView("other_view")
    assert read_indexes(catalog_indexes(spark), "animals_*").count() == 3


def _staged_model(seen):
    model = DocModel("T", object_of(field("id", id=True), field("kind", enum=["a", "b"])))
    for stage in STAGES:
        model.on(stage, lambda df, stage=stage: (seen.append(stage), df)[1])
    return model


def test_every_write_runs_its_hooks(spark):
    seen = []
    store = Collection(spark, shared_dir(spark), _staged_model(seen), buckets=2, slices=1)
    docs = spark.createDataFrame([("x", "a"), ("y", "b")], "id string, kind string")
    saved = ["post-init", "pre-normalize", "post-normalize", "pre-save", "post-save"]

    def ran(write):
        seen.clear()
        write()
        return list(seen)

    assert ran(lambda: store.append(docs)) == saved
    assert ran(lambda: store.upsert(docs)) == saved
    assert ran(lambda: store.update(store.doc["id"].eq("x"), set={"kind": "b"})) == saved
    assert ran(lambda: store.delete_keys(spark.createDataFrame([("x",)], "_id string"))) == ["pre-remove", "post-remove"]
    assert ran(lambda: store.delete(store.doc["id"].eq("y"))) == ["pre-remove", "post-remove"]
    assert store.read().count() == 0


def test_update_saves_through_the_model(spark):
    model = DocModel("T", object_of(field("id", id=True), field("kind", enum=["a", "b"])))
    store = Collection(spark, shared_dir(spark), model, buckets=4, slices=2)
    store.append(spark.createDataFrame([("x", "a"), ("y", "b")], "id string, kind string"))
    with pytest.raises(Exception, match="invalid value of kind"):
        store.update(store.doc["id"].eq("x"), set={"kind": "bogus"})
    store.update(store.doc["id"].eq("x"), set={"id": "z"})
    assert [(r._id, r.id, r._routing) for r in store.read(ids=["z"]).collect()] == [("z", "z", "z")]
    store.upsert(spark.createDataFrame([("z", "b")], "id string, kind string"))
    assert {(r._id, r.kind) for r in store.read().collect()} == {("z", "b"), ("y", "b")}
    assert {r.id for r in store.stream(store.doc["kind"].eq("b"))} == {"z", "y"}
    totals = store.aggregate_multi({"kinds": Spec([by_field("kind")], total=True)})
    assert [tuple(r) for r in totals["kinds"].collect()] == [("b", 2)]
