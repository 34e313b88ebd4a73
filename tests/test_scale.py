"""One key, route or batch id holding a third of all rows does not end up in one task."""

import pytest
from pyspark.sql import functions as F

from conftest import animal_model, plan_of
from docspark import Collection, Doc, aggregate, by_field, find, has_child, has_parent, upsert
from docspark.operators.mutate import unmatched_keys
from docspark.operators.relations import heavy_keys
from docspark.settings import shared_dir


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which a few thousand rows count as a skewed partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def skewed(spark):
    """60,000 children; parent 0 has a third of them."""
    fk = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500)
    return spark.range(0, 60000, numPartitions=8).select("id", fk.alias("fk"), F.rand(1).alias("v"))


def test_hot_parent_is_split(spark, small_partitions, skewed):
    parents = spark.range(500).withColumnRenamed("id", "pk").where("pk % 2 = 0")
    kept = skewed.where(has_parent(parents, "fk", "pk"))
    assert len(kept.collect()) == skewed.where("fk % 2 = 0").count()
    assert "skew=true" in plan_of(kept)


def test_salted_parent_spreads_the_hot_key(spark, small_partitions, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parents = spark.range(500).withColumnRenamed("id", "pk").where("pk % 2 = 0")
        both = has_parent(parents, "fk", "pk", salt=16, salt_by="id") | Doc(skewed)["v"].range(lt=0)
        kept = skewed.where(both)
        sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == skewed.where("fk % 2 = 0").count()
        assert max(sizes) < 60000 / 6
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_counted_heavy_parents_are_spread(spark, small_partitions, skewed):
    """Under `|`, and behind another relation, without a salt given."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parents = spark.range(500).withColumnRenamed("id", "pk").where("pk % 2 = 0")
        assert heavy_keys(skewed, "fk", 0.05) == [0] and heavy_keys(skewed.limit(0), "fk") == []
        expected = skewed.where("fk % 2 = 0").count()
        either = skewed.where(has_parent(parents, "fk", "pk", rows=skewed) | Doc(skewed)["v"].range(lt=0))
        before = skewed.where(has_child(spark.range(500).withColumnRenamed("id", "ck"), "fk", "ck"))
        behind = before.where(has_parent(parents, "fk", "pk", rows=before) | Doc(before)["v"].range(lt=0))
        plain = skewed.where(has_parent(parents, "fk", "pk") | Doc(skewed)["v"].range(lt=0))
        for kept, most in ((either, 60000 / 6), (behind, 60000 / 6)):
            sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == expected and max(sizes) < most
        assert max(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()) > 60000 / 4
        repeated = plan_of(either).count("explode")
        assert repeated >= 1 and none_left(either, skewed, parents)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def none_left(kept, rows, parents):
    lost = rows.join(parents, rows["fk"] == parents["pk"], "left_semi").select("id").exceptAll(kept.select("id"))
    return lost.count() == 0


def test_unmatched_keys_of_a_hot_key(spark, small_partitions, skewed):
    wanted = spark.range(400, 600).withColumnRenamed("id", "fk")
    missing = unmatched_keys(skewed, wanted, ["fk"])
    assert {r.fk for r in missing.collect()} == set(range(500, 600))
    plan = plan_of(missing).split("Initial Plan")[0]
    # plans print from the top: each side is made distinct in its tasks before it moves
    assert plan.count("SortMergeJoin") == 1 and plan.count("keys=[fk") >= 4


def test_skip_keeps_many_partitions(spark, small_partitions, skewed):
    rest = find(skewed, sort={"v": 1}, skip=20000)
    assert [r.v for r in rest.collect()] == sorted(r.v for r in skewed.collect())[20000:]
    sizes = [r["count"] for r in rest.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 2 and max(sizes) < 30000
    assert find(skewed, skip=70000).count() == 0


def test_upsert_of_a_hot_batch_key(spark, skewed):
    old = spark.range(1000).select("id", F.lit(0.0).alias("v"))
    batch = skewed.select(F.col("fk").alias("id"), "v", F.col("id").alias("_seq"))
    result = upsert(old, batch, ["id"], order_by=["_seq"])
    plan = plan_of(result)
    assert "partial_max_by" in plan and "Window" not in plan  # collapsed in every task first
    expected = {r.fk: r.v for r in skewed.groupBy("fk").agg(F.max_by("v", "id").alias("v")).collect()}
    assert {r.id: r.v for r in result.collect()} == {i: expected.get(i, 0.0) for i in range(1000)}


def test_hot_group_is_aggregated_before_the_shuffle(skewed):
    plan = plan_of(aggregate(skewed, by_field("fk"), stats={"v": ["avg"]}, total=True))
    assert plan.index("Exchange") < plan.index("partial_avg")  # plans print from the top


def test_large_cell_is_written_by_several_tasks(spark, small_partitions):
    store = Collection(spark, shared_dir(spark), animal_model(), buckets=4, slices=1)
    docs = spark.range(20000).select(
        F.col("id").cast("string").alias("animalId"),
        F.sha2(F.col("id").cast("string"), 256).alias("description"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("_routing"))
    store.append(docs)
    assert store.read().count() == 20000
    assert len(store.read(routing="hot").inputFiles()) > 1
