"""Queries over finding, projecting, storing and streaming documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from docspark.functions.geo import _BASE32, geohash
from docspark.model import DocModel, array_of, field, map_of, object_of
from docspark.operators import mutate
from docspark.operators.aggregate import by_field
from docspark.operators.find import count, find, pages as find_pages, project
from docspark.operators.predicates import Doc, none_of
from docspark.plans.registry import query, table
from docspark.settings import shared_dir
from docspark.sources.collection import Collection
from docspark.sources.indexes import folder_indexes, read_indexes
from docspark.streaming.upserts import upsert_stream
from docspark.streaming.windows import windowed_stats


def _event_model():
    return DocModel("Event", object_of(
        field("event_id", "long", id=True, key=True, index=True),
        field("user_id", "long", index=True),
        field("event_type", index=True),
        field("value", "double", index=True),
    ), index="events")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20 OFFSET 40""")
def find_page(spark, d):
    return find(table(spark, d, "orders"), sort={"o_totalprice": -1, "o_orderkey": 1}, skip=40, limit=20,
                include=["o_orderkey", "o_totalprice"])


@query("""
    SELECT o_orderkey, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS _total
    FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 5""")
def find_total(spark, d):
    orders = table(spark, d, "orders")
    return find(orders, Doc(orders)["o_orderstatus"].eq("F"), sort={"o_orderkey": 1}, limit=5,
                include=["o_orderkey"], with_total=True)


@query("""
    SELECT event_id, v FROM (SELECT event_id, CASE WHEN value >= 50 THEN value END AS v FROM events)
    ORDER BY v ASC NULLS LAST, event_id DESC LIMIT 50""")
def find_missing_last(spark, d):
    events = table(spark, d, "events").select("event_id", F.when(F.col("value") >= 50, F.col("value")).alias("v"))
    return find(events, sort={"v": 1, "event_id": -1}, limit=50)


@query("SELECT event_id, user_id FROM events WHERE event_type = 'signup' AND value > 100")
def find_all(spark, d):
    events = table(spark, d, "events")
    doc = Doc(events)
    return find(events, doc["event_type"].eq("signup") & doc["value"].range(gt=100), include=["event_id", "user_id"])


@query("SELECT count(*) AS n FROM events WHERE event_type = 'click'")
def count_match(spark, d):
    events = table(spark, d, "events")
    return count(events, Doc(events)["event_type"].eq("click"))


@query("SELECT * EXCLUDE (html) FROM pages")
def exclude_fields(spark, d):
    return project(table(spark, d, "pages"), exclude=["html"])


@query("SELECT c_custkey, c_name AS name, c_nationkey AS nation FROM customer")
def nested_fields(spark, d):
    customers = table(spark, d, "customer").select(
        "c_custkey",
        F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("profile"),
        F.array(F.struct(F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation"))).alias("accounts"),
    )
    kept = project(customers, include=["c_custkey", "profile.name", "accounts"], exclude=["accounts.balance"])
    return kept.select("c_custkey", "profile.*", F.inline("accounts"))


@query("""
    SELECT 'customer' AS _index, c_nationkey AS nationkey, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 'supplier' AS _index, s_nationkey AS nationkey, NULL AS segment FROM supplier""")
def index_glob(spark, d):
    indexes = {
        "customer": lambda: table(spark, d, "customer").select(
            F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment")),
        "supplier": lambda: table(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey")),
        "part": lambda: table(spark, d, "part"),
    }
    return read_indexes(indexes, "cust*,supplier")


@query("""
    SELECT 'nation' AS _index, * FROM nation UNION ALL BY NAME SELECT 'region' AS _index, * FROM region""")
def index_folder(spark, d):
    return read_indexes(folder_indexes(spark, d), "nation,reg*")


@query("""
    SELECT CAST(event_id AS BIGINT) AS event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           CAST(value AS BIGINT) AS whole FROM
        (SELECT event_id, props, trunc(value) AS value FROM events)""")
def cast_fields(spark, d):
    model = DocModel("Raw", object_of(
        field("event_id", "long", id=True), field("props", map_of("long")), field("whole", "long")))
    raw = table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.from_json("props", "map<string,string>").alias("props"),
        F.col("value").alias("whole"),
    )
    return model.cast(raw).select("event_id", F.col("props")["k"].alias("k"), "whole")


def _both_sides(model: DocModel, raw, id: str):
    """The id of every row, and whether the row fits the model."""
    good, bad = model.split_castable(raw)
    return good.select(id, F.lit(True).alias("fits")).union(bad.select(id, F.lit(False)))


@query("""
    SELECT event_id, try_cast(mark AS DOUBLE) IS NOT NULL AS fits FROM (
        SELECT event_id, CASE event_type WHEN 'error' THEN event_type || value ELSE CAST(value AS VARCHAR) END AS mark
        FROM events WHERE value IS NOT NULL)""")
def rejected_rows(spark, d):
    model = DocModel("Raw", object_of(field("event_id", "long", id=True), field("mark", "double")))
    value = F.col("value").cast("string")
    mark = F.when(F.col("event_type") == "error", F.concat("event_type", value)).otherwise(value)
    raw = table(spark, d, "events").where("value IS NOT NULL").select("event_id", mark.alias("mark"))
    return _both_sides(model, raw, "event_id")


@query("""
    SELECT c_custkey, c_custkey * 37 % 400 - 200 BETWEEN -180 AND 180 AND c_custkey * 17 % 200 - 100 BETWEEN -90 AND 90
               AND c_custkey % 3 < 2 AS fits FROM customer""")
def bad_points(spark, d):
    """Points that are off the globe or have three parts are rejected."""
    model = DocModel("Place", object_of(field("c_custkey", "long", id=True), field("at", "geopoint")))
    lon, lat = F.col("c_custkey") * 37 % 400 - 200, F.col("c_custkey") * 17 % 200 - 100
    at = F.when(F.col("c_custkey") % 3 < 2, F.array(lon, lat)).otherwise(F.array(lon, lat, lat))
    return _both_sides(model, table(spark, d, "customer").select("c_custkey", at.alias("at")), "c_custkey")


@query("SELECT p_partkey, p_partkey || ' ' || p_name || ' x' AS words FROM part WHERE p_name IS NOT NULL")
def all_text_arrays(spark, d):
    model = DocModel("Part", object_of(field("p_partkey", "long", id=True), field("names", array_of("string"))), all_text=True)
    names = F.array(F.col("p_name"), F.lit(None).cast("string"), F.lit("x")).alias("names")
    parts = table(spark, d, "part").where("p_name IS NOT NULL").select("p_partkey", names)
    return model.searchable(parts).select("p_partkey", F.col("_all").alias("words"))


@query("SELECT event_id FROM events WHERE value IS NULL OR value < 50")
def default_array(spark, d):
    """Null elements read as the field's default."""
    model = DocModel("Event", object_of(field("event_id", "long", id=True), field("vs", array_of("double"), default=9.0)))
    large = F.when(F.col("value") >= 50, F.col("value"))
    events = table(spark, d, "events").select("event_id", F.array(large, F.lit(2.0)).alias("vs"))
    return find(events, model.doc(events)["vs"].eq(9.0), include=["event_id"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey OFFSET 500")
def find_skip(spark, d):
    return find(table(spark, d, "orders"), sort={"o_totalprice": -1, "o_orderkey": 1}, skip=500,
                include=["o_orderkey", "o_totalprice"])


@query(r"""
    SELECT p_partkey, array_to_string(list_sort(list_filter(
               string_split_regex(lower(p_name), '[^\p{L}\p{N}]+'), lambda t: t <> '')), ' ') AS words
    FROM part WHERE list_contains(string_split_regex(lower(p_name), '[^\p{L}\p{N}]+'), 'widget')""")
def multi_field(spark, d):
    model = DocModel("Part", object_of(
        field("p_partkey", "long", id=True), field("p_name", index=True))).add_index("p_name", "standard", "words")
    parts = model.searchable(table(spark, d, "part"))
    found = find(parts, Doc(parts)["p_name__words"].text("Widget"))
    return found.select("p_partkey", F.array_join(F.array_sort("p_name__words"), " ").alias("words"))


@query("""
    SELECT DISTINCT c_mktsegment, c_nationkey, max(c_custkey) AS c_custkey FROM customer GROUP BY 1, 2""")
def keyed_latest(spark, d):
    """The newest document per value of the model's key fields."""
    model = DocModel("Segment", object_of(
        field("c_custkey", "long", id=True),
        field("c_mktsegment", key=True),
        field("c_nationkey", "integer", key=True),
    ))
    customers = table(spark, d, "customer").select("c_custkey", *model.get_keys())
    return mutate.latest(customers, model.get_keys(), order_by=["c_custkey"])


def _geohash_sql(lon: str, lat: str, precision: int) -> str:
    """Geohash in SQL, built from the rule: interleaved bits, five per character."""
    lon_bits, lat_bits = (5 * precision + 1) // 2, 5 * precision // 2
    x = f"least(floor(({lon} + 180) / 360 * {2**lon_bits})::BIGINT, {2**lon_bits - 1})"
    y = f"least(floor(({lat} + 90) / 180 * {2**lat_bits})::BIGINT, {2**lat_bits - 1})"
    chars = []
    for i in range(precision):
        bits = []
        for j in range(5 * i, 5 * i + 5):
            source, top = (x, lon_bits) if j % 2 == 0 else (y, lat_bits)
            bits.append(f"(({source} >> {top - 1 - j // 2}) & 1) * {2 ** (4 - j + 5 * i)}")
        chars.append(f"substr('{_BASE32}', ({' + '.join(bits)} + 1)::INTEGER, 1)")
    return " || ".join(chars)


@query(f"""
    SELECT k0, count(*) AS total FROM (SELECT {_geohash_sql('lon', 'lat', 3)} AS k0 FROM (
        SELECT (c_custkey*37 % 36000)/100.0 - 180 AS lon, (c_custkey*17 % 18000)/100.0 - 90 AS lat
        FROM customer)) GROUP BY 1""")
def geohash_cells(spark, d):
    lon = (F.col("c_custkey") * 37 % 36000).cast("double") / 100 - 180
    lat = (F.col("c_custkey") * 17 % 18000).cast("double") / 100 - 90
    return table(spark, d, "customer").groupBy(geohash(lon, lat, 3).alias("k0")).agg(F.count(F.lit(1)).alias("total"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus
    FROM orders""")
def upsert_orders(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    stale = urgent.select("o_orderkey", F.lit("W").alias("o_orderstatus"), F.lit(1).alias("_seq"))
    newest = urgent.select("o_orderkey", F.lit("X").alias("o_orderstatus"), F.lit(2).alias("_seq"))
    return mutate.upsert(orders, stale.union(newest), ["o_orderkey"], order_by=["_seq"])


@query("""
    SELECT CASE WHEN s_acctbal < 0 THEN s_suppkey + 1000000 ELSE s_suppkey END AS s_suppkey, s_name FROM supplier""")
def key_move(spark, d):
    suppliers = table(spark, d, "supplier")
    moved = suppliers.where("s_acctbal < 0").selectExpr(
        "s_suppkey + 1000000 AS s_suppkey", "s_name", "s_suppkey AS _old_key")
    return mutate.upsert(suppliers.select("s_suppkey", "s_name"), moved, ["s_suppkey"],
                         old_keys={"s_suppkey": "_old_key"})


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'bad' ELSE event_type END AS event_type FROM events""")
def update_set(spark, d):
    events = table(spark, d, "events").select("event_id", "event_type")
    return mutate.update(events, Doc(events)["event_type"].eq("error"), set={"event_type": "bad"})


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'replaced' ELSE event_type END AS event_type,
           CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events""")
def update_replace(spark, d):
    events = table(spark, d, "events").select("event_id", "event_type", "value")
    return mutate.update(events, Doc(events)["event_type"].eq("error"),
                         replace={"event_type": "replaced"}, keys=("event_id",))


@query("""
    SELECT event_id FROM (SELECT event_id, CASE WHEN value >= 50 THEN value END AS v FROM events)
    WHERE NOT coalesce(v > 100, false)""")
def delete_match(spark, d):
    events = table(spark, d, "events").select("event_id", F.when(F.col("value") >= 50, F.col("value")).alias("v"))
    return mutate.delete(events, Doc(events)["v"].range(gt=100)).select("event_id")


@query("""
    SELECT o_orderkey FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def delete_by_key(spark, d):
    returned = table(spark, d, "lineitem").where("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    return mutate.delete_keys(table(spark, d, "orders").select("o_orderkey"), returned, ["o_orderkey"])


@query("""
    SELECT DISTINCT o_custkey AS c_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def unknown_keys(spark, d):
    wanted = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return mutate.unmatched_keys(table(spark, d, "customer").where("c_acctbal > 0"), wanted, ["c_custkey"])


@query("SELECT event_id, user_id FROM events WHERE user_id = 8")
def routing_prune(spark, d):
    events = Collection(spark, shared_dir(spark), _event_model())
    routed = table(spark, d, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("user_id").cast("string").alias("_routing"))
    events.append(routed)
    return events.read(routing="8").select("event_id", "user_id")


@query("""
    SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 'bad' ELSE event_type END AS event_type,
           CASE WHEN event_type = 'signup' THEN -1 ELSE value END AS value
    FROM events WHERE NOT (event_type = 'view' AND value > 100)""")
def stored_changes(spark, d):
    """Append, upsert, update and delete on a stored collection, then read it."""
    events = Collection(spark, shared_dir(spark), _event_model(), buckets=4, slices=2)
    source = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    doc = Doc(source)
    events.append(source)
    events.upsert(source.where(doc["event_type"].eq("signup")).withColumn("value", F.lit(-1.0)))
    events.update(doc["event_type"].eq("error"), set={"event_type": "bad"})
    events.delete(doc["event_type"].eq("view") & doc["value"].range(gt=100))
    return events.read().select(source.columns)


@query("""
    SELECT event_id, CAST(event_id AS VARCHAR) AS _id, event_type FROM (
        SELECT CASE event_type WHEN 'error' THEN event_id + 1000000000 ELSE event_id END AS event_id, event_type FROM events)""")
def update_moves_key(spark, d):
    """An update that changes ids stores the documents in their new places."""
    events = Collection(spark, shared_dir(spark), _event_model(), buckets=4, slices=2)
    events.append(table(spark, d, "events").select("event_id", "user_id", "event_type", "value"))
    events.update(events.doc["event_type"].eq("error"), set={"event_id": F.col("event_id") + 1000000000})
    return events.read().select("event_id", "_id", "event_type")


@query("""
    SELECT event_id, CASE event_type WHEN 'error' THEN 'fault' ELSE event_type END AS event_type, value + 1 AS value FROM events""")
def update_hooks(spark, d):
    """Hooks that alter documents run on appends and on updates."""
    model = _event_model().on("pre-normalize", lambda df: df.replace("bad", "fault", "event_type"))
    model.on("pre-save", lambda df: df.withColumn("value", F.when(F.col("event_type") == "fault", F.col("value"))
                                                  .otherwise(F.col("value") + 1)))
    events = Collection(spark, shared_dir(spark), model, buckets=2, slices=2)
    events.append(table(spark, d, "events").select("event_id", "user_id", "event_type", "value"))
    events.update(events.doc["event_type"].eq("error"), set={"event_type": "bad"})
    return events.read().select("event_id", "event_type", "value")


@query("""
    SELECT event_id, event_type FROM events WHERE event_type <> 'view' OR event_type IS NULL""")
def save_hooks(spark, d):
    """A pre-save hook that keeps documents from being stored."""
    model = _event_model().on("pre-save", lambda df: df.where(none_of(Doc(df)["event_type"].eq("view"))))
    events = Collection(spark, shared_dir(spark), model, buckets=2, slices=2)
    events.append(table(spark, d, "events").select("event_id", "user_id", "event_type", "value"))
    return events.read().select("event_id", "event_type")


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_upsert(spark, d):
    """A stream of documents saved twice over, batch by batch; replays change nothing."""
    source = table(spark, d, "events")
    target = Collection(spark, shared_dir(spark), _event_model(), buckets=4, slices=2)
    for _ in range(2):
        stream = spark.readStream.schema(source.schema).parquet(f"{d}/events.parquet*")
        docs = stream.select("event_id", "user_id", "event_type", "value")
        upsert_stream(docs, target, shared_dir(spark)).trigger(availableNow=True).start().awaitTermination()
    return target.read().select("event_id", "user_id", "event_type", "value")


@query("""
    SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events WHERE ts IS NOT NULL GROUP BY user_id""")
def stream_newest(spark, d):
    """The newest event of each user from a stream whose state is the newest row of each key; late ones lose."""
    source = table(spark, d, "events")
    model = DocModel("Last", object_of(field("user_id", "integer", id=True), field("event_id", "integer"), field("ts", "date")))
    target, checkpoint = Collection(spark, shared_dir(spark), model, buckets=4, slices=2), shared_dir(spark)
    for _ in range(2):  # the second run finds nothing new
        stream = spark.readStream.schema(source.schema).parquet(f"{d}/events.parquet*").where("ts IS NOT NULL")
        docs = stream.select("user_id", "event_id", "ts")
        upsert_stream(docs, target, checkpoint, order_by=["ts", "event_id"]).trigger(availableNow=True).start().awaitTermination()
    return target.read().select("user_id", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("""
    WITH w AS (SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS k0, event_type AS k1,
                      count(*) AS total, max(value) AS value_max FROM events GROUP BY 1, 2)
    SELECT k0, k1, total, value_max FROM w
    WHERE k0 + INTERVAL '6 hours' <= (SELECT max(ts) - INTERVAL '1 hour' FROM events)""")
def stream_windows(spark, d):
    """Statistics of the closed windows of a stream."""
    source = table(spark, d, "events")
    stream = spark.readStream.schema(source.schema).parquet(f"{d}/events.parquet*")
    stats = windowed_stats(stream, "ts", "PT6H", late="PT1H", by=[by_field("event_type")], stats={"value": ["max"]})
    out = shared_dir(spark)
    writer = stats.writeStream.outputMode("append").option("checkpointLocation", shared_dir(spark))
    writer.trigger(availableNow=True).format("parquet").option("path", out).start().awaitTermination()
    return spark.read.schema(stats.schema).parquet(out).withColumn("k0", F.col("k0").cast("timestamp_ntz"))


@query("""
    WITH w AS (SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS k0, o_orderstatus AS k1, count(*) AS total,
                      max(o_totalprice) AS o_totalprice_max FROM orders GROUP BY 1, 2)
    SELECT k0, k1, total, o_totalprice_max FROM w WHERE k0 < (SELECT max(k0) FROM w)""")
def stream_months(spark, d):
    """Statistics of the calendar months of a stream that are over; the newest month stays open."""
    source = table(spark, d, "orders")
    stream = spark.readStream.schema(source.schema).parquet(f"{d}/orders.parquet*")
    stats = windowed_stats(stream, "o_orderdate", ("month", 1), late="P3D", by=[by_field("o_orderstatus")],
                           stats={"o_totalprice": ["max"]})
    out = shared_dir(spark)
    writer = stats.writeStream.outputMode("append").option("checkpointLocation", shared_dir(spark))
    writer.trigger(availableNow=True).format("parquet").option("path", out).start().awaitTermination()
    return spark.read.schema(stats.schema).parquet(out).withColumn("k0", F.col("k0").cast("timestamp_ntz"))


@query("""
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    ORDER BY o_orderstatus DESC NULLS LAST, o_totalprice NULLS LAST, o_orderkey LIMIT 30 OFFSET 40""")
def find_after(spark, d):
    """The third page of twenty and half of the fourth, each from the last row of the one before."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    sort = {"o_orderstatus": -1, "o_totalprice": 1, "o_orderkey": 1}
    pages = find_pages(orders, sort=sort, size=20)
    after = [next(pages) for _ in range(2)][-1][-1]
    return find(orders, sort=sort, after=after, limit=30)


def _places(spark, d):
    """Pages as points spread over the globe by their ids."""
    lon, lat = ((F.col("page_id") * k % 10007) / 10007 * span - span / 2 for k, span in ((7919, 360), (5003, 180)))
    return table(spark, d, "pages").select("page_id", F.struct(lon.alias("lon"), lat.alias("lat")).alias("at"))


@query("""
    WITH p AS (SELECT page_id, (page_id * 7919 % 10007) / 10007 * 360 - 180 AS lon, (page_id * 5003 % 10007) / 10007 * 180 - 90 AS lat FROM pages)
    SELECT page_id FROM p WHERE 2 * 6371008.8 * asin(sqrt(least(1.0, power(sin(radians(lat - 72) / 2), 2)
        + cos(radians(72)) * cos(radians(lat)) * power(sin(radians(lon - 179) / 2), 2)))) <= 3000000""")
def near_cells(spark, d):
    """Points near one beside the 180th meridian, by ranges of their stored geohash."""
    path = shared_dir(spark)
    stored = _places(spark, d).withColumn("cell", geohash(F.col("at.lon"), F.col("at.lat")))
    stored.repartitionByRange("cell").sortWithinPartitions("cell").write.parquet(path)
    points = spark.read.parquet(path)
    return points.where(Doc(points)["at"].near(179, 72, 3_000_000, cells="cell")).select("page_id")
