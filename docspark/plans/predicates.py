"""Queries over every predicate and relation."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from docspark.functions.dates import iso_utc
from docspark.model import all_text
from docspark.operators.aggregate import aggregate, by_field
from docspark.operators.find import find
from docspark.operators.predicates import Doc, all_of, any_of, match_all, none_of, register_operator
from docspark.operators.relations import has_child, has_parent
from docspark.plans.registry import query, table

# Points for tables without coordinates, the same arithmetic on both sides.
_POINT = """(c_custkey*37 % 36000)/100.0 - 180 AS lon, (c_custkey*17 % 18000)/100.0 - 90 AS lat"""


def _with_point(customers):
    lon = (F.col("c_custkey") * 37 % 36000).cast("double") / 100 - 180
    lat = (F.col("c_custkey") * 17 % 18000).cast("double") / 100 - 90
    return customers.withColumn("loc", F.struct(lon.alias("lon"), lat.alias("lat")))


def _lines(documents):
    """Documents with their text lines as an array of objects."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda t: F.struct(F.length(t).alias("size"), t.startswith("The").alias("the")),
    )
    return documents.select("doc_id", lines.alias("lines"))


@query("""
    SELECT c_nationkey AS k0, count(*) AS total, round(sum(c_acctbal), 2) AS c_acctbal_sum,
           max(c_acctbal) AS c_acctbal_max
    FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey IN (
        SELECT o_custkey FROM orders WHERE o_totalprice > 200000 GROUP BY 1 HAVING count(*) >= 3)
    GROUP BY 1""")
def flagship(spark, d):
    customers, orders = table(spark, d, "customer"), table(spark, d, "orders")
    large = Doc(orders)["o_totalprice"].range(gt=200000)
    groups = aggregate(
        customers,
        by=by_field("c_nationkey"),
        stats={"c_acctbal": ["sum", "max"]},
        total=True,
        where=Doc(customers)["c_mktsegment"].eq("BUILDING")
        & has_child(orders, "c_custkey", "o_custkey", where=large, min_children=3),
    )
    return groups.withColumn("c_acctbal_sum", F.round("c_acctbal_sum", 2))


@query("SELECT count(*) AS n FROM region")
def match_everything(spark, d):
    return table(spark, d, "region").where(match_all()).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id FROM events WHERE event_type = 'purchase'")
def exact_match(spark, d):
    events = table(spark, d, "events")
    return find(events, Doc(events)["event_type"].eq("purchase"), include=["event_id"])


@query("""
    SELECT c_custkey FROM customer
    WHERE c_acctbal > 0 AND (c_mktsegment = 'BUILDING' OR c_nationkey = 3) AND NOT (c_nationkey = 5)""")
def and_or_nor(spark, d):
    customers = table(spark, d, "customer")
    doc = Doc(customers)
    return customers.where(all_of(
        doc["c_acctbal"].range(gt=0),
        any_of(doc["c_mktsegment"].eq("BUILDING"), doc["c_nationkey"].eq(3)),
        none_of(doc["c_nationkey"].eq(5)),
    )).select("c_custkey")


@query("""
    SELECT c_custkey FROM customer
    WHERE (c_nationkey = 1 OR c_nationkey = 2) AND (c_mktsegment = 'BUILDING' OR c_acctbal < 0)""")
def or_sets(spark, d):
    customers = table(spark, d, "customer")
    doc = Doc(customers)
    return customers.where(
        any_of(doc["c_nationkey"].eq(1), doc["c_nationkey"].eq(2))
        & any_of(doc["c_mktsegment"].eq("BUILDING"), doc["c_acctbal"].range(lt=0))
    ).select("c_custkey")


@query("SELECT event_id FROM events WHERE NOT coalesce(value > 100 OR value < 10, false)")
def not_neither(spark, d):
    events = table(spark, d, "events")
    neither = Doc(events)["value"].none(lambda v: v.range(gt=100), lambda v: v.range(lt=10))
    return events.where(neither).select("event_id")


@query("""
    SELECT event_id FROM (SELECT event_id, nullif(event_type, 'view') AS t FROM events)
    WHERE t IS DISTINCT FROM 'click'""")
def ne_missing(spark, d):
    events = table(spark, d, "events").selectExpr("event_id", "nullif(event_type, 'view') AS t")
    return events.where(Doc(events)["t"].ne("click")).select("event_id")


@query("""
    SELECT c_custkey FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey NOT IN (1, 2, 3)""")
def in_nin(spark, d):
    customers = table(spark, d, "customer")
    doc = Doc(customers)
    return customers.where(
        doc["c_mktsegment"].isin(["BUILDING", "MACHINERY"]) & doc["c_nationkey"].nin([1, 2, 3])
    ).select("c_custkey")


@query("""
    SELECT page_id FROM (SELECT page_id, string_split(url, '/') AS parts FROM pages)
    WHERE list_contains(parts, 'en') AND list_has_all(parts, ['https:', 'en'])
      AND NOT list_has_any(parts, ['thther.example.org', 'www.thther.example.org'])""")
def array_any_all(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.split("url", "/").alias("parts"))
    parts = Doc(pages)["parts"]
    return pages.where(
        parts.eq("en") & parts.has_all(["https:", "en"])
        & parts.nin(["thther.example.org", "www.thther.example.org"])
    ).select("page_id")


@query("""
    SELECT vec_id FROM embeddings WHERE len(list_filter(embedding, lambda x: x >= 0.3 AND x < 0.35)) > 0""")
def array_range(spark, d):
    vectors = table(spark, d, "embeddings")
    return vectors.where(Doc(vectors)["embedding"].range(gte=0.3, lt=0.35)).select("vec_id")


@query("""
    SELECT (t IS NULL) AS missing, count(*) AS n
    FROM (SELECT nullif(event_type, 'view') AS t FROM events) GROUP BY 1""")
def exists_missing(spark, d):
    events = table(spark, d, "events").selectExpr("nullif(event_type, 'view') AS t")
    t = Doc(events)["t"]
    either = events.where(any_of(t.exists(), t.missing()))
    return either.groupBy(t.missing().alias("missing")).agg(F.count(F.lit(1)).alias("n"))


@query(r"""
    SELECT doc_id FROM documents
    WHERE list_has_all(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), ['the', 'of'])""")
def text_all(spark, d):
    documents = table(spark, d, "documents")
    return documents.where(Doc(documents)["text"].text("of THE")).select("doc_id")


@query(r"""
    SELECT p_partkey FROM part WHERE list_has_all(
        string_split_regex(lower(concat_ws(' ', p_name, p_brand, p_type)), '[^\p{L}\p{N}]+'),
        ['red', 'economy'])""", name="all_text")
def all_text_match(spark, d):
    parts = table(spark, d, "part").withColumn("_all", all_text(*map(F.col, ("p_name", "p_brand", "p_type"))))
    return parts.where(Doc(parts)["_all"].text("red economy")).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE p_name LIKE 'red%'")
def wildcard(spark, d):
    parts = table(spark, d, "part")
    return parts.where(Doc(parts)["p_name"].wildcard("red*")).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE p_name LIKE '%l%ring'")
def wildcard_inner(spark, d):
    parts = table(spark, d, "part")
    return parts.where(Doc(parts)["p_name"].wildcard("*l*ring")).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE regexp_full_match(p_brand, 'Brand#1[0-9]')")
def regex_full(spark, d):
    parts = table(spark, d, "part")
    return parts.where(Doc(parts)["p_brand"].regex("Brand#1[0-9]")).select("p_partkey")


@query("SELECT page_id FROM pages WHERE regexp_matches(url, 'ref=[a-z]+')")
def regex_part(spark, d):
    pages = table(spark, d, "pages")
    return pages.where(Doc(pages)["url"].regex("ref=[a-z]+", anchored=False)).select("page_id")


@query("""
    SELECT doc_id FROM documents WHERE len(list_filter(
        string_split(text, chr(10)), lambda t: len(t) > 200 AND starts_with(t, 'The'))) > 0""")
def elem_match(spark, d):
    documents = _lines(table(spark, d, "documents"))
    one_line = lambda e: e["size"].range(gt=200) & e["the"].eq(True)
    return documents.where(Doc(documents)["lines"].elem_match(one_line)).select("doc_id")


@query("""
    SELECT doc_id FROM (SELECT doc_id, string_split(text, chr(10)) AS ts FROM documents)
    WHERE len(list_filter(ts, lambda t: len(t) > 400)) > 0
      AND len(list_filter(ts, lambda t: starts_with(t, 'The'))) > 0""")
def nested_flat(spark, d):
    documents = _lines(table(spark, d, "documents"))
    doc = Doc(documents)
    return documents.where(doc["lines.size"].range(gt=400) & doc["lines.the"].eq(True)).select("doc_id")


@query(f"""
    SELECT c_custkey FROM (SELECT c_custkey, {_POINT} FROM customer)
    WHERE 2*6371008.8*asin(sqrt(pow(sin(radians(lat - 39)/2), 2)
          + cos(radians(39))*cos(radians(lat))*pow(sin(radians(lon - 84)/2), 2))) <= 3000000""")
def near(spark, d):
    customers = _with_point(table(spark, d, "customer"))
    return customers.where(Doc(customers)["loc"].near(84, 39, 3_000_000)).select("c_custkey")


@query(f"""
    SELECT c_custkey, round(dist, 3) AS meters FROM (
        SELECT c_custkey, 2*6371008.8*asin(sqrt(pow(sin(radians(lat - 70)/2), 2)
          + cos(radians(70))*cos(radians(lat))*pow(sin(radians(lon - 179)/2), 2))) AS dist
        FROM (SELECT c_custkey, {_POINT} FROM customer))
    WHERE dist <= 4000000 ORDER BY dist, c_custkey LIMIT 25""")
def near_sorted(spark, d):
    customers = _with_point(table(spark, d, "customer"))
    loc = Doc(customers)["loc"]
    nearest = find(customers, loc.near(179, 70, 4_000_000),
                   sort=[loc.distance_m(179, 70), F.col("c_custkey")], limit=25)
    return nearest.select("c_custkey", F.round(loc.distance_m(179, 70), 3).alias("meters"))


@query("SELECT o_orderkey FROM orders WHERE o_custkey = 7")
def parent_id(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "_parent")
    return orders.where(Doc(orders)["_parent"].eq("7")).select("o_orderkey")


@query("""
    SELECT event_id FROM (SELECT event_id, coalesce(CASE WHEN value >= 50 THEN value END, 75.0) AS v FROM events)
    WHERE v > 70""")
def default_value(spark, d):
    value = F.when(F.col("value") >= 50, F.col("value")).alias("v", metadata={"default": 75.0})
    events = table(spark, d, "events").select("event_id", value)
    return events.where(Doc(events)["v"].range(gt=70)).select("event_id")


@query("""
    SELECT event_id FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) >= 90""")
def open_field(spark, d):
    events = table(spark, d, "events").select("event_id", F.parse_json("props").alias("props"))
    return events.where(Doc(events)["props.k"].range(gte=90)).select("event_id")


@query("""
    WITH e AS (SELECT event_id, event_id % 10 AS i FROM events)
    SELECT event_id, i = 7 AS is_true, i IN (1, 4) AS is_5, i IN (1, 4, 8) AS to_5, i IN (0, 1, 2, 3, 4, 5, 7, 8) AS under_or_none,
           FALSE AS is_2_53, i = 6 AS is_2_53_1, i IN (6, 9) AS from_2_53, i IN (1, 2, 4, 6) AS listed, i <> 6 AS others, i = 2 AS is_x
    FROM e""")
def open_mixed(spark, d):
    """An open field of fractions, whole numbers, text, booleans and numbers that doubles cannot hold."""
    kinds = ["5.7", "5", '"x"', "6.2", '"5"', "null", "9007199254740993", "true", "-1e-3", "1e300"]
    text = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("event_id") % 10 + 1).cast("int"))
    events = table(spark, d, "events").select("event_id", F.parse_json(text).alias("v"))
    v = Doc(events)["v"]
    tests = {"is_true": v.eq(True), "is_5": v.eq(5), "to_5": v.range(lte=5), "under_or_none": v.none(lambda p: p.range(gte=2**53)),
             "is_2_53": v.eq(2**53), "is_2_53_1": v.eq(2**53 + 1), "from_2_53": v.range(gte=2**53),
             "listed": v.isin([5, "x", 2**53 + 1]), "others": v.nin([2**53 + 1]), "is_x": v.eq("x")}
    return events.select("event_id", *[F.coalesce(test, F.lit(False)).alias(name) for name, test in tests.items()])


@query("SELECT event_id FROM events WHERE json_extract_string(props, '$.k') = '42'")
def map_field(spark, d):
    props = F.from_json("props", T.MapType(T.StringType(), T.StringType()))
    events = table(spark, d, "events").select("event_id", props.alias("props"))
    return events.where(Doc(events)["props.k"].eq(42)).select("event_id")


@query("SELECT p_partkey FROM part WHERE len(p_name) > 9 AND p_size > 25")
def custom_operator(spark, d):
    register_operator("longer_than", lambda path, n: F.length(path.column) > n)
    parts = table(spark, d, "part")
    doc = Doc(parts)
    return parts.where(doc["p_name"].op("longer_than", 9) & doc["p_size"].range(gt="25")).select("p_partkey")


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z') AS at FROM orders
    WHERE o_orderdate >= TIMESTAMP '2001-06-01' AND o_orderdate < TIMESTAMP '2001-07-01'""")
def date_range(spark, d):
    orders = table(spark, d, "orders")
    day = Doc(orders)["o_orderdate"]
    return orders.where(day.range(gte="2001-06-01", lt="2001-07-01")).select(
        "o_orderkey", iso_utc(F.col("o_orderdate")).alias("at"))


@query("""
    SELECT c_custkey FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 480000)""", name="has_child")
def has_child_any(spark, d):
    customers, orders = table(spark, d, "customer"), table(spark, d, "orders")
    large = Doc(orders)["o_totalprice"].range(gt=480000)
    return customers.where(has_child(orders, "c_custkey", "o_custkey", where=large)).select("c_custkey")


@query("""
    SELECT c_custkey FROM customer WHERE c_nationkey = 3
       OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 480000)""")
def has_child_or(spark, d):
    customers, orders = table(spark, d, "customer"), table(spark, d, "orders")
    large = Doc(orders)["o_totalprice"].range(gt=480000)
    return customers.where(
        Doc(customers)["c_nationkey"].eq(3) | has_child(orders, "c_custkey", "o_custkey", where=large)
    ).select("c_custkey")


@query("""
    SELECT c_custkey FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""")
def has_no_child(spark, d):
    customers, orders = table(spark, d, "customer"), table(spark, d, "orders")
    large = Doc(orders)["o_totalprice"].range(gt=300000)
    return customers.where(
        none_of(has_child(orders, "c_custkey", "o_custkey", where=large))).select("c_custkey")


@query("""
    SELECT c_custkey FROM customer WHERE c_custkey IN (
        SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) BETWEEN 3 AND 5)""")
def child_bounds(spark, d):
    customers, orders = table(spark, d, "customer"), table(spark, d, "orders")
    return customers.where(has_child(
        orders, "c_custkey", "o_custkey", where=Doc(orders)["o_orderstatus"].eq("F"),
        min_children=3, max_children="5")).select("c_custkey")


@query("""
    SELECT c_custkey FROM customer WHERE (
        SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') <= 2""")
def child_at_most(spark, d):
    customers, orders = table(spark, d, "customer"), table(spark, d, "orders")
    return customers.where(has_child(
        orders, "c_custkey", "o_custkey", where=Doc(orders)["o_orderstatus"].eq("F"),
        min_children=0, max_children=2)).select("c_custkey")


@query("""
    SELECT o_orderkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""", name="has_parent")
def has_parent_match(spark, d):
    customers, orders = table(spark, d, "customer"), table(spark, d, "orders")
    building = Doc(customers)["c_mktsegment"].eq("BUILDING")
    return orders.where(has_parent(customers, "o_custkey", "c_custkey", where=building)).select("o_orderkey")


@query("""
    SELECT o_orderkey FROM orders WHERE o_totalprice > 450000
       OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def has_parent_or(spark, d):
    customers, orders = table(spark, d, "customer"), table(spark, d, "orders")
    building = Doc(customers)["c_mktsegment"].eq("BUILDING")
    return orders.where(
        Doc(orders)["o_totalprice"].range(gt=450000)
        | has_parent(customers, "o_custkey", "c_custkey", where=building, rows=orders)
    ).select("o_orderkey")


@query("""
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_name <> 'KENYA'))
      AND (l_returnflag = 'R' OR l_orderkey IN (
          SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')))""")
def parent_of_relation(spark, d):
    """A parent filtered by its own parent, beside and behind another relation; heavy keys are counted."""
    lines, orders, customers, suppliers, nations = (
        table(spark, d, t) for t in ("lineitem", "orders", "customer", "supplier", "nation"))
    abroad = has_parent(nations, "s_nationkey", "n_nationkey", where=Doc(nations)["n_name"].ne("KENYA"))
    lines = lines.where(has_parent(suppliers, "l_suppkey", "s_suppkey", where=abroad))
    building = has_parent(customers, "o_custkey", "c_custkey", where=Doc(customers)["c_mktsegment"].eq("BUILDING"), rows=orders)
    theirs = has_parent(orders, "l_orderkey", "o_orderkey", where=building, rows=lines)
    return lines.where(Doc(lines)["l_returnflag"].eq("R") | theirs).select("l_orderkey", "l_linenumber")


@query("""
    SELECT r_name FROM region WHERE r_regionkey IN (
        SELECT n_regionkey FROM nation
        WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 5000))""")
def nested_relative(spark, d):
    regions, nations, customers = (table(spark, d, t) for t in ("region", "nation", "customer"))
    rich = has_child(customers, "n_nationkey", "c_nationkey", where=Doc(customers)["c_acctbal"].range(gt=5000))
    return regions.where(has_child(nations, "r_regionkey", "n_regionkey", where=rich)).select("r_name")


@query("""
    SELECT n_name FROM nation
    WHERE n_nationkey IN (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) >= 2)
      AND n_nationkey IN (SELECT s_nationkey FROM supplier GROUP BY 1 HAVING count(*) >= 2)
      AND n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name <> 'ASIA')""")
def several_relatives(spark, d):
    nations, customers, suppliers, regions = (
        table(spark, d, t) for t in ("nation", "customer", "supplier", "region"))
    return nations.where(
        has_child(customers, "n_nationkey", "c_nationkey", min_children=2)
        & has_child(suppliers, "n_nationkey", "s_nationkey", min_children=2)
        & has_parent(regions, "n_regionkey", "r_regionkey", where=Doc(regions)["r_name"].ne("ASIA"))
    ).select("n_name")
