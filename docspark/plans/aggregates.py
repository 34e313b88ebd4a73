"""Queries over every group key and statistic."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from docspark.functions.text import STOP_WORDS
from docspark.functions.dates import iso_utc
from docspark.operators.aggregate import (
    Spec, aggregate, aggregate_multi, aggregate_multi_long, by_component, by_duration, by_field,
    by_interval, by_ranges, to_documents, top_groups,
)
from docspark.operators.predicates import Doc
from docspark.plans.registry import query, table

_ALL = ["count", "min", "max", "avg", "sum"]


def _rounded(df, **digits):
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("""
    SELECT count(*) AS total, count(value) AS value_count, min(value) AS value_min,
           max(value) AS value_max, round(avg(value), 6) AS value_avg, round(sum(value), 2) AS value_sum
    FROM events WHERE event_type = 'click'""")
def stats_all(spark, d):
    events = table(spark, d, "events")
    result = aggregate(events, stats={"value": _ALL}, total=True, where=Doc(events)["event_type"].eq("click"))
    return _rounded(result, value_avg=6, value_sum=2)


@query("SELECT count(t) AS t_count FROM (SELECT nullif(event_type, 'view') AS t FROM events)")
def stats_short(spark, d):
    events = table(spark, d, "events").selectExpr("nullif(event_type, 'view') AS t")
    return aggregate(events, stats="t")


@query("""
    SELECT label AS k0, count(x) AS embedding_count, min(x) AS embedding_min, max(x) AS embedding_max,
           round(avg(CAST(x AS DOUBLE)), 6) AS embedding_avg, round(sum(CAST(x AS DOUBLE)), 4) AS embedding_sum
    FROM (SELECT label, unnest(embedding) AS x FROM embeddings) GROUP BY 1""")
def stats_array(spark, d):
    vectors = table(spark, d, "embeddings")
    result = aggregate(vectors, by=by_field("label"), stats={"embedding": _ALL})
    return _rounded(result, embedding_avg=6, embedding_sum=4)


@query("SELECT event_type AS k0, count(*) AS total FROM events GROUP BY 1")
def group_field(spark, d):
    return aggregate(table(spark, d, "events"), by=by_field("event_type"), total=True)


@query("""
    SELECT k0, count(*) AS total FROM (
        SELECT unnest(list_distinct(string_split(url, '/'))) AS k0 FROM pages) GROUP BY 1""")
def group_array(spark, d):
    pages = table(spark, d, "pages").select(F.split("url", "/").alias("parts"))
    return aggregate(pages, by=by_field("parts"), total=True)


@query(r"""
    SELECT k0, count(*) AS total FROM (
        SELECT doc_id, unnest(list_distinct(string_split_regex(lower(text), '[^\p{L}\p{N}]+'))) AS k0
        FROM documents) WHERE k0 <> '' GROUP BY 1""")
def group_tokens(spark, d):
    return aggregate(table(spark, d, "documents"), by=by_field("text", analyzer="standard"), total=True)


@query(rf"""
    SELECT k0, count(*) AS total FROM (
        SELECT doc_id, unnest(list_distinct(string_split_regex(lower(text), '[^\p{{L}}]+'))) AS k0 FROM documents)
    WHERE k0 <> '' AND k0 NOT IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}) GROUP BY 1""")
def group_stops(spark, d):
    return aggregate(table(spark, d, "documents"), by=by_field("text", analyzer="stop"), total=True)


@query()
def group_stems(spark, d):
    return aggregate(table(spark, d, "documents"), by=by_field("text", analyzer="english"), total=True)


@query("""
    SELECT user_id AS k0, count(*) AS total FROM events GROUP BY 1 ORDER BY total DESC, k0 LIMIT 10""", name="top_groups")
def largest_groups(spark, d):
    return top_groups(aggregate(table(spark, d, "events"), by=by_field("user_id"), total=True), 10)


@query("""
    SELECT CAST(i AS INTEGER) AS k0, count(*) AS total
    FROM events, (VALUES (0, NULL, 50.0), (1, 20.0, 100.0), (2, 100.0, NULL)) r(i, f, t)
    WHERE (f IS NULL OR value >= f) AND (t IS NULL OR value < t) GROUP BY 1""")
def group_ranges(spark, d):
    ranges = by_ranges("value", [(None, 50), (20, 100), (100, None)])
    return aggregate(table(spark, d, "events"), by=ranges, total=True)


@query("""
    SELECT CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 5000 THEN 1 ELSE 2 END AS k0,
           count(*) AS total, min(c_acctbal) AS c_acctbal_min FROM customer GROUP BY 1""")
def group_disjoint_ranges(spark, d):
    ranges = by_ranges("c_acctbal", [(None, 0), (0, 5000), (5000, None)])
    return aggregate(table(spark, d, "customer"), by=ranges, stats={"c_acctbal": ["min"]}, total=True)


@query("""
    SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 0 ELSE 1 END AS k0, count(*) AS total
    FROM orders GROUP BY 1""")
def group_date_ranges(spark, d):
    turn = datetime(1998, 1, 1)
    return aggregate(table(spark, d, "orders"), by=by_ranges("o_orderdate", [(None, turn), (turn, None)]), total=True)


@query("SELECT floor(value / 25) * 25 AS k0, count(*) AS total FROM events GROUP BY 1")
def group_interval(spark, d):
    return aggregate(table(spark, d, "events"), by=by_interval("value", 25), total=True)


@query("SELECT floor((value - 5) / 25) * 25 + 5 AS k0, count(*) AS total FROM events GROUP BY 1")
def interval_base(spark, d):
    return aggregate(table(spark, d, "events"), by=by_interval("value", 25, base=5), total=True)


@query("""
    SELECT time_bucket(INTERVAL '30 days', o_orderdate, TIMESTAMP '1970-01-01') AS k0, count(*) AS total
    FROM orders GROUP BY 1""")
def group_duration(spark, d):
    return aggregate(table(spark, d, "orders"), by=by_duration("o_orderdate", "P1M"), total=True)


@query("""
    SELECT strftime(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01 01:00:00'),
                    '%Y-%m-%dT%H:%M:%S.000Z') AS k0, count(*) AS total FROM events GROUP BY 1""")
def duration_base(spark, d):
    key = by_duration("ts", "PT6H", base=datetime(1970, 1, 1, 1))
    groups = aggregate(table(spark, d, "events"), by=key, total=True)
    return groups.withColumn("k0", iso_utc(F.col("k0")))


@query("SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS k0, count(*) AS total FROM orders GROUP BY 1")
def group_component(spark, d):
    return aggregate(table(spark, d, "orders"), by=by_component("o_orderdate", "month"), total=True)


@query("""
    SELECT TIMESTAMP '1970-01-01' + to_months(CAST(floor(m / 5) * 5 AS INTEGER)) AS k0, count(*) AS total
    FROM (SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 - 1970 * 12 AS m FROM orders) GROUP BY 1""")
def group_5month(spark, d):
    return aggregate(table(spark, d, "orders"), by=by_component("o_orderdate", "month", 5), total=True)


@query("""
    SELECT time_bucket(INTERVAL '14 days', ts, TIMESTAMP '1969-12-29') AS k0, count(*) AS total
    FROM events GROUP BY 1""")
def group_2week(spark, d):
    return aggregate(table(spark, d, "events"), by=by_component("ts", "week", 2), total=True)


@query("""
    SELECT time_bucket(INTERVAL '2 days', ts, TIMESTAMP '1970-01-01') AS k0, count(*) AS total
    FROM events GROUP BY 1""")
def group_2day(spark, d):
    return aggregate(table(spark, d, "events"), by=by_component("ts", "day", 2), total=True)


@query("""
    SELECT event_type AS k0, floor(value / 100) * 100 AS k1, count(*) AS total, max(value) AS value_max
    FROM events GROUP BY 1, 2""")
def group_nested(spark, d):
    return aggregate(table(spark, d, "events"), by=[by_field("event_type"), by_interval("value", 100)],
                     stats={"value": ["max"]}, total=True)


@query("""
    SELECT event_type AS k0, CAST(i AS INTEGER) AS k1, CAST(date_trunc('week', ts) AS TIMESTAMP) AS k2,
           time_bucket(INTERVAL '30 days', ts, TIMESTAMP '1970-01-01') AS k3,
           count(*) AS total, count(value) AS value_count
    FROM events, (VALUES (0, NULL, 50.0), (1, 20.0, NULL)) r(i, f, t)
    WHERE (f IS NULL OR value >= f) AND (t IS NULL OR value < t) GROUP BY 1, 2, 3, 4""")
def group_many_keys(spark, d):
    return aggregate(
        table(spark, d, "events"),
        by=[by_field("event_type"), by_ranges("value", [(None, 50), (20, None)]),
            by_component("ts", "week"), by_duration("ts", "P30D")],
        stats="value", total=True)


@query("""
    SELECT 'type' AS name, event_type AS k0, count(*) AS total FROM events WHERE value > 20 GROUP BY 2
    UNION ALL
    SELECT 'user' AS name, CAST(user_id AS VARCHAR) AS k0, count(*) AS total
    FROM events WHERE value > 20 GROUP BY 2""")
def agg_multi(spark, d):
    events = table(spark, d, "events")
    return aggregate_multi_long(events, {
        "type": Spec([by_field("event_type")], total=True),
        "user": Spec([by_field("user_id")], total=True),
    }, where=Doc(events)["value"].range(gt=20))


@query("""
    SELECT 'all' AS name, CAST(NULL AS INTEGER) AS k0, NULL AS k1, NULL AS total, max(value) AS value_max,
           NULL AS value_count FROM events
    UNION ALL
    SELECT 'bands', CAST(i AS INTEGER), event_type, count(*), NULL, count(value)
    FROM events, (VALUES (0, NULL, 50.0), (1, 20.0, NULL)) r(i, f, t)
    WHERE (f IS NULL OR value >= f) AND (t IS NULL OR value < t) GROUP BY 2, 3""")
def agg_multi_shapes(spark, d):
    return aggregate_multi_long(table(spark, d, "events"), {
        "all": Spec(stats={"value": ["max"]}),
        "bands": Spec([by_ranges("value", [(None, 50), (20, None)]), by_field("event_type")],
                      stats={"value": ["count"]}, total=True),
    })


@query("""
    SELECT 'all' AS name, CAST(NULL AS VARCHAR) AS k0, count(*) AS total, sum(value) AS value_sum FROM events WHERE value < -1e9
    UNION ALL SELECT 'type', event_type, count(*), NULL FROM events WHERE value < -1e9 GROUP BY event_type""")
def agg_multi_empty(spark, d):
    """An aggregate without keys has its row though nothing matches."""
    events = table(spark, d, "events")
    return aggregate_multi_long(events, {
        "all": Spec(stats={"value": ["sum"]}, total=True),
        "type": Spec([by_field("event_type")], total=True),
    }, where=Doc(events)["value"].range(lt=-1e9))


@query("""
    SELECT 'all' AS name, NULL AS k0, CAST(NULL AS VARCHAR) AS k1, count(*) AS total, NULL AS o_totalprice_max,
           round(avg(o_totalprice), 4) AS o_totalprice_avg FROM orders
    UNION ALL SELECT 'status', o_orderstatus, NULL, count(*), max(o_totalprice), NULL FROM orders GROUP BY o_orderstatus
    UNION ALL SELECT 'status again', o_orderstatus, NULL, NULL, NULL, round(avg(o_totalprice), 4) FROM orders GROUP BY o_orderstatus
    UNION ALL SELECT 'both', CAST(year(o_orderdate) AS VARCHAR), o_orderstatus, count(*), max(o_totalprice), NULL FROM orders
              GROUP BY year(o_orderdate), o_orderstatus
    UNION ALL SELECT 'year', CAST(year(o_orderdate) AS VARCHAR), NULL, count(*), NULL, NULL FROM orders GROUP BY year(o_orderdate)""")
def agg_multi_sets(spark, d):
    """Five aggregates as four grouping sets of one scan."""
    orders = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    status, year = by_field("o_orderstatus"), by_field("year")
    result = aggregate_multi_long(orders, {
        "all": Spec(stats={"o_totalprice": ["avg"]}, total=True),
        "status": Spec([status], stats={"o_totalprice": ["max"]}, total=True),
        "status again": Spec([status], stats={"o_totalprice": ["avg"]}),
        "both": Spec([year, status], stats={"o_totalprice": ["max"]}, total=True),
        "year": Spec([year], total=True),
    })
    return _rounded(result, o_totalprice_avg=4)


@query("""
    WITH r AS (SELECT CAST(i AS INTEGER) AS k0, (i * 7) % 400 - 50 AS f, (i * 7) % 400 - 50 + i % 90 + 1 AS t FROM range(1000) x(i))
    SELECT k0, event_type AS k1, count(*) AS total, min(value) AS value_min, round(sum(value), 2) AS value_sum, count(user_id) AS user_id_count
    FROM events JOIN r ON value >= f AND value < t WHERE event_type IS NOT NULL GROUP BY 1, 2""")
def group_many_ranges(spark, d):
    """A thousand ranges that overlap: each row is placed once."""
    ranges = [((i * 7) % 400 - 50, (i * 7) % 400 - 50 + i % 90 + 1) for i in range(1000)]
    result = aggregate(table(spark, d, "events"), [by_ranges("value", ranges), by_field("event_type")],
                       stats={"value": ["min", "sum"], "user_id": ["count"]}, total=True)
    return _rounded(result, value_sum=2)


@query("""
    SELECT b.k0, b.total AS matched, a.total AS of_all FROM
        (SELECT event_type AS k0, count(*) AS total FROM events WHERE value > 100 GROUP BY 1) b
        JOIN (SELECT event_type AS k0, count(*) AS total FROM events GROUP BY 1) a USING (k0)""")
def agg_named(spark, d):
    events = table(spark, d, "events")
    specs = {"by_type": Spec([by_field("event_type")], total=True)}
    matched = aggregate_multi(events, specs, where=Doc(events)["value"].range(gt=100))["by_type"]
    everything = aggregate_multi(events, specs)["by_type"]
    return matched.withColumnRenamed("total", "matched").join(
        everything.withColumnRenamed("total", "of_all"), "k0")


@query("""
    SELECT (SELECT count(*) FROM events WHERE event_type = 'click') AS matched, count(*) AS total FROM events""")
def agg_scope_all(spark, d):
    events = table(spark, d, "events")
    clicks = Doc(events)["event_type"].eq("click")
    matched = aggregate(events, total=True, where=clicks)
    return aggregate(events, total=True, where=clicks, scope="all").select(
        matched.scalar().alias("matched"), "total")


@query("""
    SELECT '{"keys":["' || event_type || '"],"stats":{"user_id":{"min":' || min(user_id) || ',"max":'
           || max(user_id) || '}},"total":' || count(*) || '}' AS json FROM events GROUP BY event_type""")
def agg_documents(spark, d):
    spec = Spec([by_field("event_type")], stats={"user_id": ["min", "max"]}, total=True)
    groups = aggregate(table(spark, d, "events"), by=spec.by, stats=spec.stats, total=True)
    return to_documents(groups, spec)
