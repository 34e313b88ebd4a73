import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from docspark import (
    Doc, Spec, aggregate, aggregate_multi, aggregate_multi_long, by_component, by_duration, by_field,
    by_interval, by_ranges, to_documents, top_groups,
)
from docspark.functions.dates import duration_seconds, iso_utc

AGES = [(None, 2), (2, 5), (5, None)]


def totals(df):
    keys = [c for c in df.columns if c[0] == "k"]
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r.total for r in df.collect()}


def iso(df, *keys):
    return df.withColumns({k: iso_utc(F.col(k)) for k in keys})


def test_ungrouped(found):
    assert aggregate(found, stats="age").first().asDict() == {"age_count": 5}
    assert aggregate(found, total=True).first().asDict() == {"total": 5}
    row = aggregate(found, stats={"age": ["min", "max", "avg", "sum"]}).first()
    assert tuple(row) == (0.0, 8.0, 2.8, 14.0)


def test_filter_and_scope(found):
    old = Doc(found)["age"].range(gte=2)
    assert aggregate(found, total=True, where=old).first().total == 3
    assert aggregate(found, total=True, where=old, scope="all").first().total == 5


def test_by_field(found):
    assert totals(aggregate(found, by_field("name"), total=True)) == {"Charles": 2, "Baloo": 1, "Ein": 2}
    tokens = aggregate(found, by_field("name", analyzer="standard"), stats="age", total=True)
    assert totals(tokens) == {"charles": 2, "baloo": 1, "ein": 2}
    assert {r.k0: r.age_count for r in tokens.collect()} == {"charles": 2, "baloo": 1, "ein": 2}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_date_keys(found, kind):
    df = found.withColumn("found", F.col("found").cast(kind))
    ranges = by_ranges("found", [(None, dt.datetime(2015, 1, 2)), (dt.datetime(2015, 1, 2), dt.datetime(2015, 2, 1)),
                                 (dt.datetime(2015, 2, 1), None)])
    assert totals(aggregate(df, ranges, total=True)) == {0: 1, 1: 2, 2: 2}
    months = aggregate(df, by_duration("found", "P1M"), total=True)
    assert months.schema["k0"].dataType.simpleString() == kind
    assert totals(iso(months, "k0")) == {
        "2014-12-06T00:00:00.000Z": 2, "2015-01-05T00:00:00.000Z": 2, "2015-02-04T00:00:00.000Z": 1}
    days = aggregate(df, by_component("found", "day", 2), total=True)
    assert totals(iso(days, "k0")) == {
        "2015-01-01T00:00:00.000Z": 2, "2015-01-11T00:00:00.000Z": 1,
        "2015-01-31T00:00:00.000Z": 1, "2015-02-10T00:00:00.000Z": 1}


def test_numeric_keys(found):
    assert totals(aggregate(found, by_ranges("age", AGES), total=True)) == {0: 2, 1: 2, 2: 1}
    assert totals(aggregate(found, by_interval("age", 2), total=True)) == {0.0: 2, 2.0: 2, 8.0: 1}
    assert totals(aggregate(found, by_interval("age", 2, base=1), total=True)) == {-1.0: 1, 1.0: 2, 3.0: 1, 7.0: 1}
    assert totals(aggregate(found, by_interval("age", 1.5), total=True)) == {0.0: 2, 1.5: 1, 3.0: 1, 7.5: 1}
    overlapping = by_ranges("age", [(0, 3), (None, 2), (2, 2)])
    assert totals(aggregate(found, overlapping, total=True)) == {0: 3, 1: 2}


def test_calendar_units(spark):
    days = ["1969-12-28", "1969-12-29", "1970-01-12", "1970-02-28", "1971-05-01", "1968-02-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("timestamp").alias("t"))

    def starts(unit, n):
        keyed = aggregate(df, by_component("t", unit, n), total=True)
        return {r.k0.strftime("%Y-%m-%d"): r.total for r in keyed.collect()}

    assert starts("week", 2) == {"1969-12-15": 1, "1969-12-29": 1, "1970-01-12": 1, "1970-02-23": 1,
                                 "1971-04-19": 1, "1968-01-29": 1}
    assert starts("month", 3) == {"1969-10-01": 2, "1970-01-01": 2, "1971-04-01": 1, "1968-01-01": 1}
    assert starts("year", 2) == {"1968-01-01": 3, "1970-01-01": 3}
    assert starts("year", 1) == {"1968-01-01": 1, "1969-01-01": 2, "1970-01-01": 2, "1971-01-01": 1}


SIX = [
    by_field("name", analyzer="standard"),
    by_ranges("found", [(None, dt.datetime(2015, 1, 1)), (dt.datetime(2015, 1, 1), dt.datetime(2015, 2, 1)),
                        (dt.datetime(2015, 2, 1), None)]),
    by_ranges("age", AGES),
    by_duration("found", "P1M"),
    by_interval("age", 2),
    by_component("found", "day", 2),
]


def test_six_keys(found):
    groups = iso(aggregate(found, SIX, stats="age", total=True), "k3", "k5")
    assert totals(groups) == {
        ("charles", 1, 0, "2014-12-06T00:00:00.000Z", 0.0, "2015-01-01T00:00:00.000Z"): 2,
        ("ein", 2, 1, "2015-01-05T00:00:00.000Z", 2.0, "2015-01-31T00:00:00.000Z"): 1,
        ("ein", 2, 2, "2015-02-04T00:00:00.000Z", 8.0, "2015-02-10T00:00:00.000Z"): 1,
        ("baloo", 1, 1, "2015-01-05T00:00:00.000Z", 2.0, "2015-01-11T00:00:00.000Z"): 1,
    }


SPECS = {
    "stats": Spec(stats="age"),
    "field": Spec([by_field("name", analyzer="standard")], total=True),
    "multi": Spec([by_field("name", analyzer="standard"), by_ranges("age", AGES)], total=True),
}
MULTI = {("charles", 0): 2, ("baloo", 1): 1, ("ein", 1): 1, ("ein", 2): 1}


def test_several_aggregates(found):
    result = aggregate_multi(found, SPECS)
    assert result["stats"].first().asDict() == {"age_count": 5}
    assert totals(result["field"]) == {"charles": 2, "baloo": 1, "ein": 2}
    assert totals(result["multi"]) == MULTI


def test_several_aggregates_in_one_scan(spark, tmp_path, found):
    found.write.parquet(str(tmp_path / "f"))
    df = aggregate_multi_long(spark.read.parquet(str(tmp_path / "f")), SPECS)
    plan = plan_of(df)
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    rows = {(r["name"], r.k0, r.k1): (r.total, r.age_count) for r in df.collect()}
    assert rows == {
        ("stats", None, None): (None, 5),
        ("field", "charles", None): (2, None), ("field", "baloo", None): (1, None), ("field", "ein", None): (2, None),
        **{("multi", *k): (n, None) for k, n in MULTI.items()},
    }


def test_missing_values_have_no_group(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", None)], "g string, v int")
    assert totals(aggregate(df, by_field("g"), total=True)) == {"a": 2}
    assert totals(aggregate(df, by_interval("v", 1), total=True)) == {1.0: 1, 2.0: 1}
    assert aggregate(df, by_field("g"), stats="v").first().v_count == 1
    assert aggregate(df.where("g = 'x'"), by_field("g"), total=True).collect() == []
    long = aggregate_multi_long(df, {"g": Spec([by_field("g")], total=True), "v": Spec([by_field("v")], total=True)})
    assert {(r["name"], r.k0): r.total for r in long.collect()} == {("g", "a"): 2, ("v", "1"): 1, ("v", "2"): 1}


def test_array_fields(spark):
    df = spark.createDataFrame([(["x", "y", "x"], [1.0, 7.0]), (["y"], [None, 2.0]), (None, None)],
                               "tags array<string>, n array<double>")
    assert totals(aggregate(df, by_field("tags"), total=True)) == {"x": 1, "y": 2}
    row = aggregate(df, stats={"n": ["count", "min", "max", "avg", "sum"]}).first()
    assert tuple(row) == (3, 1.0, 7.0, 10 / 3, 10.0)
    assert totals(aggregate(df, by_ranges("n", [(0, 5), (1, 9)]), total=True)) == {0: 2, 1: 2}
    assert totals(aggregate(df, by_field("tags", analyzer="english"), total=True)) == {"x": 1, "y": 2}


def test_nested_field_statistics(spark):
    df = spark.createDataFrame([((5,),), ((7,),)], "a struct<b: int>")
    assert aggregate(df, stats={"a.b": ["max"]}).first().asDict() == {"a_b_max": 7}


def test_top_groups(found):
    groups = aggregate(found, by_field("name"), total=True)
    assert [(r.k0, r.total) for r in top_groups(groups, 2).collect()] == [("Charles", 2), ("Ein", 2)]


def test_documents(found):
    spec = Spec([by_field("name"), by_interval("age", 2), by_duration("found", "P1M")],
                stats={"age": ["count", "max"]}, total=True)
    groups = aggregate(found, spec.by, spec.stats, spec.total)
    docs = [json.loads(r.json) for r in to_documents(groups, spec).collect()]
    assert {"keys": ["Charles", 0, "2014-12-06T00:00:00.000Z"], "stats": {"age": {"count": 2, "max": 1}},
            "total": 2} in docs


def test_durations():
    day = 86400
    assert duration_seconds("P1M") == 30 * day and duration_seconds("P1Y") == 365 * day
    assert duration_seconds("P2M") == 61 * day and duration_seconds("P1W") == 7 * day
    assert duration_seconds("P1DT2H3M4.5S") == day + 2 * 3600 + 3 * 60 + 4.5
    for bad in ("", "P", "PT", "1M", "P1X"):
        with pytest.raises(ValueError):
            duration_seconds(bad)


def test_errors(found):
    with pytest.raises(ValueError, match="at least one range"):
        by_ranges("age", [])
    with pytest.raises(ValueError, match="unknown time unit"):
        by_component("found", "century")
    with pytest.raises(ValueError, match="unknown statistic"):
        aggregate(found, stats={"age": ["median"]})
    with pytest.raises(ValueError):
        by_interval("age", 0)


def test_disjoint_ranges_need_no_extra_rows(found):
    assert "Generate" not in plan_of(aggregate(found, by_ranges("age", AGES), total=True))
    assert "Generate" in plan_of(aggregate(found, by_ranges("age", [(0, 3), (2, 5)]), total=True))
