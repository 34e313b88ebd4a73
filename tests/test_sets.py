"""Grouping sets and ranges that overlap against one aggregate at a time, and what their plans do once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from docspark import Spec, aggregate, aggregate_multi_long, by_field, by_interval, by_ranges

ALL = ["count", "min", "max", "avg", "sum"]


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(3)
    start = dt.datetime(2020, 1, 1)
    rows = [(rnd.choice("abc") if rnd.random() < 0.9 else None, rnd.choice([None, *range(-20, 60)]), round(rnd.uniform(-30, 70), 1),
             start + dt.timedelta(days=rnd.randint(0, 60)), [rnd.randint(0, 9) for _ in range(rnd.randint(0, 3))]) for _ in range(600)]
    rows += [("a", None, None, None, None), ("b", 3, float("nan"), start, [])]
    return spark.createDataFrame(rows, "kind string, n int, v double, day timestamp, many array<int>")


def lines(df, *columns):
    return sorted(repr([round(x, 6) if isinstance(x, float) else x for x in (r[c] for c in columns)]) for r in df.collect())


def test_sets_equal_single_aggregates(events):
    kind, n, wide = by_field("kind"), by_field("n"), by_interval("v", 25)
    specs = {
        "none": Spec(stats={"n": ALL}, total=True), "kind": Spec([kind], stats={"v": ["max"]}, total=True),
        "kind again": Spec([kind], stats={"n": ["avg", "count"]}), "n": Spec([n], total=True),
        "kind n": Spec([kind, n], stats={"many": ["sum", "count"]}), "n kind": Spec([n, kind], total=True), "wide": Spec([wide], total=True),
    }
    stacked = aggregate_multi_long(events.where("v = v OR v IS NULL"), specs)
    plan = plan_of(stacked)
    assert plan.split("Initial Plan")[0].count("Expand") == 1 and "Generate inline" not in plan
    for name, spec in specs.items():
        single = aggregate(events.where("v = v OR v IS NULL"), spec.by, spec.stats, spec.total)
        keys = [f"k{i}" for i in range(len(spec.by))]
        own = stacked.where(F.col("name") == name)
        rest = [c for c in single.columns if c not in keys]
        text = [F.col(k).cast("string").alias(k) for k in keys]
        assert lines(own.select(*text, *rest), *keys, *rest) == lines(single.select(*text, *rest), *keys, *rest), name


def test_sets_of_nothing(events):
    got = aggregate_multi_long(events, {"none": Spec(stats={"n": ["sum"]}, total=True), "kind": Spec([by_field("kind")], total=True)},
                               where=F.col("n") > 1000).collect()
    assert [(r.name, r.k0, r.total, r.n_sum) for r in got] == [("none", None, 0, None)]
    assert [r.total for r in aggregate_multi_long(events, {"none": Spec(total=True)}).collect()] == [602]


@pytest.mark.parametrize("path, ranges", [
    ("n", [(None, 10), (5, 30), (5, 30), (30, None), (None, None), (7, 7), (9, 3), (-100, 100.5)]),
    ("v", [(None, 0), (-10, 20.5), (20.5, None), (0, 70), (None, None)]),
    ("day", [("2020-01-10", "2020-02-10"), (None, "2020-01-20"), ("2020-01-20", None)]),
])
def test_ranges_equal_a_filter_each(events, path, ranges):
    got = aggregate(events, [by_ranges(path, ranges), by_field("kind")], stats={"n": ALL, "many": ALL}, total=True)
    want = []
    for i, (low, high) in enumerate(ranges):
        rows = events.where(F.col(path).isNotNull())
        rows = rows if low is None else rows.where(F.col(path) >= F.lit(low))
        rows = rows if high is None else rows.where(F.col(path) < F.lit(high))
        single = aggregate(rows, by_field("kind"), stats={"n": ALL, "many": ALL}, total=True)
        want += lines(single.select(F.lit(i).alias("k0"), F.col("k0").alias("k1"), *single.columns[1:]), *got.columns)
    assert lines(got, *got.columns) == sorted(want)
    single = aggregate(events, by_field("kind"), stats={"n": ALL}, total=True)
    assert [f.dataType for f in got.schema if f.name in single.columns[1:]] == [f.dataType for f in single.schema][1:]


def test_a_thousand_ranges_place_a_row_once(spark):
    rows = spark.range(0, 4000, numPartitions=4).select((F.col("id") % 1000).cast("double").alias("v"))
    counted = aggregate(rows, by_ranges("v", [(i, i + 300) for i in range(1000)]), total=True)
    assert {r.k0: r.total for r in counted.collect()} == {i: 4 * min(300, 1000 - i) for i in range(1000)}
    plan = plan_of(counted).split("Initial Plan")[0]
    # from the top: ranges are made from groups, above the shuffle that has a row for each place between bounds
    assert plan.index("Generate explode") < plan.rindex("Exchange") and plan.count("Generate explode") == 1


def test_ranges_of_an_array_count_a_document_once(spark):
    rows = spark.createDataFrame([([1, 2, 30],), ([50],), (None,)], "v array<int>")
    got = aggregate(rows, by_ranges("v", [(0, 10), (0, 40), (40, None)]), total=True)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1), (1, 1), (2, 1)]
