"""Random documents and predicates against a plain-Python reading of the rules."""

import datetime as dt
import fnmatch
import random
import re

from pyspark.sql import functions as F

from docspark import (
    Doc, Spec, aggregate, aggregate_multi_long, all_of, any_of, by_component, by_duration, by_field, by_interval,
    by_ranges, none_of,
)

WORDS = ["red", "green", "blue ish", "Blue", "x", ""]
SCHEMA = ("id int, n int, s string, ns array<int>, ss array<string>, "
          "os array<struct<a: int, b: string>>, o struct<a: int, t: array<string>>")


def random_doc(rng, i):
    def maybe(make, p=0.3):
        return None if rng.random() < p else make()

    def number():
        return rng.randint(0, 6)

    def word():
        return rng.choice(WORDS)

    def several(make):
        return [maybe(make, 0.15) for _ in range(rng.randint(0, 4))]

    return (i, maybe(number), maybe(word), maybe(lambda: several(number)), maybe(lambda: several(word)),
            maybe(lambda: several(lambda: (maybe(number), maybe(word)))),
            maybe(lambda: (maybe(number), maybe(lambda: several(word)))))


# A Python document is a dict; `values` lists what a path holds, nulls left out.
def as_dict(row):
    d = dict(zip(("id", "n", "s", "ns", "ss"), row))
    d["os"] = None if row[5] is None else [None if e is None else {"a": e[0], "b": e[1]} for e in row[5]]
    d["o"] = None if row[6] is None else {"a": row[6][0], "t": row[6][1]}
    return d


def values(doc, path):
    found = [doc]
    for name in path.split("."):
        found = [e.get(name) for e in found if e is not None]
        found = [x for v in found for x in (v if isinstance(v, list) else [v])]
    return [v for v in found if v is not None]


def random_leaf(rng):
    """(Spark predicate of a Doc, Python predicate of a dict)"""
    numeric = rng.random() < 0.5
    path = rng.choice(["n", "ns", "os.a", "o.a"] if numeric else ["s", "ss", "os.b", "o.t"])
    value = (lambda: rng.randint(0, 6)) if numeric else (lambda: rng.choice(WORDS))
    kind = rng.choice(["eq", "ne", "isin", "nin", "has_all", "exists", "missing", "range" if numeric else "string"])
    if kind in ("eq", "ne"):
        v = value()
        hit = lambda d: v in values(d, path)
        return lambda q: getattr(q[path], kind)(v), hit if kind == "eq" else lambda d: not hit(d)
    if kind in ("isin", "nin", "has_all"):
        vs = [value() for _ in range(rng.randint(1, 3))]
        some = lambda d: any(v in values(d, path) for v in vs)
        every = lambda d: all(v in values(d, path) for v in vs)
        return lambda q: getattr(q[path], kind)(vs), {
            "isin": some, "nin": lambda d: not some(d), "has_all": every}[kind]
    if kind in ("exists", "missing"):
        return lambda q: getattr(q[path], kind)(), lambda d: bool(values(d, path)) == (kind == "exists")
    if kind == "range":
        low, high = sorted((value(), value()))
        return (lambda q: q[path].range(gt=low, lte=high),
                lambda d: any(low < v <= high for v in values(d, path)))
    glob = rng.choice(["*", "b*", "*e*", "Blue", "*x"])
    if rng.random() < 0.5:
        return (lambda q: q[path].wildcard(glob),
                lambda d: any(fnmatch.fnmatchcase(v, glob) for v in values(d, path)))
    token = rng.choice(["blue", "ish", "red x", "blu"])

    def has_tokens(d):
        tokens = {t for v in values(d, path) for t in re.findall(r"\w+", v.lower())}
        return set(token.split()) <= tokens

    return lambda q: q[path].text(token), has_tokens


def random_predicate(rng, depth):
    if depth == 0 or rng.random() < 0.3:
        if rng.random() < 0.15:
            a, b = rng.randint(0, 6), rng.choice(WORDS)
            return (lambda q: q["os"].elem_match(lambda e: all_of(e["a"].eq(a), e["b"].ne(b))),
                    lambda d: any(e is not None and e["a"] == a and e["b"] != b for e in d["os"] or []))
        return random_leaf(rng)
    parts = [random_predicate(rng, depth - 1) for _ in range(rng.randint(1, 3))]
    combine, check = rng.choice([
        (all_of, lambda d: all(p(d) for _, p in parts)),
        (any_of, lambda d: any(p(d) for _, p in parts)),
        (none_of, lambda d: not any(p(d) for _, p in parts)),
    ])
    return lambda q: combine(*[s(q) for s, _ in parts]), check


def test_predicates(spark):
    rng = random.Random(11)
    docs = [random_doc(rng, i) for i in range(150)]
    df = spark.createDataFrame(docs, SCHEMA)
    predicates = [random_predicate(rng, 3) for _ in range(120)]
    for at in range(0, len(predicates), 30):
        chunk = predicates[at:at + 30]
        flags = [F.coalesce(make(Doc(df)), F.lit(False)).alias(f"p{i}") for i, (make, _) in enumerate(chunk)]
        got = {r.id: r for r in df.select("id", *flags).collect()}
        for row in docs:
            d = as_dict(row)
            assert [got[row[0]][f"p{i}"] for i in range(len(chunk))] == [check(d) for _, check in chunk], d


def bucket_of(t, unit, n):
    epoch = dt.datetime(1970, 1, 1)
    if unit in ("year", "month"):
        step = n * (12 if unit == "year" else 1)
        months = ((t.year - 1970) * 12 + t.month - 1) // step * step
        return dt.datetime(1970 + months // 12, months % 12 + 1, 1)
    origin = dt.datetime(1969, 12, 29) if unit == "week" else epoch
    width = dt.timedelta(**{unit + "s": n})
    return origin + (t - origin) // width * width


def test_time_buckets(spark):
    rng = random.Random(5)
    times = [dt.datetime(1960, 1, 1) + dt.timedelta(seconds=rng.randint(0, 90 * 365 * 86400),
                                                    microseconds=rng.randint(0, 999999)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    for unit in ("year", "month", "week", "day", "hour", "minute", "second"):
        for n in (1, 2, 7):
            groups = aggregate(df, by_component("t", unit, n), total=True).collect()
            expected = {}
            for t in times:
                expected[bucket_of(t, unit, n)] = expected.get(bucket_of(t, unit, n), 0) + 1
            assert {r.k0: r.total for r in groups} == expected, (unit, n)
    groups = aggregate(df, by_duration("t", "PT1H30M", base=dt.datetime(2000, 1, 1, 0, 7)), total=True).collect()
    assert all((r.k0 - dt.datetime(2000, 1, 1, 0, 7)) % dt.timedelta(minutes=90) == dt.timedelta(0) for r in groups)
    assert sum(r.total for r in groups) == len(times)


def keys_of(doc, kind):
    """Distinct keys a document has under one of the group keys below."""
    if kind == "interval":
        return {v // 2 * 2.0 for v in values(doc, "ns")}
    if kind == "ranges":
        return {i for i, (lo, hi) in enumerate(RANGES) for v in values(doc, "ns")
                if (lo is None or v >= lo) and (hi is None or v < hi)}
    if kind == "tokens":
        return {t for v in values(doc, "ss") for t in re.findall(r"\w+", v.lower())}
    return set(values(doc, "s"))


RANGES = [(None, 3), (2, 5), (5, None), (4, 4)]
KEYS = {"interval": by_interval("ns", 2), "ranges": by_ranges("ns", RANGES),
        "tokens": by_field("ss", analyzer="standard"), "field": by_field("s")}


def test_groups(spark):
    rng = random.Random(23)
    docs = [random_doc(rng, i) for i in range(300)]
    df = spark.createDataFrame(docs, SCHEMA)
    specs, expected = {}, {}
    for name, kinds in {"a": ["interval"], "b": ["ranges", "field"], "c": ["tokens", "ranges"], "d": ["field"],
                        "e": ["interval", "tokens", "field"], "f": []}.items():
        specs[name] = Spec([KEYS[k] for k in kinds], stats={"n": ["sum"], "ns": ["count"]}, total=True)
        groups = {}
        for row in docs:
            d = as_dict(row)
            combos = [()]
            for k in kinds:
                combos = [c + (key,) for c in combos for key in keys_of(d, k)]
            for c in combos:
                total, added, count = groups.get(c, (0, None, 0))
                added = added if d["n"] is None else (added or 0) + d["n"]
                groups[c] = (total + 1, added, count + len(values(d, "ns")))
        expected[name] = groups
    for name, spec in specs.items():
        rows = aggregate(df, spec.by, spec.stats, spec.total).collect()
        got = {tuple(r[f"k{i}"] for i in range(len(spec.by))): (r.total, r.n_sum, r.ns_count) for r in rows}
        assert got == expected[name], name
    long = {n: {} for n in specs}
    for r in aggregate_multi_long(df, specs).collect():
        key = tuple(r[f"k{i}"] for i in range(len(specs[r["name"]].by)))
        long[r["name"]][tuple(map(str, key))] = (r.total, r.n_sum, r.ns_count)
    assert long == {n: {tuple(map(str, k)): v for k, v in g.items()} for n, g in expected.items()}
