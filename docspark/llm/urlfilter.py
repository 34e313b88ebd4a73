"""URL filter lists as of the time of fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.common import staged


def intervals(entries: DataFrame) -> DataFrame:
    """(key, since, until): when keys are on the list; `until` null where they still are.

    `entries` has `key`, `action` (add or remove) and `at`. An entry holds until the key's next one; of
    entries of one time, a removal wins. Null keys, times and other actions are left out.
    """
    known = entries.where("key IS NOT NULL AND at IS NOT NULL AND action IN ('add', 'remove')")
    known = known.groupBy("key", "at").agg(F.max("action").alias("action"))  # remove sorts after add
    following = F.lead("at").over(Window.partitionBy("key").orderBy("at"))
    return known.withColumn("until", following).where("action = 'add'").select("key", F.col("at").alias("since"), "until")


def keys_of(url: Column) -> Column:
    """Keys that a list may hold a URL under: the host and the domains above it, and the host with each leading part of the path.

    The host is in lower case, the path as it is.
    """
    bare = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?|[?#].*$", "")
    host = F.lower(F.regexp_replace(bare, r"[:/].*$", ""))
    labels, parts = F.split(host, r"\."), F.filter(F.split(F.regexp_replace(bare, r"^[^/]*", ""), "/"), lambda x: x != "")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.when(F.size(parts) > 0, F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))
    )).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(domains, paths))


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """`id`, `url`, `at`, `copies`, `blocked` and `rule` of every different capture (`id`, `url`, `at`).

    A capture is blocked by the keys of its URL that are listed at its time: from an entry's time on, until
    the time of the key's removal. `rule` is the longest such key, then the least. The key's entries become
    intervals that do not overlap, so a capture meets a key once at most. They are written first: with a
    shuffle of its own on both sides Spark splits the join at a host with most captures. Captures that are equal give one row with their number in
    `copies`. Null URLs and times match nothing. Empty tables give no rows, or no blocked ones.
    """
    seen = captures.groupBy("id", "url", "at").agg(F.count(F.lit(1)).alias("copies"))
    asked = captures.where("url IS NOT NULL AND at IS NOT NULL").select("id", "url", "at").withColumn("key", F.explode(keys_of(F.col("url"))))
    listed = staged(intervals(entries))
    active = (F.col("at") >= F.col("since")) & (F.col("until").isNull() | (F.col("at") < F.col("until")))
    best = F.min(F.struct(-F.length("key"), "key"))["key"]
    met = asked.join(listed, "key").where(active).groupBy("id", "url", "at").agg(best.alias("rule"))
    met = met.select(F.struct("id", "url", "at").alias("_c"), "rule")
    return seen.withColumn("_c", F.struct("id", "url", "at")).join(met, "_c", "left").select(
        "id", "url", "at", "copies", F.col("rule").isNotNull().alias("blocked"), "rule")
