"""Grouped statistics over event time, on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from docspark.functions.dates import duration_seconds, unit_bucket
from docspark.operators.aggregate import GroupKey, Spec, keyed_rows, measures
from docspark.operators.predicates import Doc


def windowed_stats(
    stream: DataFrame,
    time: str,
    duration: str | tuple[str, int],
    late: str,
    by: list[GroupKey] | None = None,
    stats: str | dict[str, list[str]] | None = None,
) -> DataFrame:
    """`k0` the start of the time bucket, `k1..` the keys in `by`, `total` and statistics.

    Buckets of an ISO-8601 `duration` are fixed-width from the epoch. In append mode one comes out once
    the watermark, `late` behind the newest time seen, has passed its end. Buckets of `(unit, count)`, for
    example `("month", 1)` or `("week", 2)`, are those of `by_component`. There the start of a row's bucket
    carries the watermark: a bucket comes out once a row has come whose bucket starts later, by `late` at
    least, and a row that comes for it afterwards is dropped. Either way state is kept for open
    buckets only, and partial aggregates are what is shuffled.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    if isinstance(duration, str):
        timed = timed.withWatermark(time, f"{duration_seconds(late):f} seconds")
        bucket = F.window(time, f"{duration_seconds(duration):f} seconds").alias("_window")
        start = F.col("_window.start")
    else:
        timed = timed.withColumn("_window", unit_bucket(F.col(time), T.TimestampType(), *duration))
        # not below Spark's unit: with no delay at all a bucket would close while it is the newest
        timed = timed.withWatermark("_window", f"{max(duration_seconds(late), 0.001):f} seconds")
        bucket = start = F.col("_window")
    rows, keys = keyed_rows(timed, by or [])
    renamed = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys, start=1)]
    grouped = rows.groupBy(bucket, *renamed).agg(*measures(Doc(timed), Spec(stats=stats, total=True)))
    return grouped.select(start.alias("k0"), *[c for c in grouped.columns if c != "_window"])
