"""Continuous upsert of a stream of documents into a collection."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from docspark.operators.mutate import content_hash
from docspark.sources.collection import Collection


def newest_by_key(stream: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The rows of a stream that are the newest of their key so far, by `order_by`; for `outputMode("update")`.

    The state holds the newest row of each key. A batch gives the rows that replace it: not one that
    comes late, nor one that repeats the newest. Of equal `order_by` the greatest content hash is the newest.
    """
    given = stream.withColumn("_at", F.current_timestamp())  # one time for a batch, the same if it runs again
    row = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    # of equal rows the first to come is the newest, so that a repeat does not win
    rank = F.struct(*[F.col(f"`{c}`") for c in order_by], content_hash(stream), -F.unix_micros("_at"))
    state = given.groupBy(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]).agg(
        F.max_by(row, rank).alias("_row"), F.max_by("_at", rank).alias("_won"), F.max("_at").alias("_seen"))
    return state.where("_won = _seen").select("_row.*")


def upsert_stream(stream: DataFrame, target: Collection, checkpoint: str,
                  order_by: list[str] | None = None) -> DataStreamWriter:
    """A writer whose every micro-batch appends its changes to the collection, and reads nothing of it.

    With `order_by`, or a column `_seq`, the stream keeps the newest row of each key as state, in the checkpoint, and a
    batch writes only the documents that are newer: late old ones and repeats are not written. Hooks
    before the save are then applied to the stream itself. Without it the last batch wins. A batch that runs again after a failure
    replaces what it had written. For many keys set `spark.sql.streaming.stateStore.providerClass` to
    RocksDB's. Start the writer with the trigger you want.
    """
    order = order_by or [c for c in ["_seq"] if c in stream.columns]
    name = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    documents = newest_by_key(target.prepared(stream), ["_id", "_routing"], order) if order else stream

    def save(batch: DataFrame, batch_id: int) -> None:
        target.save(batch if order else target.prepared(batch), order, source=f"{name}-{batch_id}")

    writer = documents.writeStream.option("checkpointLocation", checkpoint)
    return writer.outputMode("update" if order else "append").foreachBatch(save)
