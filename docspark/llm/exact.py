"""Exact deduplication by content sort."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import small_batches, staged, text_of, without_white

#: Code points of a text that splitters carry; the digest behind them tells longer common heads apart.
HEAD = 32

_COLUMNS = ["_id", "_chars", "_digest", "_row", "_keep", "_size", "_part", "_head", "_edge"]
_RUNS = "_id {id}, _chars int, _digest string, _row {row}, _keep {id}, _size long, _part int, _head boolean, _edge boolean"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mark the runs of equal neighbours in one sorted partition.

    Of the run that is still open only ids, lengths and digests are held, never texts; payload stays
    with the first row of a run.
    """
    part, first_run = TaskContext.get().partitionId(), True
    held: list[pa.Table] = []
    last: pa.Scalar | None = None

    def closed(rows: pa.Table, at_end: bool) -> Iterator[pa.RecordBatch]:
        nonlocal first_run
        starts = rows["_new"].to_numpy().copy()
        starts[0] = True
        heads = np.flatnonzero(starts)
        sizes = np.diff(np.append(heads, len(starts)))
        edge = np.zeros(len(heads), bool)
        edge[0] |= first_run
        edge[-1] |= at_end
        first_run = False
        out = [
            rows["_id"], rows["_chars"], rows["_digest"], rows["_row"],
            rows["_id"].take(pa.array(np.repeat(heads, sizes))), pa.array(np.repeat(sizes, sizes), pa.int64()),
            pa.array(np.full(len(starts), part), pa.int32()), pa.array(starts), pa.array(np.repeat(edge, sizes)),
        ]
        yield from pa.table(out, names=_COLUMNS).to_batches(max_chunksize=4096)

    for batch in batches:
        if not batch.num_rows:
            continue
        norm = batch["_norm"]
        new = np.ones(batch.num_rows, bool)
        if batch.num_rows > 1:
            new[1:] = pc.not_equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False)
        if last is not None:
            new[0] = norm[0].as_py() != last.as_py()
        last = norm[-1]
        row = pc.if_else(pa.array(new), batch["_row"], pa.scalar(None, batch["_row"].type))
        rows = pa.table([batch["_id"], batch["_chars"], batch["_digest"], row, pa.array(new)],
                        names=["_id", "_chars", "_digest", "_row", "_new"])
        cuts = np.flatnonzero(new)
        if held and cuts.size:
            yield from closed(pa.concat_tables([*held, rows[: cuts[0]]]), False)
            held = []
        elif not cuts.size:
            held.append(rows)
            continue
        if cuts[0] < cuts[-1]:
            yield from closed(rows[cuts[0]: cuts[-1]], False)
        held = [rows[cuts[-1]:]]
    if held:
        yield from closed(pa.concat_tables(held), True)


def equal_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Groups of documents with equal text, white space apart.

    The rows are range-partitioned and sorted by their normalised text, which spills to disk, and
    neighbours are compared in full. Splitters are sampled from the first code points of the text, its
    digest, length and id: the sample that reaches the driver is small however long the texts are, and a
    group of any size is spread over as many partitions as its rows fill. The at most two groups of a
    partition that reach its border are joined to their parts elsewhere by digest.

    Returns one row per row of `docs`: `_id`, `_keep` (the id that stays: the longest text, then the
    smallest id, null last), `_size`, `_kept`, `_digest` (SHA-256 of the normalised text) and, with
    `carry`, `_row`: the columns of the row, for the kept rows at least, whatever their names. Null text
    counts as empty. Exactly one row of a group is kept, also where rows or ids repeat. An empty table
    gives no rows.
    """
    norm = without_white(text_of(text))
    # a text moves once: where the row goes along, its normalised text is made again on the other side
    moved = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row") if carry else norm.alias("_norm")
    keyed = docs.select(
        F.col(id).alias("_id"), F.length(text_of(text)).alias("_chars"), F.substring(norm, 1, HEAD).alias("_start"),
        F.sha2(F.encode(norm, "UTF-8"), 256).alias("_digest"), moved)
    content = without_white(text_of(f"_row.{text}")) if carry else F.col("_norm")
    order = [F.col("_start"), F.col("_digest"), F.col("_chars").desc(), F.col("_id").asc_nulls_last()]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order[:2], content, *order[2:])
    ranged = ranged.select("_id", "_chars", F.col("_row") if carry else F.lit(None).cast("boolean").alias("_row"), content.alias("_norm"), "_digest")
    kinds = dict(ranged.select("_id").dtypes)
    schema = _RUNS.format(id=kinds["_id"], row=ranged.schema["_row"].dataType.simpleString())
    with small_batches(docs.sparkSession):
        runs = staged(ranged.mapInArrow(_runs, schema))

    best = F.min(F.struct(-F.col("_chars"), F.col("_id").isNull(), F.col("_id").alias("id"), F.col("_part").alias("part")))
    edges = runs.where("_edge and _head").groupBy("_digest").agg(F.sum("_size").alias("_all"), best.alias("_best"))
    # at most two rows for each partition of the sort
    joined = runs.join(F.broadcast(edges), "_digest", "left")
    inner = ~F.col("_edge")
    return joined.select(
        "_id", F.when(inner, F.col("_keep")).otherwise(F.col("_best.id")).alias("_keep"),
        F.when(inner, F.col("_size")).otherwise(F.col("_all")).alias("_size"),
        (F.col("_head") & (inner | (F.col("_part") == F.col("_best.part")))).alias("_kept"), "_digest", "_row",
    )


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, one of each group of equal texts, with their columns."""
    return equal_groups(docs, id, text, carry=True).where("_kept").select("_row.*")
