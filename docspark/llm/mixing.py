"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.common import WORD, staged, text_of

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
#: Steps into which virtual time up to the budget is cut.
STEPS = 4096
_DEAL = 3  # hex digits of the shuffle key that deal a source's documents into slices


def _shuffled(id):
    """The shuffle key of a document."""
    return F.md5(F.coalesce(id.cast("string"), F.lit("")))


def _step(at):
    """The range of virtual time: equal steps up to the level, then logarithmic ones."""
    now = at / F.col("level")
    late = STEPS + F.floor(F.log(now) * STEPS)
    return F.when(F.col("level") <= 0, 0).when(now < 1, F.floor(now * STEPS)).otherwise(late).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Words to take of each source; `sizes` has `source` and `source_size`, one row per source.

    The sources share 150 % of all words by weight; none gets more than twice its own, and what is above
    goes to the others by weight. That is one water level: with the sources in order of 2 size / weight,
    the level is the largest of (budget - what the sources before can take) / (weights from here on).
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ratio = Window.orderBy((2 * F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum(2 * F.col("source_size")).over(ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(ratio.rowsBetween(0, Window.unboundedFollowing))
    everywhere = Window.partitionBy()
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights))
    return (
        sizes.withColumn("weight", weight)
        .withColumn("_budget", F.sum("source_size").over(everywhere) * F.lit(3) / F.lit(2))
        .withColumn("_level", (F.col("_budget") - before) / rest)
        .withColumn("level", F.max("_level").over(everywhere))
        .withColumn("target", F.least((2 * F.col("source_size")).cast("double"), F.col("weight") * F.col("level")))
        .withColumnRenamed("_budget", "budget").drop("_level")
    )


def mixed(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text",
          weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """How often the mix takes each document.

    Every source's documents are shuffled by a hash of their id and offered twice in that order. An offer
    gets the virtual finish time (words of the source so far, its own included) / weight. The offers are
    taken in order of finish time until their words reach the budget. Both running sums have two levels:
    sums by slice of the shuffle key, or by range of virtual time, and then within a slice or within the
    range where the budget ends; a source with most rows, or the whole table, never meets in one task.
    Equal finish times go by source and shuffle key. Reruns agree.

    Returns one row per row of `docs`: `doc_id`, `source`, `size` (words), `source_size`, `target`,
    `finish` (of the first offer), `times` (0 to 2) and `taken` (times * size). Null text has no words; a
    null source is a source, the last. Repeated rows are offers of their own; at the budget's end one can be in and its like out. An
    empty table gives no rows.
    """
    given = F.col(source).cast("string")
    rows = staged(
        docs.select(F.col(id).alias("doc_id"), given.alias("source"),
                    F.when(given.isNull(), "-").otherwise(F.concat(F.lit("+"), given)).alias("_s"),
                    F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("size"),
                    _shuffled(F.col(id)).alias("_key"))
        .withColumn("_slice", F.substring("_key", 1, _DEAL))
    )
    slices = rows.groupBy("_s", "source", "_slice").agg(F.sum("size").alias("_words"))
    plan = targets(slices.groupBy("_s", "source").agg(F.sum("_words").alias("source_size")), weights)
    before = Window.partitionBy("_s").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    slices = slices.drop("source", "_words").join(plan.drop("source"), "_s")

    within = Window.partitionBy("_s", "_slice").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queued = rows.withColumn("_within", F.sum("size").over(within)).join(slices, ["_s", "_slice"])

    def finish(repeat):
        return (F.col("_before") + F.col("_within") + repeat * F.col("source_size")) / F.col("weight")

    queued = staged(queued.select(
        "doc_id", "source", "size", "source_size", "target", "_key", "level", "budget",
        finish(F.lit(0)).alias("finish"), finish(F.lit(1)).alias("_again"),
    ))

    def place(at, repeat):
        return F.struct(at.alias("at"), F.col("source").isNull().alias("n"), "source", "_key", "doc_id", "size",
                        F.lit(repeat).alias("repeat"))

    offers = queued.withColumn("_place", F.explode(F.array(place(F.col("finish"), 0), place(F.col("_again"), 1))))
    offers = offers.select("_place", "size", "budget", _step(F.col("_place.at")).alias("_step"))

    # one row for each range of virtual time, as many at any size of the input
    spent = offers.groupBy("_step", "budget").agg(F.sum("size").alias("_words"))
    upto = Window.orderBy("_step").rowsBetween(Window.unboundedPreceding, 0)
    spent = spent.withColumn("_spent", F.sum("_words").over(upto))
    last = spent.where(F.col("_spent") > F.col("budget")).agg(F.min("_step")).scalar()
    before = spent.where(F.col("_spent") <= F.col("budget")).agg(F.coalesce(F.max("_spent"), F.lit(0))).scalar()

    inside = Window.partitionBy("_step").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        offers.where(F.col("_step") == last).withColumn("_total", before + F.sum("size").over(inside))
        .where(F.col("_total") <= F.col("budget")).agg(F.max("_place")).scalar()
    )

    def within_budget(at, repeat):
        step = _step(at)
        early = last.isNull() | (step < last)
        return F.coalesce(early | ((step == last) & (place(at, repeat) <= cut)), F.lit(False)).cast("int")

    times = within_budget(F.col("finish"), 0) + within_budget(F.col("_again"), 1)
    return queued.select(
        "doc_id", "source", "size", "source_size", "target", "finish", times.alias("times"),
        (times * F.col("size")).cast("long").alias("taken"),
    )


def mix(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text",
        weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The documents of the mix with their columns, each as often as it is taken.

    Rows of equal id, source and size share the number of times that they are taken together: each gets as
    many, and where some are left over, the contents that come first by hash get one more. Null texts have no
    words; documents without words cost nothing and come twice. Null ids and sources are values like others, columns of any name are kept; an empty table gives no rows.
    """
    offered = staged(mixed(docs, id, source, text, weights).groupBy(F.struct("doc_id", "source", "size").alias("_at")).agg(
        F.sum("times").alias("_times"), F.count("*").alias("_rows")).where("_times > 0"))

    def place(of):
        return F.struct(_shuffled(of["doc_id"]).alias("key"), of["doc_id"].alias("doc_id"), of["size"].alias("size"))

    # a source's documents are taken in the order of their places, so its last ones tell of all others, and no text moves
    upto = [F.max(F.when(F.col("_times") >= n * F.col("_rows"), place(F.col("_at")))).alias(f"_upto{n}") for n in (1, 2)]
    bounds = staged(offered.groupBy(F.struct(F.col("_at.source").alias("source")).alias("_of")).agg(*upto))
    at = F.struct(F.col(id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                  F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("size"))
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), at.alias("_at"))
    in_order = [F.coalesce(place(F.col("_at")) <= F.col(f"_upto{n}"), F.lit(False)).cast("int") for n in (1, 2)]
    taken = given.withColumn("_of", F.struct(F.col("_at.source").alias("source"))).join(bounds, "_of")
    taken = taken.select("_row", (in_order[0] + in_order[1]).alias("_n"))
    left = staged(offered.where("_times % _rows <> 0"))  # equal rows on both sides of the budget's end, two of a source at most
    if not left.isEmpty():
        kinds = staged(given.join(left, "_at").groupBy("_at", "_times", "_rows", F.xxhash64("_row").alias("_hash")).agg(
            F.any_value("_row").alias("_row"), F.count("*").alias("_same")))
        so_far = Window.partitionBy("_at").orderBy("_hash").rowsBetween(Window.unboundedPreceding, -1)
        before = kinds.select("_at", "_hash", F.coalesce(F.sum("_same").over(so_far), F.lit(0)).alias("_before"))
        more = F.greatest(F.least(F.col("_times") % F.col("_rows") - F.col("_before"), F.col("_same")), F.lit(0))
        taken = taken.unionByName(kinds.join(before, ["_at", "_hash"]).select("_row", more.cast("int").alias("_n")))
    return taken.where("_n > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_row.*")
