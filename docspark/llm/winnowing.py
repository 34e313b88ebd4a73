"""Document fingerprints by winnowing, with Spark's own functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.common import let, staged, text_of

#: Bytes of a gram, and grams of a window as a power of two.
GRAM, DOUBLINGS = 24, 4
#: Windows worked on at once: intermediate arrays are of this length, however long the text.
PIECE = 4096
_LOW = 32  # bits below the hash that hold the place
_PLACES = (1 << _LOW) - 1


def reach(gram: int = GRAM, doublings: int = DOUBLINGS) -> int:
    """Bytes that guarantee a match: an equal string of this length in two texts has an equal mark in both."""
    return (1 << doublings) + gram - 1


def _lesser(step: int):
    """Of an array, the lesser of each element and the one `step` places on."""
    return lambda a: F.zip_with(a, F.slice(a, F.lit(step + 1), F.size(a)), lambda x, y: F.least(x, y))


def _selected(data: Column, offset: Column | None, gram: int, doublings: int) -> Column:
    """Marks of the windows of these bytes, which start `offset` bytes (none: 0) into the text."""
    window = 1 << doublings

    def of_piece(start: Column) -> Column:
        def of_bytes(piece: Column) -> Column:
            size = F.octet_length(piece)
            grams = F.greatest(size - (gram - 1), F.lit(1))
            # the hash above, the bytes from the gram to the piece's end below it: of equal hashes the rightmost is least.
            # Grams are counted from the end, by i < 0, so what is added is positive: the least hash of all has no room below it
            least = F.transform(F.sequence(-size, grams - 1 - size), lambda i: F.shiftleft(
                F.xxhash64(F.substring(piece, i, F.lit(gram))), _LOW) - i)
            for j in range(doublings):  # the least of 2, 4, 8 ... grams from each place
                least = let(least, _lesser(1 << j))
            marks = F.array_distinct(F.slice(least, F.lit(1), F.greatest(grams - (window - 1), F.lit(1))))
            # places in the text are for the marks that are left, a few of the grams
            end = size + (start if offset is None else start + offset)
            return let(F.lit(_PLACES) - end, lambda rest: F.transform(marks, lambda m: m + rest))

        return let(F.substring(data, start + 1, F.lit(PIECE + window + gram - 2)), of_bytes)

    windows = F.greatest(F.octet_length(data) - (gram - 1) - (window - 1), F.lit(1))
    pieces = F.transform(F.sequence(F.lit(0), windows - 1, F.lit(PIECE)), of_piece)
    return F.when(F.octet_length(data) == 0, F.array().cast("array<bigint>")).otherwise(F.array_distinct(F.flatten(pieces)))


def fingerprint(text: Column, gram: int = GRAM, doublings: int = DOUBLINGS) -> Column:
    """The marks of a text, ascending by place: `hash_of` and `place_of` read them.

    Every run of `gram` bytes of UTF-8 is hashed as the run rolls over the text. Of each window of
    2 ** doublings runs the one of least hash is kept, the rightmost of equals, with its place in bytes. A
    text of fewer runs is one window; one of fewer bytes than a run is one run; an empty or null text has no marks.
    """
    return let(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), lambda b: _selected(b, None, gram, doublings))


def continued(marks: Column, text: Column, kept: Column, gram: int = GRAM, doublings: int = DOUBLINGS) -> Column:
    """The fingerprint of `text`, whose first `kept` bytes are those of the text that `marks` come from.

    Only windows that reach beyond those bytes are hashed anew, and one window's length before them.
    """
    last = kept - reach(gram, doublings)  # windows that start up to here are inside

    def of_bytes(data: Column) -> Column:
        start = F.greatest(last - (1 << doublings) + 1, F.lit(0))
        rest = let(F.substring(data, start + 1, F.octet_length(data)), lambda b: _selected(b, start, gram, doublings))
        return F.array_distinct(F.concat(F.filter(marks, lambda m: place_of(m) <= last), rest))

    return let(F.encode(text, "UTF-8"), of_bytes)


def place_of(mark: Column) -> Column:
    """Where the run of bytes starts."""
    return F.lit(_PLACES) - mark.bitwiseAND(F.lit(_PLACES))


def hash_of(mark: Column) -> Column:
    """Hash of the run of bytes, as 32 bits."""
    return F.shiftright(mark, _LOW)


def likeness(a: Column, b: Column) -> Column:
    """Share of the different hashes of two fingerprints that both have, 0 to 1; 1 if both are empty."""
    hashes = lambda marks: F.array_distinct(F.transform(marks, hash_of))

    def of_pair(pair: Column) -> Column:
        both, x, y = F.size(F.array_intersect(pair["x"], pair["y"])), F.size(pair["x"]), F.size(pair["y"])
        return F.when(x + y == 0, F.lit(1.0)).otherwise(both / F.greatest(x + y - both, F.lit(1)))

    return let(F.struct(hashes(a).alias("x"), hashes(b).alias("y")), of_pair)


def written(marks: Column) -> Column:
    """A fingerprint as text: `hash@place` in hexadecimal and decimal digits, with blanks between."""
    return F.array_join(F.transform(marks, lambda m: F.concat(
        F.lower(F.hex(hash_of(m).bitwiseAND(F.lit(0xFFFFFFFF)))), F.lit("@"), place_of(m).cast("string"))), " ")


def with_next(docs: DataFrame, id: str = "doc_id", text: str = "text", gram: int = GRAM, doublings: int = DOUBLINGS) -> DataFrame:
    """Each document's fingerprint beside the text and fingerprint of the next by descending id; the first follows the last.

    Rows of one id go by hash and text, null ids last. Keys, without texts, are range-partitioned first; the
    first key of each range, four to a shuffle partition, bounds the ranges that texts are then dealt by. A
    range's first row is sent to the range before as well, so that each range is worked on alone.

    Returns `doc_id`, `text` (null is empty), `marks`, `next_text`, `next_marks`, one row per row of `docs`; a single
    document follows itself, an empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id).alias("doc_id"), text_of(text).alias("text")).withColumn("_hash", F.xxhash64("text"))
    key = F.struct("doc_id", "_hash")
    order = [F.desc_nulls_last("doc_id"), F.desc("_hash")]
    firsts = staged(
        rows.select("doc_id", "_hash").repartitionByRange(ranges, *order)
        .groupBy(F.spark_partition_id().alias("_range")).agg(F.max(key).alias("first"))
    )
    bounds = firsts.agg(F.sort_array(F.collect_list("first"), asc=False)).scalar()  # at most `ranges` of them
    steps = [F.lit(1 << i) for i in reversed(range(ranges.bit_length()))]

    def homes(bounds: Column) -> Column:
        # how many ranges begin at the row's key or before it, by binary search
        found = F.aggregate(F.array(*steps), F.lit(0), lambda n, step: F.when(
            (n + step <= F.size(bounds)) & (F.get(bounds, n + step - 1) >= key), n + step).otherwise(n))

        def of(n: Column) -> Column:
            own = F.struct((n - 1).alias("range"), F.lit(False).alias("wraps"), F.lit(True).alias("own"))
            before = F.when(n == 1, F.size(bounds) - 1).otherwise(n - 2)
            before = F.struct(before.alias("range"), (n == 1).alias("wraps"), F.lit(False).alias("own"))
            return F.array_compact(F.array(own, F.when(F.get(bounds, n - 1) == key, before)))

        return let(found, of)

    placed = rows.withColumn("_bounds", bounds).withColumn("_at", F.explode(homes(F.col("_bounds"))))
    placed = placed.select("doc_id", "text", "_hash", "_at.*").repartition("range")
    within = [F.asc("wraps"), *order, F.desc("text")]
    placed = placed.sortWithinPartitions("range", *within).withColumn("marks", fingerprint(F.col("text"), gram, doublings))
    follows = Window.partitionBy("range").orderBy(*within)
    return (
        placed.withColumns({"next_text": F.lead("text").over(follows), "next_marks": F.lead("marks").over(follows)})
        .where("own").select("doc_id", "text", "marks", "next_text", "next_marks")
    )
