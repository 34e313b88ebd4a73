"""N-gram Jaccard join by set-relation skipping."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import FEW, picked, released, small_batches, staged, text_of
from docspark.llm.components import components

#: Shingles whose frequency is known when they are put in order; the most frequent ones. It bounds what
#: the driver and every task hold (16 bytes each); the order of the others is by hash. Any order gives
#: the same result.
RANKED = 1 << 22
#: Frequencies are counted in blocks of so many shingles; one that a block has less often is left out.
BLOCK, SEEN = 4 << 20, 2
#: Leaders of each index block that its sets are compared with first; any number gives the same result. With few, many sets
#: of a large group of near copies have no link yet and meet all of the group.
LEADERS = 8
#: 64-bit words of the marks that tell sets apart before their shingles are fetched.
MARKS = 8
#: Words whose hash a worker remembers.
REMEMBERED = 200_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()


def _spread(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, width: int) -> np.ndarray:
    """The set of 64-bit hashes of the text's runs of `width` words, A-Z in lower case, ascending.

    A text of fewer words has one, of all its words; a text without words none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters, ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = _spread(out + hashes[i:len(words) - width + 1 + i])
    return np.unique(out)


def set_id(values: np.ndarray) -> int:
    """A 64-bit id of the set; equal sets have equal ids."""
    return xxhash.xxh3_64_intdigest(values.tobytes()) - (1 << 63)


def marks(values: np.ndarray) -> np.ndarray:
    """For each of 64 * MARKS cells of the shingle hashes, whether the set has an odd number in it.

    Two sets differ in as many shingles at least as their marks differ in cells.
    """
    odd = np.bincount((values >> np.uint64(17)).astype(np.int64) % (64 * MARKS), minlength=64 * MARKS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[object, np.ndarray]]:
    for batch in batches:
        for id, text in zip(batch["id"], batch["text"]):
            yield id, shingles(text.as_py(), width)


def scanned(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(id, n, sid, marks) of every document, and (token, seen): how often blocks have their frequent shingles."""
    kind = dict(docs.dtypes)["id"]

    def run(batches):
        pending, size = [], 0

        def counted() -> pa.RecordBatch:
            block = np.concatenate(pending)
            pending.clear()
            block.sort()  # in place: a task holds two copies of a block at most
            again = np.flatnonzero(block[SEEN - 1:] == block[:len(block) - SEEN + 1]) if SEEN <= len(block) else np.empty(0, np.int64)
            token = np.unique(block[again])
            seen = np.searchsorted(block, token, "right") - np.searchsorted(block, token)
            none = pa.nulls(len(token))
            return pa.record_batch([none.cast(arrow), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.list_(pa.int64())), _signed(token),
                                    pa.array(seen)], names=["id", "n", "sid", "marks", "token", "seen"])

        for batch in batches:
            arrow, ns, sids, cells = batch["id"].type, [], [], []
            for text in batch["text"]:
                values = shingles(text.as_py(), width)
                ns.append(len(values))
                sids.append(set_id(values))
                cells.append(marks(values))
                pending.append(values)
                size += len(values)
                if size >= BLOCK:
                    yield counted()
                    size = 0
            none = pa.nulls(len(ns), pa.int64())
            yield pa.record_batch([batch["id"], pa.array(ns, pa.int64()), pa.array(sids, pa.int64()), pa.array(cells, pa.list_(pa.int64())), none, none],
                                  names=["id", "n", "sid", "marks", "token", "seen"])
        if size:
            yield counted()

    rows = staged(docs.mapInArrow(run, f"id {kind}, n long, sid long, marks array<long>, token long, seen long"))
    return rows.where("token IS NULL").select("id", "n", "sid", "marks"), rows.where("token IS NOT NULL").select("token", "seen")


def ranked(seen: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The at most RANKED most frequent shingles, ascending, and the power of two of their frequency."""
    total = seen.groupBy("token").agg(F.floor(F.log2(F.sum("seen"))).cast("int").alias("power"))
    by_power, room, least = total.groupBy("power").count().orderBy(F.col("power").desc()).collect(), RANKED, 99
    for power, count in by_power:  # a row for each power of two
        room -= count
        if room < 0:
            break
        least = power
    rows = total.where(F.col("power") >= least).toArrow()
    token = rows["token"].to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], rows["power"].to_numpy().astype(np.int8)[order]


def postings(docs: DataFrame, width: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(token, sid, n, pos): the rarest shingles of each set, as many as two similar sets must share one of."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        common, power = shared.value
        for batch in batches:
            done, out = set(), []
            for text in batch["text"]:
                values = shingles(text.as_py(), width)
                n, sid = len(values), set_id(values)
                if not n or sid in done:
                    continue
                done.add(sid)
                rank = np.zeros(n, np.int8)
                if len(common):
                    at = np.minimum(np.searchsorted(common, values), len(common) - 1)
                    rank = np.where(common[at] == values, power[at], 0)
                head = values[np.argsort(rank, kind="stable")[: n + (-percent * n) // 100 + 1]]
                out.append((head, sid, n))
                if len(out) >= 1000:
                    yield _posted(out)
                    out = []
            if out:
                yield _posted(out)

    return docs.mapInArrow(run, "token long, sid long, n long, pos long")


def _posted(rows: list[tuple[np.ndarray, int, int]]) -> pa.RecordBatch:
    lengths = [len(r[0]) for r in rows]
    return pa.record_batch(
        [_signed(np.concatenate([r[0] for r in rows])), pa.array(np.repeat([r[1] for r in rows], lengths)),
         pa.array(np.repeat([r[2] for r in rows], lengths)), pa.array(np.concatenate([np.arange(k) for k in lengths]))],
        names=["token", "sid", "n", "pos"],
    )


def contents(docs: DataFrame, width: int) -> DataFrame:
    """(sid, tokens) of each document."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                values = [shingles(t.as_py(), width) for t in batch["text"][at:at + 256]]
                offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(offsets), _signed(np.concatenate(values)))
                yield pa.record_batch([batch["sid"][at:at + 256], tokens], names=["sid", "tokens"])

    return docs.mapInArrow(run, "sid long, tokens array<long>")


def _needed(n1: Column, n2: Column, percent: int) -> Column:
    """Shingles that sets of these sizes share at least if they are similar."""
    return F.ceil((percent * (n1 + n2)).cast("double") / (100 + percent) - 1e-9)


def _in_reach(percent: int) -> Column:
    """Two postings of a shingle, at `pos_a` and `pos_b`, that similar sets can have; it skips all others.

    Sizes must fit, and before any shingle that similar sets share each has only so many of its own.
    """
    needed, ahead = _needed(F.col("n_a"), F.col("n_b"), percent), F.col("pos_a") - F.col("pos_b")
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return sizes & (ahead <= F.col("n_a") - needed) & (-ahead <= F.col("n_b") - needed)


def _fewest(percent: int) -> Column:
    """Postings that similar sets share at least.

    Of the shingles a set is posted under, at most size - needed are its own; the first of two sets to run
    out of postings shares all its others with the other set's postings.
    """
    return _needed(F.col("n_a"), F.col("n_b"), percent) + 1 - F.ceil((percent * F.greatest("n_a", "n_b")) / 100 - 1e-9)


def _passed(percent: int) -> Column:
    """Postings at the end of both sets that need not be looked at: the others still share a quarter of `_fewest`.

    Shingles are in one order in all sets, so leaving out the last ones of either loses the same last shared ones.
    """
    return F.floor(F.greatest(_fewest(percent), F.lit(0)) * 0.75)


def _early(percent: int) -> Column:
    posted = lambda n: n - F.ceil((percent * n) / 100 - 1e-9) + 1
    passed = _passed(percent)
    return (F.col("pos_a") < posted(F.col("n_a")) - passed) & (F.col("pos_b") < posted(F.col("n_b")) - passed)


def _maybe_early(percent: int) -> Column:
    """The posting at `pos` is an early one beside some set of a size from `_n_least` to `_n_most`, as far as sizes tell.

    `_fewest` grows with the lesser size and falls with the greater, so that the two extremes bound it.
    """
    n, share = F.col("n"), percent / (100 + percent)
    lesser, greater = F.greatest(F.col("_n_least"), n * (percent / 100)), F.least(F.col("_n_most"), n / (percent / 100))
    fewest = F.least((lesser + n) * share - n * (percent / 100), (n + greater) * share - greater * (percent / 100))
    passed = F.floor(F.greatest(fewest - 1e-6, F.lit(0.0)) * 0.75)
    return F.col("pos") < n - F.ceil((percent * n) / 100 - 1e-9) + 1 - passed


def _alike(percent: int) -> Column:
    """The marks do not rule out that the sets are similar."""
    apart = [F.bit_count(F.get("marks_a", F.lit(i)).bitwiseXOR(F.get("marks_b", F.lit(i)))) for i in range(MARKS)]
    return reduce(lambda a, b: a + b, apart) <= F.col("n_a") + F.col("n_b") - 2 * _needed(F.col("n_a"), F.col("n_b"), percent)


def _block(n: Column, percent: int) -> Column:
    """Similar sets are in one block or in adjacent ones."""
    return F.floor(F.log(n.cast("double")) / -np.log(percent / 100 - 0.01))


def _often(met: DataFrame, percent: int, early: bool = False) -> DataFrame:
    """The pairs (a, b, n_a, n_b) that meet under enough shingles, or under enough of the early ones."""
    fewest = _fewest(percent) - (_passed(percent) if early else 0)
    counted = met.groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("_met"))
    return counted.where(F.col("_met") >= fewest).drop("_met")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, n_a, n_b) with `both`, the shingles they share."""
    left = pairs.join(sets.toDF("a", "tokens_a"), "a").join(sets.toDF("b", "tokens_b"), "b")
    return left.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long").alias("both"))


def _linked(percent: int) -> Column:
    return 100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))


def _ends(*more: Column) -> list[Column]:
    """Aggregates of postings with `n` and `pos`: how many, and the least and the greatest of them."""
    at = F.shiftleft(F.col("n"), 32) + F.col("pos")
    return [F.count(F.lit(1)).alias("_all"), F.min(at).alias("_least"), F.max(at).alias("_most"), *more]


def _two(groups: DataFrame) -> DataFrame:
    """The groups of `_ends` with n_a, pos_a, n_b and pos_b: both postings, where there are two."""
    pair = {f"{c}_{x}": f(F.col(of)) for of, x in (("_least", "a"), ("_most", "b"))
            for c, f in (("n", lambda v: F.shiftright(v, 32)), ("pos", lambda v: v.bitwiseAND(F.lit((1 << 32) - 1))))}
    return groups.withColumns(pair)


def met_lists(posted: DataFrame, percent: int) -> DataFrame:
    """(token, block, sid, n, pos) of `met_groups`."""
    return met_groups(posted, percent).drop("pair")


def met_groups(posted: DataFrame, percent: int) -> DataFrame:
    """(token, block, sid, n, pos, pair): each posting once in each block of its shingle where it can meet a similar set.

    A block has two sets at least and one of its own size, as pairs without such a one meet in the block before; of a
    block of two, sizes and positions are to be those of similar sets, and `pair` has both sets and sizes. All uses of the
    postings read one shuffle; a shingle's postings are in one task, as a stream.
    """
    dealt, block = posted.repartition("token"), _block(F.col("n"), percent)
    own = F.max(F.col("block") == block).alias("_own")
    groups = dealt.withColumn("block", F.explode(F.array(block, block + 1))).groupBy("token", "block").agg(
        *_ends(F.min("sid").alias("_a"), F.max("sid").alias("_b"), own)).where("_own and _a < _b")
    once = F.col("block") == _block(F.greatest("n_a", "n_b"), percent)
    open_ = _two(groups).where((F.col("_all") > 2) | (once & _in_reach(percent)))
    pair = F.when(F.col("_all") == 2, F.struct(F.col("_a").alias("a"), F.col("_b").alias("b"), "n_a", "n_b")).alias("pair")
    open_ = open_.groupBy("token").agg(F.collect_list(F.struct("block", pair)).alias("_blocks"))
    lists = dealt.join(open_, "token").select("token", "sid", "n", "pos", "_blocks").distinct()
    own_blocks = F.filter("_blocks", lambda x: x["block"].isin(block, block + 1))
    return lists.withColumn("_in", F.explode(own_blocks)).select("token", "_in.block", "sid", "n", "pos", "_in.pair")


def parted(lists: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The lists of larger groups, and of the groups of two the pairs (a, b, n_a, n_b) that may be similar, each once.

    Groups of two grow in number faster than the input, so none goes on as postings: a pair of one is compared, unless it
    meets too seldom to be similar even if in all larger groups of either set.
    """
    larger = lists.where("pair IS NULL").groupBy("sid", "block").agg(F.count(F.lit(1)).alias("_larger"))
    twos = lists.where("sid = pair.a").withColumn("n_b", F.col("pair.n_a") + F.col("pair.n_b") - F.col("n"))
    pairs = twos.groupBy("pair.a", "pair.b", F.col("n").alias("n_a"), "n_b", "block").agg(F.count(F.lit(1)).alias("_met"))
    for x in ("a", "b"):
        pairs = pairs.join(larger.toDF(x, "block", f"_larger_{x}"), [x, "block"], "left")
    most = F.col("_met") + F.least(*[F.coalesce(f"_larger_{x}", F.lit(0)) for x in ("a", "b")])
    pairs = staged(pairs.where(most >= _fewest(percent)).select("a", "b", "n_a", "n_b"))
    return lists.where("pair IS NULL").drop("pair"), pairs


def linked_sets(docs: DataFrame, ids: DataFrame, lists: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, component) of the sets that have a similar one; `lists` and `pairs` are those of `parted`.

    Index blocks: the postings of a shingle, cut by set size so that similar sets meet in a block.
    1. The sets of a block are compared with its leaders only, those with the least hash of their id,
       where sizes, positions, the number of blocks they meet in and their marks allow it, and the pairs of groups of two. A set that is
       linked to a leader shares its component, so no more answers among them are needed.
    2. Of the sets of a block that are still apart, those outside its largest component are compared with
       the others, where their marks allow it. A pair is skipped where what both share with a leader already tells that they cannot be
       similar: they share at most both(x, leader) + |y| - both(y, leader).
    """
    spark = lists.sparkSession
    lead = [F.min(F.struct(F.xxhash64("sid", F.lit(i)).alias("h"), F.col("sid").alias("sid"), F.col("n").alias("n"),
                           F.col("pos").alias("pos"))) for i in range(LEADERS)]
    leaders = lists.groupBy("token", "block").agg(F.array(*lead).alias("_lead"))
    stars = lists.join(leaders, ["token", "block"]).withColumn("_lead", F.explode(
        F.array_distinct(F.transform("_lead", lambda x: x.dropFields("h")))))
    stars = stars.select("block", F.col("sid").alias("a"), F.col("_lead.sid").alias("b"), F.col("n").alias("n_a"),
                         F.col("_lead.n").alias("n_b"), F.col("pos").alias("pos_a"), F.col("_lead.pos").alias("pos_b"))
    once = F.col("block") == _block(F.greatest("n_a", "n_b"), percent)  # sets of one block meet in two
    stars = _often(stars.where((F.col("a") != F.col("b")) & once & _in_reach(percent)), percent).unionByName(pairs).distinct()
    owners = ids.groupBy("sid").agg(F.min("id").alias("id"))
    cells = staged(ids.groupBy("sid").agg(F.any_value("marks").alias("marks")))
    stars = stars.join(cells.toDF("a", "marks_a"), "a").join(cells.toDF("b", "marks_b"), "b").where(_alike(percent))
    stars = staged(stars.select("a", "b", "n_a", "n_b"))

    def fetched(sids: DataFrame) -> DataFrame:
        wanted = staged(sids.join(owners, "sid"))
        return staged(contents(picked(docs, wanted, "id").select("sid", "text"), width))

    starred = stars.select("a").union(stars.select("b")).distinct().toDF("sid")
    sets = fetched(starred)
    first = staged(verified(stars, sets))
    part = components(first.where(_linked(percent)).select("a", "b"))

    placed = lists.join(part.toDF("sid", "c"), "sid", "left").withColumn("c", F.coalesce("c", "sid"))
    # before marks are joined: groups of two that cannot be similar go, by sizes, positions and block, as below
    share = placed.groupBy("token", "block", "c").agg(*_ends())
    largest = share.groupBy("token", "block").agg(
        F.count(F.lit(1)).alias("_cs"), F.max(F.struct("_all", "c"))["c"].alias("_main"), F.sum("_all").alias("_all"),
        F.min("_least").alias("_least"), F.max("_most").alias("_most"))
    largest = _two(largest.where("_cs > 1")).where((F.col("_all") > 2) | (once & _in_reach(percent) & _early(percent)))
    largest = largest.select("token", "block", "_main", F.col("n_a").alias("_n_least"), F.col("n_b").alias("_n_most"))
    placed = placed.join(largest, ["token", "block"]).where(_maybe_early(percent)).drop("_n_least", "_n_most")
    placed = staged(placed.join(cells, "sid"))
    odd = placed.where("c != _main").select("token", "block", F.col("sid").alias("a"), F.col("n").alias("n_a"),
                                            F.col("pos").alias("pos_a"), "c", F.col("marks").alias("marks_a"))
    rest = placed.select("token", "block", F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"),
                         F.col("c").alias("c_"), "_main", F.col("marks").alias("marks_b"))
    apart = (F.col("c") != F.col("c_")) & ((F.col("c_") == F.col("_main")) | (F.col("a") < F.col("b")))
    met = odd.join(rest, ["token", "block"]).where(apart & once & _in_reach(percent) & _early(percent) & _alike(percent))
    swapped = F.col("a") > F.col("b")
    met = met.select(*[F.when(swapped, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("b", "a"), ("n_a", "n_b"), ("n_b", "n_a"))])
    met = staged(_often(met, percent, early=True))

    known = first.select(F.col("a").alias("x"), F.col("b").alias("leader"), F.col("both").alias("both"))
    own = first.select(F.col("b").alias("x"), F.col("b").alias("leader"), F.col("n_b").alias("both")).distinct()
    known = known.union(own).groupBy("x").agg(F.collect_set(F.struct("leader", "both")).alias("k"))
    limits = F.flatten(F.transform("k_a", lambda p: F.transform(
        F.filter("k_b", lambda q: q["leader"] == p["leader"]),
        lambda q: F.least(p["both"] + F.col("n_b") - q["both"], q["both"] + F.col("n_a") - p["both"]))))
    bound = met.join(known.toDF("a", "k_a"), "a", "left").join(known.toDF("b", "k_b"), "b", "left")
    bound = bound.withColumn("_most", F.array_min(limits))
    open_ = bound.where(
        F.col("_most").isNull() | (F.col("_most") >= _needed(F.col("n_a"), F.col("n_b"), percent))).select("a", "b", "n_a", "n_b")
    open_ = staged(open_)
    more = open_.select("a").union(open_.select("b")).distinct().toDF("sid").join(starred, "sid", "left_anti")
    other = fetched(more)
    second = staged(verified(open_, sets.union(other)))
    links = first.union(second).where(_linked(percent)).select("a", "b")
    result = staged(components(links))
    released(spark, stars, cells, sets, first, placed, met, open_, other, second)
    return result


def similar(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """`id`, `n` (distinct shingles) and `component` (the smallest id reachable by links) of every row.

    Two documents link when 100 * shared shingles >= percent * all shingles of both. Copies, documents of
    equal sets, are one set from the first scan on; their links are not spelled out. Sets are compared by
    64-bit hashes of their shingles. Shingles are put in order of their frequency, the rarest first, and
    each set is posted under so many of its first that similar sets share one; see `linked_sets`.

    Null and empty texts have no shingles and link with nothing, also not with each other: each is a
    component of its own. Repeated rows with one id are that document, and appear as often. A null id is
    its own component null. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id).alias("id"), text_of(text).alias("text"))
    with small_batches(spark):
        ids, seen = scanned(given, width)
        posted = staged(postings(given, width, percent, ranked(seen)))
        met = staged(met_groups(posted, percent))
        released(spark, posted)
        lists, pairs = parted(met, percent)
        nodes = linked_sets(given, ids, lists, pairs, width, percent)
    sets = ids.where("n > 0").groupBy("sid").agg(F.min("id").alias("_id"))
    sets = sets.join(nodes.toDF("sid", "_c"), "sid", "left").withColumn("_c", F.coalesce("_c", "sid"))
    reach = sets.groupBy("_c").agg(F.min("_id").alias("_first"))
    named = staged(sets.join(reach, "_c").select("sid", "_first"))
    released(spark, met, pairs, nodes)
    out = ids.join(named, "sid", "left")
    return out.select("id", "n", F.when(F.col("n") > 0, F.col("_first")).otherwise(F.col("id")).alias("component"))


def drop_similar(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component of similar ones, the one of the smallest id, with its columns."""
    found = similar(docs, id, text, width, percent).groupBy("id").agg(F.max(F.col("id").eqNullSafe(F.col("component"))).alias("_kept"))
    gone = staged(found.where("not _kept").select("id"))  # fewer than those that stay, so that texts need not move
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id).alias("_id"))
    gone = F.broadcast(gone) if gone.count() <= FEW else gone
    return given.join(gone, given["_id"].eqNullSafe(gone["id"]), "left_anti").select("_row.*")
