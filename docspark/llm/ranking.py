"""Ranked lexical search over posting lists in blocks of similar documents, with exact bounds."""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.common import staged, text_of

#: A term is a run of ASCII letters and digits and of all characters beyond ASCII.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
#: Items, and their different terms, that are searched for at once; an item with more terms goes alone.
ITEMS, TERMS = 1000, 4096
#: Documents in a block of a posting list; cells (documents by terms) a task indexes at once.
BLOCK, CELLS = 64, 1 << 24
#: Directions that documents are projected on to compare them.
DIRECTIONS = 32
#: Groups that the best of the tasks are first cut in, so that no task sorts those of all tasks.
GROUPS = 64


def terms_of(text: str) -> list[str]:
    return TERM.findall(text.translate(_LOWER))


def batches(items: DataFrame, item: str, text: str) -> Iterator[list[tuple[object, list[str]]]]:
    """Items with their different terms, in lists that ITEMS and TERMS bound."""
    held, seen = [], set()
    for row in items.select(F.col(item), text_of(text)).toLocalIterator():
        terms = sorted(set(terms_of(row[1])))
        if held and (len(held) == ITEMS or len(seen.union(terms)) > TERMS):
            yield held
            held, seen = [], set()
        held.append((row[0], terms))
        seen.update(terms)
    if held:
        yield held


def counted(docs: DataFrame, id: str, text: str, places: dict[str, int]) -> DataFrame:
    """`doc_id`, `n` (terms with repeats), and `terms` by number and `tf` of those in `places`; documents without terms go."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, n, terms, tf = [], [], [], []
            for i, value in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                found = Counter(terms_of(value.as_py()))
                if found:
                    known = [(places[t], c) for t, c in found.items() if t in places]
                    ids.append(i)
                    n.append(found.total())
                    terms.append([t for t, _ in known])
                    tf.append([c for _, c in known])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int32()))],
                ["doc_id", "n", "terms", "tf"])

    given = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return given.mapInArrow(count, "doc_id long, n long, terms array<int>, tf array<int>")


class Best:
    """The best documents of one item so far: of equal scores the smallest ids, null last."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)
        self.least = 1  # a score below it cannot get in

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        enough = scores >= self.least
        if enough.any():
            scores, ids = np.concatenate([self.scores, scores[enough]]), np.concatenate([self.ids, ids[enough]])
            first = np.lexsort((ids, -scores))[:self.k]
            self.scores, self.ids = scores[first], ids[first]
            if len(first) == self.k:
                self.least = max(1, int(self.scores[-1]))


class Shard:
    """Posting lists over some documents, each list in blocks of similar documents.

    `impacts` has a row for each document and a column for each term, which go by ascending weight.
    """

    def __init__(self, impacts: np.ndarray, weights: np.ndarray):
        self.impacts, self.weights = impacts, weights
        rnd = np.random.Generator(np.random.PCG64(1))
        signs = rnd.choice(np.array([-1, 1], np.float32), (len(weights), DIRECTIONS))
        near = impacts.astype(np.float32) @ (signs * weights.astype(np.float32)[:, None])
        self.near = near / np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-9)
        terms, self.rows = np.nonzero(impacts.T)
        self.starts = np.searchsorted(terms, np.arange(len(weights) + 1))

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """The term's documents, those most like the same leader side by side, and where each block starts."""
        rows = self.rows[self.starts[term]:self.starts[term + 1]]
        if len(rows) <= BLOCK:
            return rows, np.zeros(min(len(rows), 1), np.int64)
        leader = (self.near[rows] @ self.near[rows[::BLOCK]].T).argmax(axis=1)
        order = np.argsort(leader, kind="stable")
        return rows[order], np.flatnonzero(np.diff(leader[order], prepend=-1))

    def summary(self, rows: np.ndarray, starts: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """The largest impact of each column in each block."""
        return np.maximum.reduceat(self.impacts[np.ix_(rows, columns)], starts, axis=0)

    def scores(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        return self.impacts[np.ix_(rows, columns)].astype(np.int64) @ self.weights[columns]


def searched(shard: Shard, ids: np.ndarray, items: list[np.ndarray], best: list[Best]) -> tuple[int, int]:
    """Offer every document of the shard that can be among an item's best; returns blocks opened and blocks in all.

    A document is looked for in the list of its heaviest term of the item. A block of that list is opened unless the
    item's weights, over its terms up to that one, times the block's summary stay below the worst of the best: no
    document that is looked for there can score more.
    """
    users: dict[int, list[int]] = {}
    for q, columns in enumerate(items):
        for t in columns:
            users.setdefault(int(t), []).append(q)
    bounds: list[list[np.ndarray]] = [[] for _ in items]
    places: list[list[np.ndarray]] = [[] for _ in items]
    held: list[np.ndarray] = []
    for t, asking in users.items():
        rows, starts = shard.blocks(t)
        if len(rows) == 0:
            continue
        columns = np.unique(np.concatenate([items[q][items[q] <= t] for q in asking]))
        wanted = np.zeros((len(columns), len(asking)))
        for j, q in enumerate(asking):
            own = np.searchsorted(columns, items[q][items[q] <= t])
            wanted[own, j] = shard.weights[columns[own]]
        most = (shard.summary(rows, starts, columns).astype(np.float64) @ wanted).astype(np.int64)
        number = len(held) + np.arange(len(starts))
        held += np.split(rows, starts[1:])
        for j, q in enumerate(asking):
            bounds[q].append(most[:, j])
            places[q].append(number)
    opened = total = 0
    for q, columns in enumerate(items):
        if not bounds[q]:
            continue
        bound, place = np.concatenate(bounds[q]), np.concatenate(places[q])
        order = np.argsort(-bound, kind="stable")
        bound, place = bound[order], place[order]
        total += len(bound)
        fresh = np.ones(len(ids), bool)
        at, step = 0, 1
        while at < len(bound) and bound[at] >= best[q].least:
            end = min(at + step, int(np.searchsorted(-bound, -best[q].least, "right")))
            rows = np.unique(np.concatenate([held[p] for p in place[at:end]]))
            rows = rows[fresh[rows]]
            fresh[rows] = False
            best[q].offer(shard.scores(rows, columns), ids[rows])
            opened, at, step = opened + end - at, end, step * 2
    return opened, total


_NONE = np.iinfo(np.int64).max  # a null id


def _shards(parts: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held, rows = [], 0
    for part in parts:
        while part.num_rows:
            held.append(part.slice(0, size - rows))
            rows += held[-1].num_rows
            part = part.slice(held[-1].num_rows)
            if rows == size:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def search(docs: DataFrame, items: DataFrame, k: int = 50, id: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k highest-scoring documents with a score above 0 for each item: `item_id`, `rank`, `doc_id`, `score`.

    Scores are exact, in whole numbers: a term weighs floor(1000 ln((2N + 2) / (2 df + 1))), a document with it tf
    times scores 10^9 tf div (1000 tf + 20 m) for each, m = 50 + 50 n N div L. Equal scores go by ascending id, null
    last. Ids are whole numbers; repeated rows are documents of their own, repeated items are ranked each. A
    document or an item without terms, of null or empty text, has no rows, nor has an empty table. Other columns are ignored.

    Items come to the driver in bounded lists. For each list the documents' counts of its terms are written
    once; df, N and L are sums over them. Each task then indexes its documents, some thousand at a time, and
    keeps the best of each item, whose worst lets it pass over blocks of the documents that follow.
    """
    spark = docs.sparkSession
    found = []
    for number, batch in enumerate(batches(items, item, item_text)):
        numbered = {t: i for i, t in enumerate(sorted({t for _, terms in batch for t in terms}))}
        vectors = staged(counted(docs, id, text, numbered))
        n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
        if not n_docs or not numbered:
            continue
        df = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row for each term of the batch
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in numbered.values()], np.int64)
        order = np.argsort(weights, kind="stable")
        column = np.argsort(order, kind="stable")
        weights = weights[order]
        asked = [np.sort(column[[numbered[t] for t in terms]]) if terms else np.empty(0, np.int64) for _, terms in batch]
        asked = [columns[weights[columns] > 0] for columns in asked]
        size = min(max(CELLS // len(weights), BLOCK), 4096)

        def best_of(parts: Iterator[pa.RecordBatch], n_docs=n_docs, n_terms=n_terms, weights=weights, column=column,
                    asked=asked, size=size, number=number) -> Iterator[pa.RecordBatch]:
            best = [Best(k) for _ in asked]
            for table in _shards(parts, size):
                ids = table["doc_id"].fill_null(_NONE).to_numpy()
                m = np.array([50 + 50 * n * n_docs // n_terms for n in table["n"].to_pylist()], np.int64)
                lengths = table["terms"].combine_chunks()
                row = np.repeat(np.arange(len(ids)), lengths.value_lengths().to_numpy())
                tf = table["tf"].combine_chunks().flatten().to_numpy().astype(np.int64)
                impacts = np.zeros((len(ids), len(weights)), np.uint32)
                impacts[row, column[lengths.flatten().to_numpy()]] = 1_000_000_000 * tf // (1000 * tf + 20 * m[row])
                searched(Shard(impacts, weights), ids, asked, best)
            of = np.repeat(np.arange(len(best)), [len(b.ids) for b in best])
            ids = np.concatenate([b.ids for b in best])
            yield pa.RecordBatch.from_arrays(
                [pa.array(of + number * ITEMS, pa.int64()), pa.array(ids, pa.int64(), mask=ids == _NONE),
                 pa.array(np.concatenate([b.scores for b in best]), pa.int64())], ["_item", "doc_id", "score"])

        rows = vectors.mapInArrow(best_of, "_item long, doc_id long, score long")
        kind = items.schema[item].dataType
        named = [(i + number * ITEMS, name) for i, (name, _) in enumerate(batch)]
        names = spark.createDataFrame(named, f"_item long, item_id {kind.simpleString()}")
        found.append(rows.join(F.broadcast(names), "_item"))  # ITEMS rows at most
    if not found:
        kind = items.schema[item].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    place = [F.desc("score"), F.asc_nulls_last("doc_id")]
    grouped = Window.partitionBy("_item", "_group").orderBy(*place)
    rows = rows.withColumn("_group", F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS)))
    rows = rows.withColumn("_rank", F.row_number().over(grouped)).where(F.col("_rank") <= k)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("_item").orderBy(*place))).where(F.col("rank") <= k)
    return rows.select("item_id", "rank", "doc_id", "score")
