"""Ranked search against scores of all documents for all items."""

import collections
import math
import random
import re

import numpy as np
import pytest

from docspark.llm import queries, ranking

DOCS = "doc_id long, text string, item_id string, score string, rank string, _item string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=50):
    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(c.total() for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 100 - 50 + (50 * c.total() * n_docs) // total
            scores.append((sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                               for t in set(terms(text)) if t in c), i))
        best = sorted((-s, i is None, i or 0, i) for s, i in scores if s > 0)[:k]
        out += [(item, rank, b[3], -b[0]) for rank, b in enumerate(best, 1)]
    return sorted(out, key=str)


def corpus(seed=4, n=700):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdeé日", k=rnd.randint(1, 6))) for _ in range(900)]
    pick = lambda k: " ".join(w.title() if rnd.random() < 0.1 else w for w in rnd.choices(words, [1 / (i + 1) for i in range(900)], k=k))
    docs = [(i, pick(rnd.randint(1, 60))) for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(80)] + [(5, docs[5][1]), (None, docs[5][1]), (9000, None), (9001, " ...\n"), (9002, pick(20000))]
    items = [(i, pick(rnd.randint(1, 25))) for i in range(30)] + [(30, None), (31, "!"), (3, "a b"), (None, docs[5][1]), (33, "nowhere"), (33, "nowhere")]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, "i", "s", "r", "_") for d in docs], DOCS).repartition(3),
            spark.createDataFrame([(*i, "d", "s") for i in items], "item_id long, text string, doc_id string, score string"))


@pytest.mark.parametrize("limits", [(1000, 4096, 1 << 24), (7, 60, 1 << 24), (1000, 4096, 1 << 14)])
def test_search(spark, monkeypatch, limits):
    for name, value in zip(("ITEMS", "TERMS", "CELLS"), limits, strict=True):
        monkeypatch.setattr(ranking, name, value)
    docs, items = corpus()
    got = ranking.search(*frames(spark, docs, items)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, items)


def test_query(spark, tmp_path):
    docs, items = corpus(8, 120)
    for name, frame in zip(("documents", "benchmark"), frames(spark, docs, items), strict=True):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    got = queries.QUERIES["op12_ranked_search"](spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, items)


def test_blocks_are_passed_over_and_none_is_missed():
    """Documents about one of a few subjects each: the blocks of other subjects stay closed."""
    rnd = np.random.default_rng(3)
    subject = rnd.integers(0, 8, 3000)
    impacts = np.zeros((3000, 90), np.uint32)
    for d, s in enumerate(subject):
        own = rnd.choice(10, 6, replace=False) + 10 + 10 * s
        impacts[d, own] = rnd.integers(200_000, 1_000_000, 6)
        impacts[d, rnd.choice(10, 5, replace=False)] = rnd.integers(200_000, 1_000_000, 5)
    weights = np.sort(rnd.integers(50, 300, 10)).tolist() + np.sort(rnd.integers(2000, 6000, 80)).tolist()
    shard, items = ranking.Shard(impacts, np.array(weights)), []
    for s in range(8):
        items.append(np.sort(np.concatenate([rnd.choice(10, 4, replace=False), 10 + 10 * s + rnd.choice(10, 4, replace=False)])))
    best = [ranking.Best(10) for _ in items]
    opened, total = ranking.searched(shard, np.arange(3000), items, best)
    for columns, b in zip(items, best, strict=True):
        scores = impacts[:, columns].astype(np.int64) @ shard.weights[columns]
        want = np.lexsort((np.arange(3000), -scores))[:10]
        assert b.ids.tolist() == want.tolist() and b.scores.tolist() == scores[want].tolist()
    assert opened < total / 2


def test_blocks_hold_a_list_once():
    rnd = np.random.default_rng(5)
    impacts = (rnd.random((1000, 20)) < 0.4).astype(np.uint32) * rnd.integers(1, 1000, (1000, 20)).astype(np.uint32)
    shard = ranking.Shard(impacts, np.arange(1, 21))
    for t in range(20):
        rows, starts = shard.blocks(t)
        assert sorted(rows) == np.flatnonzero(impacts[:, t]).tolist() and starts[0] == 0 and (np.diff(starts) > 0).all()
        parts = np.split(rows, starts[1:])
        assert (shard.summary(rows, starts, np.arange(20)) == [impacts[p].max(axis=0) for p in parts]).all()


def test_empty_tables(spark):
    docs, items = frames(spark, *corpus(1, 9))
    assert ranking.search(docs.limit(0), items).count() == 0
    assert ranking.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
