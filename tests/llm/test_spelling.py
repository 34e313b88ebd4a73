"""Spelling variants against all pairs of words."""

import collections
import random
import re
import zlib

import pytest

from docspark.llm import queries, spelling

SCHEMA = "doc_id long, text string, word string, n string, size string, part string, x string"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, times=5):
    """Rows of forms() for {word: n}."""
    by = collections.defaultdict(list)
    words = sorted(counts)
    for i, a in enumerate(words):
        for b in words[i + 1:]:
            if abs(len(a) - len(b)) < 2 and near(a, b):
                by[a].append(b)
                by[b].append(a)
    form = {w: min(by[w], key=lambda v: (-counts[v], v)) for w in words if by[w]}
    form = {w: f for w, f in form.items() if counts[f] >= times * counts[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), counts[w], len(by[w]), counts[form[w]] if w in form else None) for w in words)


def rows_of(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def vocabulary(seed, size, letters="abé"):
    rnd = random.Random(seed)
    words = set()
    while len(words) < size:
        w = "".join(rnd.choices(letters, k=rnd.randint(2, 7)))
        words |= {w, w[:1] + w, w[:-1] + rnd.choice(letters), w[::-1]}
    return {w: int(5 ** rnd.uniform(1, 6)) for w in words if len(w) > 1}


@pytest.mark.parametrize("seed, size, letters", [(1, 300, "abé"), (2, 250, "ab"), (3, 400, "abcdeÿ")])
def test_forms(spark, seed, size, letters):
    counts = vocabulary(seed, size, letters)
    got = rows_of(spelling.forms(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute(counts)


def test_long_chains_lead_to_the_last(spark):
    word = "abcdefghijklmnop"
    counts = {word[:i] + "z" * (16 - i): 5 ** (i + 1) for i in range(17)}
    rows = rows_of(spelling.forms(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert {r[2] for r in rows} == {word} and rows == brute(counts)


def test_a_pair_comes_once(spark):
    words = spark.createDataFrame([("aaaaaa", 5), ("aaaaaaa", 5), ("aaabaaa", 5), ("aaaaab", 5)], "word string, n long")
    got = sorted((r.x, r.y) for r in spelling.near_pairs(words).collect())
    given = [r.word for r in words.collect()]
    assert got == sorted((a, b) for a in given for b in given if (len(a), a) < (len(b), b) and near(a, b))


def test_query(spark, tmp_path):
    rnd = random.Random(9)
    words = ["Éclairs", "eclairs", "éclairs", "straße", "strasse", "naïveté", "naivete", "Writing", "writing", "writting", "short", "a×b÷cdé", "日本日本日本"]
    text = lambda n: " ".join(rnd.choices(words, weights=range(1, 14), k=n)) + ", x-writing\n"
    rows = [(i, text(rnd.randint(0, 150))) for i in range(60)] + [(None, text(40)), (3, None), (4, ""), (4, ""), (5, "writing " * 30_000), (5, "writing " * 30_000)]
    spark.createDataFrame([(*r, "w", "1", "2", "3", "4") for r in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    counts = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    assert rows_of(queries.QUERIES["op11_spelling_variants"](spark, str(tmp_path))) == brute(counts)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert spelling.forms(spelling.counted(spelling.runs(empty), "run")).count() == 0
    assert spelling.forms(spark.createDataFrame([("single", 7)], "word string, n long")).first()["root"] == "single"
