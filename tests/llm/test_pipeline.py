"""The corpus pipeline: each stage against brute force on its own input, and all of them in a run."""

import collections
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docspark.llm import bpe, quality
from docspark.llm.common import staged

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, lang string, _row string, _at string, id string"


def documents():
    rnd = random.Random(11)
    words = ["the", "of", *("".join(rnd.choices("abcdefgé", k=rnd.randint(3, 8))) for _ in range(900))]
    make = lambda n: " ".join(["the", *rnd.choices(words, k=n)])
    out = [None, "", "too short", "x " * 60, "### $$$ %%% " * 8 + make(9), make(4000)]
    out += ["\n".join([make(3)] * 6), " ".join(f"{w}{i}" for i, w in enumerate(["supercalifragilistic"] * 12))]
    for n in (60, 90, 140):
        base = make(n)
        near = base.split()
        near[n // 2] = "changed"
        out += [base, base.replace(" ", "  "), base, " ".join(near)]
    out += [make(rnd.randint(20, 120)) for _ in range(30)]
    return out


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    given = [(i, t, ["b", "a", None, "a"][i % 4], None if i % 7 == 0 else "en", "r", "a", "i") for i, t in enumerate(documents())]
    given += [given[20], (None, "the row without an id is long enough to be kept by all rules of the table", "b", None, None, None, None)]
    path = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(given, SCHEMA).write.parquet(str(path / "documents.parquet"))
    return str(path)


@pytest.fixture(scope="module")
def steps(spark, path):
    """(input, output) of every stage as lists of rows."""
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = staged(stage(spark, docs, path))
        out[name] = (docs.collect(), result.collect())
        assert name == corpus_pipeline.STAGES[-1][0] or result.columns == docs.columns
        docs = result
    return out


def good(text):
    words = WORDS.findall(text or "")
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    seen = collections.Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    if len(words) < 10 or 100 * len(repeated) > 20 * len(words):
        return False
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    stops = sum(w.lower().strip(quality.PUNCTUATION) in quality.STOP_WORDS for w in words)
    return (2 <= sum(map(len, words)) / len(words) <= 12 and len(re.findall(r"[#*$%&|<>]", text)) <= 0.1 * len(words)
            and (len(words) < 50 or stops >= 0.01 * len(words)) and len(lines) - len(set(lines)) <= 0.5 * len(lines))


def counted(rows):
    return collections.Counter(map(tuple, rows))


def test_quality_rules(steps):
    docs, kept = steps["quality rules"]
    assert counted(kept) == counted(r for r in docs if good(r.text))
    assert 0 < len(kept) < len(docs)


def test_exact_dedup(steps):
    docs, kept = steps["exact dedup"]
    groups = collections.defaultdict(list)
    for r in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text)].append(r)
    first = [min(g, key=lambda r: (-len(r.text), r.doc_id is None, r.doc_id or 0)) for g in groups.values()]
    assert counted(kept) == counted(first) and len(kept) < len(docs)


def test_near_copies(steps):
    docs, kept = steps["n-gram Jaccard join"]
    sets = {}
    for r in docs:
        words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
        sets[r.doc_id] = {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
    label = {i: i for i in sets}
    known = [i for i in sets if i is not None]
    for _ in known:
        for a, b in itertools.combinations(known, 2):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                label[a] = label[b] = min(label[a], label[b])
    assert counted(kept) == counted(r for r in docs if label[r.doc_id] == r.doc_id) and len(kept) < len(docs)


def test_mixing(steps):
    docs, mix = steps["mixing sources to target weights"]
    size = lambda r: len(WORDS.findall(r.text))
    own, taken = collections.Counter(), collections.Counter()
    for r in docs:
        own[r.source] += size(r)
    for r in mix:
        taken[r.source] += size(r)
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(own, key=lambda s: (s is None, s or "")))}
    rest, budget, targets = set(own), 1.5 * sum(own.values()), {}
    while rest:  # share by weight; what is above twice a source's size goes to the others
        share = {s: budget * weights[s] / sum(weights[x] for x in rest) for s in rest}
        full = {s for s in rest if share[s] > 2 * own[s]}
        targets.update({s: 2 * own[s] if s in full else share[s] for s in (full or rest)})
        budget -= sum(2 * own[s] for s in full)
        rest = rest - full if full else set()
    longest = max(map(size, docs))
    assert all(abs(taken[s] - targets[s]) <= 2 * longest for s in own)
    had, got = counted(docs), counted(mix)
    assert all(n <= 2 * had[r] for r, n in got.items())


def test_encoding(steps):
    from tokenizers import Tokenizer

    docs, coded = steps["BPE encoding and decoding"]
    file, want = Tokenizer.from_file(bpe.default_path()), collections.Counter()
    for r in docs:
        ids = file.encode(r.text, add_special_tokens=False).ids
        want[(r.doc_id, b"".join(x.to_bytes(4, "little") for x in ids), len(ids), file.decode(ids, skip_special_tokens=False))] += 1
    assert collections.Counter((r.doc_id, bytes(r.ids), r.n_tokens, r.decoded) for r in coded) == want


def test_run_is_its_stages(spark, path, steps):
    key = lambda r: (r.doc_id, bytes(r.ids), r.n_tokens, r.decoded)
    got = collections.Counter(map(key, corpus_pipeline.run(spark, path).collect()))
    assert got == collections.Counter(map(key, steps["BPE encoding and decoding"][1]))


@pytest.mark.parametrize("rows", [[], [(None,) * 7, (1, None, None, None, None, None, None), (2, "", "a", "en", "r", "a", "i")]])
def test_run_without_words(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_take_null_texts(spark, path):
    """Stages called alone on null and empty texts; the mix takes documents without words twice, as they cost nothing."""
    rows = [(1, None, None, None, None, None, None), (2, "", "a", "en", "r", "a", "i"), (3, " \n", "a", "en", "r", "a", "i")]
    docs = spark.createDataFrame(rows, SCHEMA)
    counts = {name: stage(spark, docs, path).agg(F.count("*")).first()[0] for name, stage in corpus_pipeline.STAGES}
    assert counts == {"quality rules": 0, "exact dedup": 1, "n-gram Jaccard join": 3, "mixing sources to target weights": 6,
                      "BPE encoding and decoding": 3}
