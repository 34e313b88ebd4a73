"""Line deduplication by an exact set-similarity join."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import WHITE, WORD, let, picked, released, small_batches, staged, text_of

#: Words in a token of a line, if not given, and least similarity in percent.
WIDTH, PERCENT = 5, 80
#: Cells of a byte that tell frequent tokens from rare ones; their number bounds what tasks are sent.
CELLS = 1 << 20
#: Bytes of text that are split into tokens at a time (a longer line is taken whole), and tokens counted at a time.
CHUNK, BLOCK = 1 << 20, 1 << 22
#: Lines in a bucket of sets, buckets of posts for each of those, and bytes a task holds before it sends them on.
LINES, SPREAD, HELD = 1 << 16, 4, 16 << 20
#: Bits of a token by which lines are looked for: a line of a chunk, a power and a token are one whole number.
BITS = 38
#: Occurrences from which the posts of a token are dealt over several groups.
HOT = 1 << 20
#: Tokens from which a line has 512 marks instead of 128, and partners under a token that a line keeps all of.
LONG, PARTNERS = 224, 4

#: A set of tokens, known by its first line, with the number of its posts; and a post.
SET = np.dtype([("sid", "u8"), ("doc", "i8"), ("line", "u4"), ("n", "u4"), ("m0", "u8"), ("m1", "u8"), ("wide", "u8", 6), ("posts", "u4")])
COUNT = np.dtype([("token", "u4"), ("seen", "u4")])
KEY = np.dtype([("token", "u4"), ("p", "u4"), ("power", "u1")])
POST = np.dtype([("token", "u4"), ("cell", "u8"), ("group", "u4"), ("home", "u1"), ("doc", "i8"), ("line", "u4"), ("n", "u4"), ("p", "u4"), ("m0", "u8"), ("m1", "u8"),
                 ("open", "u1")])

_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)
_BLACK = np.ones(256, bool)
_BLACK[[ord(c) for c in WHITE]] = False
_POWERS: list[np.ndarray] = []


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, n at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        bases = (_BASE, pow(_BASE, -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)]), dtype=np.uint64) for b in bases]
    return _POWERS


def _chunks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, line, start, bytes) of the lines of the texts that are not empty, some CHUNK bytes at a time."""
    texts = texts.cast(pa.large_string())
    places = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or places[0] == places[-1]:
        return
    data = np.frombuffer(texts.buffers()[2], np.uint8)[places[0]:places[-1]]
    places = places - places[0]
    after = np.flatnonzero(data == 10) + 1
    row = np.concatenate([np.arange(len(texts)), np.searchsorted(places, after - 1, "right") - 1])
    start = np.concatenate([places[:-1], after])
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    end = np.append(start[1:] - 1, places[-1])
    last = np.append(row[1:] != row[:-1], True)
    end[last] = places[row[last] + 1]
    line = np.arange(len(row)) - np.searchsorted(row, row)
    full = end > start
    row, line, start, end = row[full], line[full], start[full], end[full]
    i = 0
    while i < len(row):
        j = max(i + 1, int(np.searchsorted(end, start[i] + CHUNK, "right")))
        yield row[i:j], line[i:j], start[i:j] - start[i], data[start[i]:end[j - 1]]
        i = j


def _words(start: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of the words of a chunk, in their order: sums of powers over a word's bytes, shifted to its start."""
    black = _BLACK[data]
    edge = black.copy()
    edge[1:] &= ~black[:-1]
    edge[start] = black[start]  # a text may begin right behind another
    stop = black.copy()
    stop[:-1] &= ~black[1:] | edge[1:]
    first, last = np.flatnonzero(edge), np.flatnonzero(stop) + 1
    power, inverse = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * power[:len(data)], out=sums[1:])
    hashes = _mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
    return np.repeat(np.arange(len(start)), np.diff(np.append(np.searchsorted(first, start), len(first)))), hashes


def _tokens(start: np.ndarray, data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, token) of the sets of tokens of a chunk, by line: words, repeats numbered, or runs of `width` words.

    A line of fewer words than `width` is one run.
    """
    line, hashes = _words(start, data)
    if width > 1:
        begin, end = np.searchsorted(line, line), np.searchsorted(line, line, "right")
        place, runs = np.arange(len(line)), np.full(len(line), width, np.uint64)
        for k in range(width):
            inside = place + k < end
            runs[inside] = _mixed(runs[inside] + hashes[place[inside] + k])
        heads = place <= np.maximum(begin, end - width)
        line, hashes = line[heads], runs[heads]
    order = np.lexsort((hashes, line))
    line, hashes = line[order], hashes[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1]))[:len(line)]
    if width > 1:
        return line[new], hashes[new]
    place = np.arange(len(line))
    repeat = place - np.maximum.accumulate(np.where(new, place, 0))
    return line, np.where(repeat > 0, _mixed(hashes + repeat.astype(np.uint64) * np.uint64(_BASE)), hashes)


def _firsts(line: np.ndarray) -> np.ndarray:
    """Where each line begins, of ascending lines."""
    return np.flatnonzero(np.append(True, line[1:] != line[:-1])[:len(line)])


def _sets(start: np.ndarray, data: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(line, token, first, n, sid) of the sets of a chunk: the lines of their tokens, in BITS bits, and of each set where it begins, its size and a hash.

    Words that share those bits are one token here, which only makes lines look more similar.
    """
    line, hashes = _words(start, data) if width == 1 else _tokens(start, data, width)
    first = _firsts(line)
    n = np.diff(np.append(first, len(line)))
    if not len(line):
        return line, hashes, first, n, hashes
    sid = _mixed(np.add.reduceat(_mixed(hashes ^ np.uint64(_BASE)), first) + n.astype(np.uint64))  # in any order
    tokens = hashes >> np.uint64(64 - BITS)
    if width == 1:
        key = np.sort(line.astype(np.uint64) << np.uint64(BITS) | tokens)
        tokens, place = key & np.uint64((1 << BITS) - 1), np.arange(len(key))
        repeat = place - np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), place, 0))
        again = np.flatnonzero(repeat)
        tokens[again] = _mixed(tokens[again] + repeat[again].astype(np.uint64) * np.uint64(_BASE)) >> np.uint64(64 - BITS)
    return line, tokens, first, n, sid


def _marks(tokens: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128 cells, in two words, in which the tokens of a line are counted modulo two, and six of the eight words of 512 for long lines.

    Two lines differ in no more cells than tokens. The first two words are the eight ones folded, so the other two follow.
    """
    bit = np.uint64(1) << ((tokens >> np.uint64(32)) & np.uint64(63))
    word = ((tokens >> np.uint64(26)) & np.uint64(7)).astype(np.int64)
    m0, m1 = (np.bitwise_xor.reduceat(np.where(word % 2 == k, bit, np.uint64(0)), first) for k in (0, 1))
    wide, large = np.zeros((len(first), 6), np.uint64), np.flatnonzero(n >= LONG)
    if len(large):
        own = np.repeat(n >= LONG, n)
        begin = np.append(0, np.cumsum(n[large]))[:-1]
        for k in range(6):
            wide[large, k] = np.bitwise_xor.reduceat(np.where(word[own] == k + 2, bit[own], np.uint64(0)), begin)
    return m0, m1, wide


def _differ(posts: np.ndarray, wide: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many cells of their marks the lines of posts a and b differ, of 512 if both are long: those have rows `at` of `wide`."""
    m0, m1 = (posts[m][a] ^ posts[m][b] for m in ("m0", "m1"))
    out = np.bitwise_count(m0).astype(np.int64) + np.bitwise_count(m1)
    large = np.flatnonzero((posts["n"][a] >= LONG) & (posts["n"][b] >= LONG))
    wide = wide[at[a[large]]] ^ wide[at[b[large]]]
    rest = [m[large] ^ wide[:, k] ^ wide[:, k + 2] ^ wide[:, k + 4] for k, m in ((0, m0), (1, m1))]
    out[large] = np.bitwise_count(wide).sum(axis=1, dtype=np.int64) + sum(np.bitwise_count(r).astype(np.int64) for r in rest)
    return out


def _scanned(docs: DataFrame, width: int) -> DataFrame:
    """(doc, line, sid) of every line that has a word, and (bucket, counts): short tokens and how often blocks of lines have them."""
    names = ["doc", "line", "sid", "bucket", "counts"]

    def run(batches):
        pending, size = [], 0

        def counted() -> pa.RecordBatch:
            token, seen = np.unique(np.concatenate(pending), return_counts=True)
            pending.clear()
            rows = np.zeros(len(token), COUNT)
            rows["token"], rows["seen"] = token, seen
            dealt = _dealt(token.astype(np.int64) % CELLS // (CELLS // 64), ["counts"], lambda some: (_packed(rows[some]),))
            none = pa.nulls(dealt.num_rows)
            return pa.record_batch([none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.int64()), *dealt.columns], names=names)

        for batch in batches:
            doc = batch["doc"].to_numpy(zero_copy_only=False)
            for row, number, start, data in _chunks(batch["text"]):
                line, tokens, first, n, sid = _sets(start, data, width)
                at = line[first]
                none = pa.nulls(len(at))
                yield pa.record_batch([pa.array(doc[row[at]]), pa.array(number[at].astype(np.int32)), pa.array(sid.view(np.int64)),
                                       none.cast(pa.int64()), none.cast(pa.binary())], names=names)
                pending.append(tokens.astype(np.uint32))
                size += len(tokens)
                if size >= BLOCK:
                    yield counted()
                    size = 0
        if size:
            yield counted()

    with small_batches(docs.sparkSession):
        return staged(docs.mapInArrow(run, "doc long, line int, sid long, bucket long, counts binary"))


def _most(group: pa.Table) -> pa.Table:
    """For each cell of a bucket with a token that occurs twice, the power of two of the most frequent one's occurrences."""
    rows = _unpacked(group["counts"], COUNT)
    rows = rows[np.argsort(rows["token"], kind="stable")]
    first = _firsts(rows["token"])
    seen = np.add.reduceat(rows["seen"], first, dtype=np.int64)
    most = np.zeros(CELLS, np.uint8)
    np.maximum.at(most, rows["token"][first].astype(np.int64) % CELLS, np.floor(np.log2(seen)).astype(np.uint8))
    c = np.flatnonzero(most)
    return pa.table({"c": c.astype(np.int32), "p": most[c].astype(np.int32)})


def _rarity(counts: DataFrame) -> np.ndarray:
    """For each cell, the power of two of the occurrences of its most frequent token; 0 where none occurs twice."""
    rows = counts.groupBy("bucket").applyInArrow(_most, "c int, p int").toArrow()  # at most CELLS rows
    powers = np.zeros(CELLS, np.uint8)
    powers[rows["c"].to_numpy()] = rows["p"].to_numpy()
    return powers


def _by_rarity(line: np.ndarray, tokens: np.ndarray, powers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(short token, power) of each line's tokens, the rarest first: by the power of the cell, then by the token.

    Any order gives the same result; a rare token that shares the cell of a frequent one only comes later.
    """
    power = powers[(tokens & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64)
    key = np.sort(line.astype(np.uint64) << np.uint64(BITS + 6) | power << np.uint64(BITS) | tokens)
    return key.astype(np.uint32), (key >> np.uint64(BITS)).astype(np.uint8) & 63


def _packed(rows: np.ndarray) -> bytes:
    """The rows' first bytes, then their second ones, and so on, which compress well."""
    return np.ascontiguousarray(np.ascontiguousarray(rows).reshape(-1).view(np.uint8).reshape(-1, rows.dtype.itemsize).T).tobytes()


def _unpacked(column: pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), np.uint8).reshape(kind.itemsize, -1).T for x in column if len(x.as_buffer())]
    if not parts:
        return np.empty(0, kind)
    return np.ascontiguousarray(np.concatenate(parts)).reshape(-1).view(kind)


def _dealt(bucket: np.ndarray, names: list[str], columns: Callable[[np.ndarray], tuple[bytes, ...]]) -> pa.RecordBatch:
    """A row for each bucket, with what columns(its rows) packs under the names."""
    order = np.argsort(bucket, kind="stable")
    first = _firsts(bucket[order])
    blobs = [columns(some) for some in np.split(order, first[1:])] if len(order) else []
    packed = [pa.array([b[k] for b in blobs], pa.binary()) for k in range(len(names))]
    return pa.record_batch([pa.array(bucket[order][first].astype(np.int64)), *packed], names=["bucket", *names])


def _prefixes(docs: DataFrame, width: int, powers: np.ndarray, buckets: int, wanted: np.ndarray | None = None) -> DataFrame:
    """(bucket, sets, keys): the sets of a task, each once, with the tokens of their prefixes, dealt by their hash; of tokens in `wanted` cells, if given."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def sent() -> pa.RecordBatch:
            sets, keys = (np.concatenate(x) for x in zip(*held))
            held.clear()
            begin = np.append(0, np.cumsum(sets["posts"], dtype=np.int64))
            order = np.lexsort((sets["line"], sets["doc"], sets["sid"]))
            order = order[_firsts(sets["sid"][order])]
            order = order[sets["posts"][order] > 0]

            def columns(some):
                some = order[some]
                own = np.repeat(begin[some] - np.append(0, np.cumsum(sets["posts"][some], dtype=np.int64))[:-1], sets["posts"][some])
                return _packed(sets[some]), _packed(keys[own + np.arange(len(own))])

            return _dealt((sets["sid"][order] >> np.uint64(20)) % np.uint64(buckets), ["sets", "keys"], columns)

        size = 0
        for batch in batches:
            doc = batch["doc"].to_numpy(zero_copy_only=False)
            for row, number, start, data in _chunks(batch["text"]):
                line, tokens, first, n, sid = _sets(start, data, width)
                if wanted is not None and len(line):
                    some = np.logical_or.reduceat(wanted[(tokens & np.uint64(CELLS - 1)).astype(np.int64)], first)
                    own = np.repeat(some, n)
                    line, tokens, n, sid = line[own], tokens[own], n[some], sid[some]
                    first = _firsts(line)
                if not len(line):
                    continue
                short, power = _by_rarity(line, tokens, powers)
                p, own = np.arange(len(line)) - np.repeat(first, n), np.repeat(n, n)
                # similar sets share a token of their prefixes; sets too small are similar to equal ones only, tokens that occur once are not shared
                posted = (p < own + (-PERCENT * own // 100) + 1) & (power > 0) & (100 * own >= PERCENT * (own + 1))
                if wanted is not None:
                    posted &= wanted[short % CELLS]
                sets, keys = np.zeros(len(first), SET), np.zeros(int(posted.sum()), KEY)
                m0, m1, wide = _marks(tokens, first, n)
                for name, values in (("sid", sid), ("doc", doc[row[line[first]]]), ("line", number[line[first]]), ("n", n),
                                     ("m0", m0), ("m1", m1), ("wide", wide), ("posts", np.add.reduceat(posted, first, dtype=np.int64))):
                    sets[name] = values
                keys["token"], keys["p"], keys["power"] = short[posted], p[posted], power[posted]
                held.append((sets, keys))
                size += sets.nbytes + keys.nbytes
                if size >= HELD:
                    yield sent()
                    size = 0
        if size:
            yield sent()

    return docs.mapInArrow(run, "bucket long, sets binary, keys binary")


def _posted(group: pa.Table, again: np.ndarray | None, buckets: int) -> pa.Table:
    """(bucket, posts, wide): the posts of a bucket's sets, and the further marks of the long ones, each under its first line, dealt by token; `again` are the open ones, if not all.

    Posts of a token that is hot go to a group each, and once to every pair of it with another.
    """
    sets, keys = _unpacked(group["sets"], SET), _unpacked(group["keys"], KEY)
    begin = np.append(0, np.cumsum(sets["posts"], dtype=np.int64))[:-1]
    order = np.lexsort((sets["line"], sets["doc"], sets["sid"]))
    order = order[_firsts(sets["sid"][order])]
    count = sets["posts"][order].astype(np.int64)
    at = np.repeat(begin[order] - np.append(0, np.cumsum(count))[:-1], count) + np.arange(count.sum())
    of, keys = np.repeat(order, count), keys[at]
    posts = np.zeros(len(keys), POST)
    for name in ("doc", "line", "n", "m0", "m1"):
        posts[name] = sets[name][of]
    posts["token"], posts["p"] = keys["token"], keys["p"]
    posts["open"] = 1 if again is None else np.isin(sets["sid"][of], again)
    groups = np.maximum((np.int64(2) << keys["power"].astype(np.int64)) // HOT, 1)
    posts["group"] = _mixed(posts["doc"].astype(np.uint64) * np.uint64(_BASE) + posts["line"]) % groups.astype(np.uint64)
    copies = np.repeat(np.arange(len(posts)), groups)
    other = np.arange(len(copies)) - np.repeat(np.append(0, np.cumsum(groups))[:-1], groups)
    posts, wide = posts[copies], sets["wide"][of[copies]]
    low, high = np.minimum(posts["group"], other), np.maximum(posts["group"], other)
    posts["cell"], posts["home"] = low * groups[copies] + high, low == high  # a pair of groups; the pairs within one meet at home
    bucket = _mixed(posts["token"].astype(np.uint64) << np.uint64(32) | posts["cell"]) % np.uint64(buckets)

    def columns(some):
        some = some[np.argsort(posts["token"][some], kind="stable")]
        return _packed(posts[some]), _packed(wide[some[posts["n"][some] >= LONG]])

    return pa.Table.from_batches([_dealt(bucket, ["posts", "wide"], columns)])


def _met(group: pa.Table, all_of_them: bool) -> pa.Table:
    """Pairs (doc, line), (doc_, line_) of later open lines and earlier ones that share a token here and may be similar.

    Lengths, the places of the token and marks rule pairs out. Of the pairs of a line under a token there are all, if they are no more than
    PARTNERS, or the one with the earliest, and `more` is the token under which there were others; or there are all of them in any case.
    """
    posts, wide = _unpacked(group["posts"], POST), _unpacked(group["wide"], np.dtype("u8")).reshape(-1, 6)
    place = np.cumsum(posts["n"] >= LONG) - 1
    order = np.lexsort((posts["n"], posts["cell"], posts["token"]))
    posts, place = posts[order], place[order]
    k = len(posts)
    n, p = posts["n"].astype(np.int64), posts["p"].astype(np.int64)
    block = np.cumsum(np.append(True, (posts["token"][1:] != posts["token"][:-1]) | (posts["cell"][1:] != posts["cell"][:-1]))[:k])
    by_time = np.lexsort((posts["line"], posts["doc"]))
    time = np.empty(k, np.int64)
    time[by_time] = np.cumsum(np.append(False, (np.diff(posts["doc"][by_time]) != 0) | (np.diff(posts["line"][by_time].astype(np.int64)) != 0))[:k])
    at = np.empty(k, np.int64)
    at[time] = np.arange(k)  # a post of the line of each time
    best, fits, some, found = np.full(k, k, np.int64), np.zeros(k, np.int64), np.zeros((k, PARTNERS), np.int64), []
    i, d = np.arange(k - 1), 1
    while len(i):
        i = i[i + d < k]
        j = i + d
        go = (block[i] == block[j]) & (100 * n[i] >= PERCENT * n[j])  # lengths ascend: what fails once fails further on
        i, j = i[go], j[go]
        needed = -(-PERCENT * (n[i] + n[j]) // (100 + PERCENT))
        ok = (p[i] - p[j] <= n[i] - needed) & (p[j] - p[i] <= n[j] - needed) & (time[i] != time[j])
        ok &= (posts["home"][i] > 0) | (posts["group"][i] != posts["group"][j])
        a, b, needed = i[ok], j[ok], needed[ok]
        ok = _differ(posts, wide, place, a, b) <= n[a] + n[b] - 2 * needed
        a, b = a[ok], b[ok]
        late, early = np.where(time[a] > time[b], a, b), np.where(time[a] > time[b], b, a)
        ok = posts["open"][late] > 0
        late, early = late[ok], early[ok]
        if all_of_them:
            found.append(np.unique(np.stack([time[late], time[early], np.full(len(late), -1)]), axis=1))
        else:
            for side in (late == a[ok], late == b[ok]):  # a post comes once on each side
                x, y = late[side], early[side]
                best[x] = np.minimum(best[x], time[y])
                room = fits[x] < PARTNERS
                some[x[room], fits[x[room]]] = time[y[room]]
                fits[x] += 1
        d += 1
    if not all_of_them:
        x, many = np.flatnonzero((fits > 0) & (fits <= PARTNERS)), np.flatnonzero(fits > PARTNERS)
        found = [np.stack([time[y], some[y, q], np.full(len(y), -1)]) for q in range(PARTNERS) for y in [x[fits[x] > q]]]
        found.append(np.stack([time[many], best[many], posts["token"][many].astype(np.int64)]))
    pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.empty((3, 0), np.int64)
    late, early, more = at[pairs[0]], at[pairs[1]], pa.array(pairs[2], mask=pairs[2] < 0)
    return pa.table({"doc": posts["doc"][late], "line": posts["line"][late].astype(np.int32), "doc_": posts["doc"][early],
                     "line_": posts["line"][early].astype(np.int32), "more": more})



def _numbers(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc, text) with numbers in the order of the ids, and (doc, id) if ids are not such numbers themselves."""
    if dict(docs.dtypes)["id"] in ("tinyint", "smallint", "int", "bigint"):
        return docs.select(F.col("id").cast("long").alias("doc"), "text"), None
    ids = staged(docs.select("id").distinct().sort("id").withColumn("doc", F.monotonically_increasing_id()))
    return docs.join(ids, "id").select("doc", "text"), ids


def repeated(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(id, line): lines that are similar to an earlier one, by id and place in the text; rows with a null id are left out.

    Earlier lines count whether or not they are themselves repeats: where B is similar to A and C to B, C goes
    with B even if it is not similar to A. A line's tokens are its runs of `width` words; of one word, a repeat is a token of its own. Lines of
    equal tokens (by a hash of 64 bits) are one set, known by its first line. Tokens are counted; each task sends the prefixes of its sets,
    each set once, to be dealt by the sets' hash, and from there a post per token of the prefix, to be dealt by token. There posts meet in
    arrays, which makes no rows: a line keeps those earlier ones under each token that length, place and marks allow, or the earliest of many. These pairs are verified on all
    tokens, read from the texts again. Lines of which none is similar, and that had others, meet all of theirs in a second round, in which
    only the tokens under which they had others are posted: under the rest there were no others.
    """
    spark = docs.sparkSession
    given, ids = _numbers(docs.where(F.col(id).isNotNull()).select(F.col(id).alias("id"), text_of(text).alias("text")))
    if not given.groupBy("doc").count().where("count > 1").isEmpty():
        given = staged(given.dropDuplicates(["doc"]))
    scanned = _scanned(given, width)
    heads = scanned.where("bucket IS NULL").select("doc", "line", "sid")
    powers = _rarity(scanned.where("bucket IS NOT NULL").select("bucket", "counts"))
    buckets = max(8, heads.count() // LINES + 1)
    firsts = staged(heads.groupBy("sid").agg(F.min(F.struct("doc", "line")).alias("first")).select("sid", "first.*"))

    def met(open: DataFrame | None, wanted: np.ndarray | None = None) -> DataFrame:
        prefixes = _prefixes(given, width, powers, buckets, wanted).groupBy("bucket")
        kind, again = "bucket long, posts binary, wide binary", open is not None
        if not again:
            posts = prefixes.applyInArrow(lambda some: _posted(some, None, buckets * SPREAD), kind)
        else:
            dealt = open.withColumn("bucket", F.shiftrightunsigned("sid", 20) % buckets).groupBy("bucket")
            posts = prefixes.cogroup(dealt).applyInArrow(
                lambda some, sids: _posted(some, sids["sid"].to_numpy().view(np.uint64), buckets * SPREAD), kind)
        pairs = posts.groupBy("bucket").applyInArrow(
            lambda some: _met(some, again), "doc long, line int, doc_ long, line_ int, more long")
        with small_batches(spark):
            return staged(pairs.groupBy("doc", "line", "doc_", "line_").agg(F.collect_set("more").alias("more")))

    pairs = met(None)
    similar = _verified(pairs, given, width)
    open = pairs.select("doc", "line", F.explode("more").alias("token")).distinct().join(similar, ["doc", "line"], "left_anti")
    open = staged(open.join(firsts, ["doc", "line"]).select("sid", "token"))
    cells = open.select((F.col("token") % CELLS).alias("c")).distinct().toArrow()["c"].to_numpy()  # at most CELLS
    if len(cells):
        wanted = np.zeros(CELLS, bool)
        wanted[cells] = True
        similar = similar.union(_verified(met(open.select("sid").distinct(), wanted), given, width)).distinct()
    gone = firsts.join(similar.withColumn("similar", F.lit(True)), ["doc", "line"], "left").select(
        "sid", F.struct("doc", "line").alias("first"), F.col("similar").isNotNull().alias("similar"))
    out = heads.join(gone, "sid").where(F.col("similar") | (F.struct("doc", "line") != F.col("first"))).select("doc", "line").distinct()
    return out.withColumnRenamed("doc", "id") if ids is None else out.join(ids, "doc").select("id", "line")


def _verified(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(doc, line) of the pairs whose lines are similar, once each; their words are read from the texts."""
    asked = pairs.select("doc", "line").union(pairs.select("doc_", "line_")).groupBy("doc").agg(F.collect_set("line").alias("lines"))
    read = let(F.split("text", "\n", -1), lambda all: F.transform("lines", lambda i: F.struct(i.alias("line"), F.get(all, i).alias("words"))))
    asked = staged(asked)
    read = staged(picked(docs, asked, "doc").select("doc", F.inline(read)))
    both = pairs.join(read, ["doc", "line"]).join(read.toDF("doc_", "line_", "words_"), ["doc_", "line_"])

    def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = [(row, *_tokens(start, data, width)) for row, _, start, data in _chunks(texts)]
        return np.concatenate([row[line] for row, line, _ in parts]), np.concatenate([t for _, _, t in parts])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            (row, a), (row_, b) = tokens(batch["words"]), tokens(batch["words_"])
            rows, values = np.concatenate([row, row_]), np.concatenate([a, b])
            order = np.lexsort((values, rows))
            rows, values = rows[order], values[order]
            equal = (rows[1:] == rows[:-1]) & (values[1:] == values[:-1])
            shared, total = np.bincount(rows[1:][equal], minlength=batch.num_rows), np.bincount(rows, minlength=batch.num_rows)
            yield batch.select(["doc", "line"]).filter(pa.array(100 * shared >= PERCENT * (total - shared)))

    with small_batches(docs.sparkSession):
        similar = both.select("doc", "line", "words", "words_").mapInArrow(run, "doc long, line int")
        out = staged(similar.distinct())
    released(docs.sparkSession, read, asked)
    return out


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """`id`, `n_lines`, `n_removed` and `text` without the repeated lines, of every row.

    See `repeated`; lines without a word stay and are not compared. Null and empty texts have no lines.
    Rows that repeat an id are taken to be the same row; rows with a null id are not compared. Other
    columns are not read. An empty table gives no rows.
    """
    gone = repeated(docs.where(F.col(id).isNotNull()), id, text, width).groupBy("id").agg(F.collect_set("line").alias("gone"))
    given = docs.select(F.col(id).alias("id"), text_of(text).alias("text"))
    lines = F.split("text", "\n", -1)
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(let(F.col("gone"), lambda g: F.filter(lines, lambda x, i: ~F.array_contains(g, i))), "\n"))
    n = F.size(F.filter(lines, lambda x: x.rlike(WORD))).cast("long")
    return given.join(gone, "id", "left").select("id", n.alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
                                                 kept.alias("text"))
