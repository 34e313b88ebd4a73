"""Removal of repeated byte strings by suffix buckets that pointers refine."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import released, staged, text_of

#: Bytes of a string that counts as repeated, and of the q-gram that marks a suffix.
LENGTH, GRAM = 50, 20
#: Bytes of text a task works on at once, and that one group of buckets stands for.
CHUNK, PART = 2 << 20, 16 << 20
#: Bytes before a mark that a string through it may start, and after it that it may end.
_BEFORE, _AFTER = LENGTH - GRAM, LENGTH
_GAP = 0xFF  # never a byte of UTF-8
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 64, 256, np.uint64)
_AROUND = np.dtype([("gram", "<u8"), ("id", "<i8"), ("at", "<i8"), ("bytes", "u1", _BEFORE + _AFTER)])
_PLACE = 28  # bits of a key that hold a place in the chunk


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in a row with gaps around them, and where each starts."""
    gap = bytes([_GAP]) * (_BEFORE + _AFTER)
    sizes = np.array([len(t) for t in texts])
    starts = len(gap) + np.concatenate([[0], np.cumsum(sizes[:-1] + len(gap))]).astype(np.int64)
    return np.frombuffer(gap + b"".join(t + gap for t in texts), np.uint8), starts


def marks(line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the marks, ascending, with the hashes of their q-gram and of all bytes around them.

    Each string of LENGTH bytes has one mark, its q-gram of the least hash, the leftmost of equals. So
    equal strings have theirs at the same distance, and two texts share a string only around a mark
    that they share: the marks stand for the suffixes that start in between.
    """
    h1 = _BYTES[line]
    h2 = h1[:-1] * _power(1) + h1[1:]
    h4 = h2[:-2] * _power(2) + h2[2:]
    h8 = h4[:-4] * _power(4) + h4[4:]
    h16 = h8[:-8] * _power(8) + h8[8:]
    h20 = h16[:-4] * _power(4) + h4[16:]
    del h1, h2, h4, h8
    places = np.arange(len(h20), dtype=np.uint64)
    mask = np.uint64((1 << _PLACE) - 1)
    least = (_spread(h20) & ~mask) | places
    span = LENGTH - GRAM + 1
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (span - width)], least[span - width:])
    gaps = np.concatenate([[0], np.cumsum(line == _GAP)])
    whole = gaps[LENGTH:] == gaps[:-LENGTH]  # strings without a gap
    at = np.unique((least[: len(whole)][whole] & mask).astype(np.int64))
    h40 = h20[:-20] * _power(20) + h20[20:]
    around = h40[at - _BEFORE] * _power(40) + h40[at - _BEFORE + 40]  # _BEFORE + _AFTER = 80 bytes
    return at, _spread(h20[at]), _spread(around ^ np.uint64(1))


def _chunks(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[list[tuple]]:
    """Rows of id, unpacked text and further columns, as many as make a chunk of text."""
    rows, size = [], 0
    for batch in batches:
        ids = batch["id"].to_pylist()
        for i, data in enumerate(batch["data"]):
            raw = zlib.decompress(data.as_py())
            rows.append((ids[i], raw, *[batch[c][i] for c in more]))
            size += len(raw)
            if size >= CHUNK:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def _part(gram: np.ndarray, parts: int) -> np.ndarray:
    return (_spread(gram ^ np.uint64(_BASE)) % np.uint64(parts)).astype(np.int64)


def _postings(docs: DataFrame, parts: int) -> DataFrame:
    """(part, blob): marks of a chunk of texts, by part of the hash of their q-gram."""
    def run(batches):
        for rows in _chunks(batches):
            line, starts = laid_out([r[1] for r in rows])
            at, gram, around = marks(line)
            if not len(at):
                continue
            doc = np.searchsorted(starts, at, side="right") - 1
            ids = np.array([r[0] for r in rows], np.int64)
            part = _part(gram, parts)
            order = np.lexsort((doc, around, gram, part))
            part, gram, around, doc = part[order], gram[order], around[order], doc[order]
            new = np.ones(len(part), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (around[1:] != around[:-1]) | (doc[1:] != doc[:-1])
            part, gram, around, doc = part[new], gram[new], around[new], doc[new]
            cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-2))
            out = []
            for a, b in zip(cuts, cuts[1:]):
                own, local = np.unique(doc[a:b], return_inverse=True)
                out.append((part[a], b"".join([
                    np.array([b - a, len(own)], "<u4").tobytes(), ids[own].tobytes(), local.astype("<u4").tobytes(),
                    gram[a:b].view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes(),
                    around[a:b].view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes()])))
            yield pa.record_batch([pa.array([int(p) for p, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())],
                                  names=["part", "blob"])

    return docs.mapInArrow(run, "part int, blob binary")


def _read_postings(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, k = (int(x) for x in np.frombuffer(blob, "<u4", 2))
    ids = np.frombuffer(blob, np.int64, k, 8)
    at = 8 + 8 * k
    doc = ids[np.frombuffer(blob, "<u4", n, at)]
    at += 4 * n
    return doc, _wide(blob, at, n, 6), _wide(blob, at + 6 * n, n, 5)


def _wide(blob: bytes, at: int, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8, n * width, at).reshape(width, n).T
    return out.view(np.uint64).ravel()


def _shared(table: pa.Table) -> pa.Table:
    """Of one part: (id, gram, around, whole). whole: a smaller id has the same bytes all around the mark.

    The others are the smallest ids of each kind of surroundings, where a q-gram has several.
    """
    read = [_read_postings(b.as_py()) for b in table["blob"]]
    doc, gram, around = (np.concatenate([r[i] for r in read]) for i in range(3))
    order = np.lexsort((doc, around, gram))
    doc, gram, around = doc[order], gram[order], around[order]
    kind = np.ones(len(doc), bool)
    kind[1:] = (gram[1:] != gram[:-1]) | (around[1:] != around[:-1])
    first = np.flatnonzero(kind)
    whole = doc > np.repeat(doc[first], np.diff(np.append(first, len(doc))))
    bucket = np.ones(len(doc), bool)
    bucket[1:] = gram[1:] != gram[:-1]
    heads = np.flatnonzero(bucket)
    kinds = np.add.reduceat(kind.astype(np.int64), heads)
    several = np.repeat(kinds > 1, np.diff(np.append(heads, len(doc))))
    mixed = kind & several
    keep = whole | mixed
    return pa.table({"id": doc[keep], "gram": gram[keep].view(np.int64), "around": around[keep].view(np.int64), "whole": whole[keep]})


_LOW6, _LOW5 = np.uint64((1 << 48) - 1), np.uint64((1 << 40) - 1)


def _located(docs: DataFrame, parts: int) -> DataFrame:
    """Spans around marks that are whole (id, spans), and the bytes around the others (part, blob)."""
    def run(batches):
        for rows in _chunks(batches, "grams", "arounds", "wholes"):
            line, starts = laid_out([r[1] for r in rows])
            at, gram, around = marks(line)
            doc = np.searchsorted(starts, at, side="right") - 1
            low, near = gram & _LOW6, around & _LOW5
            cuts = np.searchsorted(doc, np.arange(len(rows) + 1))
            spans, pieces = [], []
            for k, row in enumerate(rows):
                a, b = cuts[k], cuts[k + 1]
                wanted = _pairs(row[2], row[3])
                order = np.lexsort(wanted[::-1])
                whole = row[4].values.to_numpy(zero_copy_only=False)[order]
                known = _mixed(wanted[0][order], wanted[1][order])
                mine = _mixed(low[a:b], near[a:b])
                sorter = np.argsort(known)
                if not len(known):
                    continue
                found = sorter[np.minimum(np.searchsorted(known, mine, sorter=sorter), len(known) - 1)]
                hit = known[found] == mine
                place = at[a:b]
                full = place[hit & whole[found]]
                if len(full):
                    end = starts[k] + len(row[1])
                    lo, hi = np.maximum(full - _BEFORE, starts[k]), np.minimum(full + _AFTER, end)
                    spans.append((row[0], _merged(np.stack([lo, hi], 1) - starts[k]).tobytes()))
                part = place[hit & ~whole[found]]
                if len(part):
                    piece = np.zeros(len(part), _AROUND)
                    piece["gram"], piece["id"], piece["at"] = gram[a:b][hit & ~whole[found]], row[0], part - starts[k]
                    piece["bytes"] = line[part[:, None] + np.arange(-_BEFORE, _AFTER)]
                    pieces.append(piece)
            if spans:
                yield _row([s[0] for s in spans], [s[1] for s in spans], [None] * len(spans), [None] * len(spans))
            if pieces:
                all_ = np.concatenate(pieces)
                where = _part(all_["gram"], parts)
                order = np.argsort(where, kind="stable")
                all_, where = all_[order], where[order]
                heads = np.flatnonzero(np.diff(where, prepend=-1, append=-2))
                yield _row([None] * (len(heads) - 1), [None] * (len(heads) - 1), [int(where[x]) for x in heads[:-1]],
                           [all_[x:y].tobytes() for x, y in zip(heads, heads[1:])])

    return docs.mapInArrow(run, "id long, spans binary, part int, blob binary")


def _row(ids, spans, parts, blobs) -> pa.RecordBatch:
    return pa.record_batch([pa.array(ids, pa.int64()), pa.array(spans, pa.binary()), pa.array(parts, pa.int32()),
                            pa.array(blobs, pa.binary())], names=["id", "spans", "part", "blob"])


def _pairs(a, b) -> tuple[np.ndarray, np.ndarray]:
    return a.values.to_numpy().view(np.uint64), b.values.to_numpy().view(np.uint64)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _spread(_spread(a) + b)


def _merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of bytes that (start, end) rows cover."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")].astype(np.int64)
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), bool)
    new[1:] = spans[1:, 0] > ends[:-1]
    heads = np.flatnonzero(new)
    return np.stack([spans[heads, 0], ends[np.append(heads[1:] - 1, len(spans) - 1)]], 1)


def refined(text: np.ndarray) -> np.ndarray:
    """Bucket of the LENGTH bytes from each place of each row: equal numbers, equal bytes.

    The buckets of eight bytes come first. A bucket of 16 bytes is two pointers to buckets of eight, at a
    place and eight later; 32 bytes are two of 16; and 50 are two of 32, at a place and 18 later. Each
    round sorts the pointers and numbers them anew, and the next reuses those numbers.
    """
    eight = np.zeros((text.shape[0], text.shape[1] - 7), np.uint64)
    for i in range(8):
        eight = (eight << np.uint64(8)) | text[:, i: i + eight.shape[1]].astype(np.uint64)
    bucket = np.unique(eight, return_inverse=True)[1].reshape(eight.shape).astype(np.int64)
    for later in (8, 16, LENGTH - 32):
        pair = bucket[:, :-later] * (bucket.max() + 1) + bucket[:, later:]
        bucket = np.unique(pair, return_inverse=True)[1].reshape(pair.shape).astype(np.int64)
    return bucket


def _compared(table: pa.Table) -> pa.Table:
    """Of one part: (id, spans) that bytes around marks share with a smaller id."""
    rows = np.concatenate([np.frombuffer(b.as_py(), _AROUND) for b in table["blob"]])
    rows = rows[np.argsort(rows["gram"], kind="stable")]
    ids, at, spans = [], [], []
    heads = np.flatnonzero(np.diff(rows["gram"], prepend=rows["gram"][:1] + np.uint64(1)))
    groups = np.append(heads, len(rows))
    start = 0
    while start < len(heads):  # whole buckets, about as many rows as bound the memory
        stop = max(start + 1, int(np.searchsorted(groups, groups[start] + 20_000, side="right")) - 1)
        some = rows[groups[start]: groups[stop]]
        start = stop
        bucket = refined(some["bytes"])
        gap = np.concatenate([np.zeros((len(some), 1), int), np.cumsum(some["bytes"] == _GAP, axis=1)], 1)
        valid = gap[:, LENGTH:] == gap[:, :-LENGTH]
        least = np.full(bucket.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, bucket[valid], np.broadcast_to(some["id"][:, None], bucket.shape)[valid])
        repeated = valid & (least[bucket] < some["id"][:, None])
        hit = np.flatnonzero(repeated.any(axis=1))
        lo = repeated[hit].argmax(axis=1)
        hi = repeated.shape[1] - 1 - repeated[hit][:, ::-1].argmax(axis=1)
        ids.append(some["id"][hit])
        first = some["at"][hit] - _BEFORE
        spans.append(np.stack([first + lo, first + hi + LENGTH], 1))
    ids, spans = np.concatenate(ids), np.concatenate(spans)
    return pa.table({"id": pa.array(ids, pa.int64()), "spans": pa.array([s.tobytes() for s in spans.astype(np.int64)], pa.binary())})


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, `n_bytes`, `spans` (removed runs, from and to) and `kept` (the bytes that are left) of every row.

    A byte goes if a string of 50 bytes that covers it also starts in a document of a smaller id. Strings
    lie within one text's UTF-8 bytes and are judged on the input. A suffix is looked at from the marks of
    its first strings (see `marks`): texts that share a string share a mark and the bytes around it. The
    marks' q-grams are the initial buckets. Where all bytes around a mark are also in a smaller document,
    they go; where a bucket has several surroundings, one of each is refined by bucket pointers until the
    buckets are the 50 bytes themselves. Hashes of 88 bits and more find equal surroundings; what is
    refined is compared byte by byte.

    Null counts as empty; texts of under 50 bytes lose nothing. Rows with a null id lose nothing and take
    nothing from others. Rows that repeat an id are taken to be the same row. A part of the buckets holds
    the marks of about 16 MB of text, each at most once for each chunk of texts and document. Other
    columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    data = docs.select(F.col(id).cast("long").alias("id"), F.encode(text_of(text), "UTF-8").alias("raw"))
    total = data.agg(F.coalesce(F.sum(F.octet_length("raw")), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART))

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch[at:at + 1024]
                yield pa.record_batch([some["id"], pa.array([zlib.compress(x.as_py(), 1) for x in some["raw"]], pa.binary())],
                                      names=["id", "data"])

    packed = data.mapInArrow(pack, "id long, data binary")  # less to shuffle
    named = packed.where("id IS NOT NULL")
    shared = _postings(named, parts).groupBy("part").applyInArrow(_shared, "id long, gram long, around long, whole boolean")
    hits = staged(shared.groupBy("id").agg(F.collect_list(F.struct("gram", "around", "whole")).alias("hits")))
    hits_ = hits.select("id", F.col("hits.gram").alias("grams"), F.col("hits.around").alias("arounds"), F.col("hits.whole").alias("wholes"))
    found = staged(_located(named.join(hits_, "id"), parts))
    mixed = found.where("part IS NOT NULL").select("part", "blob")
    spans = found.where("id IS NOT NULL").select("id", "spans").union(
        mixed.groupBy("part").applyInArrow(_compared, "id long, spans binary"))
    spans = staged(spans.groupBy("id").agg(F.collect_list("spans").alias("spans")))
    released(spark, hits, found)

    def cut(batches):
        for rows in _chunks(batches, "spans"):
            ids, sizes, runs, kept = [], [], [], []
            for row in rows:
                raw = row[1]
                own = np.empty((0, 2), np.int64)
                if row[2].is_valid:
                    own = _merged(np.frombuffer(b"".join(s.as_py() for s in row[2].values), np.int64).reshape(-1, 2))
                at, left = 0, []
                for a, b in own:
                    left.append(raw[at:a])
                    at = b
                left.append(raw[at:])
                ids.append(row[0])
                sizes.append(len(raw))
                runs.append([{"start": int(a), "end": int(b)} for a, b in own])
                kept.append(b"".join(left))
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "spans", "kept"])

    return packed.join(spans, "id", "left").mapInArrow(
        cut, "id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
