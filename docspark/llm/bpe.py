"""Byte-pair encoding and decoding with a segment tree over adjacent pair ranks."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import text_of

#: Words whose ids a worker remembers, twice: those of now, and those before that no later word displaced.
REMEMBERED = 200_000
#: Longer pieces are encoded each time.
LONG = 64
#: Rows and bytes of text of one batch that goes back to Spark.
ROWS, BYTES = 256, 4 << 20

#: Characters up to here are their own NFC form and have a lower case that no neighbour changes.
_PLAIN = regex.compile(r"[\x00-ɏ]*")
#: Bits of a symbol or position; a pair that has no rank counts as more than any.
_SHIFT = 32
_MASK, _NONE = (1 << _SHIFT) - 1, 1 << 62


class Merges:
    """The merges of a file: the key of a pair gives its rank, shifted to leave room for a position."""

    def __init__(self, pairs: list[tuple[int, int, int]]):
        self.ranks = {a << _SHIFT | b: rank << _SHIFT for rank, (a, b, _) in enumerate(pairs)}
        self.made = [c for _, _, c in pairs]


def merged(symbols: list[int], merges: Merges) -> list[int]:
    """The symbols once no pair can be merged.

    A segment tree holds rank and position of every adjacent pair, the least of each half above it: its
    root is the leftmost pair of the lowest rank. A merge updates three leaves and what is above them.
    Symbols that merges swallow keep their leaf, empty; links lead to the neighbours that are left.
    """
    n, get, made = len(symbols), merges.ranks.get, merges.made
    if n < 2:
        return symbols
    leaves = [get(a << _SHIFT | b, _NONE) + i for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
    leaves += [_NONE] * ((1 << (n - 1).bit_length()) - n + 1)
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(list(map(min, levels[-1][::2], levels[-1][1::2])))
    above = list(zip(levels, levels[1:]))
    root, after, before = levels[-1], list(range(1, n + 1)), list(range(-1, n - 1))

    def put(i: int, value: int) -> None:
        leaves[i] = value
        for below, level in above:
            a, b = below[i & ~1], below[i | 1]
            i >>= 1
            if b < a:
                a = b
            if level[i] == a:
                return
            level[i] = a

    while root[0] < _NONE:
        i = root[0] & _MASK
        j = after[i]
        new = symbols[i] = made[root[0] >> _SHIFT]
        nxt = after[i] = after[j]
        if leaves[j] < _NONE:
            put(j, _NONE)
        if nxt < n:
            before[nxt] = i
            put(i, get(new << _SHIFT | symbols[nxt], _NONE) + i)
        else:
            put(i, _NONE)
        prev = before[i]
        if prev >= 0:
            put(prev, get(symbols[prev] << _SHIFT | new, _NONE) + prev)
    out, i = [], 0
    while i < n:
        out.append(symbols[i])
        i = after[i]
    return out


class Codec:
    """Encoder and decoder of a BPE file with word ends, lower-casing and byte-level symbols.

    Text is cut at the file's special tokens, brought to NFC and lower case and split by the file's
    pattern; each piece becomes the symbols of its UTF-8 bytes, the last with the word end, which merge by
    rank. Without a decoder in the file, decoded text is the tokens joined by spaces. Text beyond Latin
    letters goes through the file's own normaliser and splitter, so that Unicode tables agree.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, first, second = spec["model"], *spec["pre_tokenizer"]["pretokenizers"]
        normal = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if normal != ["NFC", "Replace", "Lowercase"] or (first["type"], second["type"]) != ("Split", "ByteLevel") or spec["decoder"]:
            raise ValueError(f"{path} is not a BPE file with word ends in the form this codec reads")
        self.end = model["end_of_word_suffix"]
        self.vocab = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = Merges([(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in pairs])
        self.split = regex.compile(first["pattern"]["Regex"])
        self.cut = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or "(?!)")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that are their own symbol; the others follow 255
        hidden = [b for b in range(256) if b not in shown]
        self.symbol = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.file = Tokenizer.from_file(path)
        self.known: dict[str, tuple[bytes, str]] = {}
        self.before: dict[str, tuple[bytes, str]] = {}

    def _pieces(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return self.split.findall(text.lower())
        normal = self.file.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.file.pre_tokenizer.pre_tokenize_str(normal)]

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece."""
        symbols = [self.symbol[b] for b in piece.encode("utf-8")]
        symbols[-1] += self.end
        return merged([self.vocab[s] for s in symbols], self.merges)

    def _coded(self, piece: str) -> tuple[bytes, str]:
        found = self.known.get(piece)
        if found is None:
            found = self.before.get(piece)
            if found is None:
                ids = self.merge(piece)
                found = b"".join([i.to_bytes(4, "little") for i in ids]), " ".join([self.names[i] for i in ids])
            if len(piece) <= LONG:
                if len(self.known) >= REMEMBERED:
                    self.known, self.before = {}, self.known
                self.known[piece] = found
        return found

    def code(self, text: str) -> tuple[bytes, str]:
        """Ids, four little-endian bytes each, and the text they decode to."""
        found, coded, at = [], self._coded, 0
        for special in self.cut.finditer(text):
            found += map(coded, self._pieces(text[at:special.start()]))
            found.append((self.special[special[0]].to_bytes(4, "little"), special[0]))
            at = special.end()
        found += map(coded, self._pieces(text[at:] if at else text))
        return b"".join(x[0] for x in found), " ".join(x[1] for x in found)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def coded(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `ids` (binary, four little-endian bytes a token), `n_tokens` and `decoded` of every row.

    `path` names a tokenizer file that every executor has. The whole text is encoded, whatever its length;
    a piece of n bytes takes n log n steps. Null and empty texts have no tokens and decode to the empty
    text. Repeated rows and null ids are rows as any other. Other columns are not read. An empty table
    gives no rows.
    """
    given = docs.select(F.col(id).alias("doc_id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)

        def batch_of(ids: pa.Array, out: list[tuple[bytes, str]]) -> pa.RecordBatch:
            return pa.record_batch(
                [ids, pa.array([x[0] for x in out], pa.binary()), pa.array([len(x[0]) // 4 for x in out], pa.int64()),
                 pa.array([x[1] for x in out], pa.string())],
                names=["doc_id", "ids", "n_tokens", "decoded"],
            )

        for batch in batches:
            ids, texts, start, size, out = batch["doc_id"], batch["text"], 0, 0, []
            for i in range(batch.num_rows):
                out.append(coder.code(texts[i].as_py()))
                size += len(out[-1][0]) + len(out[-1][1])
                if len(out) >= ROWS or size >= BYTES:
                    yield batch_of(ids[start:i + 1], out)
                    start, size, out = i + 1, 0, []
            if out:
                yield batch_of(ids[start:], out)

    kind = dict(given.dtypes)["doc_id"]
    return given.mapInArrow(run, f"doc_id {kind}, ids binary, n_tokens long, decoded string")


def decode(ids: bytes, path: str) -> str:
    """Text of ids as `coded` gives them."""
    names = codec(path).names
    return " ".join(names[int.from_bytes(ids[i:i + 4], "little")] for i in range(0, len(ids), 4))


def default_path() -> str:
    """The public lower-casing vocabulary with word ends."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
