"""English stemming of token arrays: an Arrow UDF that stems each distinct word of a batch once."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

# The functions travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Porter's suffix stripping (M. F. Porter, "An algorithm for suffix stripping", 1980,
# with the author's later -bli and -logi rules). A word is a run of consonant groups C
# and vowel groups V; its measure m counts VC pairs.
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_M_OVER_0 = re.compile(f"(?:{_C})?{_V}{_C}")
_M_IS_1 = re.compile(f"(?:{_C})?{_V}{_C}(?:{_V})?$")
_M_OVER_1 = re.compile(f"(?:{_C})?{_V}{_C}{_V}{_C}")
_HAS_VOWEL = re.compile(f"(?:{_C})?[aeiouy]")
_ENDS_CVC = re.compile(f"{_C}[aeiouy][^aeiouwxy]$")
_DOUBLE = re.compile(r"([^aeiouylsz])\1$")

# Suffix tables of steps 2, 3 and 4 of the published algorithm.
_STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "logi": "log",
}
_STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "",
    "ness": "",
}
_STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _suffix(word: str, suffixes) -> str | None:
    """The longest suffix of the word among the given ones that leaves a stem."""
    if not word.endswith(tuple(suffixes)):
        return None
    found = [s for s in suffixes if word.endswith(s) and len(word) > len(s)]
    return max(found, key=len) if found else None


def _inflection(word: str) -> str:
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        return word[:-1] if _M_OVER_0.match(word[:-3]) else word
    ending = _suffix(word, ("ed", "ing"))
    if ending is None or not _HAS_VOWEL.match(word[: -len(ending)]):
        return word
    word = word[: -len(ending)]
    if word.endswith(("at", "bl", "iz")) or _ENDS_CVC.match(word):
        return word + "e"
    return word[:-1] if _DOUBLE.search(word) else word


def stem_word(word: str) -> str:
    """Stem of one lower-case word; words of one or two letters stay as they are."""
    if len(word) <= 2:
        return word
    if word[0] == "y":  # a leading y is a consonant; upper case keeps it out of the vowels
        word = "Y" + word[1:]
    word = _inflection(word)
    if word.endswith("y") and _HAS_VOWEL.match(word[:-1]):
        word = word[:-1] + "i"
    for table in (_STEP_2, _STEP_3):
        ending = _suffix(word, table)
        if ending and _M_OVER_0.match(word[: -len(ending)]):
            word = word[: -len(ending)] + table[ending]
    ending = _suffix(word, _STEP_4)
    if ending is None and word.endswith(("sion", "tion")):
        ending = "ion"
    if ending and _M_OVER_1.match(word[: -len(ending)]):
        word = word[: -len(ending)]
    if word.endswith("e"):
        bare = word[:-1]
        if _M_OVER_1.match(bare) or (_M_IS_1.match(bare) and not _ENDS_CVC.match(bare)):
            word = bare
    if word.endswith("ll") and _M_OVER_1.match(word):
        word = word[:-1]
    return word.lower()


#: Rows worked on at once and words whose stems a worker remembers: its memory does not follow the batch.
ROWS, REMEMBERED = 500, 100_000


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Stems of arrays of lower-case tokens."""
    known: dict[str | None, str | None] = {None: None}
    for tokens in (batch[at:at + ROWS] for batch in batches for at in range(0, len(batch), ROWS)):
        if len(known) > REMEMBERED:
            known = {None: None}
        words = tokens.flatten().dictionary_encode()
        distinct = words.dictionary.to_pylist()
        known.update((w, stem_word(w)) for w in distinct if w not in known)
        stems = pa.array([known[w] for w in distinct], pa.string())
        lengths = pc.fill_null(pc.list_value_length(tokens), 0).cast(pa.int64())
        offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(lengths)])
        yield pa.ListArray.from_arrays(
            offsets.cast(pa.int32()), stems.take(words.indices), mask=tokens.is_null())
