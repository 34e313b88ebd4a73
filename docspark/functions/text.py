"""Text analysis as Column expressions: analysers, token match, wildcard."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, SparkSession, functions as F

from docspark.functions.stemming import stem

# The common English stop list.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
)

_SEPARATORS = r"[^\p{L}\p{N}]+"


def _pieces(text: Column, separators: str) -> Column:
    return F.filter(F.split(text, separators), lambda t: t != "")


def _without_stop_words(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(*STOP_WORDS))


def _standard(c: Column) -> Column:
    return _pieces(F.lower(c), _SEPARATORS)


def _simple(c: Column) -> Column:
    return _pieces(F.lower(c), r"[^\p{L}]+")


def _english(c: Column) -> Column:
    bare = F.regexp_replace(F.lower(c), r"['’]s(?![\p{L}\p{N}])", "")
    return _without_stop_words(_pieces(bare, _SEPARATORS))


def _same(tokens: Column) -> Column:
    return tokens


# Name -> (tokens of one text, what then happens to a token array).
_ANALYZERS: dict[str, tuple[Callable[[Column], Column], Callable[[Column], Column]]] = {
    "standard": (_standard, _same),
    "simple": (_simple, _same),
    "whitespace": (lambda c: _pieces(c, r"\s+"), _same),
    "keyword": (lambda c: F.array_compact(F.array(c)), _same),
    "stop": (lambda c: _without_stop_words(_simple(c)), _same),
    "english": (_english, stem),
}


def register_analyzer(
    name: str, tokens: Callable[[Column], Column], finish: Callable[[Column], Column] = _same
) -> None:
    """Add an analyser: `tokens` from a string to an array<string> Column, `finish` over the array.

    `tokens` runs inside higher-order functions on array fields, so a UDF goes in `finish`.
    """
    _ANALYZERS[name] = (tokens, finish)


def analyze(
    c: Column, analyzer: str = "standard", is_array: bool = False, distinct: bool = False
) -> Column:
    """Tokens of a string column, or of all elements of an array of strings.

    In order with repeats, or each once with `distinct`.
    """
    if analyzer not in _ANALYZERS:
        raise ValueError(f"unknown analyzer {analyzer!r}; known: {sorted(_ANALYZERS)}")
    tokens, finish = _ANALYZERS[analyzer]
    found = F.flatten(F.transform(F.array_compact(c), lambda t: tokens(t))) if is_array else tokens(c)
    if not distinct:
        return finish(found)
    found = F.array_distinct(found)
    return found if finish is _same else F.array_distinct(finish(found))


def query_tokens(text: str, analyzer: str = "standard") -> list[str]:
    """Distinct tokens of one literal, through the same expression the data goes through."""
    spark = SparkSession.active()
    one_row = spark.sql("SELECT 1").select(analyze(F.lit(text), analyzer, distinct=True).alias("t"))
    return list(one_row.first()["t"])


def has_all_tokens(
    c: Column, text: str, analyzer: str = "standard", is_array: bool = False, tokenised: bool = False
) -> Column:
    """Every token of `text` occurs in the column; no tokens match nothing.

    `tokenised` says that the column already holds tokens of `analyzer`.
    """
    wanted = query_tokens(text, analyzer)
    if not wanted:
        return F.lit(False)
    if analyzer == "standard" and not tokenised:
        # A token is a maximal run of letters and digits, so a bounded regular expression
        # finds it without the token array of each row. Plain search goes first, as it
        # settles most rows, and the lambda holds the lowered text for all tests.
        lowered = F.lower(F.array_join(c, " ") if is_array else c)
        whole = r"(?<![\p{L}\p{N}])%s(?![\p{L}\p{N}])"
        return F.exists(F.array(lowered), lambda t: reduce(
            lambda a, b: a & b, [t.contains(w) for w in wanted] + [t.rlike(whole % w) for w in wanted]))
    tokens = c if tokenised else analyze(c, analyzer, is_array, distinct=True)
    return F.size(F.array_except(F.array(*map(F.lit, wanted)), tokens)) == 0


def like_pattern(wildcard: str) -> str:
    """LIKE pattern of a glob in which `*` stands for any run of characters."""
    escaped = wildcard.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return escaped.replace("*", "%")
