"""Quality rules: a table of thresholds compiled into one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import let, text_of, words_of

#: Frequent function words (fixed values).
STOP_WORDS = (
    "the be to of and that have with for is it in on this are was by from as at or an "
    "der die das und den von zu mit sich des ist im nicht ein eine als auch es an "
    "le la les de des et en un une du est que qui dans pour pas sur au par il "
    "el los las del que y una por con para se no al lo como su o"
).split()

#: What may stand before or after a stop word, which counts in either case.
PUNCTUATION = ".,;:!?\"()[]"

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A document fails where `measure` is outside low..high and it has at least `from_words` words."""

    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: The base conditions are in `base_failed`; these are the method's own. A null measure passes.
RULES = (
    Rule("word_length", low=2.0, high=12.0),
    Rule("symbols_per_word", high=0.1),
    Rule("stop_word_ratio", low=0.01, from_words=50),
    Rule("dup_line_ratio", high=0.5),
)


def _repeated_words(hashes: Column) -> Column:
    """Words inside a five-word window that the text has at least twice; `hashes` has one for each word.

    Windows are compared by 64-bit hash. Only texts that have some hash twice sort theirs, by hash and
    position, so a text of n words takes n log n steps however often it repeats itself.
    """
    count = F.size(hashes)
    windows = F.transform(
        F.sequence(F.lit(0), count - WINDOW),
        lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]),
    )

    def covered(found: Column) -> Column:
        ordered = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(ordered, lambda s: F.filter(
            s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
        ))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return F.aggregate(
            starts, F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n")),
            lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(F.lit(WINDOW), i - a["at"])).alias("n")),
            lambda a: a["n"],
        )

    some = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0))
    return F.when(count > WINDOW, some).otherwise(0)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of `docs` as one struct `row`, and the counts that rules are made of.

    A null text counts as empty; an empty text has no words, lines or symbols.
    """
    given = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row") if docs.columns else F.lit(None)
    lines = F.filter(F.split(F.col("_text"), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.select(given, text_of(text).alias("_text")).select(
        "row", "_text", words_of(F.col("_text")).alias("_words"), lines.alias("_lines")
    )
    return split.select(
        "row",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(F.col("_text"), F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        let(F.transform("_words", lambda w: F.xxhash64(w)), _repeated_words).cast("long").alias("n_repeat_words"),
        F.size(F.filter("_words", lambda w: F.btrim(F.lower(w), F.lit(PUNCTUATION)).isin(*sorted(set(STOP_WORDS))))).cast("long").alias("n_stop_words"),
    )


def ratios() -> dict[str, Column]:
    """Measures by name; null where there is nothing to divide by."""
    per = lambda a, b: F.col(a).cast("double") / F.nullif(F.col(b), F.lit(0))
    return {
        "word_length": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "stop_word_ratio": per("n_stop_words", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
    }


def passes(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table of rules as one condition over the counts of `measured`."""
    measures, kept = ratios(), F.lit(True)
    for rule in rules:
        value, fails = measures[rule.measure], F.lit(False)
        if rule.low is not None:
            fails = fails | (value < rule.low)
        if rule.high is not None:
            fails = fails | (value > rule.high)
        kept = kept & ~F.coalesce(fails & (F.col("n_words") >= rule.from_words), F.lit(False))
    return kept


def judged(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: `row` (its columns), the counts, `base_failed` and `kept`.

    base_failed: under ten words, or more than a fifth of the words lie in windows of five words that
    the text has at least twice. kept: not base_failed, and every rule of the table passes. A null text
    counts as empty and fails. Repeated rows are judged each; extra columns stay in `row`, whatever
    their names; an empty table gives none.
    """
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured(docs, text).withColumn("base_failed", base).withColumn("kept", ~base & passes(rules))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that no rule rejects, with their columns."""
    return judged(docs, text, rules).where("kept").select("row.*")
