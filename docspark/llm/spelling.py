"""Groups of spelling variants by asymmetric q-chunks."""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import staged, text_of

#: A run of letters.
RUN = "[A-Za-zÀ-ÿ]+"
#: Code points and occurrences of a word at least.
CHARS, COUNT = 6, 5
#: A word's form occurs at least so many times as often.
TIMES = 5


def lowered(word: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.when(word.rlike("[A-Z]"), F.translate(word, string.ascii_uppercase, string.ascii_lowercase)).otherwise(word)


def runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every run of letters of the whole texts, A-Z lowered: `id` (text; empty if null) and `run`. Null text has none."""
    found = F.regexp_extract_all(text_of(text), F.lit(RUN), F.lit(0))
    return docs.select(text_of(id).alias("id"), F.explode(found).alias("run")).select("id", lowered(F.col("run")).alias("run"))


def counted(words: DataFrame, word: str = "word", chars: int = CHARS, count: int = COUNT) -> DataFrame:
    """Different words of at least `chars` code points that occur at least `count` times: `word`, `n`."""
    given = words.select(F.col(word).cast("string").alias("word"))
    return given.where(F.length("word") >= chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= count)


def _pieces(word: Column, parts: list[tuple[Column, int, Column]]) -> Column:
    return F.array(*[F.struct(size.alias("size"), F.lit(part).alias("part"), gram.alias("gram")) for size, part, gram in parts])


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs of words that differ by one inserted, deleted or replaced code point, each pair once.

    Takes `word` (different, of two code points or more) and `n`; returns `x`, `n_x`, `y`, `n_y`, where y is the
    longer one, or the later in code-point order of two of one length. x gives its two disjoint halves, y the grams
    of their lengths at their places, or one on: one edit leaves a half as it is, the first at its place, the
    second moved by the difference of the lengths, so grams further away are not made. What is left of the two is
    compared in full inside the join, which lets verified pairs through only; of a pair that both halves
    find the second is passed over. A half that many words share is split like any skewed join key.
    """
    word, size = F.col("word"), F.length("word")
    half = F.floor(size / 2).cast("int")
    chunks = [(size, 0, F.substring(word, F.lit(1), half)), (size, 1, F.substring(word, half + 1, size))]
    grams = []
    for shift in (0, 1):
        other = size - shift
        middle = F.floor(other / 2).cast("int")
        grams += [(other, 0, F.substring(word, F.lit(1), middle)), (other, 1, F.substring(word, middle + shift + 1, size))]
    a = words.select(word.alias("x"), F.col("n").alias("n_x"), F.inline(_pieces(word, chunks)))
    b = words.select(word.alias("y"), F.col("n").alias("n_y"), F.inline(_pieces(word, grams)))

    x, y, middle, first = F.col("x"), F.col("y"), F.floor(F.col("size") / 2).cast("int"), F.col("part") == 0
    longer = F.length(y) > F.col("size")
    head = lambda w, n: F.substring(w, F.lit(1), n)
    rest = lambda w: F.when(first, F.substring(w, middle + 1, F.length(w))).otherwise(head(w, middle + F.length(w) - F.col("size")))
    once = first | ~longer | (head(x, middle) != head(y, middle))
    joined = a.join(b, ["size", "part", "gram"]).where((longer | (x < y)) & (F.levenshtein(rest(x), rest(y), 1) == 1) & once)
    return joined.select("x", "n_x", "y", "n_y")


def forms(words: DataFrame, times: int = TIMES) -> DataFrame:
    """Words with their more frequent form: `word`, `n`, `n_near`, `form`, `form_n`, `root`.

    `words` has `word` and `n`, one row a word. A word's form is its near word of largest n, the first in code-point
    order of equals, if that n is at least `times` times the word's; else null. `root` is where the forms lead to,
    the word itself if it has none. n grows by `times` with each step, so the largest n bounds a chain's length,
    and steps are doubled until they reach it. An empty table gives no rows.
    """
    words = staged(words.select("word", "n"))
    most, least = words.agg(F.max("n"), F.min("n")).first()
    pairs = near_pairs(words)
    ways = F.array(F.struct(F.col("x").alias("word"), (-F.col("n_y")).alias("less"), F.col("y").alias("near")),
                   F.struct(F.col("y").alias("word"), (-F.col("n_x")).alias("less"), F.col("x").alias("near")))
    near = pairs.select(F.inline(ways)).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct("less", "near")).alias("best"))
    best_n = -F.col("best.less")
    enough = best_n >= times * F.col("n")
    words = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, best_n).alias("form_n")))

    steps = words.where("form IS NOT NULL").select("word", F.col("form").alias("to"))
    length = math.floor(math.log(most / least, times) + 1e-9) if most else 0  # of the longest chain
    for _ in range(max(length - 1, 0).bit_length()):
        steps = staged(steps)
        on = steps.select(F.col("word").alias("to"), F.col("to").alias("_on"))
        steps = steps.join(on, "to", "left").select("word", F.coalesce("_on", "to").alias("to"))
    return words.join(steps, "word", "left").withColumn("root", F.coalesce("to", "word")).drop("to")
