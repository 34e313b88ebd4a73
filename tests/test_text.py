from pyspark.sql import functions as F

from docspark import Doc
from docspark.functions.stemming import stem, stem_word
from docspark.functions.text import analyze, query_tokens, register_analyzer

# Examples given with the published algorithm.
STEMS = dict(
    caresses="caress", ponies="poni", ties="ti", caress="caress", cats="cat", feed="feed", agreed="agre",
    plastered="plaster", bled="bled", motoring="motor", sing="sing", conflated="conflat", troubled="troubl",
    sized="size", hopping="hop", tanned="tan", falling="fall", hissing="hiss", fizzed="fizz", failing="fail",
    filing="file", happy="happi", sky="sky", relational="relat", conditional="condit", rational="ration",
    valenci="valenc", digitizer="digit", conformabli="conform", radicalli="radic", differentli="differ",
    vileli="vile", analogousli="analog", vietnamization="vietnam", predication="predic", operator="oper",
    feudalism="feudal", decisiveness="decis", hopefulness="hope", callousness="callous", formaliti="formal",
    sensitiviti="sensit", sensibiliti="sensibl", triplicate="triplic", formative="form", formalize="formal",
    electriciti="electr", electrical="electr", hopeful="hope", goodness="good", revival="reviv",
    allowance="allow", inference="infer", airliner="airlin", gyroscopic="gyroscop", adjustable="adjust",
    defensible="defens", irritant="irrit", replacement="replac", adjustment="adjust", dependent="depend",
    adoption="adopt", homologou="homolog", communism="commun", activate="activ", angulariti="angular",
    homologous="homolog", effective="effect", bowdlerize="bowdler", probate="probat", rate="rate", cease="ceas",
    controll="control", roll="roll", basement="basement", yes="ye", generalizations="gener",
)


def test_stems():
    assert {w: stem_word(w) for w in STEMS} == STEMS
    assert [stem_word(w) for w in ("is", "a", "", "x1")] == ["is", "a", "", "x1"]


def test_stems_of_arrays(spark):
    rows = [(1, ["cats", "hopping"]), (2, []), (3, None), (4, ["cats", None]), (5, ["sky"])]
    df = spark.createDataFrame(rows, "id int, t array<string>").repartition(2)
    got = {r.id: r.s for r in df.select("id", stem("t").alias("s")).collect()}
    assert got == {1: ["cat", "hop"], 2: [], 3: None, 4: ["cat", None], 5: ["sky"]}
    odd = df.where("id <> 1").select("id", stem("t").alias("s")).collect()
    assert {r.id: r.s for r in odd} == {k: v for k, v in got.items() if k != 1}


def test_analyzers(spark):
    text = "The Dog's café-houses, 3rd RUN"
    assert query_tokens(text) == ["the", "dog", "s", "café", "houses", "3rd", "run"]
    assert query_tokens(text, "english") == ["dog", "café", "hous", "3rd", "run"]
    assert query_tokens(text, "simple") == ["the", "dog", "s", "café", "houses", "rd", "run"]
    assert query_tokens(text, "stop") == ["dog", "s", "café", "houses", "rd", "run"]
    assert query_tokens(text, "whitespace") == ["The", "Dog's", "café-houses,", "3rd", "RUN"]
    assert query_tokens(text, "keyword") == [text]
    register_analyzer("commas", lambda c: F.split(c, ","))
    assert query_tokens(text, "commas") == ["The Dog's café-houses", " 3rd RUN"]


def test_bounded_match_equals_token_arrays(spark):
    texts = ["The end", "the-end", "theend", "", None, "end\nof THE", "1the 2", "ünder the", "the9 end", "(the) end."]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for wanted in ("the", "end the", "9", "ünder", "2 1the"):
        tokens = analyze(F.col("t"))
        slow = df.where(F.size(F.array_except(F.array(*map(F.lit, query_tokens(wanted))), tokens)) == 0)
        fast = df.where(Doc(df)["t"].text(wanted))
        assert {r.id for r in fast.collect()} == {r.id for r in slow.collect()}, wanted


def test_group_stems_against_plain_python(spark):
    """The English grouping against a count made without Spark's functions."""
    from collections import Counter

    import regex

    from docspark import aggregate, by_field
    from docspark.functions.text import STOP_WORDS

    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = Counter()
    for row in documents.select("text").collect():
        bare = regex.sub(r"['’]s(?![\p{L}\p{N}])", "", row.text.lower())
        words = {w for w in regex.split(r"[^\p{L}\p{N}]+", bare) if w} - set(STOP_WORDS)
        expected.update({stem_word(w) for w in words})
    groups = aggregate(documents, by_field("text", analyzer="english"), total=True)
    assert {r.k0: r.total for r in groups.collect()} == dict(expected)


def test_stems_of_a_long_batch_are_made_in_slices():
    import pyarrow as pa

    from docspark.functions.stemming import ROWS, stem

    tokens = [None if i % 7 == 0 else [f"running{i}", "houses", None][: i % 4] for i in range(3 * ROWS + 11)]
    made = list(stem.func(iter([pa.array(tokens, pa.list_(pa.string()))])))
    assert max(map(len, made)) <= ROWS
    assert [v for m in made for v in m.to_pylist()] == [
        None if t is None else [None if w is None else stem_word(w) for w in t] for t in tokens]
