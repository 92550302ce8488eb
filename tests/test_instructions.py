"""Instructions as a table: every kind, lists of their own, odd rows."""

import pytest
from pyspark.sql import functions as F

from scoreloom.operators import instructions as I

CASES = [
    ("word_count", {"n": "3"}, "one two three", "one two"),
    ("word_count", {"n": "3", "relation": "less than"}, "one two", "one two three"),
    ("word_count", {"n": "2", "relation": "exactly"}, " a  b ", "a b c"),
    ("sentence_count", {"n": "2"}, "First one. Second one!", "Only one... sentence"),
    ("line_count", {"n": "2", "relation": "exactly"}, "a\n\n b", "a\nb\nc"),
    ("paragraph_count", {"n": "2"}, "a\nb\n \nc", "a\nb\nc"),
    ("bullet_count", {"n": "2", "relation": "exactly"}, "* a\n - b\ntext", "* a\n*b"),
    ("placeholder_count", {"n": "1"}, "send [name] that", "send [] that"),
    ("highlight_count", {"n": "1"}, "a *bold* word", "2 * 3"),
    ("capital_word_count", {"n": "1"}, "so WOW, ÄÖ", "So W1, I"),
    ("letter_count", {"n": "2", "letter": "A"}, "Banana", "bone a"),
    ("word_frequency", {"n": "2", "word": "c++"}, "C++ or c++!", "c++ or c++c"),
    ("word_frequency", {"n": "1", "word": "über"}, "Über allem", "darüber"),
    ("words_present", {"words": "red|blue"}, "Blue, red.", "red reblue"),
    ("words_absent", {"words": "red|a\\E.b"}, "reddish a.b", "a\\E.b"),
    ("all_lower", {}, "low ä 1", "Low"),
    ("all_upper", {}, "HIGH 1", "High"),
    ("no_comma", {}, "a; b", "a, b"),
    ("json", {}, '```json\n{"a": [1]}\n```', '{"a": 1} x'),
    ("title", {}, "<<My title>>\ntext", "<< >> text"),
    ("quoted", {}, ' "all of it" ', '"'),
    ("starts_with", {"text": "dear"}, "\n Dear all".lstrip("\n"), "My dear"),
    ("ends_with", {"text": "the end."}, "It is The End. ", "the end. No"),
    ("one_of", {"choices": "yes|no"}, " yes ", "yes no"),
    ("parts", {"separator": "***", "n": "2", "relation": "exactly"}, "a *** b", "a *** "),
]


def test_every_kind(spark):
    assert {c[0] for c in CASES} == set(I.KINDS)
    rows = [(kind, arguments, good, bad) for kind, arguments, good, bad in CASES]
    df = spark.createDataFrame(rows, "kind string, arguments map<string,string>, good string, bad string")
    found = df.select("kind", "arguments", *(I.follows(F.col(c), F.col("kind"), F.col("arguments")).alias(c) for c in ("good", "bad")))
    wrong = [tuple(r) for r in found.collect() if (r.good, r.bad) != (True, False)]
    assert wrong == []


INSTRUCTIONS = "id bigint, ord int, kind string, arguments map<string,string>"


def test_lists_of_their_own(spark):
    asked = spark.createDataFrame(
        [(1, 0, "no_comma", {}), (1, 1, "word_count", {"n": "2"}), (2, 0, "all_lower", {}), (3, 0, "no such kind", {}),
         (3, 1, "word_count", {}), (3, 2, "no_comma", {}), (9, 0, "no_comma", {})],
        INSTRUCTIONS,
    )
    replies = spark.createDataFrame(
        [(1, 0, "one two", "x"), (1, 1, "one, two", "x"), (2, 0, "*B*\nlow", "x"), (3, 0, "", "y"), (3, 1, None, "y"), (4, 0, "no list", "y")],
        "id bigint, sample int, text string, kind string",
    )
    marks = I.judged(replies.drop("kind"), asked, prompt="id", response="text", keep=["sample"], loose=True)
    got = {(r.id, r.sample, r.ord): (r.strict, r.loose) for r in marks.collect()}
    assert got == {
        (1, 0, 0): (True, True), (1, 0, 1): (True, True), (1, 1, 0): (False, False), (1, 1, 1): (True, True), (2, 0, 0): (False, True),
        (3, 0, 0): (None, None), (3, 0, 1): (None, None), (3, 0, 2): (False, False), (3, 1, 0): (None, None), (3, 1, 1): (None, None),
        (3, 1, 2): (False, False),
    }
    total = I.accuracy(marks, [], ["id", "sample"]).first()
    assert (total.n_instructions, total.n_prompts) == (7, 5)
    assert (total.inst_level_strict_acc, total.prompt_level_strict_acc) == (pytest.approx(3 / 7), pytest.approx(1 / 5))
    kinds = {r.kind: (r.n, r.strict_accuracy) for r in I.by_kind(marks).collect()}
    assert kinds["no such kind"] == (0, None) and kinds["no_comma"] == (4, 0.25)


def test_one_long_list(spark):
    asked = spark.range(500).select(F.lit(1).alias("id"), F.col("id").cast("int").alias("ord"), F.lit("word_count").alias("kind"),
                                    F.create_map(F.lit("n"), F.col("id").cast("string")).alias("arguments"))
    replies = spark.createDataFrame([(1, "word " * 250)], "id int, text string")
    total = I.accuracy(I.judged(replies, asked, prompt="id", response="text"), [], ["id"]).first()
    assert (total.n_instructions, total.inst_level_strict_acc, total.prompt_level_strict_acc) == (500, 251 / 500, 0.0)


def test_patterns_give_the_counts_of_whole_sentences_and_words(spark):
    import re

    texts = ["", ".", "a.", "a .", " . a", "a. b", "a.. b!? c", "a\n.\nb", "... a", "a . . b.", "é. ß!x", "no mark", "AB CD.EF AB_ ÄÖ-Ü ABc", "DE de\tde_ Dé DE", "a . b"]
    sentences = lambda t: len(re.findall(r"[^.!?\s][^.!?]*[.!?]+", t, re.ASCII))
    capitals = lambda t: sum(len(w) > 1 and w.isalpha() and w == w.upper() and w != w.lower() for w in re.split(r"\W+", t))
    words = lambda t: sum(w.lower() == "de" for w in re.split(r"\W+", t))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind, given, count in [("sentence_count", {}, sentences), ("capital_word_count", {}, capitals), ("word_frequency", {"word": "de"}, words)]:
        for t in texts:
            arguments = F.create_map(*(F.lit(x) for pair in {**given, "n": str(count(t)), "relation": "exactly"}.items() for x in pair))
            assert df.where(F.col("t") == t).select(I.follows(F.col("t"), F.lit(kind), arguments)).first()[0], (kind, t)


def test_long_text_without_marks_takes_linear_time(spark):
    import time

    df = spark.range(2).select(F.repeat(F.lit("word "), 60_000).alias("t"))
    arguments = F.create_map(F.lit("n"), F.lit("1"))
    judged = df.select(I.follows(F.col("t"), F.lit("sentence_count"), arguments).alias("ok"))
    start = time.perf_counter()
    assert [r.ok for r in judged.collect()] == [False, False]
    assert time.perf_counter() - start < 20
