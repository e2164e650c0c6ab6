import random

import pytest
from pyspark.sql import functions as F

from chirrup.functions.text import word_counts
from chirrup.operators.polarity import score
from chirrup.schemas import LEXICON, LEXICON_WITH_DEGREES
from chirrup.sources.lexicon import read_lexicon, read_xml_lexicon, starter_lexicon
from tests.fixture import WORDS, lexicon_df

VOCABULARY, JOIN = {}, {"max_broadcast_words": 0}


def scores(spark, texts, lexicon, **options):
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, text string")
    scored = score(df, "text", lexicon, **options)
    assert scored.columns == ["i", "text", "sentiment_score"]
    return [row.sentiment_score for row in scored.orderBy("i").collect()]


@pytest.mark.parametrize("options", [VOCABULARY, JOIN])
def test_mean_of_known_words(spark, options):
    texts = [None, "", "nothing known", "I LOVE this", "I hate this", "love hate", "good-good, bad!", "lovely badly",
             "ébad bad", "good good", "good good"]
    got = scores(spark, texts, lexicon_df(spark), **options)
    assert got == [0.0, 0.0, 0.0, 0.5, -0.8, -0.15, 0.233333, 0.0, -0.7, 0.7, 0.7]


def test_signs_of_the_example_sentences(spark):
    love, hate = scores(spark, ["I love this", "I hate this"], starter_lexicon(spark))
    assert love > 0 > hate


@pytest.mark.parametrize("options", [VOCABULARY, JOIN])
def test_against_plain_python(spark, options):
    rng = random.Random(7)
    polarity = dict(WORDS)
    words = [*polarity, "x", "meh", "Love", "BAD", "..."]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(200)]

    def plain(text):
        known = [polarity[word] for word in text.lower().split() if word in polarity]
        return sum(known) / len(known) if known else 0.0

    got = scores(spark, texts, lexicon_df(spark), **options)
    assert got == pytest.approx([plain(text) for text in texts], abs=1e-6)


@pytest.mark.parametrize("options", [VOCABULARY, JOIN])
def test_lexicon_rows_are_cleaned(spark, options):
    lexicon = spark.createDataFrame([(" Fine ", 0.2), ("fine", 0.4), ("bad", None), (None, 1.0)], LEXICON)
    assert scores(spark, ["fine bad"], lexicon, **options) == [0.3]


def test_both_ways_give_the_same_scores(spark):
    rng = random.Random(11)
    lexicon = spark.createDataFrame([(f"word{chr(97 + k)}", rng.randint(-999, 999) / 1000) for k in range(26)], LEXICON)
    texts = [" ".join(f"word{chr(97 + rng.randrange(30) % 26)}" for _ in range(rng.randint(0, 30))) for _ in range(20_000)]
    assert scores(spark, texts, lexicon, **VOCABULARY) == scores(spark, texts, lexicon, **JOIN)


def test_empty_lexicon(spark):
    assert scores(spark, ["love"], lexicon_df(spark).limit(0)) == [0.0]


DEGREES = [("good", 0.7, None), ("bad", -0.7, None), ("not", None, -0.5), ("very", None, 1.3), ("slightly", None, 0.5),
           ("pretty", 0.2, 1.2), ("zero", None, 0.0), ("good", None, None)]


@pytest.mark.parametrize("options", [VOCABULARY, JOIN])
def test_words_that_change_others(spark, options):
    lexicon = spark.createDataFrame(DEGREES, LEXICON_WITH_DEGREES)
    cases = {
        "good": 0.7, "not good": -0.35, "NOT, good!": -0.35, "very good": 0.91, "very very good": 1.0,
        "not very good": -0.269231, "very not good": -0.269231, "not not good": 0.175, "not slightly good": -0.7,
        "not the the good": -0.35, "not the the the good": 0.7, "not the the very the the good": -0.269231,
        "not good bad": -0.525, "bad not": -0.7, "not": 0.0, "pretty good": 0.52, "not pretty good": 0.37,
        "zero good": 0.7, "good " * 40 + "not bad": 0.691463, "\u00e9 not good": -0.35, None: 0.0, "": 0.0,
    }
    assert scores(spark, list(cases), lexicon, **options) == list(cases.values())
    plain = scores(spark, list(cases), lexicon.filter("polarity is not null").drop("degree"), **options)
    assert scores(spark, list(cases), lexicon, reach=0, **options) == plain
    assert scores(spark, list(cases), lexicon.withColumn("degree", F.lit(None).cast("double")), **options) == plain


def test_not_good_is_negative_with_the_starter_lexicon(spark):
    lexicon = starter_lexicon(spark, degrees=True)
    bad, mild, good, isnt = scores(spark, ["not good", "not very good", "very good", "This isn't good"], lexicon)
    assert bad < mild < 0 < good and isnt < 0


def plain_scan(text, lexicon, reach=3):
    """In plain numbers, word by word."""
    gains, waiting, last = [], [], None
    for place, word in enumerate(text.split()):
        polarity, degree = lexicon.get(word, (None, None))
        if last is not None and place - last > reach:
            waiting = []
        if polarity is not None:
            factor, below = 1.0, [d for d in waiting if d < 0]
            for d in waiting:
                factor *= d if d > 0 else 1
            if below:
                negation = 1.0
                for d in below:
                    negation *= d
                factor = negation / factor
            gains.append(max(-1.0, min(1.0, polarity * factor)))
            waiting, last = [], None
        if degree is not None:
            waiting, last = [*waiting, degree], place
    return sum(gains) / len(gains) if gains else 0.0


@pytest.mark.parametrize("options", [VOCABULARY, JOIN])
def test_changes_against_plain_python(spark, options):
    rng = random.Random(3)
    lexicon = {word: (polarity, degree) for word, polarity, degree in DEGREES[:6]}
    words = [*lexicon, *["x"] * 6]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 25))) for _ in range(400)]
    texts += texts[:50]  # copies are scored once and all get the score
    got = scores(spark, texts, spark.createDataFrame(DEGREES[:6], LEXICON_WITH_DEGREES), **options)
    assert got == pytest.approx([plain_scan(text, lexicon) for text in texts], abs=2e-6)


def test_a_lexicon_with_degrees_needs_no_shuffle_and_no_python_worker(spark):
    df = spark.range(10).select(F.concat(F.lit("I do not love "), "id").alias("text"))
    plan = score(df, "text", starter_lexicon(spark, degrees=True))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "from_json" not in plan
    assert plan.count("regexp_extract_all") == 1


def test_word_counts_of_a_row(spark):
    rng = random.Random(5)
    rows = [rng.choices(["a", "b", "", "\u00e9", "zz"], k=rng.randint(0, 30)) for _ in range(200)] + [[]]
    df = spark.createDataFrame([(i, row) for i, row in enumerate(rows)], "i int, words array<string>")
    for row in df.select("i", word_counts(F.col("words")).alias("counts")).collect():
        want = {word: rows[row.i].count(word) for word in rows[row.i]}
        assert [tuple(c) for c in row.counts] == sorted(want.items(), key=lambda c: c[0].encode())


def test_a_joined_lexicon_explodes_only_what_its_sieve_lets_through(spark, tmp_path):
    """Of 1,000 words that no lexicon has, few are exploded, and neither texts nor words without letters meet in one task."""
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(1000)]
    df = spark.createDataFrame([(" ".join(words) + f" good {k}",) for k in range(50)] + [(None,)] * 300 + [("...",)] * 300, "text string")
    scored = score(df, "text", lexicon_df(spark), **JOIN)
    assert sorted(row.sentiment_score for row in scored.collect()) == [0.0] * 600 + [0.7] * 50
    found = []

    def walk(node):
        if "Generate" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))
        for inner in ("executedPlan", "plan", "child"):
            if node.nodeName() in ("AdaptiveSparkPlan",) and inner == "executedPlan":
                walk(node.executedPlan())
            if "QueryStage" in node.nodeName() and inner == "plan":
                walk(node.plan())

    walk(scored._jdf.queryExecution().executedPlan())
    assert sum(found) < 0.2 * 50 * 1000


def test_both_ways_agree_for_a_large_lexicon(spark):
    """More words than the bound, many of them in the texts."""
    rng = random.Random(13)
    entries = [(f"w{chr(97 + a)}{chr(97 + b)}{chr(97 + c)}", rng.randint(-999, 999) / 1000) for a in range(20) for b in range(20) for c in range(20)]
    lexicon = spark.createDataFrame(entries, LEXICON)
    texts = [" ".join(rng.choice(entries)[0] if rng.random() < 0.3 else f"x{rng.randrange(50)}" for _ in range(40)) for _ in range(300)]
    assert scores(spark, texts, lexicon, **VOCABULARY) == scores(spark, texts, lexicon, max_broadcast_words=7999)


def test_scoring_shuffles_nothing_and_needs_no_python_worker(spark):
    df = spark.range(10).select(F.lit("I love this").alias("text"))
    plan = score(df, "text", lexicon_df(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_lexicon_files(spark, tmp_path):
    (tmp_path / "words.csv").write_text("word,polarity\nlove,0.5\nhate,-0.8\n")
    assert sorted(map(tuple, read_lexicon(spark, str(tmp_path / "words.csv")).collect())) == [
        ("hate", -0.8), ("love", 0.5)
    ]
    (tmp_path / "degrees.csv").write_text("word,polarity,degree\nlove,0.5,\nnot,,-0.5\n")
    got = read_lexicon(spark, str(tmp_path / "degrees.csv"), degrees=True)
    assert sorted(map(tuple, got.collect())) == [("love", 0.5, None), ("not", None, -0.5)]
    (tmp_path / "words.xml").write_text(
        '<sentiment><word form="fine" pos="JJ" polarity="0.4"/><word form="fine" pos="JJ" polarity="0.6"/>'
        '<word form="fine" pos="RB" polarity="0.1"/><word form="awful" pos="JJ" polarity="-1.0"/></sentiment>'
    )
    got = dict(map(tuple, read_xml_lexicon(spark, str(tmp_path / "words.xml")).collect()))
    assert got == pytest.approx({"fine": 0.3, "awful": -1.0})
