import math
import random

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from chirrup.operators.bronze import bronze
from chirrup.operators import predictions
from chirrup.operators.predictions import fit, fit_predict, fold_of, out_of_fold, predict, term_weights, tfidf, vocabulary
from chirrup.schemas import TWEET
from tests.fixture import rows, tweets_df

POSITIVE = ["sunny great day", "great happy news", "happy sunny walk"]
NEGATIVE = ["awful rainy day", "sad awful news", "rainy sad walk"]


def toy(spark, copies=5):
    texts = [(text, 1) for text in POSITIVE] + [(text, 0) for text in NEGATIVE]
    data = [(i, label, i, text, i) for i, (text, label) in enumerate(texts * copies)]
    return spark.createDataFrame(data, TWEET)


def test_separable_texts_are_predicted_exactly(spark):
    tweets = toy(spark)
    got = fit_predict(tweets).join(tweets, "id")
    assert got.columns[:2] == ["id", "ml_sentiment"]
    assert got.filter("(label = 1) != (ml_sentiment = 'positive')").count() == 0
    assert {row.ml_sentiment for row in got.collect()} == {"positive", "negative"}


def test_unlabelled_texts_are_predicted_and_missing_texts_are_not(spark):
    more = [(100, None, 0, "a GREAT sunny day", 1), (101, None, 0, "rainy, awful", 1), (102, 1, 0, None, 1)]
    tweets = toy(spark).unionAll(spark.createDataFrame(more, TWEET))
    got = dict(rows(fit_predict(tweets).filter("id >= 100")))
    assert got == {100: "positive", 101: "negative"}


def test_holdout(spark):
    model = fit(toy(spark))
    unseen = spark.createDataFrame([(1, None, 0, "great walk", 1), (2, None, 0, "sad walk", 1)], TWEET)
    assert rows(predict(model, unseen)) == [(1, "positive"), (2, "negative")]


def test_predictions_in_a_session_that_observes(spark):
    observation = Observation()
    spark.range(3).observe(observation, F.count(F.lit(1)).alias("n")).collect()
    assert observation.get["n"] == 3
    assert len(fit_predict(toy(spark)).collect()) == 30


def test_predictions_feed_bronze(spark):
    tweets = toy(spark)
    joined = bronze(tweets, fit_predict(tweets))
    assert joined.count() == tweets.count()
    assert joined.filter("ml_sentiment IS NULL").count() == 0


def test_nothing_to_fit_on(spark):
    with pytest.raises(ValueError):
        fit(tweets_df(spark).filter("label IS NULL"))


def test_vocabulary_counts_and_weights(spark):
    texts = ["One one two", "two x naïve ça", "two_2 22 -- two", None, ""]
    tweets = spark.createDataFrame([(i, 1, 0, text, 1) for i, text in enumerate(texts)], TWEET)
    got = {row.term: row for row in vocabulary(tweets).collect()}
    assert {term: (row.term_count, row.doc_count) for term, row in got.items()} == {
        "one": (2, 1), "two": (3, 3), "naïve": (1, 1), "ça": (1, 1), "two_2": (1, 1), "22": (1, 1)
    }
    for row in got.values():
        assert row.idf == pytest.approx(math.log(5 / (row.doc_count + 1)) + 1)
    assert [row.term for row in vocabulary(tweets, 3).collect()] == ["two", "one", "22"]


def test_features_equal_the_formula(spark):
    texts = ["one one two", "two three", "three four four"]
    tweets = spark.createDataFrame([(i, 1, 0, text, 1) for i, text in enumerate(texts)], TWEET)
    idf = {row.term: row.idf for row in vocabulary(tweets).collect()}
    got = {(row.id, row.term): row.weight for row in term_weights(tweets).collect()}
    want = {}
    for i, text in enumerate(texts):
        words = text.split()
        raw = {word: words.count(word) * idf[word] for word in words}
        norm = math.sqrt(sum(weight**2 for weight in raw.values()))
        want.update({(i, word): weight / norm for word, weight in raw.items()})
    assert got.keys() == want.keys()
    assert all(got[key] == pytest.approx(want[key]) for key in want)


def test_features_need_no_python_worker(spark):
    features = tfidf(["day", "news"], [1.0, 2.0]).transform(toy(spark)).select("id", F.col("features"))
    assert "Python" not in features._jdf.queryExecution().executedPlan().toString()


def newton(features, labels, steps=50):
    """Minimum of the summed logistic loss plus half the squared length of the weights, intercept unpenalised."""
    design = np.hstack([features, np.ones((len(features), 1))])
    penalty = np.diag([1.0] * features.shape[1] + [0.0])
    weights = np.zeros(design.shape[1])
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-design @ weights))
        gradient = design.T @ (chance - labels) + penalty @ weights
        hessian = design.T @ (design * (chance * (1 - chance))[:, None]) + penalty
        weights -= np.linalg.solve(hessian, gradient)
    return weights[:-1], weights[-1]


def test_the_regression_equals_a_direct_solution(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(30)]
    data = [(i, rng.randint(0, 1), 0, " ".join(rng.choices(words, k=rng.randint(1, 8))), 1) for i in range(300)]
    tweets = spark.createDataFrame(data, TWEET)
    model = fit(tweets).stages[-1]

    terms = [row.term for row in vocabulary(tweets).collect()]
    features = np.zeros((len(data), len(terms)))
    for row in term_weights(tweets).collect():
        features[row.id, terms.index(row.term)] = row.weight
    weights, intercept = newton(features, np.array([row[1] for row in data]))
    assert model.coefficients.toArray() == pytest.approx(weights, abs=1e-3)
    assert model.intercept == pytest.approx(intercept, abs=1e-3)

    chosen = {row.id: row.ml_sentiment for row in predict(fit(tweets), tweets).collect()}
    margins = features @ weights + intercept
    clear = [i for i, margin in enumerate(margins) if abs(margin) > 1e-3]
    assert len(clear) > 290
    assert all((chosen[i] == "positive") == (margins[i] > 0) for i in clear)


def test_each_text_is_predicted_by_a_model_that_has_not_seen_it(spark):
    """Every text has its own word, so a model that has seen it knows its label, and one that has not only the prior."""
    data = [(i, i % 2, i, f"own{i} own{i}", i) for i in range(60)]
    tweets = spark.createDataFrame(data, TWEET)
    seen = fit_predict(tweets).join(tweets, "id").filter("(label = 1) = (ml_sentiment = 'positive')").count()
    assert seen == 60
    got = out_of_fold(tweets, folds=4).join(tweets, "id")
    folds = {}
    for row in got.collect():
        folds.setdefault(row.fold, set()).add(row.ml_sentiment)
    assert set(folds) == {0, 1, 2, 3}
    assert all(len(answers) == 1 for answers in folds.values())  # no fold tells its own texts apart


def test_out_of_fold_covers_each_text_once_and_finds_what_is_common(spark):
    more = [(900, None, 0, "a GREAT sunny day", 1), (901, None, 0, "rainy, awful", 1), (902, 1, 0, None, 1), (903, None, 0, "", 1)]
    words = ["great", "sunny", "happy", "day", "walk"], ["awful", "rainy", "sad", "news", "walk"]
    rng = random.Random(2)
    texts = [(i, 1 - i % 2, i, " ".join(rng.choices(words[i % 2], k=6)) + f" {i}", i) for i in range(200)]
    tweets = spark.createDataFrame(texts + [(500 + i, *texts[i][1:]) for i in range(9)] + more, TWEET)
    got = {row.id: row for row in out_of_fold(tweets, folds=3).collect()}
    assert set(got) == {row.id for row in tweets.filter("tweet IS NOT NULL").collect()}
    want = {row.id: row.fold for row in tweets.select("id", fold_of(F.col("tweet"), 3).alias("fold")).collect()}
    assert all(row.fold == want[i] for i, row in got.items())
    assert all(got[500 + i].fold == got[i].fold for i in range(9))
    right = [(got[i].ml_sentiment == "positive") == (label == 1) for i, label, *_ in texts]
    assert sum(right) >= 195
    assert (got[900].ml_sentiment, got[901].ml_sentiment) == ("positive", "negative")


def test_out_of_fold_equals_models_fitted_one_by_one(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    tweets = spark.createDataFrame([(i, rng.randint(0, 1), 0, " ".join(rng.choices(words, k=8)), 1) for i in range(300)], TWEET)
    got = {row.id: (row.fold, row.ml_sentiment) for row in out_of_fold(tweets, folds=2).collect()}
    terms = [row.term for row in vocabulary(tweets).collect()]
    features, labels = np.zeros((300, len(terms))), np.array([row.label for row in tweets.orderBy("id").collect()])
    for row in term_weights(tweets).collect():
        features[row.id, terms.index(row.term)] = row.weight
    fold = np.array([got[i][0] for i in range(300)])
    for k in (0, 1):
        weights, intercept = newton(features[fold != k], labels[fold != k])
        margins = features @ weights + intercept
        clear = [i for i in np.flatnonzero(fold == k).tolist() if abs(margins[i]) > 1e-3]
        assert len(clear) > 100
        assert all((got[i][1] == "positive") == (margins[i] > 0) for i in clear)


def test_folds_need_labelled_tweets_outside(spark):
    tweets = spark.createDataFrame([(1, 1, 0, "only one text", 1), (2, 1, 0, "only one text", 1)], TWEET)
    with pytest.raises(ValueError, match="no labelled tweet outside"):
        out_of_fold(tweets)
    with pytest.raises(ValueError, match="two folds"):
        out_of_fold(toy(spark), folds=1)


def vocabularies(tweets, size):
    return rows(vocabulary(tweets, size)), rows(vocabulary(tweets, size, sketch=True))


def test_a_sketch_gives_the_same_vocabulary(spark, monkeypatch):
    """Few terms, null and empty texts, ties at the cut, and many words that come once."""
    texts = ["One one two", "two x naïve ça", "two_2 22 -- two", None, ""]
    tweets = spark.createDataFrame([(i, 1, 0, text, 1) for i, text in enumerate(texts)], TWEET)
    for size in (1, 2, 4, 1000):
        plain, sketched = vocabularies(tweets, size)
        assert plain == sketched
    junk = spark.range(0, 30_000, 1, 8).selectExpr(
        "id", "1L AS label", "0L AS timestamp", "id AS user_id",
        "concat('the of ', repeat(concat('w', id % 50, ' '), 3), 'u', id % 10, ' junk', id, ' junk', -id) AS tweet",
    )
    calls = []
    monkeypatch.setattr(predictions, "TRACKED_TERMS", 4096)
    whole = predictions._weighted_terms
    monkeypatch.setattr(predictions, "_weighted_terms", lambda *args: calls.append(args) or whole(*args))
    plain, sketched = vocabularies(junk, 40)
    assert plain == sketched and len(calls) == 1  # the sketch was proof enough
    calls.clear()
    plain, sketched = vocabularies(junk, 5000)
    assert plain == sketched and len(calls) == 2  # it was not: the last terms come once


def test_a_sketch_shuffles_sketches_and_not_terms(spark):
    """However many distinct terms there are, what meets is one sketch for each group of tasks, and counts by number."""
    assert fit(toy(spark), sketch=True).stages[1].vocabulary == fit(toy(spark)).stages[1].vocabulary
    assert predictions._sketched_terms(tweets_df(spark).limit(0), 10) is None
    assert vocabulary(tweets_df(spark).limit(0), sketch=True).count() == 0
