"""Prediction job: TF-IDF weights and a logistic regression on the labelled tweets.

The weights follow the smoothed, length-normalised form: `count * (ln((n + 1) / (doc_count + 1)) + 1)`, scaled to
unit length per tweet. The penalty of the regression equals an inverse strength of 1 on the summed loss.
"""

import math
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirrup.functions.constants import constant
from chirrup.functions.sentiment import prediction_text
from chirrup.sources.tables import scratch, stored_bytes

MAX_FEATURES = 1000
MAX_ITER = 1000
FOLDS = 5

# What a task reads in a pass of the regression: less, and starting the task costs more than its work.
TASK_BYTES = 8 << 20

# A sketch of terms tells so many apart; so many of the most frequent are counted exactly, and more than the vocabulary has.
# Sketches meet in groups of tasks before they meet in one.
TRACKED_TERMS = 1 << 18
CANDIDATES = 8
SKETCH_GROUPS = 64

# Fixed value: a term is a run of at least two letters, digits or underscores, in any script.
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"
TERMS = f"regexp_extract_all(lower(tweet), r'{TERM_PATTERN}', 0)"


def fit_predict(tweets: DataFrame, max_features: int = MAX_FEATURES, max_iter: int = MAX_ITER, sketch: bool = False) -> DataFrame:
    """Fit on the labelled tweets and predict every tweet that has a text: `id, ml_sentiment`."""
    return predict(fit(tweets, max_features, max_iter, sketch), tweets)


def fit(tweets: DataFrame, max_features: int = MAX_FEATURES, max_iter: int = MAX_ITER, sketch: bool = False) -> PipelineModel:
    """Model from raw tweets to a 0/1 prediction; the driver holds the vocabulary and the coefficients only.

    The label 1 is learned against all others. The tweets are read twice, for the vocabulary and for the features. The
    features are stored for the time of the regression, so its many passes, and the recovery of a lost executor, do not
    go back to the texts. `sketch` finds the vocabulary without a shuffle of all terms, see `vocabulary`.
    """
    train = _labelled(tweets)
    terms = _terms(train, max_features, sketch).collect()
    weigher = _weigher(terms)
    with scratch(train.sparkSession) as folder:
        features = _stored(weigher.transform(train).select("features", "label"), f"{folder}/features")
        _regression(terms[0].documents, max_iter).fit(features).save(f"{folder}/regression")
        # Read back without its training summary, which refers to the session: after an `observe` that does not serialise.
        return PipelineModel([*weigher.stages, LogisticRegressionModel.load(f"{folder}/regression")])


def _labelled(tweets: DataFrame) -> DataFrame:
    known = tweets.filter(F.col("tweet").isNotNull() & F.col("label").isNotNull())
    return known.select("tweet", (F.col("label") == 1).cast("double").alias("label"))


def _weigher(terms: list) -> PipelineModel:
    if not terms:
        raise ValueError("no labelled tweet with a term to fit on")
    return tfidf([row.term for row in terms], [row.idf for row in terms])


def _stored(features: DataFrame, path: str) -> DataFrame:
    """Features in a table of their own. Each of the many passes of a regression has a task for each `TASK_BYTES` of it."""
    features.write.parquet(path)
    spark = features.sparkSession
    return spark.read.parquet(path).coalesce(1 + stored_bytes(spark, path) // TASK_BYTES)


def _regression(documents: int, max_iter: int) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features",
        labelCol="label",
        probabilityCol="",
        rawPredictionCol="",
        family="binomial",
        maxIter=max_iter,
        regParam=1.0 / documents,
        elasticNetParam=0.0,
        standardization=False,
    )


def predict(model: PipelineModel, tweets: DataFrame) -> DataFrame:
    scored = model.transform(tweets.filter(F.col("tweet").isNotNull()).select("id", "tweet"))
    return scored.select("id", prediction_text(F.col("prediction")).alias("ml_sentiment"))


def fold_of(tweet: Column, folds: int) -> Column:
    """The fold of a text, from the digest of its lower-cased form: copies of a text have one fold."""
    return (F.conv(F.substring(F.md5(F.lower(tweet).cast("binary")), 1, 8), 16, 10).cast("long") % folds).cast("int")


def out_of_fold(
    tweets: DataFrame, folds: int = FOLDS, max_features: int = MAX_FEATURES, max_iter: int = MAX_ITER, sketch: bool = False
) -> DataFrame:
    """Predict every tweet that has a text by a model that has not seen it: `id, fold, ml_sentiment`.

    There is one model for each fold, fitted on the labelled tweets of the other folds; unlabelled tweets get the model of
    their fold, too. So the accuracy over labelled tweets is that on unseen texts. The vocabulary and its weights are those
    of all labelled texts, which says nothing of labels. The texts are read three times, whatever the number of folds: for
    the vocabulary, for the features that all regressions share, and to predict. A fold without labelled tweets outside
    it raises an error.
    """
    if folds < 2:
        raise ValueError("at least two folds")
    train = _labelled(tweets)
    terms = _terms(train, max_features, sketch).collect()
    weigher = _weigher(terms)
    with scratch(train.sparkSession) as folder, ThreadPoolExecutor(folds) as pool:
        marked = weigher.transform(train).select("features", "label", fold_of(F.col("tweet"), folds).alias("fold"))
        features = _stored(marked, f"{folder}/features")
        sizes = {row["fold"]: row["count"] for row in features.groupBy("fold").count().collect()}

        def fitted(fold: int) -> LogisticRegressionModel:
            documents = sum(sizes.values()) - sizes.get(fold, 0)
            if not documents:
                raise ValueError(f"no labelled tweet outside fold {fold}")
            return _regression(documents, max_iter).fit(features.filter(F.col("fold") != fold))

        models = list(pool.map(fitted, range(folds)))
        weights = constant([model.coefficients.toArray().tolist() for model in models], "array<array<double>>")
        intercepts = constant([float(np.clip(model.intercept, -1e300, 1e300)) for model in models], "array<double>")
    texts = tweets.filter(F.col("tweet").isNotNull()).select("id", "tweet", fold_of(F.col("tweet"), folds).alias("fold"))
    vector = F.unwrap_udt("features")
    own = F.transform(F.array(F.get(weights, F.col("fold"))), lambda w: F.transform(vector["indices"], lambda i: F.get(w, i)))[0]
    products = F.zip_with(own, vector["values"], lambda w, value: w * value)
    margin = F.aggregate(products, F.lit(0.0), lambda total, x: total + x) + F.get(intercepts, F.col("fold"))
    return weigher.transform(texts).select("id", "fold", prediction_text((margin > 0).cast("double")).alias("ml_sentiment"))


def vocabulary(tweets: DataFrame, max_features: int = MAX_FEATURES, sketch: bool = False) -> DataFrame:
    """The most frequent terms, ties in term order: `term, term_count, doc_count, idf`.

    Without `sketch` every distinct term of the corpus is counted, in one pass and with one shuffle of them. With it, a
    pass over the texts makes a mergeable sketch of frequent terms, of bounded size whatever the number of terms, and a
    second pass counts the terms in it exactly. What the sketch may have missed has a count that its size bounds; only if
    the last term of the vocabulary is not above that, all terms are counted after all. Both give the same rows.
    """
    return _terms(tweets, max_features, sketch).drop("documents")


def _terms(tweets: DataFrame, max_features: int, sketch: bool) -> DataFrame:
    found = _sketched_terms(tweets, max_features) if sketch else None
    return _weighted_terms(tweets, max_features) if found is None else found


def _sketched_terms(tweets: DataFrame, max_features: int) -> DataFrame | None:
    """The vocabulary by way of a sketch, or None where that cannot be proven."""
    texts = tweets.filter(F.col("tweet").isNotNull())
    uses = texts.select(F.explode(F.expr(TERMS)).alias("term"), (F.spark_partition_id() % SKETCH_GROUPS).alias("part"))
    parts = uses.groupBy("part").agg(F.count("*").alias("uses"), F.expr(f"approx_top_k_accumulate(term, {TRACKED_TERMS})").alias("sketch"))
    most = min(CANDIDATES * max_features, TRACKED_TERMS)
    # Grouped by a constant, as no sketch at all cannot be combined.
    merged = parts.groupBy(F.lit("all")).agg(F.sum("uses").alias("uses"), F.expr(f"approx_top_k_combine(sketch, {TRACKED_TERMS})").alias("sketch"))
    row = merged.selectExpr("uses", f"approx_top_k_estimate(sketch, {most}) AS top").first()
    if row is None:
        return None
    # The error of the sketch is at most 3.5 parts of its table's size, and a term that it leaves out has at most two errors.
    table = 1 << (math.ceil(TRACKED_TERMS / 0.75) - 1).bit_length()
    missed = max(2 * 3.5 / table * row["uses"], row["top"][-1]["count"] if len(row["top"]) == most else 0)
    names = [item["item"] for item in row["top"]]
    counter = CountVectorizerModel.from_vocabulary(names, inputCol="tokens", outputCol="counts")
    vector = F.unwrap_udt("counts")
    entries = counter.transform(texts.selectExpr(f"{TERMS} AS tokens")).select(F.inline(F.arrays_zip(vector["indices"], vector["values"])))
    counts = entries.groupBy("indices").agg(F.sum("values").cast("long").alias("term_count"), F.count("*").alias("doc_count")).collect()
    counts = sorted(((names[i], uses, docs) for i, uses, docs in counts), key=lambda count: (-count[1], count[0].encode()))[:max_features]
    if missed >= (counts[-1][1] if len(counts) == max_features else 1):
        return None
    documents = texts.count()
    rows = [(*count, documents) for count in counts]
    found = tweets.sparkSession.createDataFrame(rows, "term string, term_count long, doc_count long, documents long")
    return found.withColumn("idf", F.log((F.col("documents") + 1) / (F.col("doc_count") + 1)) + 1)


def _weighted_terms(tweets: DataFrame, max_features: int) -> DataFrame:
    """The vocabulary with the number of texts, `documents`, from one pass over the texts.

    Each text emits its terms, then its distinct terms, told apart by position, then a null that counts the text
    itself. Counts are combined before the shuffle, the cut is a distributed top-k that always keeps the null, and
    the window spreads its count over the rows that are left.
    """
    texts = tweets.filter(F.col("tweet").isNotNull())
    text_mark = F.array(F.lit(None).cast("string"))
    uses = texts.selectExpr(f"{TERMS} AS tokens").select(
        F.posexplode(F.concat("tokens", F.array_distinct("tokens"), text_mark)).alias("position", "term"),
        F.size("tokens").alias("uses"),
    )
    counts = uses.groupBy("term").agg(
        F.count_if(F.col("position") < F.col("uses")).alias("term_count"),
        F.count_if(F.col("position") >= F.col("uses")).alias("doc_count"),
    )
    top = counts.orderBy(F.col("term").isNotNull(), F.desc("term_count"), "term").limit(max_features + 1)
    documents = F.max(F.when(F.col("term").isNull(), F.col("doc_count"))).over(Window.partitionBy(F.lit(0)))
    return (
        top.withColumn("documents", documents)
        .filter(F.col("term").isNotNull())
        .withColumn("idf", F.log((F.col("documents") + 1) / (F.col("doc_count") + 1)) + 1)
    )


def tfidf(terms: list[str], idf: list[float]) -> PipelineModel:
    """Stages from `tweet` to a sparse, unit-length `features` vector over the given terms."""
    return PipelineModel([
        SQLTransformer(statement=f"SELECT *, {TERMS} AS tokens FROM __THIS__"),
        CountVectorizerModel.from_vocabulary(terms, inputCol="tokens", outputCol="counts"),
        ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="counts", outputCol="weights"),
        Normalizer(p=2.0, inputCol="weights", outputCol="features"),
    ])


def term_weights(tweets: DataFrame, max_features: int = MAX_FEATURES, sketch: bool = False) -> DataFrame:
    """The TF-IDF weights as rows: `id, term, weight`."""
    terms = vocabulary(tweets, max_features, sketch).collect()
    names = [row.term for row in terms]
    texts = tweets.filter(F.col("tweet").isNotNull()).select("id", "tweet")
    vectors = tfidf(names, [row.idf for row in terms]).transform(texts)
    features = F.unwrap_udt("features")
    entries = vectors.select("id", F.inline(F.arrays_zip(features["indices"], features["values"])))
    return entries.select(
        "id", F.element_at(F.lit(names), F.col("indices") + 1).alias("term"), F.col("values").alias("weight")
    )
