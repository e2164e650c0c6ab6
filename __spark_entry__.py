"""

The driver's tables hold no tweets, so every query starts from a `tweets` view over them: each event is a tweet of
its user, its text is the document with the event's id (an event without one has no text), and its label is that
document's quality. A word and a tag derived from the event are put around the whole text, because the documents
contain none of the counted words. Events of small value lose their user. Predictions come from `labels.toxic`, and
from `labels.quality` a second time where it is 0, so ids have one prediction, two equal ones or two different ones.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chirrup.operators import anomalies, predictions, trends, words
from chirrup.operators.bronze import bronze
from chirrup.operators.polarity import score
from chirrup.operators.silver import silver
from chirrup.plans.pipeline import run
from chirrup.schemas import NEGATIVE_WORDS, POSITIVE_WORDS, STARTER_DEGREES, STARTER_LEXICON, TWEET
from chirrup.sources.lexicon import starter_lexicon
from chirrup.sources.records import export_csv, read_csv, read_predictions, read_tweets, write_predictions
from chirrup.sources.tables import shared_folder
from chirrup.streaming.replay import replay, replay_in_order

try:
    from chirrup.llm import queries as llm
except ImportError:  # the subpackage may be left out
    llm = None

try:
    from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL
    from corpus_pipeline import run as pipeline
except ImportError:
    pipeline, PIPELINE_SQL = None, None

LOG_TIME = datetime(2024, 2, 1, tzinfo=timezone.utc)

# The text around each document; the same expression runs in both engines.
POST_TEXT = """' ' || CASE WHEN e.value < 5 THEN 'hate' WHEN e.value < 10 THEN 'lost' WHEN e.value < 20 THEN 'the'
                           WHEN e.value < 30 THEN 'love' WHEN e.value < 40 THEN 'Good' WHEN e.value < 60 THEN 'HAPPY'
                           ELSE 'bad' END
               || ' ' || d.text || ' ' ||
               CASE e.event_type WHEN 'error' THEN '#sad' WHEN 'purchase' THEN '#joy' WHEN 'signup' THEN '#Win'
                                 WHEN 'view' THEN '#love' ELSE '' END || ' '"""


# The same expressions run in both engines.
USER = "CASE WHEN e.value < 1 THEN NULL ELSE e.user_id END"
PREDICTIONS = """SELECT doc_id AS id, CASE toxic WHEN 0 THEN 'positive' ELSE 'negative' END AS ml_sentiment FROM {0}
  UNION ALL SELECT doc_id AS id, 'negative' AS ml_sentiment FROM {0} WHERE quality = 0"""

# Reading with a schema spares a look into the files per table.
SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
    "documents": "doc_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = _table(spark, sf_dir, "events").alias("e")
    documents = _table(spark, sf_dir, "documents").alias("d")
    labels = _table(spark, sf_dir, "labels").alias("l")
    return (
        events.join(documents, F.expr("d.doc_id = e.event_id"), "left")
        .join(labels, F.expr("l.doc_id = e.event_id"), "left")
        .selectExpr(
            "e.event_id AS id",
            "CAST(l.quality AS BIGINT) AS label",
            "unix_millis(CAST(e.ts AS TIMESTAMP)) AS timestamp",
            f"{POST_TEXT} AS tweet",
            f"{USER} AS user_id",
        )
    )


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PREDICTIONS.format("{labels}"), labels=_table(spark, sf_dir, "labels"))


def _bronze(spark: SparkSession, sf_dir: str, compat: bool = False) -> DataFrame:
    return bronze(_tweets(spark, sf_dir), _predictions(spark, sf_dir), compat)


# Each event is a prediction for one and the same tweet, half of them different ones.
HOT_PREDICTIONS = "SELECT 7 AS id, 'model ' || (event_id % 2 * event_id) AS ml_sentiment FROM {1}"


def _hot_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = spark.sql(HOT_PREDICTIONS.format("", "{events}"), events=_table(spark, sf_dir, "events"))
    return bronze(_tweets(spark, sf_dir), _predictions(spark, sf_dir).unionAll(hot))


def _silver(spark: SparkSession, sf_dir: str, compat: bool = False) -> DataFrame:
    return silver(_bronze(spark, sf_dir, compat), starter_lexicon(spark))


def _on_silver(job: Callable[..., DataFrame], compat: bool = False, **options) -> Callable[..., DataFrame]:
    return lambda spark, sf_dir: job(_silver(spark, sf_dir, compat), **options)


def _polarity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_tweets(spark, sf_dir), "tweet", starter_lexicon(spark)).select("id", "sentiment_score")


def _polarity_score_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(_tweets(spark, sf_dir), "tweet", starter_lexicon(spark), max_broadcast_words=0)
    return scored.select("id", "sentiment_score")


# Polarities of three digits, whose means are seldom short.
FINE_LEXICON = {word: round(polarity + 0.001 * place, 3) for place, (word, polarity) in enumerate(STARTER_LEXICON.items())}


def _fine_score(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    lexicon = spark.createDataFrame(list(FINE_LEXICON.items()), "word string, polarity double")
    return score(_tweets(spark, sf_dir), "tweet", lexicon, **options).select("id", "sentiment_score")


# Words that change the word after them, by the id of the tweet; the same expression runs in both engines.
DEGREE_TEXT = """CASE id % 9 WHEN 0 THEN ' not' WHEN 1 THEN ' Very' WHEN 2 THEN ' not very' WHEN 3 THEN ' never the of'
                             WHEN 4 THEN ' not the of the' WHEN 5 THEN ' slightly, so' WHEN 6 THEN ' is not bad but so'
                             WHEN 7 THEN ' isn\\'t without' ELSE '' END || tweet"""


def _degree_score(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    tweets = _tweets(spark, sf_dir).withColumn("tweet", F.expr(DEGREE_TEXT))
    return score(tweets, "tweet", starter_lexicon(spark, degrees=True), **options).select("id", "sentiment_score")


def _ml_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the fitted regression is at the one minimum of its loss: the gradient for each term, and for the intercept.

    The bound is 0.02, or a fifty-thousandth per labelled text where that is more, on either side of zero.
    """
    labelled = _tweets(spark, sf_dir).filter("label IS NOT NULL AND tweet IS NOT NULL")
    model = predictions.fit(labelled)
    terms, fitted = model.stages[1].vocabulary, model.stages[-1]
    coefficients = spark.createDataFrame(list(zip(terms, fitted.coefficients.toArray().tolist())), "term string, w double")
    path = f"{shared_folder(spark)}/weights"
    predictions.term_weights(labelled).write.parquet(path)
    weights = spark.read.parquet(path)
    margins = weights.join(F.broadcast(coefficients), "term").groupBy("id").agg(F.sum(F.col("weight") * F.col("w")).alias("margin"))
    chance = 1 / (1 + F.exp(-F.coalesce("margin", F.lit(0.0)) - fitted.intercept))
    errors = labelled.join(margins, "id", "left").select("id", (chance - F.expr("int(label = 1)")).alias("error"))
    total = errors.agg(F.count("*").alias("texts"), F.sum("error").alias("error"))
    slopes = weights.join(errors, "id").groupBy("term").agg(F.sum(F.col("weight") * F.col("error")).alias("slope"))
    slopes = slopes.join(F.broadcast(coefficients), "term").select("term", (F.col("slope") + F.col("w")).alias("slope"))
    slopes = slopes.unionAll(total.select(F.lit("(intercept)"), "error"))
    bound = F.broadcast(total.select(F.greatest(F.lit(0.02), F.col("texts") / 50_000).alias("bound"), F.lit(1).alias("one")))
    return slopes.withColumn("one", F.lit(1)).join(bound, "one").select("term", F.expr("abs(slope) < bound").alias("optimal"))


# Texts whose words tell which side they are on; one of five has no label.
SIDES = """SELECT event_id AS id, CASE WHEN event_id % 5 > 0 THEN event_id % 2 END AS label,
  CASE event_id % 2 WHEN 1 THEN 'bright sunny day, ' ELSE 'gloomy rainy night, ' END || event_type || ' ' || event_id AS tweet FROM {0}"""


def _sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SIDES.format("{events}"), events=_table(spark, sf_dir, "events"))


def _tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = predictions.term_weights(_tweets(spark, sf_dir))
    return weights.withColumn("weight", F.round("weight", 6))


def _prediction_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/predictions"
    write_predictions(_predictions(spark, sf_dir), path)
    return read_predictions(spark, path)


def _prediction_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/predictions"
    write_predictions(_predictions(spark, sf_dir).repartition(3), path, array=True)
    return read_predictions(spark, path, array=True)


def _tweet_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tweets"
    _tweets(spark, sf_dir).write.json(path)
    return read_tweets(spark, path)


def _replay_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is a day, empty, null or missing; blank lines lie between the records."""
    folder = shared_folder(spark)
    day = F.expr("CASE label WHEN 1 THEN date_format(timestamp_millis(timestamp), 'yyyy-MM-dd') WHEN 0 THEN '' END")
    record = F.struct(*TWEET.names, day.alias("Date"))
    line = F.when(F.col("user_id").isNull(), F.to_json(record, {"ignoreNullFields": "false"})).otherwise(F.to_json(record))
    _tweets(spark, sf_dir).select(F.explode(F.array(line, F.lit("  ")))).write.text(f"{folder}/raw")
    replay(spark, f"{folder}/raw", f"{folder}/stream", f"{folder}/checkpoint").awaitTermination()
    keyed = T.StructType([*TWEET, T.StructField("key", T.StringType())])
    return spark.read.schema(keyed).json(f"{folder}/stream")


def _drained(query) -> None:
    query.processAllAvailable()
    query.stop()


def _one_file(spark: SparkSession, sf_dir: str, lines: Column) -> str:
    """A folder with one file of lines, in the order of the tweets' ids."""
    path = f"{shared_folder(spark)}/raw"
    _tweets(spark, sf_dir).repartition(1).sortWithinPartitions("id").select(lines.alias("value")).write.text(path)
    return path


def _replay_paced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file in eight batches of records, each of which goes on where the last one ended, and what is left."""
    folder = shared_folder(spark)
    raw = _one_file(spark, sf_dir, F.to_json(F.struct("id")))
    pace = _table(spark, sf_dir, "events").count() // 8
    query = replay(spark, raw, f"{folder}/stream", f"{folder}/checkpoint", records_per_trigger=pace, rejects=f"{folder}/rejects")
    _drained(query)
    return spark.read.schema("id long, key string, batch int").json(f"{folder}/stream").select("id", "batch")


def _replay_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of the records by their user, over four batches; records without a user are dealt over lanes."""
    folder = shared_folder(spark)
    raw = _one_file(spark, sf_dir, F.to_json(F.struct("id", F.col("user_id").alias("Date"))))
    pace = _table(spark, sf_dir, "events").count() // 4 + 1
    _drained(replay_in_order(spark, raw, f"{folder}/stream", f"{folder}/checkpoint", pace))
    return spark.read.schema("id long, key string, lane int, sequence long").json(f"{folder}/stream")


def _replay_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third record is cut off and every fifth line has two: both go aside, with the reason."""
    folder = shared_folder(spark)
    record = F.to_json(F.struct("id"))
    line = F.when(F.expr("id % 3 = 0"), F.left(record, F.length(record) - 1)).when(F.expr("id % 5 = 0"), F.concat(record, F.lit(","), record))
    raw = _one_file(spark, sf_dir, line.otherwise(record))
    replay(spark, raw, f"{folder}/stream", f"{folder}/checkpoint", rejects=f"{folder}/rejects").awaitTermination()
    sent = spark.read.schema("id long").json(f"{folder}/stream").select(F.col("id").cast("string").alias("value"), F.lit(None).cast("string").alias("reason"))
    return sent.unionAll(spark.read.schema("value string, reason string").json(f"{folder}/rejects").select("value", "reason"))


def _pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    database = folder.rsplit("/", 1)[1].replace("-", "_")
    tables = run(
        spark, _tweets(spark, sf_dir), _predictions(spark, sf_dir), starter_lexicon(spark), folder, database,
        log_time=LOG_TIME,
    )
    sums = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"), _checksum(df)) for name, df in tables.items()]
    return reduce(DataFrame.unionAll, sums)


def _checksum(df: DataFrame) -> Column:
    """Sum of a hash of each row's columns in name order; fractions count in whole millionths, times in microseconds."""
    texts = []
    for name, kind in sorted(df.dtypes):
        value = {"double": f"bigint(round({name} * 1000000))", "timestamp": f"unix_micros({name})"}.get(kind, name)
        texts.append(f"coalesce(string({value}), '-')")
    return F.expr(f"sum(bigint(conv(substr(md5(concat_ws('|', {', '.join(texts)})), 1, 8), 16, 10)))").alias("checksum")


def _csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/neutral_word_frequency"
    export_csv(words.neutral_word_frequency(_silver(spark, sf_dir)), path)
    return read_csv(spark, path, "word string, freq long")


def _trend_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the place at which each row is read."""
    ordered = trends.by_time(trends.hourly_sentiment_trend(_silver(spark, sf_dir)))
    return ordered.coalesce(1).withColumn("place", F.monotonically_increasing_id())


def _anomaly_log_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log that is stamped with the time of the run: one time, which is that of the query."""
    log = anomalies.anomaly_log(_silver(spark, sf_dir))
    same = F.bool_and(F.col("log_time") == F.current_timestamp())
    return log.agg(F.count("*").alias("rows"), F.count_distinct("log_time").alias("times"), same.alias("of_the_run"))


def _top_neutral_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.ranked(words.neutral_word_frequency(_silver(spark, sf_dir)), "freq", "word", k=100)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: hourly sentiment trend."""
    return queries()["hourly_sentiment_trend"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "tweet_data": _bronze,
        "tweet_data_compat": lambda spark, sf_dir: _bronze(spark, sf_dir, compat=True),
        "tweet_data_hot": _hot_bronze,
        "ml_predictions": lambda spark, sf_dir: predictions.fit_predict(_tweets(spark, sf_dir)),
        "ml_predictions_of_sides": lambda spark, sf_dir: predictions.fit_predict(_sides(spark, sf_dir)),
        "ml_predictions_out_of_fold": lambda spark, sf_dir: predictions.out_of_fold(_sides(spark, sf_dir)),
        "ml_optimality": _ml_optimality,
        "tfidf_vocabulary": lambda spark, sf_dir: predictions.vocabulary(_tweets(spark, sf_dir)).withColumn(
            "idf", F.round("idf", 6)
        ),
        "tfidf_vocabulary_by_sketch": lambda spark, sf_dir: predictions.vocabulary(
            _tweets(spark, sf_dir), sketch=True
        ).withColumn("idf", F.round("idf", 6)),
        "tfidf_weights": _tfidf_weights,
        "polarity_score": _polarity_score,
        "polarity_score_by_join": _polarity_score_by_join,
        "polarity_score_fine": _fine_score,
        "polarity_score_fine_by_join": lambda spark, sf_dir: _fine_score(spark, sf_dir, max_broadcast_words=0),
        "polarity_score_degrees": _degree_score,
        "polarity_score_degrees_by_join": lambda spark, sf_dir: _degree_score(spark, sf_dir, max_broadcast_words=0),
        "valid_tweets": _silver,
        "hourly_sentiment_trend": _on_silver(trends.hourly_sentiment_trend),
        "hourly_sentiment_trend_by_time": _trend_by_time,
        "anomaly_log_time": _anomaly_log_time,
        "discrepant_tweets": _on_silver(anomalies.discrepant_tweets),
        "negative_word_frequency": _on_silver(words.negative_word_frequency),
        "positive_word_frequency": _on_silver(words.positive_word_frequency),
        "neutral_word_frequency": _on_silver(words.neutral_word_frequency),
        "top_neutral_words": _top_neutral_words,
        "top_hashtags_by_sentiment": _on_silver(words.top_hashtags_by_sentiment),
        "ml_sentiment_accuracy": _on_silver(trends.ml_sentiment_accuracy),
        "ml_sentiment_accuracy_compat": _on_silver(trends.ml_sentiment_accuracy, compat=True),
        "ml_vs_label_comparison": _on_silver(trends.ml_vs_label_comparison),
        "ml_vs_label_comparison_compat": _on_silver(trends.ml_vs_label_comparison, compat=True),
        "anomaly_log": _on_silver(anomalies.anomaly_log, log_time=LOG_TIME),
        "anomaly_alert": lambda spark, sf_dir: anomalies.anomaly_alert(
            anomalies.anomaly_log(_silver(spark, sf_dir), LOG_TIME)
        ),
        "tweet_file": _tweet_file,
        "prediction_file": _prediction_file,
        "prediction_array": _prediction_array,
        "replay_ingest": _replay_ingest,
        "replay_paced": _replay_paced,
        "replay_in_order": _replay_in_order,
        "replay_rejects": _replay_rejects,
        "pipeline_run": _pipeline_run,
        "csv_export": _csv_export,
    }
    if llm is not None:
        found |= llm.queries()
    if pipeline is not None:
        found["pipeline"] = pipeline
    return found


def _sql_list(texts: list[str]) -> str:
    return ", ".join(f"'{text}'" for text in texts)


def _lexicon_rows(lexicon: dict[str, float]) -> str:
    return ", ".join(f"('{word}', {polarity}::DOUBLE)" for word, polarity in lexicon.items())


_LEXICON_ROWS = _lexicon_rows(STARTER_LEXICON)

_TWEETS = f"""tweets AS (
  SELECT e.event_id AS id, l.quality::BIGINT AS label, epoch_us(e.ts) // 1000 AS timestamp, {POST_TEXT} AS tweet, {USER} AS user_id
  FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id LEFT JOIN labels l ON l.doc_id = e.event_id)"""

# Records without a user have a lane by `xxhash64` of their place in the file, a long, with Spark's seed of 42.
_PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
_P1, _P2, _P3, _P4, _P5, _TWO_64 = (f"{number}::UHUGEINT" for number in (*_PRIMES, 2**64))


def _rotated(x: str, bits: int) -> str:
    return f"({x} * {2**bits}::UHUGEINT % {_TWO_64} + {x} // {2 ** (64 - bits)}::UHUGEINT)"


_LANES = f"""records AS (
  SELECT id, coalesce(user_id::VARCHAR, 'default') AS key, row_number() OVER (ORDER BY id NULLS FIRST) - 1 AS record FROM tweets),
laned AS (
  SELECT id, key, record, record::UHUGEINT * {_P2} % {_TWO_64} AS h1,
         xor({_P5} + 50::UHUGEINT, {_rotated("h1", 31)} * {_P1} % {_TWO_64}) AS h2,
         ({_rotated("h2", 27)} * {_P1} + {_P4}) % {_TWO_64} AS h3,
         xor(h3, h3 // {2**33}::UHUGEINT) * {_P2} % {_TWO_64} AS h4,
         xor(h4, h4 // {2**29}::UHUGEINT) * {_P3} % {_TWO_64} AS h5,
         CASE key WHEN 'default' THEN (xor(h5, h5 // {2**32}::UHUGEINT) % 8::UHUGEINT)::INTEGER ELSE 0 END AS lane
  FROM records)"""

_PREDICTIONS = f"predictions AS (\n  {PREDICTIONS.format('labels')})"

_BRONZE = """bronze AS (
  SELECT t.id, t.label, t.timestamp, t.tweet, t.user_id, p.ml_sentiment FROM tweets t LEFT JOIN predictions p ON p.id = t.id)"""

_BRONZE_COMPAT = """bronze AS (
  SELECT t.id, t.label, t.timestamp, t.tweet, t.user_id, t.label::VARCHAR AS ml_sentiment
  FROM tweets t LEFT JOIN predictions p ON p.id = t.id)"""

_SCORES = rf"""lexicon(word, polarity) AS (VALUES {_LEXICON_ROWS}),
hits AS (
  SELECT id, unnest(regexp_extract_all(lower(tweet), '\p{{L}}+')) AS word FROM tweets WHERE tweet IS NOT NULL),
scores AS (
  SELECT id, round(sum(round(polarity * 1000000)::BIGINT)::DOUBLE / count(*)::DOUBLE / 1000000, 6) + 0.0::DOUBLE AS sentiment_score
  FROM hits JOIN lexicon USING (word) GROUP BY id)"""

_DEGREE_SCORES = rf"""lexicon(word, polarity, degree) AS (
  SELECT word, polarity, NULL FROM (VALUES {_LEXICON_ROWS}) p(word, polarity) UNION ALL
  SELECT word, NULL, degree FROM (VALUES {_lexicon_rows(STARTER_DEGREES)}) d(word, degree)),
tokens AS (
  SELECT id, unnest(words) AS word, generate_subscripts(words, 1) AS pos
  FROM (SELECT id, regexp_extract_all(lower({DEGREE_TEXT.replace("\\'", "''")}), '\p{{L}}+') AS words FROM tweets WHERE tweet IS NOT NULL)),
marks AS (
  SELECT id, pos, 0 AS kind, polarity, NULL AS degree FROM tokens JOIN lexicon USING (word) WHERE polarity IS NOT NULL UNION ALL
  SELECT id, pos, 1 AS kind, NULL AS polarity, degree FROM tokens JOIN lexicon USING (word) WHERE degree IS NOT NULL),
opened AS (
  SELECT *, CASE WHEN lag(kind) OVER w = 1 AND pos - lag(pos) OVER w <= 3 THEN 0 ELSE 1 END AS opens
  FROM marks WINDOW w AS (PARTITION BY id ORDER BY pos, kind)),
chained AS (SELECT *, sum(opens) OVER (PARTITION BY id ORDER BY pos, kind) AS chain FROM opened),
factors AS (
  SELECT id, max(polarity) AS polarity, count(*) FILTER (WHERE degree < 0) AS negations,
         list_reduce(list_prepend(1.0::DOUBLE, coalesce(list(degree ORDER BY pos) FILTER (WHERE degree < 0), [])), lambda a, b: a * b) AS negation,
         list_reduce(list_prepend(1.0::DOUBLE, coalesce(list(degree ORDER BY pos) FILTER (WHERE degree > 0), [])), lambda a, b: a * b) AS degree
  FROM chained GROUP BY id, chain HAVING max(polarity) IS NOT NULL),
gains AS (
  SELECT id, least(greatest(floor(round(polarity * 1000000)::BIGINT * CASE WHEN negations > 0 THEN negation / degree ELSE degree END + 0.5::DOUBLE),
                            -1000000), 1000000)::BIGINT AS gain FROM factors),
scores AS (
  SELECT id, round(sum(gain)::DOUBLE / count(*)::DOUBLE / 1000000, 6) + 0.0::DOUBLE AS sentiment_score FROM gains GROUP BY id)"""

_SILVER = """scored AS (
  SELECT b.*, CASE label WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
         coalesce(s.sentiment_score, 0.0::DOUBLE) AS sentiment_score
  FROM bronze b LEFT JOIN scores s ON s.id = b.id WHERE b.tweet IS NOT NULL AND b.user_id IS NOT NULL),
binned AS (
  SELECT *, CASE WHEN sentiment_score >= 0.6::DOUBLE THEN 'strong positive' WHEN sentiment_score > 0.1::DOUBLE THEN 'positive'
                 WHEN sentiment_score > -0.1::DOUBLE THEN 'neutral' WHEN sentiment_score > -0.6::DOUBLE THEN 'negative'
                 ELSE 'strong negative' END AS sentiment_category FROM scored),
silver AS (
  SELECT id, label, timestamp, trim(tweet, ' ') AS tweet, user_id, ml_sentiment, sentiment_label, sentiment_score,
         sentiment_category, sentiment_label <> sentiment_category AS discrepancy FROM binned)"""

_TERMS = r"""texts AS (SELECT id, lower(tweet) AS tweet FROM tweets WHERE tweet IS NOT NULL),
term_uses AS (SELECT id, unnest(regexp_extract_all(tweet, '[\p{L}\p{N}_]{2,}')) AS term FROM texts),
vocabulary AS (
  SELECT term, count(*) AS term_count, count(DISTINCT id) AS doc_count,
         ln(((SELECT count(*) FROM texts) + 1)::DOUBLE / (count(DISTINCT id) + 1)) + 1 AS idf
  FROM term_uses GROUP BY term ORDER BY term_count DESC, term LIMIT 1000)"""

_SILVER_CTES = ",\n".join([_TWEETS, _PREDICTIONS, _BRONZE, _SCORES, _SILVER])
_SILVER_COMPAT_CTES = ",\n".join([_TWEETS, _PREDICTIONS, _BRONZE_COMPAT, _SCORES, _SILVER])

_HOURLY = """SELECT date_trunc('hour', make_timestamp(timestamp * 1000)) AS hour, sentiment_label, count(*) AS tweet_count,
       count(*)::DOUBLE / (sum(count(*)) OVER (PARTITION BY date_trunc('hour', make_timestamp(timestamp * 1000))))::DOUBLE
         * 100 AS percentage
FROM silver GROUP BY 1, 2"""

_DISCREPANT = """SELECT id, label, sentiment_label, sentiment_score, ml_sentiment, sentiment_category
FROM silver WHERE discrepancy"""

_LOWER_WORDS = "SELECT unnest(string_split(lower(tweet), ' ')) AS word FROM silver"

_NEGATIVE = f"""SELECT word, count(*) AS freq FROM ({_LOWER_WORDS} WHERE sentiment_label = 'negative')
WHERE word IN ({_sql_list(NEGATIVE_WORDS)}) GROUP BY word"""

_POSITIVE = f"""SELECT word, count(*) AS freq FROM ({_LOWER_WORDS} WHERE sentiment_label = 'positive')
WHERE word IN ({_sql_list(POSITIVE_WORDS)}) GROUP BY word"""

_NEUTRAL = f"""SELECT word, count(*) AS freq FROM ({_LOWER_WORDS} WHERE sentiment_category = 'neutral') GROUP BY word"""

_HASHTAGS = """SELECT word, sentiment_category, count(*) AS count
FROM (SELECT unnest(string_split(tweet, ' ')) AS word, sentiment_category FROM silver)
WHERE starts_with(word, '#') GROUP BY ALL"""

_ACCURACY = """SELECT day, count(*) AS total_tweets, sum(correct)::BIGINT AS correct_predictions,
       sum(correct)::DOUBLE / count(*)::DOUBLE * 100 AS accuracy_percentage
FROM (SELECT date_trunc('day', make_timestamp(timestamp * 1000))::TIMESTAMP AS day,
             (CASE ml_sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN 0
                                ELSE try_cast(ml_sentiment AS BIGINT) END = label)::INTEGER AS correct FROM silver)
GROUP BY day"""

_CONFUSION = "SELECT label, ml_sentiment, count(*) AS total_tweets FROM silver GROUP BY label, ml_sentiment"

_ANOMALIES = """SELECT id, tweet, label, ml_sentiment, sentiment_label, sentiment_score, sentiment_category,
       TIMESTAMP '2024-02-01 00:00:00' AS log_time, 'Discrepancy between label and sentiment' AS description
FROM silver WHERE discrepancy"""

_ALERT = """SELECT count(*) AS anomaly_count,
       'Anomaly Detected! ' || count(*) || ' discrepancies found in sentiment pipeline.' AS message
FROM silver WHERE discrepancy HAVING count(*) > 0"""

_TABLE_SQL = {
    "tweet_data": "SELECT * FROM bronze",
    "valid_tweets": "SELECT * FROM silver",
    "hourly_sentiment_trend": _HOURLY,
    "discrepant_tweets": _DISCREPANT,
    "negative_word_frequency": _NEGATIVE,
    "positive_word_frequency": _POSITIVE,
    "neutral_word_frequency": _NEUTRAL,
    "top_hashtags_by_sentiment": _HASHTAGS,
    "ml_sentiment_accuracy": _ACCURACY,
    "ml_vs_label_comparison": _CONFUSION,
    "anomaly_log": _ANOMALIES,
    "anomaly_alert": _ALERT,
}


_SILVER_COLUMNS = "discrepancy id label ml_sentiment sentiment_category sentiment_label sentiment_score timestamp tweet user_id"
_TABLE_COLUMNS = {
    "tweet_data": "id label ml_sentiment timestamp tweet user_id",
    "valid_tweets": _SILVER_COLUMNS,
    "hourly_sentiment_trend": "hour percentage sentiment_label tweet_count",
    "discrepant_tweets": "id label ml_sentiment sentiment_category sentiment_label sentiment_score",
    "negative_word_frequency": "freq word",
    "positive_word_frequency": "freq word",
    "neutral_word_frequency": "freq word",
    "top_hashtags_by_sentiment": "count sentiment_category word",
    "ml_sentiment_accuracy": "accuracy_percentage correct_predictions day total_tweets",
    "ml_vs_label_comparison": "label ml_sentiment total_tweets",
    "anomaly_log": "description id label log_time ml_sentiment sentiment_category sentiment_label sentiment_score tweet",
    "anomaly_alert": "anomaly_count message",
}


def _checksum_sql(table: str) -> str:
    kinds = dict.fromkeys(("sentiment_score", "percentage", "accuracy_percentage"), "round({} * 1000000)::BIGINT")
    kinds |= dict.fromkeys(("hour", "day", "log_time"), "epoch_us({})")
    texts = [f"coalesce(({kinds.get(name, '{}').format(name)})::VARCHAR, '-')" for name in _TABLE_COLUMNS[table].split()]
    return f"sum(('0x' || substr(md5(concat_ws('|', {', '.join(texts)})), 1, 8))::BIGINT)::BIGINT AS checksum"


def oracle_sql() -> dict[str, str]:
    sql = {name: f"WITH {_SILVER_CTES}\n{query}" for name, query in _TABLE_SQL.items()}
    for name in ("ml_sentiment_accuracy", "ml_vs_label_comparison"):
        sql[f"{name}_compat"] = f"WITH {_SILVER_COMPAT_CTES}\n{_TABLE_SQL[name]}"
    sql["tweet_data_compat"] = f"WITH {_TWEETS},\n{_PREDICTIONS},\n{_BRONZE_COMPAT}\nSELECT * FROM bronze"
    hot = _PREDICTIONS[:-1] + "\n  UNION ALL " + HOT_PREDICTIONS.format("", "events") + ")"
    sql["tweet_data_hot"] = f"WITH {_TWEETS},\n{hot},\n{_BRONZE}\nSELECT * FROM bronze"
    sql["polarity_score"] = sql["polarity_score_by_join"] = (
        f"WITH {_TWEETS},\n{_SCORES}\n"
        "SELECT t.id, coalesce(s.sentiment_score, 0.0::DOUBLE) AS sentiment_score "
        "FROM tweets t LEFT JOIN scores s ON s.id = t.id"
    )
    sql["polarity_score_fine"] = sql["polarity_score_fine_by_join"] = sql["polarity_score"].replace(
        _LEXICON_ROWS, _lexicon_rows(FINE_LEXICON)
    )
    sql["polarity_score_degrees"] = sql["polarity_score_degrees_by_join"] = sql["polarity_score"].replace(_SCORES, _DEGREE_SCORES)
    side = "CASE id % 2 WHEN 1 THEN 'positive' ELSE 'negative' END AS ml_sentiment"
    sql["ml_predictions_of_sides"] = f"SELECT id, {side} FROM ({SIDES.format('events')})"
    sql["ml_predictions_out_of_fold"] = (
        f"SELECT id, (('0x' || substr(md5(lower(tweet)), 1, 8))::BIGINT % 5)::INTEGER AS fold, {side} FROM ({SIDES.format('events')})"
    )
    sql["tfidf_vocabulary"] = sql["tfidf_vocabulary_by_sketch"] = (
        f"WITH {_TWEETS},\n{_TERMS}\nSELECT term, term_count, doc_count, round(idf, 6) AS idf FROM vocabulary"
    )
    labelled = _TERMS.replace("tweet IS NOT NULL", "tweet IS NOT NULL AND label IS NOT NULL", 1)
    sql["ml_optimality"] = (
        f"WITH {_TWEETS},\n{labelled}\nSELECT term, true AS optimal FROM vocabulary UNION ALL SELECT '(intercept)', true"
    )
    sql["tfidf_weights"] = f"""WITH {_TWEETS},
{_TERMS},
raw_weights AS (
  SELECT u.id, u.term, count(*) * any_value(v.idf) AS weight
  FROM term_uses u JOIN vocabulary v USING (term) GROUP BY u.id, u.term)
SELECT id, term, round(weight / sqrt(sum(weight * weight) OVER (PARTITION BY id)), 6) AS weight FROM raw_weights"""
    sql["tweet_file"] = f"WITH {_TWEETS}\nSELECT * FROM tweets"
    sql["prediction_file"] = sql["prediction_array"] = f"WITH {_PREDICTIONS}\nSELECT * FROM predictions"
    sql["replay_ingest"] = (
        f"WITH {_TWEETS}\nSELECT *, CASE label WHEN 1 THEN strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') "
        "WHEN 0 THEN '' ELSE 'default' END AS key FROM tweets"
    )
    sql["replay_paced"] = (
        "SELECT event_id AS id, ((row_number() OVER (ORDER BY event_id) - 1) // ((SELECT count(*) FROM events) // 8))::INTEGER AS batch "
        "FROM events"
    )
    sql["replay_in_order"] = f"""WITH {_TWEETS},
{_LANES}
SELECT id, key, lane, row_number() OVER (PARTITION BY key, lane ORDER BY record) - 1 AS sequence FROM laned"""
    record = "'{\"id\":' || event_id"
    sql["replay_rejects"] = f"""SELECT CASE WHEN event_id % 3 = 0 THEN {record} WHEN event_id % 5 = 0 THEN {record} || '}},' || {record} || '}}'
            ELSE event_id::VARCHAR END AS value,
       CASE WHEN event_id % 3 = 0 THEN 'no JSON' WHEN event_id % 5 = 0 THEN 'not one record' END AS reason FROM events"""
    sums = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, {_checksum_sql(name)} FROM ({query})"
        for name, query in _TABLE_SQL.items()
    )
    sql["hourly_sentiment_trend_by_time"] = (
        f"WITH {_SILVER_CTES}\nSELECT *, row_number() OVER (ORDER BY hour, sentiment_label) - 1 AS place FROM ({_HOURLY})"
    )
    sql["anomaly_log_time"] = f"WITH {_SILVER_CTES}\nSELECT count(*) AS rows, 1 AS times, true AS of_the_run FROM silver WHERE discrepancy"
    sql["pipeline_run"] = f"WITH {_SILVER_CTES}\n{sums}"
    sql["csv_export"] = f"WITH {_SILVER_CTES}\n{_NEUTRAL}"
    sql["top_neutral_words"] = f"WITH {_SILVER_CTES}\n{_NEUTRAL} ORDER BY freq DESC, word LIMIT 100"
    if llm is not None:
        sql |= llm.oracle_sql()
    if PIPELINE_SQL is not None:
        sql["pipeline"] = PIPELINE_SQL
    return sql
