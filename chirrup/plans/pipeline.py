"""Write every table once, in dependency order; all tables change together or none does."""

import hashlib
import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from chirrup.operators.anomalies import anomaly_alert, anomaly_log, discrepant_tweets
from chirrup.operators.bronze import bronze
from chirrup.operators.silver import silver
from chirrup.operators.trends import hourly_sentiment_trend, ml_sentiment_accuracy, ml_vs_label_comparison
from chirrup.operators.words import counted_words, word_tables
from chirrup.schemas import TABLE_COMMENTS
from chirrup.sources.tables import delete_others, exists, publish, write_once

GOLD = {
    "hourly_sentiment_trend": hourly_sentiment_trend,
    "discrepant_tweets": discrepant_tweets,
    "ml_sentiment_accuracy": ml_sentiment_accuracy,
    "ml_vs_label_comparison": ml_vs_label_comparison,
}


def run(
    spark: SparkSession,
    tweets: DataFrame,
    predictions: DataFrame,
    lexicon: DataFrame,
    out: str,
    database: str = "default",
    compat: bool = False,
    log_time: datetime | None = None,
    hot_predictions: bool = True,
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Store bronze, silver, the gold tables and the anomaly log below `out`; return them and the alert.

    Each stage reads the stored stage before it, so texts are joined, scored and split into words once, and a lost
    executor costs no more than its own tasks. The tables after silver do not depend on each other and are written side
    by side, so the last tasks of one leave no executor idle. They are stored unsorted; see `words.ranked` for sorted
    reads.

    A run writes into a folder of its own, `out/runs/<run id>`, and only when all of it is there do the tables of the
    database point to it, one after the other, in a moment. Until then they show the last run; a run that is stopped
    changes nothing. When it is started again, with the same id, it writes only the stages that are not complete, and then
    points all tables. The id is that of the inputs and parameters (see `fingerprint`) unless given; a run whose tables
    are shown already is begun anew. The files of the last run but this one are kept for those who still read them, older
    ones are deleted.
    """
    run_id = run_id or fingerprint(tweets, predictions, lexicon, compat, log_time)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{out}'")
    shown = _shown(spark, database)
    if run_id == shown.partition("~")[0]:  # complete: another one beside it, so that the tables can be read meanwhile
        run_id = f"{run_id}~{int(shown.partition('~')[2] or 0) + 1}"
    folder = f"{out}/runs/{run_id}"

    def store(name: str, df: DataFrame) -> DataFrame:
        return write_once(df, f"{folder}/{name}")

    tweet_data = f"{folder}/tweet_data"
    joined = bronze(tweets, predictions, compat, hot_predictions and not exists(spark, f"{tweet_data}/_SUCCESS"))
    valid_tweets = store("valid_tweets", silver(store("tweet_data", joined), lexicon))
    gold = {name: job(valid_tweets) for name, job in GOLD.items()}
    gold["anomaly_log"] = anomaly_log(valid_tweets, log_time)
    with ThreadPoolExecutor() as pool:
        writes = [pool.submit(store, name, df) for name, df in gold.items()]
        by_word = word_tables(store("counted_words", counted_words(valid_tweets)))
        writes += [pool.submit(store, name, df) for name, df in by_word.items()]
        for write in writes:
            write.result()
    tables = {name: publish(spark, f"{database}.{name}", f"{folder}/{name}", comment) for name, comment in TABLE_COMMENTS.items()}
    delete_others(spark, folder, set(TABLE_COMMENTS))
    delete_others(spark, f"{out}/runs", {run_id, shown})
    return {**tables, "anomaly_alert": anomaly_alert(tables["anomaly_log"])}


def _shown(spark: SparkSession, database: str) -> str:
    """The id of the run that the last of the tables to be pointed shows; empty if there is none."""
    name = f"{database}.{list(TABLE_COMMENTS)[-1]}"
    if not spark.catalog.tableExists(name):
        return ""
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
    parts = location.rstrip("/").split("/")
    return parts[-2] if parts[-3] == "runs" else ""


def fingerprint(tweets: DataFrame, predictions: DataFrame, lexicon: DataFrame, *parameters: object) -> str:
    """An id for the same inputs, as Spark's plans and the names of the files that they read say, and the same parameters.

    A file that was overwritten in place has the name that it had. Then, or for inputs that are made anew each time, give
    a run an id.
    """
    inputs = [[df.semanticHash(), sorted(df.inputFiles())] for df in (tweets, predictions, lexicon)]
    return hashlib.sha256(json.dumps([inputs, *map(str, parameters)]).encode()).hexdigest()[:16]
