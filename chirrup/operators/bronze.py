"""Bronze: raw tweets with their predictions."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

# Copies of one prediction are expanded in runs of at most this many rows.
COPIES_PER_RUN = 4096

# An id with more than this part of a task's share of the predictions, and more rows than a run has, is hot; its pairs are
# dealt over so many cells for each task.
HOT_PART = 4
CELLS_PER_TASK = 64

# Hot ids are looked for among so many items per task; at most so many are told apart from the others.
TRACKED_PER_TASK = 64
MAX_HOT_IDS = 1024


def bronze(
    tweets: DataFrame, predictions: DataFrame, compat: bool = False, hot_predictions: bool = True
) -> DataFrame:
    """Left join on `id`: every tweet stays, a tweet with several predictions appears once for each.

    `compat=True` puts the label, as a string, in place of the prediction.

    Both sides may be as large as the tweets, so no side is broadcast by hint. A hot id among the tweets is split
    by the adaptive skew join (the left side of a left join can be split). The right side of a left join cannot,
    therefore a job here, at definition, looks for hot ids among the predictions with a sketch, in one pass and without
    a shuffle of the predictions. If there is none, the join is a plain one. If there are, their tweets and predictions
    meet in a grid of cells: a tweet goes to one row of cells, a prediction to one column, and both to every cell of it.
    So each pair meets once, and neither many copies of a prediction nor many different ones stay in one task. The
    result is the same in all cases; `hot_predictions=False` spares the job.
    """
    predictions = predictions.select("id", "ml_sentiment")
    grid = _grid(tweets, predictions) if hot_predictions else None
    if grid is None:
        joined = tweets.join(predictions, on="id", how="left")
    else:
        ids, cells = grid
        hot = F.coalesce(F.col("id").isin(ids), F.lit(False))
        cold = tweets.filter(~hot).join(predictions.filter(~hot), on="id", how="left")
        joined = cold.unionByName(_in_cells(tweets.filter(hot), predictions.filter(hot), cells))
    return joined.withColumn("ml_sentiment", F.col("label").cast("string")) if compat else joined


def _grid(tweets: DataFrame, predictions: DataFrame) -> tuple[list, DataFrame] | None:
    """The hot ids, and a row for each with the numbers of rows and columns of its cells; None if no id is hot.

    The sketch holds every id that is hot. Its counts, which may be a little low, decide on the number of cells only.
    """
    n_tasks = int(tweets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(MAX_HOT_IDS, HOT_PART * n_tasks)
    tracked = min(1_000_000, max(TRACKED_PER_TASK * n_tasks, 2 * most))
    found = predictions.filter("id IS NOT NULL").agg(F.count("*").alias("n"), F.expr(f"approx_top_k(id, {most}, {tracked})").alias("top")).first()
    least = max(COPIES_PER_RUN, found["n"] // (HOT_PART * n_tasks))
    hot = {item["item"]: item["count"] for item in found["top"] or [] if item["count"] > least}
    if not hot:
        return None
    counted = tweets.groupBy(F.when(F.col("id").isin(list(hot)), F.col("id")).alias("id")).count().collect()
    uses = {row["id"]: row["count"] for row in counted}
    rows = [(id, *_cells(uses.get(id, 0), n, CELLS_PER_TASK * n_tasks)) for id, n in hot.items()]
    kind = predictions.schema["id"].dataType.simpleString()
    return list(hot), tweets.sparkSession.createDataFrame(rows, f"id {kind}, _rows int, _columns int")


def _cells(tweets: int, predictions: int, most: int) -> tuple[int, int]:
    """Rows and columns of cells of a run of pairs or more each; their ratio is the one that sends out the fewest copies."""
    wanted = max(1, min(most, tweets * predictions // COPIES_PER_RUN))
    columns = min(max(round(math.sqrt(wanted * predictions / max(tweets, 1))), 1), wanted, predictions)
    return min(max(wanted // columns, 1), max(tweets, 1)), columns


def _dealt(values: list[Column], n: str) -> Column:
    return F.pmod(F.xxhash64(*values), F.col(n)).cast("int")


def _every(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def _in_cells(tweets: DataFrame, predictions: DataFrame, cells: DataFrame) -> DataFrame:
    """The pairs of hot ids. Equal predictions are counted first, and one row per run of copies moves and is expanded where
    it arrives; equal tweets stay together and are split by the adaptive skew join."""
    plain = [F.col(f"`{field.name}`") for field in tweets.schema if isinstance(field.dataType, AtomicType)]
    cells = F.broadcast(cells)  # a row for each hot id
    left = tweets.join(cells, "id").withColumn("_row", _dealt(plain, "_rows")).withColumn("_column", _every("_columns"))
    counted = predictions.groupBy("id", "ml_sentiment").agg(F.count("*").alias("_total"))
    runs = counted.withColumn("_run", F.explode(F.expr(f"sequence(0L, (_total - 1) div {COPIES_PER_RUN})")))
    copies = F.least(F.col("_total") - F.col("_run") * COPIES_PER_RUN, F.lit(COPIES_PER_RUN))
    right = runs.join(cells, "id").withColumn("_column", _dealt([F.col("ml_sentiment"), F.col("_run")], "_columns"))
    right = right.withColumn("_row", _every("_rows")).select("id", "_row", "_column", "ml_sentiment", copies.alias("_copies"))
    cell = ["id", "_row", "_column"]
    n_tasks = int(tweets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Few rows may become many, so the adaptive execution is not to join tasks: it leaves a given number as it is.
    pairs = left.drop("_rows", "_columns").repartition(n_tasks, *cell).join(right.repartition(n_tasks, *cell), cell)
    expanded = pairs.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return expanded.select(*(f"`{name}`" for name in tweets.columns), "ml_sentiment")
