"""Exact top-k by inner product over an impact-ordered index, score at a time.

A shard holds some vectors and, for each dimension, its postings by value, cut into segments of one quantised value each.
A score is what the squared lengths of both vectors leave when the squared differences of their components are taken off:
`2 q v = |q|^2 + |v|^2 - sum (q - v)^2`. So each vector starts with an upper bound, and each posting lowers it by its
impact, the squared difference. A query adds segments by falling impact, those far from its own component first. A vector
whose bound is below the `k`-th best score found so far is out: that is the proof, and it holds for most vectors long
before all segments are read. Those that it leaves are scored exactly.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chirrup.llm.common import stored, tasks

SCALE = 1024
SHARD_ROWS = 1 << 14
LEVELS = 32
# The part of all postings that is read before the first look at the bounds, and between two looks.
FIRST, STEP = 3 / 8, 1 / 16
# The search stops when the proof leaves at most this part of a shard; what is left is scored exactly.
RESCORED = 1 / 20


class Shard:
    """Postings by dimension: rows and their values in rising order, cut into segments of one quantised value each."""

    def __init__(self, values: np.ndarray):
        self.values = values
        n, dims = values.shape
        exact = values.T.astype(float)
        self.lengths = (exact**2).sum(axis=0)
        self.middle = float(np.median(self.lengths)) if n else 0.0
        self.rows = np.argsort(exact, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(exact, self.rows, 1)
        low, high = (exact.min(axis=1), exact.max(axis=1)) if n else (np.zeros(dims), np.zeros(dims))
        self.edges = low[:, None] + (high - low)[:, None] * np.arange(LEVELS + 1) / LEVELS
        cuts = [np.searchsorted(x, edges) for x, edges in zip(self.sorted, self.edges)]
        self.cuts = np.stack(cuts) if dims else np.zeros((0, LEVELS + 1), int)
        self.cuts[:, 0], self.cuts[:, -1] = 0, n

    def best(self, query: np.ndarray, k: int, own: np.ndarray) -> tuple[np.ndarray, int]:
        """Rows that may be among the k best besides `own`, all of the k best among them; and the postings read."""
        n, dims = self.values.shape
        few = max(4 * k, int(n * RESCORED))
        length = float((query.astype(float) ** 2).sum())
        if n - len(own) <= few or not length or not self.middle:
            return np.setdiff1d(np.arange(n), own), 0
        # The bounds hold for any stretch of the query; they are close where it has the vectors' length.
        stretch = np.sqrt(self.middle / length)
        aim = query * stretch
        bound = (length * stretch**2 + self.lengths) / (2 * stretch)
        error = float(bound.max()) * 1e-9 + 1e-6
        bound[own] = -np.inf
        # A segment's impact is what each of its postings takes off at least. Segments below the query's component are
        # read upwards and those above it downwards, so what is read of a dimension is always its two ends.
        below = self.edges[:, :-1] <= aim[:, None]
        apart = np.where(below, aim[:, None] - self.edges[:, 1:], self.edges[:, :-1] - aim[:, None])
        order = np.argsort(-np.maximum(apart, 0).ravel() ** 2, kind="stable")
        dimension, lower = order // LEVELS, below.ravel()[order]
        upto = np.cumsum(np.diff(self.cuts, axis=1).ravel()[order])
        looks = np.arange(FIRST, 1 + STEP, STEP) * n * dims
        reads = np.append(np.unique(np.searchsorted(upto, looks[looks < upto[-1]])), len(order))
        left, right, at, all_dims = np.zeros(dims, np.int64), np.full(dims, LEVELS), 0, np.arange(dims)
        for read in reads.tolist():
            part = slice(at, read)
            low = left + np.bincount(dimension[part][lower[part]], minlength=dims)
            high = right - np.bincount(dimension[part][~lower[part]], minlength=dims)
            ends = np.stack([left, low, high, right])
            for d, (a, b, c, e) in enumerate(self.cuts[all_dims, ends].T.tolist()):
                for x, y in ((a, b), (c, e)):
                    if x < y:
                        bound[self.rows[d, x:y]] -= (self.sorted[d, x:y] - aim[d]) ** 2 / (2 * stretch)
            left, right, at = low, high, read
            leaders = np.argpartition(bound, n - k)[n - k :]
            least = min(self.scores(leaders, query))
            possible = np.flatnonzero(bound >= least - error - abs(least) * 1e-9)
            if len(possible) <= few:
                break
        return possible, int(upto[at - 1])

    def scores(self, rows: np.ndarray, query: np.ndarray) -> list[int]:
        if not len(rows) or not len(query):
            return [0] * len(rows)
        found = self.values[rows]
        if float(np.abs(found).max()) * float(np.abs(query).max()) * len(query) < 2**62:
            return (found @ query).tolist()
        return [min(max(sum(map(int.__mul__, x, query.tolist())), -(2**63)), 2**63 - 1) for x in found.tolist()]


def top_k(
    vectors: DataFrame,
    is_query: str,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: for each row that the SQL condition `is_query` names, its k best other rows.

    Components become `floor(1024 * x)`; the score is the inner product of these whole numbers, ties go to the smaller
    key, a null key last. Vectors that are null or hold a null or non-finite component take no part, and vectors of
    different lengths do not meet. A repeated row is a row of its own, also as a query. Queries travel to all shards;
    a shard holds about `shard_rows` vectors and returns at most `k` rows for each query. An empty table gives none.
    """
    values = F.transform(F.col(vector), lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.filter(F.col(vector).isNotNull() & ~bad).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), values.alias("v"), F.expr(f"coalesce({is_query}, false)").alias("asks")
    )
    rows = stored(rows)
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).withColumn("shards", F.ceil(F.col("n") / shard_rows).cast("int"))
    sized = rows.withColumn("size", F.size("v")).join(sizes, "size")
    held = sized.withColumn("shard", F.pmod(F.xxhash64("row"), "shards").cast("int")).withColumn("asks", F.lit(False))
    asked = sized.filter("asks").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    columns = ["size", "shard", "asks", "row", "id", "v"]
    n_parts = max(tasks(vectors), int(sizes.agg(F.coalesce(F.sum("shards"), F.lit(1))).first()[0]))
    met = held.select(columns).unionByName(asked.select(columns)).repartition(n_parts, "size", "shard")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by shard, with its vectors before the queries."""
        current, parts, shard = None, [], None
        for batch in batches:
            size, number, asks, row, ids = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            flat, out = batch.column(5).flatten().to_numpy(), []
            own_ids, at = batch.column(4).to_pylist(), 0
            for j in range(len(batch)):
                v, at = flat[at : at + size[j]], at + size[j]
                if (size[j], number[j]) != current:
                    current, parts, shard = (size[j], number[j]), [], None
                if not asks[j]:
                    parts.append((row[j], own_ids[j], v))
                    continue
                if shard is None:
                    shard = Shard(np.stack([p[2] for p in parts]))
                    shard_row, shard_id = np.array([p[0] for p in parts]), [p[1] for p in parts]
                found, _ = shard.best(v, k, np.flatnonzero(shard_row == row[j]))
                ranked = sorted(zip([-s for s in shard.scores(found, v)], [(shard_id[x] is None, shard_id[x] or 0) for x in found.tolist()]))[:k]
                out += [(row[j], own_ids[j], None if missing else x, -s) for s, (missing, x) in ranked]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["row", "query_id", "vec_id", "score"])

    found = met.sortWithinPartitions("size", "shard", "asks").mapInArrow(search, "row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
