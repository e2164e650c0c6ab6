from collections import Counter

import numpy as np
import pytest

from chirrup.llm import queries, ranked_search
from tests.llm import plain

COLUMNS = ["item_id", "rank", "doc_id", "score"]


@pytest.fixture(scope="module")
def items(spark):
    rows = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    strange = [(None, "Two words"), (900, None), (901, ""), (902, "... --"), (903, "nowhere-seen zzzqqq"), (904, "THE the tHe"), (905, "é漢 \U0001F600x"), rows[3], (906, rows[3][1])]
    return rows + strange


def collected(found):
    assert found.columns == COLUMNS
    return Counter(tuple(row) for row in found.collect())


def asked(spark, items):
    return spark.createDataFrame([(key, text, 1, "x") for key, text in items], "item_id long, text string, score int, doc_id string")


@pytest.mark.parametrize("bounds", [{}, {"part_bytes": 3000, "block_bytes": 60_000, "shard_postings": 2000}])
def test_ranks_agree_with_plain_scores(spark, table, documents, items, bounds):
    want = Counter(plain.ranked(documents, items))
    assert collected(ranked_search.top_k(table.withColumnRenamed("ids", "rank"), asked(spark, items), **bounds)) == want


@pytest.mark.parametrize("k", [1, 3, 10**6])
def test_other_numbers_of_ranks(table, spark, documents, items, k):
    few = items[:4] + items[-9:]
    assert collected(ranked_search.top_k(table, asked(spark, few), k=k)) == Counter(plain.ranked(documents, few, k))


def test_ties_go_to_the_smaller_key_over_shards(spark):
    rows = [(key, "same words here" if key % 3 else "same other text of more words") for key in range(200)] + [(5, "same words here"), (None, "same words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    items = [(1, "same"), (2, "words here words")]
    want = Counter(plain.ranked(rows, items))
    for bounds in ({}, {"block_bytes": 64, "shard_postings": 8}):
        assert collected(ranked_search.top_k(docs, asked(spark, items), **bounds)) == want


def test_empty_tables_and_names(spark, table, empty, items):
    found = asked(spark, items)
    assert collected(ranked_search.top_k(empty, found)) == Counter()
    assert collected(ranked_search.top_k(table, found.limit(0))) == Counter()
    text_keys = ranked_search.top_k(table.selectExpr("cast(doc_id as string) as name", "text"), found, key="name")
    assert dict(text_keys.dtypes) == {"item_id": "bigint", "rank": "int", "name": "string", "score": "bigint"} and text_keys.count() > 0
    with pytest.raises(ValueError, match="different names"):
        ranked_search.top_k(table, found, item_key="doc_id")


def test_reading_stops_on_proof():
    """Where a few texts stand out, the lists are not read to their ends, and never out of order."""
    rng = np.random.default_rng(2)
    n, lists = 20_000, 6
    terms = np.repeat(np.arange(lists), n)
    places = np.concatenate([rng.permutation(n) for _ in range(lists)])
    impacts = rng.integers(1, 1000, n * lists)
    impacts[places < 12] += 50_000 + 1000 * places[places < 12]
    shard = ranked_search.Shard(n, terms, places, impacts, lists)
    sums = np.bincount(places, impacts, n).astype(np.int64)
    want = np.lexsort((np.arange(n), -sums))[:10]
    found, scores, read = shard.best(np.arange(lists), np.ones(lists, np.int64), 10)
    assert found.tolist() == want.tolist() and scores.tolist() == sums[want].tolist()
    assert read < 0.01 * n * lists
    found, _, read = shard.best(np.arange(lists), np.ones(lists, np.int64), 10, floor=10**9)
    assert not len(found) and read < 0.01 * n * lists


def test_bounds_agree_with_sums_on_random_lists():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n, lists, k = int(rng.integers(1, 60)), int(rng.integers(1, 9)), int(rng.integers(1, 12))
        held = rng.random((lists, n)) < rng.random()
        terms, places = np.nonzero(held)
        impacts, uses = rng.integers(0, 6, len(terms)), rng.integers(1, 4, lists)
        sums = np.bincount(places, impacts * uses[terms], n).astype(np.int64)
        order = np.lexsort((np.arange(n), -sums))[:k]
        order = order[sums[order] > 0]
        found, scores, _ = ranked_search.Shard(n, terms, places, impacts, lists).best(np.arange(lists), uses, k)
        assert found.tolist() == order.tolist() and scores.tolist() == sums[order].tolist()


def test_long_texts_do_not_overflow():
    lengths = np.array([10**9, 1, 3 * 10**8])
    n_texts, n_terms = 10**9, 4 * 10**11
    got = ranked_search.impacts_of(np.full(3, 700), np.array([5, 1, 10**6]), lengths, n_texts, n_terms)
    damp = [25 + 75 * int(n) * n_texts // n_terms for n in lengths]
    assert got.tolist() == [700 * (10**9 * u // (1000 * u + 8 * m)) for u, m in zip((5, 1, 10**6), damp)]


def test_the_query_takes_whole_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert collected(queries.op11_ranked_search(spark, folder)) == Counter(plain.ranked(rows, items))
