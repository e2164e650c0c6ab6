import random
from collections import Counter

import numpy as np
import pytest

from chirrup.llm import convolution, periodic_runs, queries
from tests.llm import plain


def words_with_runs(rnd):
    n, k = rnd.choice([0, 1, 5, 23, 24, 25, 60, 150, 300]), rnd.choice([1, 2, 3, 10, 1000])
    words = [rnd.randrange(k) for _ in range(n)]
    for _ in range(rnd.randrange(3)):
        if n > 3:
            a = rnd.randrange(n)
            p, end = 1 + rnd.randrange(max(1, (n - a) // 3)), rnd.randrange(a, n + 1)
            words[a:end] = [words[a + (i - a) % p] for i in range(a, end)]
    return words


@pytest.mark.parametrize(("factor", "least", "periods"), [(1, 24, 3), (2_000_000, 24, 3), (1, 1, 3), (1, 7, 4), (1, 50, 3)])
def test_runs_of_random_words(factor, least, periods):
    rnd = random.Random(factor + least)
    for _ in range(120):
        texts = [words_with_runs(rnd) for _ in range(rnd.randrange(1, 5))]
        first = np.append(0, np.cumsum([len(words) for words in texts]))
        codes = np.array([code * factor for words in texts for code in words], np.int64)
        got = periodic_runs.runs_of(codes, first, least, periods) if len(codes) else np.zeros((0, 3), int)
        want = [(s + a, s + a + n, q) for words, a in zip(texts, first.tolist()) for s, n, q in plain.runs(words, least, periods)]
        assert [tuple(run) for run in got.tolist()] == want


@pytest.mark.parametrize("top", [2, 5, 60_000, 1 << 40])
def test_occurrences_are_exact(top):
    """Also where the sums of squares are beyond one prime, or beyond all that 64 bits hold."""
    rng = np.random.default_rng(top)
    values = rng.integers(0, 3, 400) * (top // 3 + 1)
    starts = np.arange(0, 380, 8)
    block, place = convolution.occurrences(values, starts, 8, 1, 32)
    want = [(k, j) for k, s in enumerate(starts) for j in range(25) if np.array_equal(values[s : s + 8], values[s + 1 + j : s + 9 + j])]
    assert sorted(zip(block.tolist(), place.tolist())) == want


def test_a_zero_modulo_one_prime_is_no_occurrence():
    p = convolution.PRIMES[0][0]
    values = np.array([0, *[9] * 7, p, *[9] * 7, *[5] * 40])
    block, _ = convolution.occurrences(values, np.array([0]), 8, 8, 16)
    assert not len(block)
    assert (convolution._squared_differences(values[None, :8], values[None, 8:24], *convolution.PRIMES[0]) == 0).any()


def test_transforms_come_back():
    rng = np.random.default_rng(0)
    for p, root in convolution.PRIMES:
        for size in (2, 32, 1024):
            rows = rng.integers(0, p, (3, size)).astype(np.uint64)
            assert np.array_equal(convolution.restored(convolution.transformed(rows, p, root), p, root), rows)


def test_hard_texts_end_soon():
    """A million equal words, and a word of Fibonacci's, whose runs lie in runs."""
    a, b = [0], [0, 1]
    while len(b) < 30_000:
        a, b = b, b + a
    n = 1_000_000
    assert periodic_runs.runs_of(np.zeros(n, np.int64), np.array([0, n])).tolist() == [[0, n, 1]]
    own = b[:3000]
    got = periodic_runs.runs_of(np.array(own), np.array([0, 3000])).tolist()
    assert [(s, e - s, q) for s, e, q in got] == plain.runs(own)
    assert len(periodic_runs.runs_of(np.array(b), np.array([0, len(b)])))


def test_find(table, documents, empty):
    got = periodic_runs.find(table.withColumnRenamed("ids", "runs"))
    assert got.columns == [c for c in table.columns if c not in ("ids", "n_words")] + ["n_words", "runs", "collapsed"]
    rows = Counter((r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in got.collect())
    plain_rows = Counter()
    for key, text in documents:
        words = plain.WORDS.findall(text or "")
        if len(words) > 5000:
            continue
        found = plain.runs(words)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        plain_rows[key, len(words), tuple(found), " ".join(w for i, w in enumerate(words) if i not in gone)] += 1
    assert not plain_rows - rows and sum(rows.values()) == len(documents)
    assert periodic_runs.find(empty).count() == 0
    with pytest.raises(ValueError, match="three periods"):
        periodic_runs.find(table, periods=2)


def test_the_query_on_whole_documents(spark, table, documents):
    """Tails that repeat, by the hash of the id, and the digests."""
    short = table.filter("coalesce(length(text), 0) < 30000")
    short.write.mode("overwrite").parquet(folder := f"{queries.shared_folder(spark)}/documents.parquet")
    got = queries.op13_periodic_runs(spark, folder.removesuffix("/documents.parquet"))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = Counter(plain.periodic(key, text) for key, text in documents if len(text or "") < 30000)
    assert Counter(tuple(row) for row in got.collect()) == want
    assert sum(row[1] > 0 for row in want) > 20
