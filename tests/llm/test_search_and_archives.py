import base64
import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chirrup.llm import exact_search, warc
from chirrup.sources.tables import shared_folder
from tests.llm import plain


def test_exact_search(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(size=(900, 12)).astype(np.float32)
    values[400:500] = values[400]  # ties
    values[7] *= 1e3
    rows = [(k, v.tolist()) for k, v in enumerate(values)]
    strange = [(5000, None), (5100, [1.0, None]), (5200, [float("nan")] * 12), (5300, [float("inf")] * 12), (5400, []), (None, [9.0] * 12)]
    vectors = {k: np.floor(1024 * v.astype(float)).astype(np.int64) for k, v in enumerate(values)}
    want = plain.best(vectors | {10**9: np.full(12, 9216)}, [k for k in vectors if k % 100 == 0])
    want = Counter((q, rank, None if i == 10**9 else i, s) for q, rank, i, s in want)
    docs = spark.createDataFrame(rows + strange, "vec_id long, embedding array<float>")
    for size in (64, 1 << 14):
        got = exact_search.top_k(docs, "vec_id % 100 = 0", shard_rows=size)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert Counter(tuple(r) for r in got.collect()) == want
    assert exact_search.top_k(docs.limit(0), "vec_id % 100 = 0").count() == 0


def test_search_of_few_and_repeated_vectors(spark):
    docs = spark.createDataFrame([(0, [1.0, 2.0]), (0, [1.0, 2.0]), (3, [0.5, 0.5])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in exact_search.top_k(docs, "vec_id = 0").orderBy("rank").collect()]
    one, half = 1024**2 * 5, 1024 * 512 * 3
    assert Counter(got) == Counter({(0, 1, 0, one): 2, (0, 2, 3, half): 2})


@pytest.mark.parametrize("lengths", [1, 9])
def test_search_stops_on_proof(spark, lengths):
    """Less than half of the postings are read, a twentieth at most is scored again, and no row of the best is missing."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").select("embedding").collect()
    values = np.floor(1024 * np.array([r.embedding for r in rows], float)).astype(np.int64)
    values *= np.random.default_rng(1).integers(1, lengths + 1, len(values))[:, None]
    shard, read, left = exact_search.Shard(values), [], []
    for own in range(0, len(values), 20):
        found, postings = shard.best(values[own], 10, np.array([own]))
        scores = values @ values[own]
        scores[own] = scores.min() - 1
        assert set(np.flatnonzero(scores >= np.sort(scores)[-10])) <= set(found.tolist()) and own not in found
        read.append(postings / values.size)
        left.append(len(found) / len(values))
    assert np.mean(read) < 0.5 and max(left) <= 0.05


def test_search_leaves_out_no_length(spark):
    """Vectors of more than 65,536 lengths are too large for a test, so the plan must not bound their number."""
    docs = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<double>")
    plan = exact_search.top_k(docs, "vec_id = 0")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "Limit 65536" not in plan


def archived(spark, pages, least=0):
    path = f"{shared_folder(spark)}/archives"
    warc.write_archives(warc.resolved(pages, least_bytes=least), path)
    return warc.read_archives(spark, path).withColumn("page", F.regexp_extract("record_id", "page:(.*?):", 1)).collect()


def test_archives(spark):
    trap = "<p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n</p>é"
    rows = [(1, "u1", "same"), (5, "u5\r\nX: y", "same"), (3, None, "same"), (2, "u2", trap), (9, "u9", None), (4, "u4", ""), (5, "u5", "same"), (None, "u0", "same"), (6, "u6", "x" * 300_000)]
    pages = spark.createDataFrame([(*row, "extra") for row in rows], "page_id long, url string, html string, place string")
    got = archived(spark, pages)
    body = lambda html: (html or "").encode()
    digest = lambda html: base64.b32encode(hashlib.sha1(body(html)).digest()).decode()
    assert Counter((r.page, r.payload_bytes, r.payload_digest) for r in got) == Counter(("null" if k is None else str(k), len(body(h)), digest(h)) for k, _, h in rows)
    responses = {r.record_id: r for r in got if r.record_type == "response"}
    assert Counter(bytes(r.payload) for r in responses.values()) == Counter({body(h) for _, _, h in rows})
    assert all(responses[r.refers_to].payload_digest == r.payload_digest and r.payload is None for r in got if r.record_type == "revisit")
    assert [r.page for r in responses.values() if bytes(r.payload) == b"same"] == ["5"]
    assert [r.page for r in responses.values() if bytes(r.payload) == b""] == ["9"]
    assert all("\n" not in (r.target_uri or "") for r in got)


def test_small_payloads_can_stay_and_no_pages_make_no_records(spark):
    pages = spark.createDataFrame([(1, "a", "same"), (2, "b", "same")], "page_id long, url string, html string")
    assert {r.record_type for r in archived(spark, pages, least=5)} == {"response"}
    assert warc.resolved(pages.limit(0)).count() == 0


@pytest.mark.parametrize(("damage", "says"), [(lambda x: x.replace(b"same", b"sane"), "its header says"), (lambda x: x[:-6], "ends after"),
                                              (lambda x: x.replace(b"Length: 4\r", b"Length: 9\r"), "ends after")])
def test_damaged_archives_stop_the_job(spark, tmp_path, damage, says):
    pages = spark.createDataFrame([(1, "a", "same")], "page_id long, url string, html string")
    path = f"{shared_folder(spark)}/archives"
    warc.write_archives(warc.resolved(pages, least_bytes=0), path, compression="none")
    whole = spark.read.format("binaryFile").load(path).filter("length > 0").first()["content"]
    assert bytes(next(warc._parsed(bytes(whole)))[-1]) == b"same"
    (tmp_path / "damaged.warc").write_bytes(damage(bytes(whole)))
    with pytest.raises(Exception, match=says):
        warc.read_archives(spark, str(tmp_path)).collect()
