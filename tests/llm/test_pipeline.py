from pyspark.sql import functions as F

import corpus_pipeline
from chirrup.llm.common import stored
from chirrup.llm.queries import table
from tests.llm import plain

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_against_plain_python(spark):
    docs, seen = table(spark, SF_DIR, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        seen.append(docs)
        docs = stored(stage(spark, docs, SF_DIR))
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
            assert docs.filter(F.char_length("text") != F.col("n_chars")).isEmpty()
    raw, good, single, clean, safe = map(rows, seen)
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    known = [key for key in raw if key in labels]
    assert sum((key in good) == (labels[key] == 1) for key in known) >= 0.97 * len(known)
    assert set(single) == {key for key, _, least in plain.classes(list(good.items())) if key == least}
    want = [" ".join(w for w, g in zip(words, gone) if not g) for words, gone in plain.removed(list(single.values()))]
    assert [" ".join(plain.WORDS.findall(clean[key])) for key in single] == want
    assert {key for key in clean if clean[key] != safe[key]} >= {key for key in clean if plain.base_spans(clean[key])}
    ids = dict(zip(safe, plain.json_ids(safe.values())))
    pieces = docs.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert {r.doc_id: r.n for r in pieces} == {r.doc_id: r["all"] for r in pieces} == {key: len(x) + 1 for key, x in ids.items()}


def test_repeated_rows_and_rows_without_a_key(spark):
    text = " ".join(f"w{k}" for k in range(60))
    values = [(1, text), (1, text), (2, text + " more"), (None, "no key"), (3, None), (3, None)]
    docs = spark.createDataFrame([(k, t, "en", None, None) for k, t in values], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.one_of_each_class(spark, stored(docs), SF_DIR).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, "no key"), (1, text), (3, "")]
