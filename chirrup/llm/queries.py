"""One query for each operator, over its whole table, and the SQL of those that SQL can express."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirrup.llm import (
    bpe_codec,
    exact_search,
    near_duplicates,
    packing,
    periodic_runs,
    pii,
    quality_crf,
    quality_rules,
    ranked_search,
    repeats,
    token_counts,
    toxicity,
    warc,
)
from chirrup.sources.tables import shared_folder

# The layout of the tables.
SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "embeddings": "vec_id long, embedding array<float>",
    "labels": "doc_id long, quality int, toxic int",
    "benchmark": "item_id long, text string",
}

MAX_TOKENS = 1024
MIN_QUALITY = 0.7
MIN_TOXICITY = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> Column:
    """Rows that teach no label."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 4 == 2, F.lit(False))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    base = F.filter("spans", lambda span: span["base"])
    return found.select(
        "doc_id",
        *(pii.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.joined_spans(base), 256).alias("base_sha256"),
        pii.joined_spans(F.col("spans")).alias("spans"),
    )


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.components(table(spark, sf_dir, "documents"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_codec.decode(bpe_codec.encode(docs, path, carry=["doc_id"]), path)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = repeats.remove_repeats(docs)
    words = F.array_remove(F.split(F.translate("text", "\t\n\x0b\x0c\r", "     "), " "), "")
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.array_join(words, " "), 256).alias("kept_sha256"))


def op5_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = quality_crf.fit(docs, labels.filter(~held_out()))
    scored = quality_crf.score(docs, model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= MIN_QUALITY).cast("int").alias("predicted")
    )


def piece_columns(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_columns(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"),
    )


def op8_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", k=10)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/archives"
    warc.write_archives(warc.resolved(table(spark, sf_dir, "pages")), path)
    page = lambda record: F.regexp_extract(record, "<urn:page:(-?[0-9]+):", 1).try_cast("long")
    return warc.read_archives(spark, path).select(
        page(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page(F.col("refers_to")).alias("refers_to"),
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.top_k(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= MIN_TOXICITY).cast("int").alias("predicted")
    )


def repeated_tails(docs: DataFrame) -> DataFrame:
    """`doc_id, text`; in one of ten documents, by the hash of its id, the words from a place on repeat with a period."""
    words = F.array_remove(F.split(F.translate(F.coalesce("text", F.lit("")), "\t\n\x0b\x0c\r", "     "), " "), "")
    hashed = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8"))
    hit = docs.select("doc_id", "text", hashed.alias("h"), F.floor(hashed / 10).alias("g"), F.when(hashed % 10 == 0, words).alias("words"))
    a = F.expr("g % size(words)").cast("int")
    rest = F.size("words") - a
    period = F.expr("1 + (size(words) - g % size(words)) div (3 + g % 8)").cast("int")
    unit = F.slice("words", a + 1, period)
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / period).cast("int"))), F.lit(1), rest)
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return hit.select("doc_id", F.when(F.size("words") > 0, changed).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(repeated_tails(table(spark, sf_dir, "documents")))
    strongest = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))),
        F.get("runs", F.lit(0)),  # of equal ones the first stays
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    best = found.select("doc_id", "runs", "collapsed", strongest.alias("best"), F.array_join(lines, "").alias("lines"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": op1_pii,
        "op2_near_duplicates": op2_near_duplicates,
        "op3_bpe_codec": op3_bpe_codec,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_quality_crf": op5_quality_crf,
        "op6_packing": op6_packing,
        "op7_token_counts": op7_token_counts,
        "op8_exact_search": op8_exact_search,
        "op9_quality_rules": op9_quality_rules,
        "op10_warc": op10_warc,
        "op11_ranked_search": op11_ranked_search,
        "op12_toxicity": op12_toxicity,
        "op13_periodic_runs": op13_periodic_runs,
    }


EXACT_SEARCH_SQL = """WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores) WHERE rank <= 10"""


RANKED_SEARCH_SQL = r"""WITH cut AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
lengths AS (SELECT doc_id, count(*)::BIGINT AS n FROM cut GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS texts, sum(n)::BIGINT AS terms FROM lengths),
uses AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM cut GROUP BY doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(texts) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM uses, total GROUP BY term),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
counted AS (SELECT item_id, term, count(*)::BIGINT AS repeats FROM asked GROUP BY item_id, term),
scores AS (
  SELECT item_id, doc_id,
         sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * texts) // terms))))::BIGINT AS score
  FROM counted JOIN weights USING (term) JOIN uses USING (term) JOIN lengths USING (doc_id), total
  GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0)
WHERE rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {"op8_exact_search": EXACT_SEARCH_SQL, "op11_ranked_search": RANKED_SEARCH_SQL}
