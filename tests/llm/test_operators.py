import itertools
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from chirrup.llm import bpe_codec, near_duplicates, packing, pii, quality_crf, quality_rules, repeats, token_counts
from chirrup.llm.common import stored, stored_alone
from chirrup.llm.fm_index import FmIndex, repeated_windows
from tests.llm import plain

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def counted(rows):
    return Counter(tuple(row) for row in rows)


def test_bpe_codec(table, documents, empty):
    whole = stored(table)
    got = bpe_codec.decode(bpe_codec.encode(whole, RANKS), RANKS)
    assert got.columns == [c for c in table.columns if c != "ids"] + ["ids", "decoded"]
    encoding = plain.multi_encoding()
    want = [(key, plain.little_endian(encoding.encode_ordinary(text or "")), (text or "").encode()) for key, text in documents]
    assert counted((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got.collect()) == counted(want)
    assert bpe_codec.encode(empty, RANKS).count() == 0


def test_decoding_of_nulls_and_of_no_ids(spark):
    ids = [None, b"", plain.little_endian(plain.multi_encoding().encode_ordinary("some é text")), None, b""] * 200
    docs = spark.createDataFrame(list(enumerate(ids)), "key long, ids binary").coalesce(1)
    got = {r.key: r.decoded for r in bpe_codec.decode(docs, RANKS).collect()}
    want = {None: None, b"": b""}
    assert all((None if got[k] is None else bytes(got[k])) == want.get(blob, "some é text".encode()) for k, blob in enumerate(ids))
    assert bpe_codec.decode(docs.limit(0), RANKS).count() == 0


def test_a_block_that_changes_between_readings_stops_the_job(spark):
    chance = F.udf(lambda: str(random.random())).asNondeterministic()
    docs = spark.range(2000).select(F.concat(F.lit("a "), chance()).alias("text"))
    with pytest.raises(Exception, match="changed between two readings"):
        bpe_codec.encode(docs, RANKS).collect()


def test_token_counts(table, documents, empty):
    want = counted(zip((key for key, _ in documents), map(len, plain.json_ids(text or "" for _, text in documents))))
    for frequent in (0, 100):
        got = token_counts.token_counts(table, JSON, out="n_words", frequent=frequent)
        assert got.columns == table.columns
        assert counted((r.doc_id, r.n_words) for r in got.collect()) == want
    assert token_counts.token_counts(empty, JSON).count() == 0


@pytest.mark.parametrize("targets", [None, {"s": 3.0, None: 1.0}, {"s": 1.0}])
def test_packing(table, documents, targets):
    pieces = packing.pack(table, JSON, targets, window_tokens=4096).collect()
    ids = Counter((key, plain.little_endian([*found, 0])) for (key, _), found in zip(documents, plain.json_ids(text or "" for _, text in documents)))
    sequences, open_docs = {}, Counter()
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert len(p.ids) == 4 * p.length
    for parts in sequences.values():
        ends = [offset + length for offset, length in sorted(parts)]
        assert [offset for offset, _ in sorted(parts)] == [0, *ends[:-1]]
    sizes = [sum(length for _, length in sequences[k]) for k in sorted(sequences)]
    full = sum(size == 1024 for size in sizes)
    assert sizes[:full] == [1024] * full and all(size & (size - 1) == 0 for size in sizes[full:])
    by_size = sum(n * len(blob) // 4 for (_, blob), n in ids.items())
    assert sum(sizes) == by_size
    unique = {key: blob for (key, blob), n in ids.items() if n == 1 and key is not None}
    for key, blob in unique.items():
        own = sorted((p.start, bytes(p.ids)) for p in pieces if p.doc_id == key)
        assert b"".join(part for _, part in own) == blob


def test_packing_keeps_the_mixture(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "if(id % 3 = 0, 'a', 'b') as source", "repeat('word ', 50) as text")
    pieces = packing.pack(docs, JSON, window_tokens=8192).join(docs, "doc_id")
    shares = pieces.groupBy(F.floor(F.col("sequence_id") / 8).alias("w"), "source").agg(F.sum("length").alias("n")).collect()
    last = max(r.w for r in shares)
    assert all(abs(r.n / 8192 - (1 / 3 if r.source == "a" else 2 / 3)) < 0.02 for r in shares if r.w < last)
    assert packing.pack(docs.limit(0), JSON).count() == 0


def test_pii_base(table, documents, empty):
    got = pii.find(table)
    assert got.columns == [c for c in table.columns if c != "spans"] + ["spans"]
    base = got.select("doc_id", pii.joined_spans(F.filter("spans", lambda s: s["base"])).alias("s"))
    assert counted(base.collect()) == counted((key, plain.base_spans(text or "")) for key, text in documents)
    assert pii.find(empty).count() == 0


def test_pii_learns_from_contexts(spark):
    known = [(k, f"please write mail to user{k}@example{k}.com today") for k in range(8)]
    other = [(100 + k, f"the shop sold item{k}x9 of kind number part{k}z") for k in range(8)]
    docs = spark.createDataFrame([*known, (50, "please write mail to someone@localhost9, thanks"), (51, "item77 stays"), *other], "doc_id long, text string")
    found = {r.doc_id: (r.s, r.t) for r in pii.find(docs).select("doc_id", pii.joined_spans(F.col("spans")).alias("s"), pii.redacted(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert found[50] == ("email:21:39", "please write mail to <EMAIL>, thanks")
    assert found[51][0] == "" and all(found[key][0] == "" for key, _ in other)
    assert found[3][1] == "please write mail to <EMAIL> today"


def test_pii_context_is_the_text_before_the_match(spark):
    known = [f"order 77 from user{k}@example{k}.com came" for k in range(4)]
    known += [f"reader{k}@example{k}.com wrote" for k in range(4)]
    known += [f"Contact writer{k}@example{k}.com today" for k in range(4)]
    known += [f"members of staff are: one{k}@example{k}.com (two{k}@example{k}.com) three{k}@example{k}.com four{k}@example{k}.com" for k in range(4)]
    words = ["order 77 from alice@localhost1", "bob@localhost2 wrote", "Contact carol@localhost3 today", "members of staff are: dave@localhost4 (erin@localhost5) frank@localhost6", "order 77 sent item5x"]
    docs = spark.createDataFrame(list(enumerate(known + words)), "doc_id long, text string").orderBy("doc_id")
    out = pii.find(docs).select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("t"))
    found = [r.t for r in sorted(out.collect()) if r.doc_id >= len(known)]
    assert found == ["order 77 from <EMAIL>", "<EMAIL> wrote", "Contact <EMAIL> today", "members of staff are: <EMAIL> (<EMAIL>) <EMAIL>", "order 77 sent item5x"]


def test_pii_goes_on_while_patterns_are_new(spark):
    """The pattern of each zone is confident once the last zone's identifiers are known."""
    new = lambda zone: [f"n{zone}y{j}@localhost" for j in range(3)]
    texts = [f"zone{zone} mail {x}" for k, zone in enumerate("abcdef") for x in [f"user{j}@example.com" for j in range(9 + 3 * (k == 0))] + new(zone) + (new("abcdef"[k - 1]) if k else [])]
    out = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert out.filter("size(spans) = 1").count() == len(texts)
    assert pii.find(out.drop("spans"), rounds=3).filter("size(spans) = 1").count() < len(texts)


def test_pii_candidates_of_several_words_and_any_length(spark):
    texts = [f"my card 4111 1111 1111 1111 {x}" for x in "ab"] + ["my card 4012 8888 8888 1881 c", "my card 5555 5555 5555 4444 d", "my card 3782 8224 6310 005 e"]
    texts += [f"write to user{k}@example.com" for k in range(4)]
    last = ["my card 4111 1111 1111 1112, thanks", f"write to {'x' * 300}@localhost"]
    docs = spark.createDataFrame(list(enumerate(texts + last)), "doc_id long, text string")
    found = {r.doc_id: r.t for r in pii.find(docs).select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert [found[len(texts) + k] for k in (0, 1)] == ["my card <CARD>, thanks", "write to <EMAIL>"]


def test_pii_contexts_against_the_text(table, documents):
    texts = {key: text or "" for key, text in documents}
    rows, each = pii.occurrences(table.filter("doc_id is not null"), "text", ["doc_id"])
    found = each.join(rows, "_row").selectExpr("_own_0 as key", "match", "start", "end", "context").collect()
    assert len(found) > 1000
    for r in found:
        before = texts[r.key][: r.start]
        assert texts[r.key][r.start : r.end] == r.match and before.endswith(r.context)
        assert r.context == before or len(r.context) >= 100 or len(plain.WORDS.findall(r.context)) > 1


def test_near_duplicates(table, documents, empty):
    assert counted(near_duplicates.components(table).collect()) == counted(plain.classes(documents))
    assert near_duplicates.components(empty).count() == 0


def test_near_duplicates_without_a_common_original(spark):
    rows, base = [], [f"v{k}" for k in range(300)]
    for k in range(40):
        words = list(base)
        for j in range(6):
            words[(37 * k + 11 * j) % 300] = f"x{k}_{j}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, " ".join(base[:60]) + " " + " ".join(f"u{k}_{j}" for j in range(80))) for k in range(40)]
    got = near_duplicates.components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert counted(got.collect()) == counted(plain.classes(rows))


def test_near_duplicates_compare_few_long_texts(spark, monkeypatch):
    """Long texts that share a quarter meet in many buckets, but hardly a pair takes its texts along."""
    frames = []
    monkeypatch.setattr(near_duplicates, "stored_alone", lambda df: frames.append(stored_alone(df)) or frames[-1])
    passage = " ".join(f"p{k}" for k in range(2000))
    rows = [(k, " ".join([passage, *(f"t{k}_{j}" for j in range(6000))])) for k in range(24)]
    rows.append((100, rows[7][1].replace("t7_3000", "other")))
    # Sizes on both sides of a change in the number of cells.
    rows += [(200 + k, " ".join(f"s{j}" for j in range(4 + 1024 + 2 * k))) for k in range(-3, 4)]
    got = near_duplicates.components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert counted(got.collect()) == counted(plain.classes(rows))
    assert sum(df.count() for df in frames if "linked" in df.columns) < 24


@pytest.mark.parametrize("hot_runs", [3, repeats.HOT_RUNS])
def test_repeats(table, documents, hot_runs):
    got = repeats.remove_repeats(table, hot_runs=hot_runs)
    assert got.columns == [c for c in table.columns if c != "n_words"] + ["n_words", "n_removed"]
    want = [(key, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)) for (key, _), (words, gone) in zip(documents, plain.removed([t for _, t in documents]))]
    assert counted((r.doc_id, r.n_words, r.n_removed, " ".join(plain.WORDS.findall(r.text))) for r in got.collect()) == counted(want)


def test_repeats_around_a_hot_passage(spark):
    """A passage in many texts, whose neighbours differ, come in few kinds, or are the same: all three ways are taken."""
    rnd = random.Random(3)
    passage, word = [f"p{k}" for k in range(50)], lambda n: f"w{rnd.randrange(n)}"
    texts = [" ".join([*(word(500) for _ in range(20)), *passage, *(word(4) for _ in range(3)), *(word(500) for _ in range(20))]) for _ in range(60)]
    texts += ["z " * 90, "z " * 90 + "y", " ".join(passage)]
    docs = spark.createDataFrame([(k, text) for k, text in enumerate(texts)], "doc_id long, text string")
    want = [(k, len(words), sum(gone)) for k, (words, gone) in enumerate(plain.removed(texts))]
    for hot_runs in (0, 2, 30, 200):
        got = repeats.remove_repeats(docs, hot_runs=hot_runs)
        assert counted((r.doc_id, r.n_words, r.n_removed) for r in got.collect()) == counted(want)


def test_own_columns_with_the_names_of_helpers_stay(spark):
    names = ["_key", "_marks", "_text_key", "_kept", "_text", "_good", "_own_0"]
    docs = spark.range(8).selectExpr("id as doc_id", "repeat('the same words in a line ', 20) as text", *(f"id as `{name}`" for name in names))
    got = repeats.remove_repeats(docs)
    assert got.columns == [*docs.columns, "n_words", "n_removed"]
    assert all(r[name] == r.doc_id and r.n_removed == 120 for r in got.collect() for name in names)
    labels = spark.range(8).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "id as _key", "id as _good")
    assert quality_crf.fit(docs, labels).prior == 0.5


def test_windows_are_searched_in_few_steps(monkeypatch):
    """A repeated passage with changed words and one long copy: the steps do not grow with the windows of a sequence."""
    rng = np.random.default_rng(4)
    passage = rng.integers(1, 500, 60)
    sequences = [np.concatenate([rng.integers(1, 5000, 20), passage, rng.integers(1, 5000, 20)]) for _ in range(30)]
    for own in sequences[::3]:
        own[rng.integers(0, len(own), 2)] = 7
    sequences += [rng.integers(1, 5000, n) for n in (3, 35, 36)] + [np.tile([1, 2, 3], 40), np.full(90, 5)]
    sequences += [rng.integers(1, 5000, 2000)] * 2
    weights = rng.integers(1, 3, len(sequences)) * (np.arange(len(sequences)) % 5 == 0) + 1
    flat, first = np.concatenate(sequences), np.append(0, np.cumsum([len(own) for own in sequences]))
    joined = np.insert(flat, first[1:], 0)
    index = FmIndex(joined, np.insert(np.repeat(weights, np.diff(first)), first[1:], 0), 35)
    held = [(a + i, own[i : i + 35].tobytes(), weight) for own, a, weight in zip(sequences, first, weights) for i in range(len(own) - 34)]
    uses = Counter()
    for _, words, weight in held:
        uses[words] += weight
    calls, step = [], index.step
    monkeypatch.setattr(index, "step", lambda *lanes: calls.append(len(lanes[0])) or step(*lanes))
    got = repeated_windows(index, flat, first, 35)
    assert np.flatnonzero(got).tolist() == [place for place, words, _ in held if uses[words] > 1]
    assert len(calls) < 500


def test_repeats_of_nothing(empty):
    assert repeats.remove_repeats(empty).count() == 0


def test_quality_rules(table, documents, empty):
    got = quality_rules.judge(table, carry=["doc_id"]).collect()
    want = counted((key, *plain.quality_counts(text or "")) for key, text in documents)
    assert counted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)
    assert quality_rules.judge(empty).count() == 0


def test_quality_verdicts(spark, table):
    scales = {rule: (10 if rule == "word_length" else 1000, events) for rule, events in quality_rules.RULES.items()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source").unionByName(table.select("doc_id", "text", "lang", "source"))
    rows = docs.collect()
    want = plain.quality_kept([(r.text, r.lang, r.source) for r in rows], scales)
    got = quality_rules.judge(docs, carry=["doc_id"]).collect()
    assert counted((r.doc_id, r.kept) for r in got) == counted(zip((r.doc_id for r in rows), want))
    assert 0 < sum(want) < sum(not r.base_failed for r in got)


def test_quality_limits_do_not_jump_with_the_size_of_a_group(spark):
    """With 99 or 101 texts a group has the same limit; with many more it is its own. Ten of the texts probe the limit."""
    word = "concat(if(x <= k, 'w#', 'w'), lpad(pmod(hash(doc_id, x), 1000), 3, '0'))"
    verdicts = []
    for size in (99, 101, 800):
        marked = f"if(id < {size - 10}, 10, if(id < {size}, 10 + 2 * (id - {size - 10}), 0)) + if(id < {size - 10} or id >= {size}, pmod(id, 2), 0)"
        docs = spark.range(3000).selectExpr("id as doc_id", "'en' as lang", f"if(id < {size}, 'notes', 'prose') as source", f"{marked} as k")
        docs = docs.selectExpr("*", f"concat_ws(' ', transform(sequence(1, 80), x -> {word})) as text")
        verdicts.append(sum(r.kept for r in quality_rules.judge(docs).collect() if size - 10 <= r.doc_id < size))
    assert verdicts[0] == verdicts[1] != verdicts[2]


def test_quality_thresholds_adapt(spark):
    prose = "concat_ws(' ', transform(sequence(1, 80), x -> concat('w', hash(id, x))))"
    docs = spark.range(600).selectExpr(
        "id as doc_id", "'en' as lang", "if(id < 300, 'prose', 'code') as source",
        f"if(id >= 300 or id = 7, concat_ws(' ', transform(split({prose}, ' '), w -> concat('<', w, '>'))), {prose}) as text",
    )
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    assert not kept[7] and sum(kept.values()) == 599


def test_quality_limits_follow_the_group_both_ways(spark):
    """Two symbols in a hundred characters are usual in one source and far above the other's limit."""
    plain_word, marked = "concat('w', lpad(pmod(hash(id, x), 10000), 4, '0'))", "concat('w#', lpad(pmod(hash(id, x), 1000), 3, '0'))"
    docs = spark.range(600).selectExpr(
        "id as doc_id", "'en' as lang", "if(id < 300, 'prose', 'notes') as source",
        f"concat_ws(' ', transform(sequence(1, 80), x -> if((id >= 300 or id = 7) and x % 10 = 0, {marked}, {plain_word}))) as text",
    )
    judged = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert judged[7].n_symbols == judged[300].n_symbols == 8 and judged[7].word_chars == 400
    assert not judged[7].kept and all(r.kept for key, r in judged.items() if key != 7)


def test_quality_rules_against_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality_rules.judge(docs, carry=["doc_id"]).filter("not base_failed").join(labels, "doc_id").collect()
    good = [r.kept for r in judged if r.quality == 1]
    assert sum(good) >= 0.98 * len(good) and not any(r.kept for r in judged if r.quality == 0)


def test_quality_crf(spark, table, empty):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = quality_crf.fit(docs, labels.filter(~held), documents=1024)
    scored = quality_crf.score(docs.join(labels.filter(held), "doc_id"), model).collect()
    assert sum((r.score >= 0.7) == (r.quality == 1) for r in scored) > 0.98 * len(scored)
    rows = quality_crf.score(table, model, out="spans").collect()
    assert all(0 <= r.spans <= 1 for r in rows)
    assert quality_crf.score(empty, model).count() == 0


def test_quality_crf_learns_from_long_texts(spark):
    """All labelled texts are longer than the bounds on lines, on characters, or both."""
    text = "array_join(transform(sequence(1, 90), x -> if(id % 2 = 0, 'some words of plain prose in a line', '#$%& ||| ### 12 *** <<>> $$')), if(id < 20, '\n', ' '))"
    docs = spark.range(40).selectExpr("id as doc_id", f"repeat({text}, if(id < 10, 1, 30)) as text")
    labels = spark.range(40).selectExpr("id as doc_id", "cast(id % 2 = 0 as int) as quality")
    model = quality_crf.fit(docs, labels)
    assert all((r.score >= 0.7) == (r.doc_id % 2 == 0) for r in quality_crf.score(docs, model).collect())
    with pytest.warns(UserWarning, match="no two labels"):
        quality_crf.fit(docs, labels.filter("quality = 1"))


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    logits, chain, first = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([0, 4, 4, 9])
    chances, joint = quality_crf.marginals(logits, chain, first)
    total = np.zeros((2, 2))
    for a, b in ((0, 4), (4, 9)):
        paths = list(itertools.product((0, 1), repeat=b - a))
        weight = np.array([np.exp(sum((s - 0.5) * x for s, x in zip(path, logits[a:b])) + sum(chain[s, t] for s, t in zip(path, path[1:]))) for path in paths])
        weight /= weight.sum()
        assert np.allclose(chances[a:b], [sum(w for w, path in zip(weight, paths) if path[k]) for k in range(b - a)])
        for w, path in zip(weight, paths):
            for s, t in zip(path, path[1:]):
                total[s, t] += w
    assert np.allclose(joint, total)
